"""Tables: appended Parquet folders, and catalogue tables that are replaced or merged.

Append tables are folders partitioned by batch (bronze by load day and batch), so parallel writers never share a partition
and a batch that is written again replaces itself.

Tables that are replaced or merged live in the session's catalogue.  A name is a view of the table written last; writing
makes a new managed table and then points the view at it, so readers of the old one finish undisturbed and a job that dies
half way changes nothing.  Marks and load times are properties of that view.  A replaced table may be clustered into buckets
by its business key, so joins on the key need no exchange.  A merged table is partitioned by key bucket: only the buckets
an increment touches are read and overwritten, in place.  One writer per table is assumed; between applications the
catalogue must be a lasting one (a metastore).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..session import shared_dir

__all__ = ["path_exists", "file_paths", "local_table", "append_bronze", "append_batch", "read_bronze", "ConcurrentWrite", "Version",
           "open_database", "work_table", "drop_database", "table_name", "table_property", "set_property", "current_version", "overwrite_table", "create_merged", "merge_table", "Merged",
           "read_table", "table_exists", "written_versions", "cluster_count", "truncate_reload", "stage_table", "drop_table", "compact_table", "require_success",
           "expire_snapshots", "reset_gold"]

BATCH, DAY = "_batch", "_load_date"
BUCKET = "_key_bucket"


class ConcurrentWrite(RuntimeError):
    """Another version was written since the one this write started from."""


def path_exists(spark: SparkSession, path: str) -> bool:
    return file_paths(spark, path) is not None


def file_paths(spark: SparkSession, path: str) -> list[str] | None:
    """The files below ``path``, empty ones too, from the listing that any read makes; None where there is no such path."""
    try:
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return [unquote(f) for f in listed.inputFiles()]


# ---------------------------------------------------------------- appended folders

def append_bronze(df: DataFrame, path: str, batch: str | None = None) -> None:
    """Append one batch; new columns are allowed, older files then read as NULL in them.  An empty frame writes nothing.

    A batch with a name replaces what was written under that name before, so a retry does not load rows twice.  Rows with
    a load day are laid out by it first, so that later reads can leave days out.
    """
    if df.columns and not df.isEmpty():
        append_batch(df, path, batch)


def append_batch(df: DataFrame, path: str, batch: str | None = None) -> None:
    """Write ``df`` as partitions of its own: by load day, if it has one, and batch."""
    name = re.sub(r"[^A-Za-z0-9.-]", "-", batch) if batch else uuid.uuid4().hex
    layout = [c for c in (DAY, BATCH) if c == BATCH or c in df.columns]
    writer = df.withColumn(BATCH, F.lit(f"b-{name}")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*layout).parquet(path)


def read_bronze(spark: SparkSession, path: str, since=None) -> DataFrame:
    """All appended batches under the union of their columns.

    With ``since`` only load days from that one on are listed, opened and read (rows without a load day never are).
    """
    reader = spark.read.option("mergeSchema", "true").option("basePath", path)
    if since is None:
        return reader.parquet(path).drop(BATCH)
    days = {m[1] for f in file_paths(spark, path) if (m := re.search(f"/{DAY}=([0-9-]+)/", f)) and m[1] >= str(since)}
    if not days:
        return reader.parquet(path).where(F.lit(False)).drop(BATCH)
    return reader.parquet(*[f"{path}/{DAY}={day}" for day in sorted(days)]).where(F.col(DAY) >= F.lit(since).cast("date")).drop(BATCH)


def local_table(spark: SparkSession, rows: Sequence[Sequence], ddl: str) -> DataFrame:
    """A small literal table as a local relation.

    Unlike a frame made from Python rows its exact size is known to Catalyst, so a join broadcasts it and never the
    other side.
    """
    fields = StructType.fromDDL(ddl).fields

    def literal(value) -> str:
        if value is None:
            return "NULL"
        if isinstance(value, bool) or isinstance(value, (int, float)):
            return str(value)
        return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"

    columns = ", ".join(f"CAST(v.c{i} AS {f.dataType.simpleString()}) AS `{f.name}`" for i, f in enumerate(fields))
    names = ", ".join(f"c{i}" for i in range(len(fields)))
    lines = rows or [[None] * len(fields)]
    values = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in lines)
    return spark.sql(f"SELECT {columns} FROM VALUES {values} AS v({names})" + ("" if rows else " WHERE false"))


# ---------------------------------------------------------------- catalogue tables

def open_database(spark: SparkSession, name: str, location: str | None = None) -> str:
    """Make sure the database exists; its tables live below ``location``, or below the shared folder."""
    name = re.sub(r"[^a-z0-9_]", "_", name.lower())
    location = location or f"{shared_dir(spark)}/boxledger/{name}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{location}'")
    return name


def work_table(spark: SparkSession, purpose: str) -> str:
    """A fresh table name in a database of this application; nothing is written yet."""
    database = open_database(spark, f"work_{spark.sparkContext.applicationId}")
    return table_name(database, f"{purpose}_{uuid.uuid4().hex[:12]}")


def drop_database(spark: SparkSession, name: str) -> None:
    """Remove the database with the data of all its tables."""
    spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")


def table_name(database: str, name: str) -> str:
    return f"{database}.{re.sub(r'[^a-z0-9_]', '_', name.lower())}"


@dataclass(frozen=True)
class Version:
    """What a name points at."""

    number: int
    physical: str
    committed_at: datetime
    mark: datetime | None
    buckets: str | None
    cluster_by: tuple[str, ...]


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def _moment(text: str | None) -> datetime | None:
    return datetime.fromisoformat(text) if text else None


def current_version(spark: SparkSession, table: str) -> Version | None:
    if not spark.catalog.tableExists(table):
        return None
    p = _properties(spark, table)
    return Version(int(p["number"]), p["physical"], _moment(p["committed_at"]), _moment(p.get("mark")), p.get("buckets"),
                   tuple(c for c in p.get("cluster_by", "").split(",") if c))


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def table_property(spark: SparkSession, table: str, name: str) -> str | None:
    return _properties(spark, table).get(name)


def set_property(spark: SparkSession, table: str, name: str, value: str) -> None:
    """Remember a value with a table; it is lost when the table is replaced."""
    _set(spark, "VIEW", table, {name: value})


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _set(spark: SparkSession, kind: str, table: str, values: Mapping[str, str | None]) -> None:
    spark.sql(f"ALTER {kind} {table} SET TBLPROPERTIES ({', '.join(f'{_literal(k)} = {_literal(v)}' for k, v in values.items() if v is not None)})")


def cluster_count(*frames: DataFrame, rows_each: int = 1 << 19) -> int:
    """Buckets for tables that are clustered alike: a power of two, so that one of the largest has about ``rows_each`` rows.

    Rows of a Parquet table are counted from its footers.
    """
    largest = max(df.count() for df in frames)
    return max(8, 1 << max(0, -(-largest // rows_each) - 1).bit_length())


def overwrite_table(df: DataFrame, table: str, as_of: datetime, mark: datetime | None = None, cluster_by: Sequence[str] = (),
                    clusters: int | None = None, expected: int | None = None, buckets: str | None = None) -> None:
    """Replace the table, schema included; it may be made from itself.

    ``cluster_by`` clusters the rows by hash of these columns into ``clusters`` buckets, sorted: joins and groupings on
    them read the table without an exchange, if both tables have as many.  A bucket is written, sorted and read by one
    task, so without ``clusters`` the rows are staged and counted first (see :func:`cluster_count`).
    ``buckets`` (see :func:`create_merged`) lays it out for merges instead.
    The version that is written last wins, whatever its ``as_of``.  With ``expected``, the number of the version that
    ``df`` was made from (0: none), the write fails if another one was written since.
    """
    spark = df.sparkSession
    database, name = table.split(".")
    physical = f"{database}.{name}__{uuid.uuid4().hex}"
    if buckets:
        bucketed = df.withColumn(BUCKET, F.expr(buckets))
        bucketed.hint("rebalance", BUCKET).write.format("parquet").partitionBy(BUCKET).saveAsTable(physical)
    else:
        rows, staged = df, None
        if cluster_by:
            if clusters is None:
                staged = work_table(spark, "clustering")
                rows = stage_table(df, staged)
                clusters = cluster_count(rows)
            rows = rows.repartition(clusters, *cluster_by)
        writer = rows.write.format("parquet")
        if cluster_by:
            writer = writer.bucketBy(clusters, *cluster_by).sortBy(*cluster_by)
        writer.saveAsTable(physical)
        if staged:
            drop_table(spark, staged)
    last = current_version(spark, table)
    number = last.number if last else 0
    if expected is not None and number != expected:
        spark.sql(f"DROP TABLE {physical}")
        raise ConcurrentWrite(f"{table} is at version {number}, not {expected}")
    facts = {"number": str(number + 1), "physical": physical, "committed_at": as_of.isoformat(), "mark": mark.isoformat() if mark else None,
             "buckets": buckets, "cluster_by": ",".join(cluster_by)}
    _set(spark, "TABLE", physical, facts)
    shown = ", ".join(f"{_literal(k)} = {_literal(v)}" for k, v in facts.items() if v is not None)
    columns = ", ".join(f"`{c}`" for c in df.columns)
    spark.sql(f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ({shown}) AS SELECT {columns} FROM {physical}")


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """The table as last written."""
    if not spark.catalog.tableExists(table):
        raise FileNotFoundError(f"no table {table}")
    return spark.table(table)


def drop_table(spark: SparkSession, table: str) -> None:
    """Remove a name and every table written under it, or a staged table."""
    if not spark.catalog.tableExists(table):
        return
    if spark.catalog.getTable(table).tableType == "VIEW":
        old = written_versions(spark, table)
        spark.sql(f"DROP VIEW {table}")
        for physical in old:
            spark.sql(f"DROP TABLE {physical}")
    else:
        spark.sql(f"DROP TABLE {table}")


def written_versions(spark: SparkSession, table: str) -> list[str]:
    """All physical tables under a name."""
    database, name = table.split(".")
    names = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {database} LIKE '{name}__*'").collect()]
    return [f"{database}.{n}" for n in names if re.fullmatch(re.escape(name) + "__[0-9a-f]{32}", n)]


def truncate_reload(df: DataFrame, table: str, as_of: datetime) -> int:
    """Empty and reload in full; returns the rows written, counted by the write itself."""
    seen = Observation()
    overwrite_table(df.observe(seen, F.count(F.lit(1)).alias("n")), table, as_of)
    return seen.get["n"]


def stage_table(df: DataFrame, table: str) -> DataFrame:
    """Materialise a query that several steps read, dropping what was staged before.

    A managed table in the shared folder, so it survives the loss of an executor; :func:`drop_table` gives it back.
    """
    spark = df.sparkSession
    df.write.format("parquet").mode("overwrite").saveAsTable(table)
    return spark.table(table)


# ---------------------------------------------------------------- merges by key bucket

def create_merged(df: DataFrame, table: str, keys: Sequence[str], as_of: datetime, mark: datetime | None = None, n_buckets: int = 64,
                  bucket_expr: str | None = None, expected: int | None = None) -> None:
    """Write a table that :func:`merge_table` can change bucket by bucket.

    A row's bucket is a hash of its keys, or ``bucket_expr`` (an integer in SQL over key columns): with ids that are given
    in order, ``order_id div 1000000`` keeps an increment of recent ids in few buckets.  NULL counts as bucket -1.
    """
    text = bucket_expr or f"pmod(xxhash64({', '.join(f'`{k}`' for k in keys)}), {n_buckets})"
    overwrite_table(df, table, as_of, mark, expected=expected, buckets=f"coalesce(cast({text} as int), -1)")


def _as(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema`` in its order and types; a value that does not fit its type stops the write."""
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])


@dataclass(frozen=True)
class Merged:
    """What a merge did: buckets read and overwritten, and rows in them before and after and in the increment."""

    buckets: tuple[int, ...]
    rows_before: int
    rows_after: int
    rows_arrived: int


def merge_table(table: str, source: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame], as_of: datetime,
                mark: datetime | None = None) -> Merged:
    """Change the table by ``combine(its rows in the buckets of source, source)``, for example an upsert.

    Only those buckets are read (a partition filter) and overwritten (dynamic partition overwrite); the files of all other
    buckets stay as they are.  ``combine`` must keep at least one row in each bucket, which upserts and delete-and-insert
    do.  Rows take the table's types.  Merging the same increment again gives the same table, so a run that died half way is simply repeated: the mark is
    set last.  Only bucket numbers come to the driver.  The row counts are observed by the write and may be too high after
    lost executors; they are for logs.
    """
    spark = source.sparkSession
    version = current_version(spark, table)
    arriving = source.withColumn(BUCKET, F.expr(version.buckets))
    touched = tuple(sorted(r[0] for r in arriving.select(BUCKET).distinct().collect()))
    if not touched:
        return Merged((), 0, 0, 0)
    before, arrived, after = Observation(), Observation(), Observation()
    count = F.count(F.lit(1)).alias("n")
    held = spark.table(version.physical).where(F.col(BUCKET).isin(*touched)).drop(BUCKET).observe(before, count)
    combined = _as(combine(held, _as(source, held.schema).observe(arrived, count)), held.schema)
    bucketed = combined.withColumn(BUCKET, F.expr(version.buckets)).observe(after, count)
    place = spark.sql(f"DESCRIBE EXTENDED {version.physical}").where("col_name = 'Location'").first()["data_type"]
    bucketed.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(place)
    spark.sql(f"ALTER TABLE {version.physical} RECOVER PARTITIONS")
    spark.catalog.refreshTable(version.physical)
    _set(spark, "VIEW", table, {"committed_at": as_of.isoformat(), "mark": mark.isoformat() if mark else None, "number": str(version.number + 1)})
    return Merged(touched, before.get["n"], after.get["n"], arrived.get["n"])


# ---------------------------------------------------------------- maintenance

def _bytes(spark: SparkSession, physical: str) -> int:
    spark.sql(f"ANALYZE TABLE {physical} COMPUTE STATISTICS NOSCAN")
    shown = spark.sql(f"DESCRIBE EXTENDED {physical}").where("col_name = 'Statistics'").first()
    return int(shown["data_type"].split()[0]) if shown else 0


def compact_table(spark: SparkSession, tables: Mapping[str, str], as_of: datetime,
                  target_bytes: int = 256 * 1024 * 1024) -> DataFrame:
    """Rewrite each table into files of about ``target_bytes``, in the layout it has; a clustered one has a file per bucket.

    Every table is attempted; the returned log says which failed, :func:`require_success` then stops the job.
    """
    log = []
    for name, table in tables.items():
        try:
            version = current_version(spark, table)
            if version is None:
                raise FileNotFoundError(f"no table {table}")
            whole = spark.table(table)
            files = cluster_count(whole) if version.cluster_by else max(1, -(-_bytes(spark, version.physical) // target_bytes))
            packed = whole if version.buckets or version.cluster_by else whole.repartition(files)
            overwrite_table(packed, table, as_of, version.mark, version.cluster_by, files, expected=version.number, buckets=version.buckets)
            log.append((name, files, "Succeeded", ""))
        except Exception as problem:  # one broken table must not stop the others
            log.append((name, 0, "Failed", str(problem)))
    return local_table(spark, log, "table_name string, files int, status string, message string")


def require_success(log: DataFrame) -> None:
    failed = [r["table_name"] for r in log.where("status = 'Failed'").select("table_name").collect()]
    if failed:
        raise RuntimeError(f"maintenance failed for {len(failed)} table(s): {', '.join(sorted(failed))}")


def expire_snapshots(spark: SparkSession, table: str, retain_hours: int, as_of: datetime) -> list[str]:
    """Drop tables that were superseded under this name more than ``retain_hours`` ago; the current one always stays.

    Only table properties come to the driver: one set per load, bounded by the number of loads in the retention.
    """
    written = [(int(p["number"]), _moment(p["committed_at"]), physical) for physical in written_versions(spark, table)
               if "number" in (p := _properties(spark, physical))]
    limit = as_of - timedelta(hours=retain_hours)
    current = current_version(spark, table).physical
    rows = sorted(written)
    # A table is superseded when its successor was written; merges change the current one only.
    expired = [old for (_, _, old), (_, when, _) in zip(rows, rows[1:]) if when < limit and old != current]
    for physical in expired:
        spark.sql(f"DROP TABLE {physical}")
    return expired


def reset_gold(spark: SparkSession, tables: Mapping[str, str], as_of: datetime,
               keep: Sequence[str] = ("dim_date", "recon_note", "user_venue", "privileged_users")) -> DataFrame:
    """Empty facts, dimensions and marks but keep calendar, notes and security; returns the rows left per table."""
    counts = []
    for name, table in tables.items():
        version = current_version(spark, table)
        if version is None:
            continue
        if name not in keep:
            overwrite_table(read_table(spark, table).limit(0), table, as_of, cluster_by=version.cluster_by, buckets=version.buckets)
        counts.append(read_table(spark, table).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n"))
    out = counts[0]
    for other in counts[1:]:
        out = out.unionByName(other)
    return out
