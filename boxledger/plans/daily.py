"""The daily run: land, check, clean, and load the star in order.

Nothing here rewrites or reads a whole silver or incremental gold table: bronze is read from the mark's day on, and merges
touch the key buckets of the increment.

Independent tables share nothing but logs, where every line is a batch of its own, so a caller may run
:func:`process_entity` for several of them from a small thread pool under Spark's FAIR scheduler; scheduling itself stays
outside.  ``as_of`` is the run's logical time; the start and end of each step come from ``clock``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from hashlib import sha256

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..contracts import Contracts, Rule, TableContract
from ..operators.aggregate import require_no_mismatch, rowcount_reconcile
from ..operators.changes import delete_insert, latest_per_key, upsert
from ..operators.clean import add_missing_meta, conform, filter_pending, with_row_hash
from ..operators.identity import XREF_SCHEMA, append_xref, golden_people, match_keys, match_known
from ..operators.quality import Gate, apply_dq, dq_counts, dq_lines
from ..sources.landing import add_lineage, available_days, pending_partitions, read_landing_csv, read_landing_json, read_manifests
from ..sources.logs import load_log, log_ingest, log_run
from ..sources.tables import (append_batch, append_bronze, create_merged, current_version, drop_table, local_table, merge_table, open_database,
                              overwrite_table, path_exists, read_bronze, read_table, stage_table, table_exists, table_name)

__all__ = ["Lake", "Step", "utc_now", "ingest_landing", "check_landing", "pending_rows", "process_entity", "load_identities", "load_gold", "run_daily"]

CATALOGUED = ("silver", "gold", "stage")
#: How many days a delivery may be named before the day of the changes in it (time zones, business days).
LOOK_BACK_DAYS = 3


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


Clock = Callable[[], datetime]


class Lake:
    """Where the tables of a run live: landing, bronze, logs and quality tables in folders below ``root`` (appended), silver and
    gold in a database of the catalogue (replaced or merged)."""

    def __init__(self, spark: SparkSession, root: str, database: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.database = open_database(spark, database or f"lake_{sha256(self.root.encode()).hexdigest()[:12]}", f"{self.root}/tables")

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def table(self, layer: str, name: str) -> str:
        return table_name(self.database, f"{layer}_{name}")

    def landing(self, source: str) -> str:
        return f"{self.root}/landing/{source}"

    def exists(self, layer: str, name: str) -> bool:
        if layer in CATALOGUED:
            return table_exists(self.spark, self.table(layer, name))
        return path_exists(self.spark, self.path(layer, name))

    def read(self, layer: str, name: str) -> DataFrame:
        if layer in CATALOGUED:
            return read_table(self.spark, self.table(layer, name))
        return read_bronze(self.spark, self.path(layer, name))

    def get(self, layer: str, name: str) -> DataFrame | None:
        return self.read(layer, name) if self.exists(layer, name) else None


def ingest_landing(lake: Lake, source: str, contract: TableContract, format: str, run_id: str, as_of: datetime,
                   load_date: str | None = None, reprocess: bool = False, clock: Clock = utc_now) -> list[str]:
    """Append every landed day of one table that the log does not have.  Returns the days loaded.

    A day counts as loaded even when its file is empty.  A day is one batch, so a run that stopped between the append and
    its log line replaces the day's rows when it is tried again; ``reprocess`` adds another batch.
    """
    spark = lake.spark
    days = [(contract.key, d) for d in available_days(spark, lake.landing(source), contract.name)]
    if not days:
        return []
    listed = local_table(spark, days, "entity string, load_date string")
    todo = pending_partitions(listed, lake.get("audit", "ingest_log"), [contract.key], load_date, reprocess)
    done = []
    for day in sorted(r["load_date"] for r in todo.collect()):
        started = clock()
        read = read_landing_csv if format == "csv" else read_landing_json
        raw = read(spark, f"{lake.landing(source)}/{contract.name}/load_date={day}")
        stamped = add_lineage(raw, day, run_id, as_of)
        rows = 0 if len(raw.columns) <= 1 else raw.count()
        if rows:
            append_bronze(stamped, lake.path("bronze", contract.key), f"{day}-{run_id}" if reprocess else day)
        log_ingest(spark, lake.path("audit", "ingest_log"), contract.key, day, rows, run_id, as_of)
        log_run(spark, lake.path("audit", "run_log"), run_id=run_id, step="ingest_landing", entity=contract.key, stage="bronze",
                rows_in=rows, rows_out=rows, started_at=started, ended_at=clock())
        done.append(day)
    return done


def check_landing(lake: Lake, manifest_paths: Sequence[str], as_of: datetime) -> DataFrame:
    """Compare announced with loaded rows, save the outcome and stop the run on a mismatch."""
    expected = read_manifests(lake.spark, list(manifest_paths))
    recon = rowcount_reconcile(expected, lake.read("audit", "ingest_log"))
    overwrite_table(recon.withColumn("checked_at", F.lit(as_of).cast("timestamp")), lake.table("gold", "reconciliation"), as_of)
    saved = lake.read("gold", "reconciliation")
    require_no_mismatch(saved)
    return saved


def pending_rows(lake: Lake, contract: TableContract, as_of: datetime, full_refresh: bool = False,
                 look_back_days: int = LOOK_BACK_DAYS) -> tuple[DataFrame, datetime | None]:
    """Bronze rows newer than the silver table's mark, with ``_change``, the change value as a time; and that mark.

    A change can only be delivered on its own day or later, so the mark is also a lower bound of the load day, less
    ``look_back_days``: earlier days are neither listed for reading nor opened.  Change values that are no time are kept
    here with a NULL ``_change`` so that they can be counted.
    """
    version = current_version(lake.spark, lake.table("silver", contract.key))
    mark = None if version is None or full_refresh else version.mark
    change = contract.change_column
    since = (mark - timedelta(days=look_back_days)).date() if mark is not None and change else None
    df = add_missing_meta(read_bronze(lake.spark, lake.path("bronze", contract.key), since), change, as_of)
    if not change:
        return df, None
    if change not in df.columns:  # no delivery of these days has the column
        return df.withColumn("_change", F.lit(None).cast("timestamp")), mark
    return df.withColumn("_change", F.col(change).try_cast("timestamp")), mark


def process_entity(lake: Lake, contract: TableContract, rules: Sequence[Rule], run_id: str, as_of: datetime,
                   references: Mapping[str, DataFrame] | None = None, full_refresh: bool = False, clock: Clock = utc_now) -> str:
    """Bronze to silver for one table: increment, type, newest version, gate, fingerprint, upsert, mark, log.

    Returns ``Succeeded`` or ``Skipped``.  The increment is gated and staged by one write, which also counts rows in and
    out, rule failures and the new mark (observed metrics); results, quarantine and upsert read what it staged, and no
    count is a job of its own.  The upsert reads and overwrites only the key buckets that the increment touches.  The mark
    is set after the rows; a run that died before it is repeated to the same end.  Rows whose change value is no timestamp
    never load; the log counts those of the days read.  The logged counts may be too high after lost executors.
    """
    spark, key, started = lake.spark, contract.key, clock()
    run_log = lake.path("audit", "run_log")

    def log(rows_in=0, rows_out=0, bad=0, status="Succeeded", message=""):
        log_run(spark, run_log, run_id=run_id, step="process_entity", entity=key, stage="silver", rows_in=rows_in,
                rows_out=rows_out, rows_quarantined=bad, status=status, message=message, started_at=started, ended_at=clock())

    if not lake.exists("bronze", key):
        log(status="Skipped", message="no bronze table yet")
        return "Skipped"
    change = contract.change_column
    df, old_mark = pending_rows(lake, contract, as_of, full_refresh)
    arrived, gated = Observation(), Observation()
    if change:
        given = F.col(change).isNotNull() if change in df.columns else F.lit(False)
        unread = F.count_if(given & F.col("_change").isNull()).alias("unread")
        pending = F.lit(True) if old_mark is None else F.col("_change") > F.lit(old_mark)
        df = df.observe(arrived, unread, F.count_if(pending).alias("n"), F.max(F.when(pending, F.col("_change"))).alias("mark"))
        fresh = filter_pending(df, "_change", old_mark).drop("_change")
    else:
        fresh = df.observe(arrived, F.lit(0).cast("bigint").alias("unread"), F.count(F.lit(1)).alias("n"), F.max(F.lit(None).cast("timestamp")).alias("mark"))

    newest = latest_per_key(conform(fresh, contract.columns), contract.primary_key, contract.order_by)
    gate = apply_dq(newest, key, rules, restricted=contract.restricted, references=references, run_id=run_id, as_of=as_of)
    flagged = gate.flagged.observe(gated, *dq_counts(gate.active))
    staging = lake.table("stage", f"{key}-{run_id}")
    staged = stage_table(flagged, staging)
    seen, counts = arrived.get, gated.get
    note = f"{seen['unread']} change values are no timestamp" if seen["unread"] else ""
    if change and seen["mark"] is None:
        drop_table(spark, staging)
        log(message="checked: nothing new" + (f"; {note}" if note else ""))
        return "Succeeded"
    gate = Gate.of(staged, gate.active, key, newest.columns, contract.restricted, run_id, as_of)
    if gate.active:
        append_batch(dq_lines(spark, counts, gate.active, key, run_id, as_of), lake.path("dq", "results"), f"{key}-{run_id}")
        if counts["bad_rows"]:
            append_batch(gate.quarantine, lake.path("dq", "quarantine"), f"{key}-{run_id}")
    columns = list(contract.columns)
    source = with_row_hash(gate.valid, columns).select(
        *columns, "_row_hash", "_load_date", F.lit(as_of).cast("timestamp").alias("_silver_updated_at"))
    target = lake.table("silver", key)
    if table_exists(spark, target):
        _merge(spark, target, source, lambda held, new: upsert(held, new, contract.primary_key), contract.primary_key, as_of, seen["mark"])
    else:
        create_merged(source, target, contract.primary_key, as_of, seen["mark"], expected=0)
    log(seen["n"], counts["total_rows"] - counts["bad_rows"], counts["bad_rows"], message=note)
    drop_table(spark, staging)
    return "Succeeded"


def _merge(spark: SparkSession, table: str, source: DataFrame, combine, keys: Sequence[str], as_of: datetime, mark: datetime | None):
    """Merge by key bucket, or in full where columns or types have changed since the table was written."""
    version = current_version(spark, table)
    held = read_table(spark, table)
    types = {f.name: f.dataType for f in held.schema}
    if version.buckets and types == {f.name: f.dataType for f in source.schema}:
        return merge_table(table, source, combine, as_of, mark)
    held = held.select(*[(F.col(f.name) if f.name in types else F.lit(None)).cast(f.dataType).alias(f.name) for f in source.schema])
    return create_merged(combine(held, source), table, keys, as_of, mark or version.mark, expected=version.number)


def load_identities(lake: Lake, candidates: DataFrame, run_id: str, as_of: datetime, clock: Clock = utc_now) -> None:
    """Match one batch of person records and write the cross-reference, then the people that follow from it.

    The matched batch is staged once.  Each write fails if another writer came between; people are made from the
    cross-reference that this run wrote.
    """
    spark, started = lake.spark, clock()
    xref_table, people_table = lake.table("silver", "person_xref"), lake.table("silver", "people")
    versions = [current_version(spark, t) for t in (xref_table, people_table)]
    before = [v.number if v else 0 for v in versions]
    arrived, made = Observation(), Observation()
    keyed = stage_table(match_keys(candidates).observe(arrived, F.count(F.lit(1)).alias("n")), lake.table("stage", f"people-{run_id}"))
    known = lake.get("silver", "person_xref")
    known = known if known is not None else local_table(spark, [], XREF_SCHEMA)
    matched = stage_table(match_known(keyed, known), lake.table("stage", f"matched-{run_id}"))
    overwrite_table(append_xref(known, matched, as_of), xref_table, as_of, expected=before[0])
    people = golden_people(keyed, lake.read("silver", "person_xref"), as_of).observe(made, F.count(F.lit(1)).alias("n"))
    overwrite_table(people, people_table, as_of, expected=before[1])
    log_run(spark, lake.path("audit", "run_log"), run_id=run_id, step="load_identities", entity="people", stage="silver",
            rows_in=arrived.get["n"], rows_out=made.get["n"], started_at=started, ended_at=clock())
    for purpose in ("people", "matched"):
        drop_table(spark, lake.table("stage", f"{purpose}-{run_id}"))


@dataclass(frozen=True)
class Step:
    """One target of the gold load.  ``build`` gets a reader ``(target, ddl) -> frame`` for tables built so far.

    A step with ``keys`` is incremental: ``build`` also gets the target's mark (None at first) and returns the changed
    rows, whose old versions are replaced by key, and ``top`` returns the highest change value to be read before.  Only
    the key buckets that changed rows fall in are rewritten; ``bucket_expr`` is the bucket in SQL if not a hash of the keys.
    A step without ``keys`` is replaced in full and clustered by ``cluster_by``.
    """

    target: str
    build: Callable[..., DataFrame]
    keys: Sequence[str] = ()
    top: Callable[[Callable[..., DataFrame]], datetime | None] | None = None
    bucket_expr: str | None = None
    cluster_by: Sequence[str] = ()


def _load_step(lake: Lake, step: Step, reader, as_of: datetime) -> tuple[int, int, int]:
    """Rows inserted, updated and deleted, as the writes count them."""
    spark, table = lake.spark, lake.table("gold", step.target)
    version = current_version(spark, table)
    number = version.number if version else 0
    count = F.count(F.lit(1)).alias("n")
    if not step.keys:
        before = lake.read("gold", step.target).count() if version else 0  # answered from the files' footers
        written = Observation()
        overwrite_table(step.build(reader).observe(written, count), table, as_of, cluster_by=step.cluster_by, expected=number)
        return written.get["n"], 0, before
    old = version.mark if version else None
    top = step.top(reader) if step.top else None
    if version and top is not None and old is not None and top <= old:
        return 0, 0, 0
    staging = lake.table("stage", f"gold-{step.target}")
    arrived = Observation()
    changed = stage_table(step.build(reader, old).observe(arrived, count), staging)
    n = arrived.get["n"]
    if version is None:
        create_merged(changed, table, step.keys, as_of, top, bucket_expr=step.bucket_expr, expected=number)
        out = n, 0, 0
    else:
        merged = merge_table(table, changed, lambda held, new: delete_insert(held, new, list(step.keys)), as_of, top or old)
        replaced = merged.rows_before + n - merged.rows_after
        out = max(n - replaced, 0), min(replaced, n), max(replaced - n, 0)
    drop_table(spark, staging)
    return out


def load_gold(lake: Lake, steps: Sequence[Step], run_id: str, as_of: datetime, run_by: str = "", clock: Clock = utc_now) -> None:
    """Run the steps in order.  The first failure is logged and stops the load; earlier steps stay loaded.

    An incremental step's mark is committed with its rows.
    """
    spark = lake.spark
    log_path = lake.path("audit", "load_log")

    def reader(target: str, ddl: str | None = None) -> DataFrame:
        existing = lake.get("gold", target)
        if existing is None and ddl is None:
            raise FileNotFoundError(f"gold table {target} has not been built")
        return existing if existing is not None else local_table(spark, [], ddl)

    for step in steps:
        started = clock()
        try:
            inserted, updated, deleted = _load_step(lake, step, reader, as_of)
            load_log(spark, log_path, run_id=run_id, step=f"load {step.target}", target=step.target, inserted=inserted, updated=updated,
                     deleted=deleted, started_at=started, ended_at=clock(), run_by=run_by)
        except Exception as problem:
            load_log(spark, log_path, run_id=run_id, step=f"load {step.target}", target=step.target, status="Failed",
                     message=str(problem), started_at=started, ended_at=clock(), run_by=run_by)
            raise


def run_daily(lake: Lake, contracts: Contracts, steps: Sequence[Step], run_id: str, as_of: datetime,
              manifests: Sequence[str] = (), identities: Callable[[Lake], DataFrame] | None = None, clock: Clock = utc_now) -> None:
    """Landing to gold.  Tables that only look others up come first, as listed in the contract.

    ``identities`` returns the person records of all systems; people are matched between silver and gold, because facts
    look them up.
    """
    for source in contracts.sources:
        if source.lands_in != "files":
            continue
        for table in source.tables:
            ingest_landing(lake, source.source, table, source.format, run_id, as_of, clock=clock)
    if manifests:
        check_landing(lake, manifests, as_of)
    for source in contracts.sources:
        for table in source.tables:
            rules = contracts.rules.get(table.key, ())
            references = {}
            for rule in rules:
                if rule.ref_entity and rule.ref_entity not in references and lake.exists("silver", rule.ref_entity):
                    references[rule.ref_entity] = lake.read("silver", rule.ref_entity)
            process_entity(lake, table, rules, run_id, as_of, references, clock=clock)
    if identities is not None:
        load_identities(lake, identities(lake), run_id, as_of, clock)
    load_gold(lake, steps, run_id, as_of, clock=clock)
