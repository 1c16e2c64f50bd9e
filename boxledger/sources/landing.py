"""Landed day folders: ``<root>/<table>/load_date=YYYY-MM-DD/<files>``."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from .tables import file_paths

__all__ = ["read_landing_csv", "read_landing_json", "add_lineage", "available_days", "pending_partitions",
           "read_manifests", "manifest_lines", "MANIFEST_SCHEMA"]

DAY_PREFIX = "load_date="
FILE_COLUMN = "_source_file"


def _as_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    def text(name: str):
        kind = df.schema[name].dataType
        column = F.col(f"`{name}`")
        if isinstance(kind, (StructType, ArrayType, MapType)):
            return F.to_json(column).alias(name)
        return column.cast("string").alias(name)

    return df.select(*[text(c) for c in columns], F.col("_metadata.file_path").alias(FILE_COLUMN))


def read_landing_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """CSV with a header and quoted multi-line fields; every column as text, plus the file it came from.

    A zero-byte file is an empty table of no columns.  Give ``schema`` (all strings) where the columns are known: it
    spares the pass that reads the header.
    """
    reader = spark.read.option("recursiveFileLookup", "true").option("header", True).option("multiLine", True)
    reader = reader.option("escape", '"')
    raw = (reader.schema(schema) if schema else reader.option("inferSchema", False)).csv(path)
    return _as_text(raw, raw.columns)


def read_landing_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Newline-delimited JSON; scalars as text, nested values as JSON text.

    ``schema`` spares the inference pass over the files.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    reader = reader.schema(schema) if schema else reader.option("primitivesAsString", "true")
    raw = reader.json(path)
    return _as_text(raw, raw.columns)


def add_lineage(df: DataFrame, load_date, batch_id: str, as_of) -> DataFrame:
    """Stamp load date, ingest time and batch.  The file column is kept when the reader brought it, else NULL."""
    if FILE_COLUMN not in df.columns:
        df = df.withColumn(FILE_COLUMN, F.lit(None).cast("string"))
    return df.withColumns({
        "_load_date": F.lit(load_date).cast("date"),
        "_ingested_at": F.lit(as_of).cast("timestamp"),
        "_batch_id": F.lit(batch_id),
    })


def available_days(spark: SparkSession, root: str, entity: str) -> list[str]:
    """Days that have a folder with files, from the directory listing alone."""
    files = file_paths(spark, f"{root.rstrip('/')}/{entity}") or []
    return sorted({m[1] for f in files if (m := re.search(f"/{DAY_PREFIX}([^/]+)/", f))})


def pending_partitions(available: DataFrame, ingest_log: DataFrame | None, entities: Sequence[str] | None = None,
                       load_date: str | None = None, reprocess: bool = False) -> DataFrame:
    """Listed (entity, load_date) pairs that the log does not have yet, optionally for some tables or one day."""
    todo = available
    if entities:
        todo = todo.where(F.col("entity").isin(*entities))
    if load_date:
        todo = todo.where(F.col("load_date") == load_date)
    if ingest_log is None or reprocess:
        return todo
    return todo.join(ingest_log.select("entity", "load_date"), ["entity", "load_date"], "left_anti")


MANIFEST_SCHEMA = ("load_date string, generated_at string, "
                   "files array<struct<source:string,entity:string,path:string,rows:bigint,api_count:bigint>>")


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """Announced rows per table and day: ``entity`` (source.table), ``load_date``, ``expected_rows``."""
    return manifest_lines(spark.read.schema(MANIFEST_SCHEMA).option("multiLine", True).json(path))


def manifest_lines(manifests: DataFrame) -> DataFrame:
    """One line per announced table of each manifest."""
    lines = manifests.select("load_date", F.inline("files"))
    return lines.select(F.concat_ws(".", "source", "entity").alias("entity"), "load_date",
                        F.col("rows").alias("expected_rows"))
