"""Paged JSON interfaces: ``{count, value: [...], next_link}``.

Saved pages are read like any other files.  A live interface is read through a Python data source with one input
partition per table and day: the pages of a day name their successor, so they are followed in order inside one task,
while days and tables run in parallel.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from urllib.parse import urljoin
from urllib.request import urlopen

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

__all__ = ["read_paged_json", "page_records", "new_api_days", "build_manifest", "PagedJsonSource"]


def page_records(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records and announced counts from a frame of pages (``entity, load_date, page, count, value``).

    Overlapping pages repeat records; they stay as received.  The count is that of the first page.
    """
    records = pages.select("entity", "load_date", F.explode("value").alias("record"))
    counts = pages.groupBy("entity", "load_date").agg(F.min_by("count", "page").alias("api_count"))
    return records, counts


def read_paged_json(spark: SparkSession, root: str, entity: str, record_schema: str,
                    days: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Saved pages ``<root>/<entity>/<day>/page-N.json`` as (records, counts).

    Folders in Spark's own layout (``day=D/page=N/``) are read as well.
    """
    schema = f"count bigint, value array<struct<{record_schema}>>, next_link string"
    base = f"{root.rstrip('/')}/{entity}"
    paths = [f"{base}/{d}" for d in days] if days else [base]
    raw = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", "true").json(paths)
    where = F.col("_metadata.file_path")
    pages = raw.select(
        F.lit(entity).alias("entity"), F.regexp_extract(where, entity + r"/(?:[a-z_]+=)?([0-9]{4}-[0-9]{2}-[0-9]{2})/", 1).alias("load_date"),
        F.regexp_extract(where, r"page[-=]([0-9]+)", 1).cast("int").alias("page"), "count", "value")
    records, counts = page_records(pages)
    return records.select("entity", "load_date", "record.*"), counts


def new_api_days(index: DataFrame, manifests: DataFrame | None, load_date: str | None = None,
                 redownload: bool = False) -> DataFrame:
    """Days the interface offers (``load_dates`` array) that have no saved manifest."""
    days = index.select(F.explode("load_dates").alias("load_date")).distinct()
    if load_date:
        days = days.where(F.col("load_date") == load_date)
    if manifests is None or redownload:
        return days
    return days.join(manifests.select("load_date"), "load_date", "left_anti")


def build_manifest(records: DataFrame, counts: DataFrame) -> DataFrame:
    """Rows received and rows announced per table and day.  Written last, so a listed day is complete."""
    received = records.groupBy("entity", "load_date").agg(F.count(F.lit(1)).alias("rows"))
    return counts.join(received, ["entity", "load_date"], "left").select(
        "entity", "load_date", F.coalesce("rows", F.lit(0)).alias("rows"), "api_count")


class _TableDay(InputPartition):
    def __init__(self, entity: str, day: str):
        self.entity = entity
        self.day = day


class _PagedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.base = options["base_url"].rstrip("/") + "/"
        self.entities = [e for e in options["entities"].split(",") if e]
        self.days = [d for d in options["days"].split(",") if d]

    def partitions(self) -> Sequence[InputPartition]:
        return [_TableDay(e, d) for e in self.entities for d in self.days]

    def read(self, partition: _TableDay) -> Iterator[tuple]:
        url, page = urljoin(self.base, f"{partition.entity}/{partition.day}/page-1.json"), 1
        while url:
            with urlopen(url, timeout=60) as response:
                body = json.loads(response.read())
            for record in body["value"]:
                yield partition.entity, partition.day, page, body["count"], json.dumps(record)
            if not body["value"]:
                yield partition.entity, partition.day, page, body["count"], None
            url = urljoin(url, body["next_link"]) if body.get("next_link") else None
            page += 1


class PagedJsonSource(DataSource):
    """``spark.read.format("paged_json")`` with options ``base_url``, ``entities`` and ``days`` (comma lists).

    Register once with ``spark.dataSource.register(PagedJsonSource)``.  Records arrive as JSON text for
    ``from_json``; a page without records gives one row with a NULL record so that its count is not lost.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return "entity string, load_date string, page int, count bigint, record string"

    def reader(self, schema) -> DataSourceReader:
        return _PagedReader(dict(self.options))
