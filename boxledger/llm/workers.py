"""Python on the executors: the package travels with the application, so tasks can import it on any node."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from boxledger.session import work_path

_shipped: set[str] = set()

#: Hashes of keys that ``only_marked`` tells apart.
MARKS = 1 << 26


def ship(spark: SparkSession) -> None:
    """Add this package to the application's Python files, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{os.path.basename(root)}.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def released(run: Callable) -> Callable:
    """``run``, giving Arrow's unused memory back after every batch sent and at the end: workers live on between tasks and stages."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):
            yield batch
            pa.default_memory_pool().release_unused()
        pa.default_memory_pool().release_unused()

    return task


def map_arrow(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with the package at hand on every executor."""
    ship(df.sparkSession)
    return df.mapInArrow(released(run), schema)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written below the shared folder and read again: later steps survive the loss of any executor."""
    path = work_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def only_marked(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """The rows of ``df`` whose ``column`` is in ``keys``, and a few others: for an exact join that should shuffle little else.

    Every hash of a key has a bit; at most 2,048 rows of 4 KB are sent to the tasks, whatever the number of keys.
    """
    place = F.pmod(F.xxhash64(column), F.lit(MARKS)) + 1
    marks = keys.select(place.alias("_place")).groupBy(F.bitmap_bucket_number("_place").alias("_block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bits"))
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(_bit div 8 + 1 as int), 1)")), 16, 10).cast("int")
    near = df.withColumns({"_block": F.bitmap_bucket_number(place), "_bit": F.bitmap_bit_position(place)}).join(F.broadcast(marks), "_block")
    return near.filter(F.getbit(byte, (F.col("_bit") % 8).cast("int")) == 1).select(*df.columns)
