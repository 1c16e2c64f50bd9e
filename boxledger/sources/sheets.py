"""Folders of sheet extracts kept by hand."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import clean_text
from .tables import file_paths, local_table

__all__ = ["combine_sheets", "read_sheet_folder"]


def combine_sheets(by_file: Mapping[str, DataFrame], renames: Mapping[str, str], types: Mapping[str, str], key: str,
                   yes_no: Sequence[str] = (), extension: str = ".csv") -> DataFrame:
    """Union of sheets by column name with the file each row came from.

    Files of another extension are ignored (case does not matter); rows with a blank key drop; friendly headers are
    renamed; ``yes_no`` columns become booleans (only ``Yes`` is true); other columns are cast, bad text to NULL.
    """
    wanted = [df.withColumn("source_file", F.lit(name)) for name, df in by_file.items()
              if name.lower().endswith(extension.lower())]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), wanted)
    return _tidy(stacked, renames, types, key, yes_no)


def _tidy(df: DataFrame, renames: Mapping[str, str], types: Mapping[str, str], key: str, yes_no: Sequence[str]) -> DataFrame:
    named = df.withColumnsRenamed(dict(renames))
    named = named.where(clean_text(key).isNotNull())
    columns = {}
    for name in yes_no:
        columns[name] = F.coalesce(F.col(name) == "Yes", F.lit(False))
    for name, ddl in types.items():
        if name not in yes_no:
            present = clean_text(name) if name in named.columns else F.lit(None)
            columns[name] = present.try_cast(ddl)
    return named.withColumns(columns)


def read_sheet_folder(spark: SparkSession, folder: str, headers: Sequence[str], renames: Mapping[str, str],
                      types: Mapping[str, str], key: str, yes_no: Sequence[str] = (),
                      extension: str = ".csv") -> DataFrame:
    """All extracts of a folder; ``headers`` is the union of their columns, in any order per file.

    The first line of each file (one row a file comes to the driver) tells its layout; files of one layout are one
    distributed read, so the plan grows with the number of layouts, not of files.  Columns outside ``headers`` are left
    out, absent ones are NULL.  Header names may be quoted but do not span lines.
    """
    paths = [f for f in file_paths(spark, folder) or [] if f.lower().endswith(extension.lower())]
    file_name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    layouts: dict[tuple[str, ...], list[str]] = {}
    if paths:
        lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path"), F.struct(
            F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")).alias("at"))
        for row in lines.groupBy("path").agg(F.min_by("value", "at").alias("first")).collect():
            layouts.setdefault(tuple(next(csv.reader([row["first"].lstrip("\ufeff")]))), []).append(row["path"])
    frames = [local_table(spark, [], ", ".join(f"`{h}` string" for h in headers) + ", source_file string")]
    for layout, files in sorted(layouts.items()):
        schema = ", ".join(f"`{h}` string" for h in layout)
        raw = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
               .option("enforceSchema", True).schema(schema).csv(files))
        frames.append(raw.select(*[F.col(f"`{h}`") for h in layout if h in headers], file_name.alias("source_file")))
    return _tidy(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames), renames, types, key, yes_no)
