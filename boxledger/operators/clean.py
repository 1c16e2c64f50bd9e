"""Typing and cleaning of landed rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..contracts import check_identifier
from ..functions import clean_text, row_hash

__all__ = ["conform", "add_missing_meta", "with_row_hash", "filter_pending"]


def conform(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Give every declared column its type, in declared order, followed by the ``_`` columns.

    Text is trimmed and empty text becomes NULL; a column named ``email`` is lower-cased; a value that does not
    parse becomes NULL; a declared column that did not arrive is a typed NULL; undeclared columns are dropped.
    One narrow projection, no shuffle.
    """
    arrived = set(df.columns)

    def typed(name: str, ddl: str):
        check_identifier(name)
        if name not in arrived:
            return F.lit(None).cast(ddl).alias(name)
        text = clean_text(F.col(f"`{name}`"))
        if name == "email":
            text = F.lower(text)
        return text.try_cast(ddl).alias(name)

    passthrough = [F.col(f"`{c}`") for c in df.columns if c.startswith("_")]
    return df.select(*(typed(n, t) for n, t in columns.items()), *passthrough)


def add_missing_meta(df: DataFrame, change_column: str | None, as_of) -> DataFrame:
    """Lineage for tables that arrive typed: ingest time is the change column (or ``as_of``), load date its day."""
    have = set(df.columns)
    ingested = F.col("_ingested_at") if "_ingested_at" in have else (
        F.col(change_column) if change_column else F.lit(as_of)
    ).try_cast("timestamp")
    stamped = df.withColumn("_ingested_at", ingested)
    return stamped if "_load_date" in have else stamped.withColumn("_load_date", F.to_date("_ingested_at"))


def with_row_hash(df: DataFrame, columns: Sequence[str], name: str = "_row_hash") -> DataFrame:
    """Add the change-detection fingerprint over ``columns``."""
    return df.withColumn(name, row_hash(*columns))


def filter_pending(df: DataFrame, column: str, mark) -> DataFrame:
    """Rows strictly newer than the mark; a NULL change value never passes, no mark passes everything.

    The literal takes the column's own type so the comparison reaches the scan.
    """
    if mark is None:
        return df
    return df.where(F.col(column) > F.lit(mark).cast(df.schema[column].dataType))
