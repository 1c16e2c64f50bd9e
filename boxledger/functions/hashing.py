"""Fingerprints used for change detection."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import as_column

__all__ = ["row_hash", "scd_hash", "hash_value"]

# Separators and the NULL marker of the two fingerprints.
ROW_SEPARATOR = "||"
ROW_NULL = "~"
SCD_SEPARATOR = "|"


def row_hash(*columns: str | Column) -> Column:
    """SHA-256, lower-case hex, over every column; a NULL keeps its place as ``~``."""
    parts = [F.ifnull(as_column(c).cast("string"), F.lit(ROW_NULL)) for c in columns]
    return F.sha2(F.concat_ws(ROW_SEPARATOR, *parts), 256)


def scd_hash(*columns: str | Column) -> Column:
    """SHA-256, upper-case hex, over the tracked columns.  NULLs are skipped, so values can shift place."""
    return F.upper(F.sha2(F.concat_ws(SCD_SEPARATOR, *[as_column(c).cast("string") for c in columns]), 256))


def hash_value(column: str | Column) -> Column:
    """SHA-256 of one value as text; NULL stays NULL."""
    return F.sha2(as_column(column).cast("string"), 256)
