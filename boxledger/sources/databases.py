"""Incremental copies from databases."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..operators.clean import filter_pending

__all__ = ["read_jdbc_incremental"]


def read_jdbc_incremental(spark: SparkSession, options: Mapping[str, str] | DataFrame, table: str | None,
                          change_column: str, last=None) -> DataFrame:
    """First a full snapshot (``last`` is None), then rows with ``change_column`` above ``last``.

    Rows whose change column is NULL never load.  The comparison is typed like the column, so the JDBC source pushes
    it to the database.  Give ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` in the options
    to read a large table in parallel.  A DataFrame in place of the options is used as the table.
    """
    source = options if isinstance(options, DataFrame) else (
        spark.read.format("jdbc").options(**dict(options)).option("dbtable", table).load())
    present = source.where(source[change_column].isNotNull())
    return filter_pending(present, change_column, last)
