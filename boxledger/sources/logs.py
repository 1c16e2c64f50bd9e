"""Run logs and small control tables."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from ..contracts import SourceContract
from .tables import append_batch, local_table

__all__ = ["log_run", "load_log", "log_ingest", "source_config", "RUN_LOG_SCHEMA", "LOAD_LOG_SCHEMA",
           "INGEST_LOG_SCHEMA"]

RUN_LOG_SCHEMA = ("run_id string, notebook string, entity string, stage string, rows_in bigint, rows_out bigint, "
                  "rows_quarantined bigint, status string, message string, started_at timestamp, ended_at timestamp")
LOAD_LOG_SCHEMA = ("run_id string, procedure_name string, target_table string, rows_inserted bigint, "
                   "rows_updated bigint, rows_deleted bigint, status string, message string, started_at timestamp, "
                   "ended_at timestamp, run_by string")
INGEST_LOG_SCHEMA = "entity string, load_date string, rows bigint, batch_id string, ingested_at timestamp"
CONFIG_SCHEMA = "source_system string, source string, expected_refresh string, sla_hours int"


def _append(spark: SparkSession, row: tuple, schema: str, path: str | None) -> DataFrame:
    """One line as a batch of its own: parallel calls never meet."""
    frame = local_table(spark, [row], schema)
    if path:
        append_batch(frame.coalesce(1), path)
    return frame


def log_run(spark: SparkSession, path: str | None, *, run_id: str, step: str, entity: str, stage: str, rows_in: int = 0,
            rows_out: int = 0, rows_quarantined: int = 0, status: str = "Succeeded", message: str = "",
            started_at: datetime, ended_at: datetime) -> DataFrame:
    """One row per table and step."""
    return _append(spark, (run_id, step, entity, stage, rows_in, rows_out, rows_quarantined, status,
                           message, started_at, ended_at), RUN_LOG_SCHEMA, path)


def load_log(spark: SparkSession, path: str | None, *, run_id: str, step: str, target: str, inserted: int = 0,
             updated: int = 0, deleted: int = 0, status: str = "Succeeded", message: str | None = None,
             started_at: datetime, ended_at: datetime, run_by: str = "") -> DataFrame:
    """One row per Gold step."""
    return _append(spark, (run_id, step, target, inserted, updated, deleted, status, message, started_at, ended_at,
                           run_by), LOAD_LOG_SCHEMA, path)


def log_ingest(spark: SparkSession, path: str | None, entity: str, load_date: str, rows: int, batch_id: str,
               as_of: datetime) -> DataFrame:
    """Record a day as loaded.  An empty day is recorded too, otherwise it would be tried again forever."""
    return _append(spark, (entity, load_date, rows, batch_id, as_of), INGEST_LOG_SCHEMA, path)


def source_config(spark: SparkSession, sources: Iterable[SourceContract]) -> DataFrame:
    """Expected refresh and allowed age per source."""
    return local_table(spark, [(s.system, s.source, s.refresh, s.sla_hours) for s in sources], CONFIG_SCHEMA)
