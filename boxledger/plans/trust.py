"""Can today's numbers be trusted: integrity checks, health, freshness, service levels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import boundary_hours, local_time, system_of
from ..operators.aggregate import union_all

__all__ = ["gold_integrity", "finance_integrity", "pipeline_health", "source_freshness", "freshness_status",
           "snapshot_source_freshness", "dq_sla_check", "count_check", "duplicate_check", "fold_checks", "data_through",
           "DEFAULT_SLA_HOURS", "SLA_TARGETS"]

DEFAULT_REFRESH, DEFAULT_SLA_HOURS = "daily", 26
# Service levels, as the smallest acceptable share.
SLA_TARGETS = {"error rule pass rate": 0.995, "known member rows": 0.995, "bronze reconciliation": 1.0,
               "concerts matched": 1.0, "loaded by 07:00": 1.0}


def count_check(df: DataFrame, table: str, check: str, condition: Column) -> DataFrame:
    """One line: rows that satisfy a failing condition."""
    return fold_checks(df, table, {check: condition})


def duplicate_check(df: DataFrame, table: str, check: str, key: str) -> DataFrame:
    """One line: keys that occur more than once."""
    return fold_checks(df, table, {}, key, {check: F.count(F.lit(1)) > 1})


def fold_checks(df: DataFrame, table: str, rows: Mapping[str, Column], key: str | None = None,
                groups: Mapping[str, Column] | None = None) -> DataFrame:
    """All checks of one table from one reading of it, one line per check with the rows (or groups) that fail.

    ``rows`` are conditions on rows; ``groups`` are conditions on aggregates of the rows that share ``key``.  With groups,
    the row conditions are counted by the same grouping, so the table is read and shuffled once; it combines on the map
    side.  The counts are laid out as lines at the end.
    """
    groups = groups or {}
    counted = {f"_r{k}": F.count_if(condition) for k, condition in enumerate(rows.values())}
    tested = {f"_g{k}": condition for k, condition in enumerate(groups.values())}
    if groups:
        df = df.groupBy(key).agg(*[c.alias(n) for n, c in {**counted, **tested}.items()])
        counted = {n: F.coalesce(F.sum(n), F.lit(0)) for n in counted} | {n: F.count_if(F.col(n)) for n in tested}
    folded = df.agg(*[c.alias(n) for n, c in counted.items()])
    lines = [F.struct(F.lit(table).alias("fact_table"), F.lit(check).alias("check_name"), F.col(n).alias("rows_failing"))
             for check, n in zip([*rows, *groups], counted)]
    return folded.select(F.inline(F.array(*lines)))


def gold_integrity(sales: DataFrame, gifts: DataFrame, patrons: DataFrame) -> DataFrame:
    """Unknown keys, repeated ids and several open versions; each table is read once."""
    repeated = F.count(F.lit(1)) > 1
    return union_all([
        fold_checks(sales, "fact.ticket_sales", {"unknown patron": F.col("patron_key") == -1, "unknown performance": F.col("performance_key") == -1},
                    "order_line_id", {"duplicate order_line_id": repeated}),
        fold_checks(gifts, "fact.gifts", {"unknown patron": F.col("patron_key") == -1, "unknown campaign": F.col("campaign_key") == -1},
                    "gift_id", {"duplicate gift_id": repeated}),
        duplicate_check(patrons.where("is_current"), "dim.patron", "multiple current versions", "patron_id")])


def finance_integrity(gl: DataFrame, funds: DataFrame, events: DataFrame, bookings: DataFrame,
                      recon: DataFrame) -> DataFrame:
    """Unbalanced journals, unknown keys, missing links and variances without an explanation; each table is read once."""
    return union_all([
        fold_checks(gl, "fin.fact_gl_entry", {"unknown account": F.col("account_key") == -1, "unknown fund": F.col("fund_key") == -1},
                    "journal_id", {"unbalanced journals": F.sum("debit_amount") != F.sum("credit_amount")}),
        # Check names are fixed output values.
        count_check(funds, "dim.fund", "Tessitura fund with no ledger code",
                    (F.col("fund_key") > 0) & F.col("ledger_fund_code").isNull()),
        count_check(events, "dim.event", "concert not linked to a performance",
                    (F.col("event_type") == "Concert") & ~F.col("is_linked")),
        count_check(bookings, "fact.venue_booking", "unknown event or room",
                    (F.col("event_key") == -1) | (F.col("room_key") == -1)),
        count_check(recon, "fin.recon_revenue_to_gl", "variances to investigate, no note yet",
                    (F.col("status") == "Investigate") & F.col("cause").isNull())])


def pipeline_health(load_log: DataFrame, *run_logs: DataFrame) -> DataFrame:
    """One timeline over the Gold log and the run logs of the other layers."""
    gold = load_log.select(F.lit("gold").alias("layer"), F.col("procedure_name").alias("step"),
                           F.col("target_table").alias("entity"), F.col("rows_inserted").cast("bigint").alias("rows_out"),
                           "status", "message", "started_at", "ended_at")
    others = [log.select(F.col("stage").alias("layer"), F.col("notebook").alias("step"), "entity", "rows_out", "status",
                         "message", "started_at", "ended_at") for log in run_logs]
    return union_all([gold, *others])


def data_through(legs: Sequence[tuple[str, str, str, DataFrame, str, str]]) -> DataFrame:
    """Latest business date per source: (system, label, name, rows, date column, what is measured)."""
    return union_all([
        rows.agg(F.max(F.col(column).cast("date")).alias("data_through")).select(
            F.lit(system).alias("source_system"), F.lit(label).alias("source_label"), F.lit(name).alias("source_name"),
            "data_through", F.lit(measured).alias("measured_by"))
        for system, label, name, rows, column, measured in legs])


def freshness_status(last_loaded: str | Column, sla_hours: str | Column, as_of) -> Column:
    """``Never loaded`` beats everything; at the limit a source is still fresh."""
    loaded = F.col(last_loaded) if isinstance(last_loaded, str) else last_loaded
    limit = F.col(sla_hours) if isinstance(sla_hours, str) else sla_hours
    now = F.lit(as_of).cast("timestamp")
    return F.when(loaded.isNull(), "Never loaded").when(boundary_hours(loaded, now) <= limit, "Fresh").otherwise("Stale")


def source_freshness(through: DataFrame, run_log: DataFrame, config: DataFrame, as_of) -> DataFrame:
    """How current each source is.  A successful run that found nothing new counts as a load."""
    done = run_log.where((F.col("stage") == "silver") & (F.col("status") == "Succeeded"))
    loads = done.groupBy(system_of("entity").alias("source_system")).agg(F.max("ended_at").alias("last_loaded_utc"))
    expected = config.groupBy("source_system").agg(F.max("expected_refresh").alias("expected_refresh"),
                                                   F.min("sla_hours").alias("sla_hours"))
    joined = through.join(loads, "source_system", "left").join(expected, "source_system", "left").withColumns({
        "expected_refresh": F.coalesce("expected_refresh", F.lit(DEFAULT_REFRESH)),
        "sla_hours": F.coalesce("sla_hours", F.lit(DEFAULT_SLA_HOURS))})
    return joined.select(
        "source_system", "source_label", "source_name", "last_loaded_utc",
        F.date_trunc("second", local_time("last_loaded_utc")).alias("last_loaded_et"), "data_through", "measured_by",
        "expected_refresh", "sla_hours",
        boundary_hours("last_loaded_utc", F.lit(as_of).cast("timestamp")).alias("hours_since_load"),
        freshness_status("last_loaded_utc", "sla_hours", as_of).alias("freshness_status"))


def snapshot_source_freshness(freshness: DataFrame, as_of) -> DataFrame:
    """The part that is saved for reports, which work out staleness when they open."""
    return freshness.select("source_system", "source_name", "last_loaded_utc", "data_through", "measured_by",
                            F.lit(as_of).cast("timestamp").alias("snapshot_at"), "source_label", "last_loaded_et",
                            "expected_refresh", "sla_hours")


def dq_sla_check(results: DataFrame, sales: DataFrame, recon: DataFrame, events: DataFrame, load_log: DataFrame,
                 as_of_day, due_hour: int = 7) -> DataFrame:
    """Measured share against target for each service level."""
    def share(df: DataFrame, name: str, good: Column) -> DataFrame:
        measured = df.agg((F.count_if(good).cast("double") / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("value"))
        return measured.select(F.lit(name).alias("metric"), "value", F.lit(SLA_TARGETS[name]).alias("target"))

    rules = results.where(F.col("severity") == "error")
    passed = rules.agg((1 - F.sum("failed_rows").cast("double") / F.nullif(F.sum("total_rows"), F.lit(0))).alias("value"))
    in_time = F.hour(local_time("ended_at")) < due_hour
    today = load_log.where(F.to_date("ended_at") == F.lit(as_of_day).cast("date"))
    legs = union_all([
        passed.select(F.lit("error rule pass rate").alias("metric"), "value",
                      F.lit(SLA_TARGETS["error rule pass rate"]).alias("target")),
        share(sales, "known member rows", F.col("patron_key") > 0),
        share(recon, "bronze reconciliation", F.col("status") == "OK"),
        share(events.where(F.col("event_type") == "Concert"), "concerts matched", F.col("is_linked")),
        share(today, "loaded by 07:00", in_time & (F.col("status") == "Succeeded"))])
    return legs.withColumn("met", F.coalesce(F.col("value") >= F.col("target"), F.lit(False)))
