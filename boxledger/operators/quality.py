"""The quality gate: declarative rules, severity routing, results and quarantine.

All rules of a table are evaluated in one projection; the counts of all rules come from one aggregate.
Foreign keys are the only rules that join, each against the distinct keys of its reference table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..contracts import Rule
from ..functions import as_column, hash_value

__all__ = ["dq_not_null", "dq_regex", "dq_accepted_values", "dq_range", "dq_not_future", "dq_expression",
           "dq_foreign_key", "dq_route", "dq_results", "dq_quarantine", "dq_latest", "dq_alerts", "apply_dq",
           "flag_rules", "hash_restricted", "dq_counts", "dq_lines", "Gate"]


def dq_not_null(column: str | Column) -> Column:
    return as_column(column).isNull()


def dq_regex(column: str | Column, pattern: str, allow_null: bool = False) -> Column:
    """Search, not full match.  NULL fails unless allowed."""
    value = as_column(column)
    return F.coalesce(~value.rlike(pattern), F.lit(not allow_null))


def dq_accepted_values(column: str | Column, values: Sequence) -> Column:
    """NULL passes."""
    return F.coalesce(~as_column(column).isin(*values), F.lit(False))


def dq_range(column: str | Column, low=None, high=None) -> Column:
    """Inclusive bounds, either may be left open.  NULL passes."""
    value = as_column(column)
    below = value < F.lit(low) if low is not None else F.lit(False)
    above = value > F.lit(high) if high is not None else F.lit(False)
    return F.coalesce(below | above, F.lit(False))


def dq_not_future(column: str | Column, as_of) -> Column:
    """Later than ``as_of``.  NULL passes."""
    return F.coalesce(as_column(column).cast("timestamp") > F.lit(as_of).cast("timestamp"), F.lit(False))


def dq_expression(check: str) -> Column:
    """The SQL condition must be true: both false and unknown fail."""
    return ~F.coalesce(F.expr(check), F.lit(False))


def dq_foreign_key(df: DataFrame, column: str, reference: DataFrame, ref_column: str, flag: str = "_orphan") -> DataFrame:
    """Add ``flag``: true where the value is not among the reference keys.  NULL passes.

    The reference is reduced to its distinct keys first, so a match never multiplies rows.
    """
    known = reference.select(F.col(ref_column).alias("_ref")).where("_ref is not null").distinct()
    matched = df.join(known, df[column] == known["_ref"], "left")
    return matched.withColumn(flag, F.col(column).isNotNull() & F.col("_ref").isNull()).drop("_ref")


def _violation(rule: Rule, as_of) -> Column:
    if rule.rule == "not_null":
        return dq_not_null(rule.column)
    if rule.rule == "regex":
        return dq_regex(rule.column, rule.pattern, rule.allow_null)
    if rule.rule == "accepted_values":
        return dq_accepted_values(rule.column, rule.values)
    if rule.rule == "range":
        return dq_range(rule.column, rule.min, rule.max)
    if rule.rule == "not_future":
        return dq_not_future(rule.column, as_of)
    return dq_expression(rule.check)


def flag_rules(df: DataFrame, rules: Sequence[Rule], references: Mapping[str, DataFrame] | None,
               as_of) -> tuple[DataFrame, list[tuple[str, Rule]]]:
    """Rows with one boolean column per active rule.

    A foreign-key rule whose reference table does not exist is skipped and leaves no result.
    """
    references = references or {}
    active = [(f"_rule_{i}", r) for i, r in enumerate(rules)
              if r.rule != "foreign_key" or r.ref_entity in references]
    simple = {flag: _violation(rule, as_of) for flag, rule in active if rule.rule != "foreign_key"}
    flagged = df.withColumns(simple) if simple else df
    for flag, rule in active:
        if rule.rule == "foreign_key":
            flagged = dq_foreign_key(flagged, rule.column, references[rule.ref_entity], rule.ref_column, flag)
    return flagged, active


def _any_error(active: Sequence[tuple[str, Rule]]) -> Column:
    errors = [F.coalesce(F.col(flag), F.lit(False)) for flag, rule in active if rule.severity == "error"]
    return reduce(lambda a, b: a | b, errors, F.lit(False))


def dq_route(flagged: DataFrame, active: Sequence[tuple[str, Rule]]) -> tuple[DataFrame, DataFrame]:
    """(valid, bad): any failed error rule sets the row aside; warnings are kept."""
    failed = _any_error(active)
    return flagged.where(~failed).drop(*[flag for flag, _ in active]), flagged.where(failed)


def dq_results(flagged: DataFrame, active: Sequence[tuple[str, Rule]], entity: str, run_id: str, as_of) -> DataFrame:
    """One row per rule with failed and total rows.  All rules are counted in a single aggregate."""
    counts = flagged.agg(F.count(F.lit(1)).alias("total_rows"),
                         *[F.count_if(F.col(flag)).alias(flag) for flag, _ in active])
    lines = F.array(*[
        F.struct(F.lit(rule.rule).alias("rule"), F.lit(rule.column).alias("column_name"),
                 F.lit(rule.severity).alias("severity"), F.col(flag).alias("failed_rows"))
        for flag, rule in active
    ])
    share = F.when(F.col("total_rows") == 0, F.lit(1.0)).otherwise(
        1 - F.col("failed_rows").cast("double") / F.nullif(F.col("total_rows"), F.lit(0)))
    return counts.select(F.inline(lines), "total_rows").select(
        F.lit(run_id).alias("run_id"), F.lit(entity).alias("entity"), "rule", "column_name", "severity",
        "failed_rows", "total_rows", share.alias("pass_rate"), F.lit(as_of).cast("timestamp").alias("checked_at"))


def dq_counts(active: Sequence[tuple[str, Rule]]) -> list[Column]:
    """Rows, rows set aside and failures per rule as aggregates, for ``observe`` on a write that happens anyway."""
    return [F.count(F.lit(1)).alias("total_rows"), F.count_if(_any_error(active)).alias("bad_rows"),
            *[F.count_if(F.coalesce(F.col(flag), F.lit(False))).alias(flag) for flag, _ in active]]


def dq_lines(spark, counts: Mapping[str, int], active: Sequence[tuple[str, Rule]], entity: str, run_id: str, as_of) -> DataFrame:
    """The lines of :func:`dq_results` from counts that a write has observed."""
    from ..sources.tables import local_table

    total = counts["total_rows"]
    rows = [(run_id, entity, rule.rule, rule.column, rule.severity, counts[flag], total, 1.0 if not total else 1 - counts[flag] / total, as_of)
            for flag, rule in active]
    return local_table(spark, rows, "run_id string, entity string, rule string, column_name string, severity string, failed_rows bigint, "
                                    "total_rows bigint, pass_rate double, checked_at timestamp")


def hash_restricted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace contact columns by their SHA-256, so two rows can be told apart but not read."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: hash_value(c) for c in present}) if present else df


def dq_quarantine(bad: DataFrame, active: Sequence[tuple[str, Rule]], columns: Sequence[str], restricted: Sequence[str],
                  entity: str, run_id: str, as_of) -> DataFrame:
    """The rows set aside: failed error rules as ``rule:column,...`` and the row as JSON with contact data hashed."""
    names = F.concat_ws(",", *[F.when(F.col(flag), F.lit(rule.label)) for flag, rule in active
                               if rule.severity == "error"])
    safe = hash_restricted(bad.withColumn("_failed", names), restricted)
    return safe.select(
        F.lit(run_id).alias("run_id"), F.lit(entity).alias("entity"), F.col("_failed").alias("failed_rules"),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns])).alias("record"),
        F.lit(as_of).cast("timestamp").alias("quarantined_at"))


def dq_latest(results: DataFrame) -> DataFrame:
    """Results of the newest run only.  The run id comes from one aggregate used as a scalar subquery."""
    newest = results.agg(F.max_by("run_id", F.struct("checked_at", "run_id"))).scalar()
    return results.where(F.col("run_id") == newest)


def dq_alerts(results: DataFrame) -> DataFrame:
    """Error rules that failed at least once."""
    return results.where((F.col("severity") == "error") & (F.col("failed_rows") > 0))


@dataclass
class Gate:
    """Outcome of the gate.  ``flagged`` is what a job persists before it writes the other three."""

    valid: DataFrame
    results: DataFrame | None
    quarantine: DataFrame | None
    flagged: DataFrame
    active: Sequence[tuple[str, Rule]] = ()

    @classmethod
    def of(cls, flagged: DataFrame, active: Sequence[tuple[str, Rule]], entity: str, columns: Sequence[str], restricted: Sequence[str],
           run_id: str, as_of) -> "Gate":
        """The outcome of rows that carry their flags already, such as staged ones."""
        if not active:
            return cls(flagged, None, None, flagged)
        valid, bad = dq_route(flagged, active)
        return cls(valid, dq_results(flagged, active, entity, run_id, as_of), dq_quarantine(bad, active, columns, restricted, entity, run_id, as_of),
                   flagged, active)

    def release(self) -> None:
        """Give back what ``persist=True`` keeps; call it after the three outcomes are written."""
        self.flagged.unpersist()


def apply_dq(df: DataFrame, entity: str, rules: Sequence[Rule], *, restricted: Sequence[str] = (),
             references: Mapping[str, DataFrame] | None = None, run_id: str = "", as_of=None,
             persist: bool = False) -> Gate:
    """Run the rules of one table.  A table without rules passes through unchanged."""
    flagged, active = flag_rules(df, rules, references, as_of)
    if not active:
        return Gate(df, None, None, df)
    if persist:
        flagged = flagged.persist()
    return Gate.of(flagged, active, entity, df.columns, restricted, run_id, as_of)
