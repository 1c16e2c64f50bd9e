"""Fiscal-year time intelligence for additive measures.

A report cell for a month wants sums over *other* dates: the year so far, the same month last year, everything since
the beginning.  Turned round, every source month knows the report months it contributes to.  So rows are folded to
months first, each monthly row is spread over its report months, and one grouping finishes every calculation at once.
No self join, no window over the fact; months without postings still show their year to date.

With a ``cap`` (the last ledger date) a year in progress counts up to that day and the prior year up to the same day
twelve months earlier.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fiscal_end, fiscal_start, fiscal_year, month_start, safe_ratio

__all__ = ["CALCULATIONS", "period_table", "ti_current", "ti_fytd", "ti_py", "ti_py_fytd", "ti_yoy", "ti_yoy_pct",
           "ti_fytd_vs_py", "ti_fytd_vs_py_pct", "as_of_date", "trailing_year", "with_comparisons"]

_MONTH = "month_start"
_ALL, _CAPPED, _PRIOR_CAPPED = "", "__capped", "__prior_capped"


@dataclass(frozen=True)
class _Calculation:
    """Which of the three monthly sums is used, and for which report months."""

    slot: str
    suffix: str
    needs_cap: bool = False


CALCULATIONS = {
    "current": _Calculation(_ALL, ""),
    "py": _Calculation(_ALL, "_py"),
    "fytd": _Calculation(_CAPPED, "_fytd"),
    "py_fytd": _Calculation(_PRIOR_CAPPED, "_py_fytd"),
    "full_year": _Calculation(_ALL, "_full_year"),
    "balance": _Calculation(_CAPPED, "_balance", needs_cap=True),
    "balance_py": _Calculation(_CAPPED, "_balance_py", needs_cap=True),
    "balance_py_fytd": _Calculation(_PRIOR_CAPPED, "_balance_py_fytd", needs_cap=True),
}


def as_of_date(gl: DataFrame, date: str = "date") -> Column:
    """Last ledger date, whatever is filtered; a scalar subquery."""
    return gl.agg(F.max(date)).scalar()


def _months(first: Column, last: Column) -> Column:
    """Month starts from first to last; none when the range is empty."""
    step = F.expr("interval 1 month")
    nothing = F.array().cast("array<date>")
    return F.when(first <= last, F.sequence(first, last, step)).otherwise(nothing)


def _targets(calculation: str, cap: Column | None) -> Column:
    month = F.col(_MONTH)
    last_of_year = month_start(fiscal_end(fiscal_year(month)))
    if calculation == "current":
        return F.array(month)
    if calculation == "py":
        return F.array(F.add_months(month, 12))
    if calculation == "fytd":
        return _months(month, last_of_year)
    if calculation == "py_fytd":
        return _months(F.add_months(month, 12), F.add_months(last_of_year, 12))
    if calculation == "full_year":
        return _months(fiscal_start(fiscal_year(month)), last_of_year)
    cap_month = month_start(cap)
    if calculation == "balance":
        return _months(month, cap_month)
    if calculation == "balance_py":
        return _months(F.add_months(month, 12), F.add_months(cap_month, 12))
    # Year to date of the prior year: runs on to the end of the year the cap lies in.
    return _months(F.add_months(month, 12), month_start(fiscal_end(fiscal_year(cap))))


def period_table(daily: DataFrame, measures: Mapping[str, Column] | Sequence[str], calculations: Sequence[str],
                 keys: Sequence[str] = (), cap: Column | None = None, calendar: DataFrame | None = None,
                 date: str = "date") -> DataFrame:
    """Measures by month and calculation: columns ``<measure><suffix>`` beside ``keys``, ``fiscal_year``, ``month_start``.

    ``measures`` are row-level values that are summed.  ``calendar`` limits the report months to those it holds.
    """
    values = dict(measures) if isinstance(measures, Mapping) else {m: F.col(m) for m in measures}
    day = F.col(date)
    in_cap = F.lit(True) if cap is None else day <= cap
    in_prior_cap = F.lit(True) if cap is None else day <= F.add_months(cap, -12)
    # Days first: one plain sum per measure over the fact, the three capped variants only over the days.
    by_day = daily.groupBy(*keys, day.alias(date)).agg(*[F.sum(value).alias(name) for name, value in values.items()])
    slots = {_ALL: F.lit(True), _CAPPED: in_cap, _PRIOR_CAPPED: in_prior_cap}
    used = {CALCULATIONS[c].slot for c in calculations}
    folds = [F.sum(F.when(slots[slot], F.col(name))).alias(name + slot) for name in values for slot in sorted(used)]
    monthly = by_day.groupBy(*keys, month_start(day).alias(_MONTH)).agg(*folds)

    monthly = monthly.withColumns({f"_to_{c}": _targets(c, cap) for c in calculations})
    reach = F.concat(*[
        F.arrays_zip(F.col(f"_to_{c}"), F.array_repeat(F.lit(c), F.size(f"_to_{c}"))).cast(
            "array<struct<month:date,calc:string>>") for c in calculations])
    spread = monthly.withColumn("_to", F.explode(reach))
    spread = spread.withColumns({_MONTH: F.col("_to.month"), "_calc": F.col("_to.calc")})
    totals = [F.sum(F.when(F.col("_calc") == c, F.col(name + CALCULATIONS[c].slot))).alias(name + CALCULATIONS[c].suffix)
              for name in values for c in calculations]
    table = spread.groupBy(*keys, _MONTH).agg(*totals)
    if calendar is not None:
        known = calendar.where(F.col("date_key") > 0).select(month_start("date").alias(_MONTH)).distinct()
        table = table.join(known, _MONTH, "left_semi")
    columns = [name + CALCULATIONS[c].suffix for name in values for c in calculations]
    return table.select(*keys, fiscal_year(_MONTH).alias("fiscal_year"), _MONTH, *columns)


def trailing_year(daily: DataFrame, value: Column, name: str, cap: Column, keys: Sequence[str] = (),
                  date: str = "date", prior: bool = False) -> DataFrame:
    """Sum over the 365 days that end on the last day of each month (or on the cap, if that is earlier).

    ``prior`` gives the window that ended twelve months before.  A day reaches thirteen months, or up to the end of the
    fiscal year of the cap.
    """
    per_day = daily.groupBy(*keys, F.col(date).alias("_day")).agg(F.sum(value).alias("_value"))
    shift = 12 if prior else 0
    limit = F.add_months(cap, -12) if prior else cap
    last_report = month_start(fiscal_end(fiscal_year(cap))) if prior else month_start(cap)
    start = F.add_months(month_start("_day"), shift)
    # After the cap the window stands still, so the last year of days reaches on to the end of the report.
    normal_end = F.add_months(start, 12)
    reach = _months(start, F.when(normal_end >= month_start(cap), last_report).otherwise(normal_end))
    spread = per_day.withColumn(_MONTH, F.explode(reach))
    window_end = F.least(F.last_day(F.add_months(F.col(_MONTH), -shift)), limit)
    inside = spread.where(F.col("_day").between(F.date_add(window_end, -364), window_end))
    return inside.groupBy(*keys, _MONTH).agg(F.sum("_value").alias(name))


def with_comparisons(table: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Add year-over-year differences (NULL when either side is) and shares for every measure that has both sides."""
    added = {}
    present = set(table.columns)
    for name in measures:
        if {name, f"{name}_py"} <= present:
            difference = F.col(name) - F.col(f"{name}_py")
            added[f"{name}_yoy"] = difference
            added[f"{name}_yoy_pct"] = safe_ratio(difference, f"{name}_py")
        if {f"{name}_fytd", f"{name}_py_fytd"} <= present:
            difference = F.col(f"{name}_fytd") - F.col(f"{name}_py_fytd")
            added[f"{name}_fytd_vs_py"] = difference
            added[f"{name}_fytd_vs_py_pct"] = safe_ratio(difference, F.abs(f"{name}_py_fytd"))
    return table.withColumns(added) if added else table


def _one(calculation: str):
    def run(daily: DataFrame, measures, keys: Sequence[str] = (), cap: Column | None = None,
            calendar: DataFrame | None = None) -> DataFrame:
        return period_table(daily, measures, [calculation], keys, cap, calendar)

    run.__name__ = f"ti_{calculation}"
    run.__doc__ = f"The calculation ``{calculation}`` alone; see :func:`period_table`."
    return run


ti_current, ti_fytd, ti_py, ti_py_fytd = (_one(c) for c in ("current", "fytd", "py", "py_fytd"))


def _compared(calculations: Sequence[str], suffix: str):
    def run(daily: DataFrame, measures, keys: Sequence[str] = (), cap: Column | None = None,
            calendar: DataFrame | None = None) -> DataFrame:
        table = with_comparisons(period_table(daily, measures, calculations, keys, cap, calendar), list(measures))
        return table.select(*keys, "fiscal_year", _MONTH, *[f"{m}{suffix}" for m in measures])

    run.__name__ = f"ti{suffix}"
    run.__doc__ = f"The comparison ``{suffix.lstrip('_')}``; see :func:`with_comparisons`."
    return run


ti_yoy = _compared(["current", "py"], "_yoy")
ti_yoy_pct = _compared(["current", "py"], "_yoy_pct")
ti_fytd_vs_py = _compared(["fytd", "py_fytd"], "_fytd_vs_py")
ti_fytd_vs_py_pct = _compared(["fytd", "py_fytd"], "_fytd_vs_py_pct")
