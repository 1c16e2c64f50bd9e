"""Readable change texts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import as_column

__all__ = ["fmt_change", "favourable"]

# Arrows and the no-break space around a change text.
UP, DOWN, FLAT, NBSP = "▲", "▼", "─", "\u00a0"


def _number(size: Column, digits: int) -> Column:
    """Halves are rounded away from zero; ``format_number`` alone rounds them to the even digit."""
    return F.format_number(F.round(size, digits), digits)


def _signed(value: Column, digits: int) -> Column:
    body = _number(F.abs(value), digits)
    rounded = F.round(value, digits)
    sign = F.when(rounded > 0, "+").when(rounded < 0, "-").otherwise("")
    return F.concat(sign, body)


def _money(change: Column) -> Column:
    size = F.abs(change)
    text = F.when(size >= 1_000_000, F.concat(F.lit("$"), _number(size / 1_000_000, 1), F.lit("M"))).otherwise(
        F.concat(F.lit("$"), _number(size / 1_000, 0), F.lit("K"))
    )
    return F.concat(F.when(change >= 0, "+").otherwise("-"), text)


def fmt_change(actual: str | Column, comparison: str | Column, kind: str = "money", none_text: str = "No prior year") -> Column:
    """Text for a change.  ``kind``: money (amount and percent), money_only, pct (points) or days."""
    actual, comparison = as_column(actual).cast("double"), as_column(comparison).cast("double")
    change = actual - comparison
    if kind == "pct":
        body = F.concat(_signed(change * 100, 1), F.lit(" pts"))
    elif kind == "days":
        body = F.concat(_signed(change, 0), F.lit(" days"))
    elif kind == "money_only":
        body = _money(change)
    elif kind == "money":
        share = F.when(comparison != 0, change / F.nullif(F.abs(comparison), F.lit(0.0)))
        percent = F.coalesce(F.concat(_signed(share * 100, 1), F.lit("%")), F.lit(""))
        body = F.concat(_money(change), F.lit(" | "), percent)
    else:
        raise ValueError(f"unknown kind {kind!r}")
    arrow = F.when(change > 0, UP).when(change < 0, DOWN).otherwise(FLAT)
    text = F.concat(F.lit(NBSP), body, F.lit(NBSP), arrow, F.lit(NBSP))
    return F.when(actual.isNull() | comparison.isNull(), F.lit(none_text)).otherwise(text)


def favourable(actual: str | Column, comparison: str | Column, up_is_good: bool = True) -> Column:
    """1 when the change is good, -1 when bad, 0 when equal, NULL when there is nothing to compare."""
    actual, comparison = as_column(actual), as_column(comparison)
    direction = F.signum((actual - comparison).cast("double")).cast("int")
    return direction if up_is_good else -direction
