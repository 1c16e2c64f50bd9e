"""Money and ratio expressions.  Amounts are decimals before any arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import as_column

__all__ = ["money", "safe_ratio", "gross_amount", "net_amount", "signed_ledger_amount", "conditional_sum",
           "conditional_count", "distinct_when", "favourable_variance"]


def money(value: str | Column, precision: int = 14) -> Column:
    """``decimal(precision, 2)`` with NULL read as zero."""
    return F.coalesce(as_column(value).cast(f"decimal({precision},2)"), F.lit(0).cast(f"decimal({precision},2)"))


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """Quotient; a zero denominator gives NULL instead of an error (ANSI mode is on)."""
    num, den = as_column(num), as_column(den)
    zero = F.lit(0)
    return F.when(den != zero, num / F.nullif(den, zero))


def gross_amount(quantity: str | Column, unit_price: str | Column) -> Column:
    """Quantity times price, either missing part read as zero."""
    qty = F.coalesce(as_column(quantity).cast("int"), F.lit(0))
    return (qty * money(unit_price, 12)).cast("decimal(14,2)")


def net_amount(quantity: str | Column, unit_price: str | Column, discount: str | Column) -> Column:
    """Gross less discount."""
    return (gross_amount(quantity, unit_price) - money(discount)).cast("decimal(14,2)")


def signed_ledger_amount(debit: str | Column, credit: str | Column) -> Column:
    """Credit less debit: revenue is positive, expense negative."""
    return (money(credit) - money(debit)).cast("decimal(14,2)")


def conditional_sum(value: str | Column, condition: Column, empty_as_zero: bool = True) -> Column:
    """Sum of ``value`` over rows where ``condition`` is true."""
    total = F.sum(F.when(condition, as_column(value)))
    return F.coalesce(total, F.lit(0)) if empty_as_zero else total


def conditional_count(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def distinct_when(value: str | Column, condition: Column | None = None) -> Column:
    """Distinct non-null values, optionally only under a condition."""
    column = as_column(value)
    return F.count_distinct(column if condition is None else F.when(condition, column))


def favourable_variance(account_type: str | Column, actual: str | Column, budget: str | Column) -> Column:
    """Positive is good: revenue above its budget, or any other account below it."""
    actual, budget = as_column(actual), as_column(budget)
    return F.when(as_column(account_type) == "Revenue", actual - budget).otherwise(budget - actual)
