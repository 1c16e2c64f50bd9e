"""Masks for contact columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import as_column

__all__ = ["mask_email", "mask_partial", "mask_default", "unmask"]

# The shapes a masked value takes.
EMAIL_MASK = "XXX@XXXX.com"
PHONE_PREFIX = "XXX-XXX-"
DEFAULT_MASK = "xxxx"
CLEAR_TEXT_ROLES = frozenset({"development"})


def mask_email(value: str | Column) -> Column:
    """First letter, then a constant."""
    return F.concat(F.substring(as_column(value), 1, 1), F.lit(EMAIL_MASK))


def mask_partial(value: str | Column, keep: int = 4, prefix: str = PHONE_PREFIX) -> Column:
    """Constant prefix and the last ``keep`` characters.  A value no longer than ``keep`` shows only the prefix."""
    text = as_column(value)
    tail = F.when(F.length(text) > keep, F.right(text, F.lit(keep))).otherwise(F.lit(""))
    return F.when(text.isNotNull(), F.concat(F.lit(prefix), tail))


def mask_default(value: str | Column) -> Column:
    """Full mask; NULL stays NULL."""
    return F.when(as_column(value).isNotNull(), F.lit(DEFAULT_MASK))


def unmask(role: str) -> bool:
    """Does the role see clear text?"""
    return role.lower() in CLEAR_TEXT_ROLES
