"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

__all__ = ["as_column", "nullif_blank", "clean_text", "full_name", "region_bucket", "system_of", "ordered_string_agg"]

# The boroughs and neighbouring states that define the two local regions.
NYC_BOROUGHS = ("New York", "Brooklyn", "Queens", "Bronx", "Staten Island")
METRO_STATES = ("NY", "NJ", "CT")


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def nullif_blank(value: str | Column) -> Column:
    """The empty string becomes NULL; blanks inside the text are untouched."""
    return F.nullif(as_column(value), F.lit(""))


def clean_text(value: str | Column) -> Column:
    """Cast to text, trim, and turn an empty result into NULL."""
    return nullif_blank(F.trim(as_column(value).cast("string")))


def full_name(*parts: str | Column) -> Column:
    """Join the parts that are present with one space; all NULL gives ''."""
    return F.concat_ws(" ", *[as_column(p) for p in parts])


def region_bucket(city: str | Column, state: str | Column, country: str | Column) -> Column:
    """NYC, NY Metro, Domestic or Unknown.  A NULL never satisfies a test, so it falls through."""
    city, state, country = as_column(city), as_column(state), as_column(country)
    in_city = city.isin(*NYC_BOROUGHS) & (state == "NY")
    return (
        F.when(in_city, "NYC")
        .when(state.isin(*METRO_STATES), "NY Metro")
        .when(country == "USA", "Domestic")
        .otherwise("Unknown")
    )


def system_of(entity: str | Column) -> Column:
    """The source system is the part of an entity name before its first dot."""
    return F.substring_index(as_column(entity), ".", 1)


def ordered_string_agg(value: str | Column, order: str | Column, sep: str = " · ") -> Column:
    """Aggregate: join ``value`` with ``sep`` in ascending ``order``; NULL values are left out.

    Meant for groups of bounded size such as one row per source system.
    """
    pair = F.struct(as_column(order).alias("o"), as_column(value).alias("v"))
    ranked = F.array_sort(F.collect_list(F.when(as_column(value).isNotNull(), pair)))
    return F.array_join(F.transform(ranked, lambda p: p["v"]), sep)
