"""Row rules as SQL table functions: ``SELECT * FROM gifts_for('reader')`` gives the rows that a reader may see.

The reader's name is an argument, so a rule can be tried for anyone, and the rule is part of the query: Catalyst inlines it,
filters and column choices of the caller reach the scan, and a list of readers is one subquery, whatever the size of the
table.  (A parameter cannot be used inside a subquery, so rules look the reader up in what a subquery returns.)
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..contracts import check_identifier

__all__ = ["create_row_policy", "read_as", "gift_policy", "venue_policy", "GIFT_RULE", "VENUE_RULE"]

#: A reader sees gifts if a role of theirs does, and anonymous ones only if they are listed by name.
GIFT_RULE = """array_contains((SELECT collect_set(p.user_principal_name) FROM {readers} AS p WHERE p.sees_gifts), {name}.reader)
    AND (NOT r.is_anonymous OR array_contains((SELECT collect_set(p.user_principal_name) FROM {listed} AS p), {name}.reader))"""
#: A reader with the venue rule sees the venues mapped to them; others see all.
VENUE_RULE = """NOT array_contains((SELECT collect_set(p.user_principal_name) FROM {readers} AS p WHERE p.by_venue), {name}.reader)
    OR array_contains(try_element_at((SELECT map_from_entries(collect_list(struct(v.who, v.venues))) FROM (
        SELECT user_principal_name AS who, collect_set(venue_id) AS venues FROM {mapped} WHERE user_principal_name IS NOT NULL GROUP BY 1) AS v),
        {name}.reader), r.venue_id)"""


def create_row_policy(rows: DataFrame, name: str, rule: str, lists: Mapping[str, DataFrame]) -> None:
    """Define the table function ``name(reader)`` over ``rows``, for this session.

    ``rule`` is a SQL condition over a row ``r``, ``{name}.reader`` and the named ``lists`` in braces.  A NULL condition hides
    the row.
    """
    spark = rows.sparkSession
    check_identifier(name)
    views = {key: f"{name}_{key}_of_policy" for key in lists}
    rows.createOrReplaceTempView(f"{name}_rows_of_policy")
    for key, df in lists.items():
        df.createOrReplaceTempView(views[key])
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    shown = ", ".join(f"r.`{c}`" for c in rows.columns)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(reader STRING) RETURNS TABLE ({columns}) "
              f"RETURN SELECT {shown} FROM {name}_rows_of_policy AS r WHERE {rule.format(name=name, **views)}")


def read_as(spark: SparkSession, name: str, reader: str) -> DataFrame:
    """The rows of a policy's table that ``reader`` may see."""
    check_identifier(name)
    return spark.sql(f"SELECT * FROM {name}(:reader)", args={"reader": reader})


def gift_policy(gifts: DataFrame, readers: DataFrame, listed: DataFrame, name: str = "gifts_for") -> None:
    """``readers``: ``user_principal_name, sees_gifts``; ``listed``: who sees anonymous gifts."""
    create_row_policy(gifts, name, GIFT_RULE, {"readers": readers, "listed": listed})


def venue_policy(rows: DataFrame, readers: DataFrame, mapped: DataFrame, name: str = "performances_for") -> None:
    """``readers``: ``user_principal_name, by_venue``; ``mapped``: ``user_principal_name, venue_id``."""
    create_row_policy(rows, name, VENUE_RULE, {"readers": readers, "mapped": mapped})
