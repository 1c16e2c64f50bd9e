"""Joins.

No join carries a hint.  Dimension-sized sides are broadcast only when Catalyst's size estimate, or the size measured
at a shuffle, is below the session's threshold; larger sides fall back to sort-merge, where adaptive execution splits
skewed partitions.  Range conditions never stand alone: each operator turns them into an equality first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage

__all__ = ["lookup_or_unknown", "point_in_time_join", "bridge_lookup", "inner_star", "dim_left_fact",
           "full_outer_align", "align_facts", "range_expand_join", "interval_join", "conditional_match", "theta_join",
           "self_join_prior", "left_anti", "left_semi", "exists_predicate", "multi_key_fallback_match", "note_join",
           "one_person_per_email"]

UNKNOWN_KEY = -1


def _names(value: str | Sequence[str]) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def lookup_or_unknown(fact: DataFrame, dim: DataFrame, on: str | Mapping[str, str], key: str,
                      unknown: int = UNKNOWN_KEY) -> DataFrame:
    """Attach the surrogate key by business key; a miss or a NULL becomes the unknown key.

    ``on`` is a shared column, or ``{fact column: dim column}``.  The dimension holds one row per business key.
    """
    pairs = {on: on} if isinstance(on, str) else dict(on)
    slim = dim.select(key, *[F.col(d).alias(f"_d_{i}") for i, d in enumerate(pairs.values())])
    condition = reduce(lambda a, b: a & b, [fact[f] == slim[f"_d_{i}"] for i, f in enumerate(pairs)])
    joined = fact.join(slim, condition, "left").drop(*[c for c in slim.columns if c.startswith("_d_")])
    return joined.withColumn(key, F.coalesce(F.col(key), F.lit(unknown)))


def point_in_time_join(fact: DataFrame, versions: DataFrame, person: str, ts: str, key: str = "patron_key",
                       unknown: int = UNKNOWN_KEY) -> DataFrame:
    """Key of the version valid at ``ts``: ``valid_from <= ts < valid_to``.

    Equality on the person, the interval as residual.  A NULL time or one outside every version gives the unknown
    key, never a dropped row.  Versions of one person do not overlap, so rows are not multiplied.
    """
    slim = versions.select(F.col(person).alias("_person"), "valid_from", "valid_to", key)
    valid = (fact[ts] >= slim["valid_from"]) & (fact[ts] < slim["valid_to"])
    joined = fact.join(slim, (fact[person] == slim["_person"]) & valid, "left")
    return joined.drop("_person", "valid_from", "valid_to").withColumn(key, F.coalesce(F.col(key), F.lit(unknown)))


def bridge_lookup(fact: DataFrame, xref: DataFrame, versions: DataFrame, source_id: str, ts: str,
                  system: str, person: str = "patron_id", key: str = "patron_key") -> DataFrame:
    """Source id to person through the cross-reference, then to the version valid at ``ts``."""
    bridge = xref.where(F.col("source_system") == system).select(F.col("source_id").alias("_source_id"), person)
    linked = fact.join(bridge, fact[source_id] == bridge["_source_id"], "left").drop("_source_id")
    return point_in_time_join(linked, versions, person, ts, key).drop(person)


def inner_star(fact: DataFrame, dims: Sequence[tuple[DataFrame, str | Sequence[str]]]) -> DataFrame:
    """Fact joined to each dimension; rows with a missing member drop out."""
    return reduce(lambda acc, dim: acc.join(dim[0], _names(dim[1]), "inner"), dims, fact)


def dim_left_fact(dim: DataFrame, fact: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Every member of the dimension, with its facts if it has any."""
    return dim.join(fact, _names(key), "left")


def full_outer_align(left: DataFrame, right: DataFrame, keys: Sequence[str],
                     amounts: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Two pre-aggregated legs side by side: keys coalesced, absent amounts zero.  NULL keys do not match."""
    names = list(amounts)
    joined = left.join(right, list(keys), "full_outer")
    return joined.withColumns({n: F.coalesce(F.col(n), F.lit(0)) for n in names})


def align_facts(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Aggregates of several facts on shared keys, one row per key.

    Stacked and regrouped instead of joined: one shuffle for any number of facts, NULL keys align, and a fact is
    never joined to a fact.  Every frame holds at most one row per key; measures absent from a frame are NULL.
    """
    measures = list(dict.fromkeys(c for f in frames for c in f.columns if c not in keys))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    if not keys:
        return stacked.agg(*[F.first(m, ignorenulls=True).alias(m) for m in measures])
    return stacked.groupBy(*keys).agg(*[F.first(m, ignorenulls=True).alias(m) for m in measures])


def range_expand_join(budget: DataFrame, calendar: DataFrame, period_start: str = "period_start") -> DataFrame:
    """One row per day of the month that starts at ``period_start``; days outside the calendar are lost.

    The days are generated from the line itself and joined by equality, which avoids a nested loop.
    """
    days = budget.withColumn("date", F.explode(F.sequence(F.col(period_start), F.last_day(period_start))))
    return days.join(calendar.select("date", "date_key"), "date", "inner")


def interval_join(clicks: DataFrame, sales: DataFrame, person: str, click_day: str, sale_day: str, days: int,
                  measures: Sequence[str], series: tuple[str, str] | None = None) -> DataFrame:
    """Sales of the same person 0 to ``days`` days after each click, as sums beside the click.

    ``series=(click column, sale column)`` also asks for the same series, unless the click's is NULL.
    ``clicks`` are distinct rows.  Sales are summed per person, day and series first and each click is spread over
    its ``days + 1`` days, so the join is a plain equality and its output grows with the clicks, not with
    clicks times sales of a busy person.  Clicks without a sale are left out; ``sales_matched`` counts sale rows.
    """
    any_series = F.lit("*")
    tag = F.array(any_series) if series is None else F.array_compact(
        F.array(any_series, F.concat(F.lit("="), F.col(series[1]).cast("string"))))
    daily = (
        sales.where(F.col(person).isNotNull())
        .select(F.col(person).alias("_person"), F.col(sale_day).cast("date").alias("_day"),
                F.explode(tag).alias("_series"), *measures)
        .groupBy("_person", "_day", "_series")
        .agg(F.count(F.lit(1)).alias("sales_matched"), *[F.sum(m).alias(m) for m in measures])
    )
    wanted = any_series if series is None else F.coalesce(
        F.concat(F.lit("="), F.col(series[0]).cast("string")), any_series)
    columns = clicks.columns
    reach = clicks.withColumns({
        "_series": wanted,
        "_day": F.explode(F.sequence(F.col(click_day).cast("date"), F.date_add(F.col(click_day).cast("date"), days))),
    })
    hit = reach.join(daily, (reach[person] == daily["_person"]) & (reach["_day"] == daily["_day"])
                     & (reach["_series"] == daily["_series"]), "inner")
    return hit.groupBy(*[reach[c] for c in columns]).agg(
        F.sum("sales_matched").alias("sales_matched"), *[F.sum(m).alias(m) for m in measures])


def conditional_match(wanted: str, actual: str) -> Column:
    """Residual predicate: no preference, or the preferred value."""
    return F.col(wanted).isNull() | (F.col(actual) == F.col(wanted))


def theta_join(giving: DataFrame, person: str = "patron_id", year: str = "fiscal_year",
               amount: str = "amount") -> DataFrame:
    """Each person in every year that occurs from their first gift on (``gift year <= year``), with their history.

    Columns: ``fiscal_year``, the person, ``by_year`` (map of year to amount) and ``first_year``.  A person's giving
    is folded into one map first (at most one entry per fiscal year), so the inequality becomes a generated
    sequence of years; years nobody gave in are removed by a semi join.  The totals per person and year are kept in
    the shared folder, because history, last year and the list of years all read them and the facts behind them
    should be joined once.
    """
    yearly = cut_lineage(giving.groupBy(person, year).agg(F.sum(amount).alias("_amount")))
    history = yearly.groupBy(person).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(year), F.col("_amount")))).alias("by_year"),
        F.min(year).alias("first_year"))
    last = yearly.agg(F.max(year)).scalar()
    grid = history.withColumn(year, F.explode(F.sequence(F.col("first_year"), last)))
    return grid.join(yearly.select(year).distinct(), year, "left_semi")


def self_join_prior(df: DataFrame, year: str, values: Mapping[str, str], keys: Sequence[str] = ()) -> DataFrame:
    """Prior-year values beside the current ones: ``values`` maps source to output name.

    A self join and not ``lag``: a missing year must give NULL, not the year before it.
    """
    prior = df.select(*keys, (F.col(year) + 1).alias(year), *[F.col(v).alias(n) for v, n in values.items()])
    return df.join(prior, [*keys, year], "left")


def left_anti(left: DataFrame, right: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right``."""
    return left.join(right.select(*_names(keys)), _names(keys), "left_anti")


def left_semi(left: DataFrame, right: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key is in ``right``; duplicates on the right do not multiply."""
    return left.join(right.select(*_names(keys)), _names(keys), "left_semi")


def exists_predicate(df: DataFrame, listed: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Keep rows for which the list has an entry; ``on`` maps column to list column."""
    slim = listed.select(*[F.col(c).alias(f"_l_{i}") for i, c in enumerate(on.values())])
    condition = reduce(lambda a, b: a & b, [df[c] == slim[f"_l_{i}"] for i, c in enumerate(on)])
    return df.join(slim, condition, "left_semi")


def multi_key_fallback_match(new: DataFrame, known: DataFrame, keys: Sequence[str], result: str,
                             rule: str = "match_rule", labels: Sequence[str] | None = None) -> DataFrame:
    """Try each key in turn against ``known``; the first hit wins and its label is recorded.

    When several known rows share a key value the smallest result is taken.  A NULL key never matches.
    """
    labels = list(labels or keys)
    matched = new
    for i, key in enumerate(keys):
        best = known.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(result).alias(f"_hit_{i}"))
        matched = matched.join(best, key, "left")
    hits = [F.col(f"_hit_{i}") for i in range(len(keys))]
    named = reduce(lambda acc, pair: acc.when(pair[0].isNotNull(), pair[1]), zip(hits, labels), F)
    matched = matched.withColumns({result: F.coalesce(*hits), rule: named})
    return matched.drop(*[f"_hit_{i}" for i in range(len(keys))])


def note_join(lines: DataFrame, notes: DataFrame, keys: Sequence[str] = ("month_start", "revenue_stream", "fund_code"),
              columns: Sequence[str] = ("cause", "note", "resolution", "owner_upn")) -> DataFrame:
    """Hand-entered notes beside each line.  Notes are unique per key; two notes on one key repeat the line."""
    return lines.join(notes.select(*keys, *columns), list(keys), "left")


def one_person_per_email(patrons: DataFrame, email: str = "email", person: str = "patron_id") -> DataFrame:
    """Smallest person id per lower-cased address, current versions only where the frame has versions."""
    current = patrons.where("is_current") if "is_current" in patrons.columns else patrons
    return current.where(F.col(email).isNotNull()).groupBy(F.lower(email).alias("email_key")).agg(
        F.min(person).alias(person))
