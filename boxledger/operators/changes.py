"""Latest version per key, upserts, delete-and-insert, marks.

Every result is a new DataFrame: Parquet has no in-place MERGE, so a caller writes it as a new snapshot
(:mod:`boxledger.sources.tables`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import MapType, VariantType

from ..functions import row_hash

__all__ = ["latest_per_key", "upsert", "upsert_null_safe", "delete_insert", "update_changed_then_insert",
           "insert_only_dim", "crosswalk_update", "get_mark", "set_mark", "next_mark", "loaded_days", "change_counts", "tie_break"]

EPOCH_MARK = "1900-01-01 00:00:00"


def tie_break(df: DataFrame, used: Sequence[str] = ()) -> list[Column]:
    """Ordering over the columns not used yet, so that only rows equal in everything can tie."""
    rest = [f for f in df.schema if f.name not in used]
    return [(row_hash(f"`{f.name}`") if isinstance(f.dataType, (MapType, VariantType)) else F.col(f"`{f.name}`")).desc_nulls_last()
            for f in rest]


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: str | Sequence[str],
                   ingested_at: str | None = "_ingested_at") -> DataFrame:
    """The newest row per key: ``order_by`` descending with NULL last, then ingest time, then the other columns.

    Ordering by the remaining columns makes ties deterministic at no cost where there are none.  The ``= 1`` filter is recognised by Catalyst, which keeps one
    row per key on every map task before the shuffle (WindowGroupLimit), so a key holding a third of the table
    sends one row per task, not the group.
    """
    names = [order_by] if isinstance(order_by, str) else list(order_by)
    if ingested_at and ingested_at in df.columns:
        names.append(ingested_at)
    ordering = [F.col(n).desc_nulls_last() for n in names] + tie_break(df, [*keys, *names])
    version = F.row_number().over(Window.partitionBy(*keys).orderBy(*ordering))
    return df.withColumn("_version", version).where(F.col("_version") == 1).drop("_version")


def _fresh_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target does not have.

    The target is first reduced to the keys it shares with the source.  With a small increment that is a broadcast
    semi join over the target's key columns, so the large side is never shuffled.
    """
    shared = target.select(*keys).join(source.select(*keys), list(keys), "left_semi")
    return source.join(shared, list(keys), "left_anti")


def _replace_matching(target: DataFrame, source: DataFrame, keys: Sequence[str], take_source: Column) -> DataFrame:
    """Target rows, each swapped for its source row where ``take_source`` (over structs ``_t``/``_s``) holds."""
    packed_target = target.select(*[F.col(k).alias(k) for k in keys], F.struct(*target.columns).alias("_t"))
    packed_source = source.select(*[F.col(k).alias(k) for k in keys],
                                  F.struct(*[F.col(c) for c in target.columns]).alias("_s"))
    joined = packed_target.join(packed_source, list(keys), "left")
    chosen = F.when(F.col("_s").isNotNull() & take_source, F.col("_s")).otherwise(F.col("_t"))
    return joined.select(chosen.alias("_row")).select("_row.*")


def upsert(target: DataFrame | None, source: DataFrame, keys: Sequence[str], hash_column: str = "_row_hash",
           newest_wins: str | None = None) -> DataFrame:
    """Insert unseen keys and replace rows whose fingerprint differs; equal rows stay untouched.

    ``source`` holds one row per key.  By default the arriving row wins even when it is an older version delivered
    late; name a column in ``newest_wins`` to keep whichever row is newer by it.
    """
    if target is None:
        return source
    differs = F.col(f"_t.{hash_column}") != F.col(f"_s.{hash_column}")
    if newest_wins:
        arrived, held = F.col(f"_s.{newest_wins}"), F.col(f"_t.{newest_wins}")
        differs = differs & (held.isNull() | (arrived >= held))
    kept = _replace_matching(target, source, keys, differs)
    return kept.unionByName(_fresh_rows(target, source, keys).select(*target.columns))


def upsert_null_safe(target: DataFrame, source: DataFrame, keys: Sequence[str], compare: Sequence[str],
                     tag: str = "_action") -> DataFrame:
    """As :func:`upsert`, comparing columns with NULL equal to NULL.

    The extra column says ``insert``, ``update`` or ``same``; :func:`change_counts` summarises it.
    """
    changed = F.lit(False)
    for name in compare:
        changed = changed | ~F.col(f"_t.{name}").eqNullSafe(F.col(f"_s.{name}"))
    columns = target.columns
    packed_target = target.select(*keys, F.struct(*columns).alias("_t"))
    packed_source = source.select(*keys, F.struct(*columns).alias("_s"))
    joined = packed_target.join(packed_source, list(keys), "left").withColumn(
        tag, F.when(F.col("_s").isNotNull() & changed, "update").otherwise("same"))
    row = F.when(F.col(tag) == "update", F.col("_s")).otherwise(F.col("_t"))
    kept = joined.select(row.alias("_row"), tag).select("_row.*", tag)
    fresh = _fresh_rows(target, source, keys).select(*columns).withColumn(tag, F.lit("insert"))
    return kept.unionByName(fresh)


def change_counts(tagged: DataFrame, tag: str = "_action") -> DataFrame:
    """One row: how many rows were inserted and updated."""
    return tagged.agg(F.count_if(F.col(tag) == "insert").alias("inserted"),
                      F.count_if(F.col(tag) == "update").alias("updated"))


def delete_insert(target: DataFrame | None, staged: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Drop target rows whose id is staged, then add the staged rows.  Handles rows that change late."""
    if target is None:
        return staged
    keys = [key] if isinstance(key, str) else list(key)
    survivors = target.join(staged.select(*keys), keys, "left_anti")
    return survivors.unionByName(staged)


def update_changed_then_insert(dim: DataFrame, source: DataFrame, business_id: str, key: str, watched: Sequence[str],
                               attributes: Sequence[str] | None = None, insert_only: Mapping[str, Column] | None = None,
                               unknown: Mapping | None = None) -> DataFrame:
    """Type-1 dimension.

    ``attributes`` are overwritten only where one of the ``watched`` columns differs (NULL equals NULL), so a change
    in an unwatched column alone is not copied.  Unseen ids get the next keys; the unknown member is ensured.
    ``insert_only`` gives expressions applied to new rows but not to updates.
    """
    from .dimensions import assign_surrogate_keys, unknown_member

    attributes = list(attributes or [c for c in dim.columns if c not in (business_id, key)])
    arriving = source.select(business_id, F.struct(*attributes).alias("_s"))
    moved = F.lit(False)
    for name in watched:
        moved = moved | ~F.col(name).eqNullSafe(F.col(f"_s.{name}"))
    joined = dim.join(arriving, business_id, "left").withColumn("_moved", F.col("_s").isNotNull() & moved)
    updated = joined.select(*[
        F.when(F.col("_moved"), F.col(f"_s.{c}")).otherwise(F.col(c)).alias(c) if c in attributes else F.col(c)
        for c in dim.columns
    ])
    new_rows = source.withColumns(dict(insert_only)) if insert_only else source
    result = assign_surrogate_keys(updated, new_rows, business_id, key)
    return unknown_member(result, key, unknown, dim) if unknown is not None else result


def insert_only_dim(dim: DataFrame, source: DataFrame, business_id: str, key: str,
                    unknown: Mapping | None = None) -> DataFrame:
    """Type-0 dimension: unseen ids are added, existing rows never change."""
    from .dimensions import assign_surrogate_keys, unknown_member

    result = assign_surrogate_keys(dim, source, business_id, key)
    return unknown_member(result, key, unknown, dim) if unknown is not None else result


def crosswalk_update(dim_fund: DataFrame, crosswalk: DataFrame, fund_id: str = "fund_id",
                     source_id: str = "source_fund_id", code: str = "fund_code",
                     target: str = "ledger_fund_code") -> DataFrame:
    """Stamp the ledger's code on the fund dimension; funds absent from the crosswalk keep theirs."""
    links = crosswalk.where(F.col(source_id).isNotNull()).groupBy(F.col(source_id).alias(fund_id)).agg(
        F.max(code).alias("_code"))
    stamped = dim_fund.join(links, fund_id, "left").withColumn(target, F.coalesce("_code", target))
    return stamped.select(*dim_fund.columns)


def get_mark(marks: DataFrame | None, name: str):
    """The saved high-water mark, or 1900-01-01 when there is none."""
    from datetime import datetime

    floor = datetime.fromisoformat(EPOCH_MARK)
    if marks is None:
        return floor
    row = marks.where(F.col("object_name") == name).agg(F.max("last_value").alias("m")).first()
    return row["m"] or floor


def next_mark(*changes: tuple[DataFrame, str]) -> DataFrame:
    """One row: the largest change value over all tables involved, to be read before the load starts."""
    tops = [df.agg(F.max(column).cast("timestamp").alias("last_value")) for df, column in changes]
    stacked = tops[0]
    for other in tops[1:]:
        stacked = stacked.unionByName(other)
    return stacked.agg(F.max("last_value").alias("last_value"))


def set_mark(marks: DataFrame | None, name: str, value: DataFrame, as_of) -> DataFrame:
    """Marks with the row for ``name`` replaced; a NULL value leaves the old mark in place."""
    row = value.where(F.col("last_value").isNotNull()).select(
        F.lit(name).alias("object_name"), "last_value", F.lit(as_of).cast("timestamp").alias("updated_at"))
    if marks is None:
        return row
    nothing_new = value.agg(F.count("last_value") == 0).scalar()
    return marks.where((F.col("object_name") != name) | nothing_new).unionByName(row)


def loaded_days(log: DataFrame) -> DataFrame:
    """Distinct (table, day) pairs that are already loaded."""
    return log.select("entity", "load_date").distinct()
