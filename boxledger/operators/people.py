"""Exact counts of distinct people at any level, from mergeable bitmaps.

People get dense numbers once.  A fact is folded once, per day (or other finest key) and block of 32,768 numbers, to a bitmap
of 4 KB; rows are combined on the map side to one per key and person first, so a person with a third of all rows costs one
row a key and task.  Any
coarser count is the union of those bitmaps and a sum of their bits: it never looks at the fact, at a person or at a
distinct value again, and sub-totals of all levels come from each other instead of from copies of the rows.

Bitmaps compress to a small part of the memory they take, so partitions merged by their shuffled size would grow with the
data; those that hold bitmaps are therefore numbered by blocks of people.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .aggregate import union_all
from .dimensions import number_in_order

__all__ = ["number_people", "person_bitmaps", "merge_bitmaps", "count_people", "people_subtotals", "BLOCK"]

BLOCK = "_block"
NUMBER = "_person_number"


def number_people(people: DataFrame, person: str, known: DataFrame | None = None) -> DataFrame:
    """``person`` and its dense number, from 1 in the order of the id; NULL is nobody.

    With ``known``, numbers given earlier stay and new people follow, so bitmaps of earlier days stay valid.
    """
    distinct = people.select(person).where(F.col(person).isNotNull()).distinct()
    if known is None:
        return number_in_order(distinct, person, NUMBER)
    fresh = number_in_order(distinct.join(known.select(person), person, "left_anti"), person, NUMBER)
    top = F.coalesce(known.agg(F.max(NUMBER)).scalar(), F.lit(0))
    return known.unionByName(fresh.withColumn(NUMBER, F.col(NUMBER) + top))


def person_bitmaps(fact: DataFrame, numbers: DataFrame, person: str, keys: Sequence[str], flags: Mapping[str, Column | None], *,
                   few_keys: bool = False) -> DataFrame:
    """One row per key and block with a bitmap per flag: the people with a row that satisfies it (None: any row).

    Conditions see the fact's columns.  Rows without a person, or with one that has no number, count for nobody but keep
    their key, whose counts are then 0; a block whose flag nobody satisfies has a bitmap without bits.  A fact that has the
    numbers already, looked up where it had fewer rows, is not joined.  With ``few_keys`` (years, not days) every task builds its
    own bitmaps, which take about a byte for each person of a key; rows per key and person, most of them different, would fill
    its memory and move whole.
    """
    numbered = fact if NUMBER in fact.columns else fact.join(numbers.select(F.col(person).alias("_p"), NUMBER), F.col(person) == F.col("_p"), "left")
    shown = numbered.select(*keys, NUMBER, *[(F.lit(True) if flag is None else flag).alias(f"_is_{name}") for name, flag in flags.items()])
    if few_keys:
        dealt = shown.withColumn(BLOCK, F.bitmap_bucket_number(NUMBER))
    else:
        once = shown.groupBy(*keys, NUMBER).agg(*[F.bool_or(f"_is_{name}").alias(f"_is_{name}") for name in flags])
        dealt = once.withColumn(BLOCK, F.bitmap_bucket_number(NUMBER)).repartition(2 * _blocks(numbers.agg(F.max(F.bitmap_bucket_number(NUMBER)))), *keys, BLOCK)
    return dealt.groupBy(*keys, BLOCK).agg(
        *[F.bitmap_construct_agg(F.when(F.col(f"_is_{name}"), F.bitmap_bit_position(NUMBER))).alias(name) for name in flags])


def _blocks(highest: DataFrame) -> int:
    """Number of blocks, from a frame with the highest block number (they start at 1), NULL where there is nobody."""
    return highest.first()[0] or 1


def merge_bitmaps(bitmaps: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """The bitmaps of coarser keys: unions per block."""
    return bitmaps.groupBy(*keys, BLOCK).agg(*[F.bitmap_or_agg(name).alias(name) for name in names])


def _counted(bitmaps: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    return bitmaps.groupBy(*keys).agg(*[F.coalesce(F.sum(F.bitmap_count(name)), F.lit(0)).alias(name) for name in names])


def count_people(bitmaps: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Distinct people per key and flag."""
    return _counted(merge_bitmaps(bitmaps, keys, names), keys, names)


def people_subtotals(bitmaps: DataFrame, levels: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Distinct people on every level of a hierarchy and on the grand total; ``level`` is the number of levels shown.

    Each level is the union of the one below, so the rows shrink from level to level; a NULL key is a group of its own and
    told from a total by ``level``.  The bitmaps are read several times, so they should be staged.
    """
    parts = 2 * _blocks(bitmaps.agg(F.max(BLOCK)))
    merged, out = bitmaps.repartition(parts, *levels[:1], BLOCK), []
    types = {f.name: f.dataType for f in bitmaps.schema}
    for shown in range(len(levels), -1, -1):
        keys = list(levels[:shown])
        merged = merge_bitmaps(merged, keys, names)
        hidden = [F.lit(None).cast(types[c]).alias(c) for c in levels[shown:]]
        out.append(_counted(merged, keys, names).select(*keys, *hidden, F.lit(shown).alias("level"), *names))
    return union_all(out)
