"""Exact distinct counts from bitmaps against plain counting."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from boxledger.operators import people
from boxledger.plans.measures import measure
from conftest import rows

DDL = "year int, month int, who string, amount int"


def facts(n, seed=1):
    rng = random.Random(seed)
    return [(2020 + rng.randrange(3), rng.randrange(1, 5), rng.choice([None, "hot", "hot", f"p{rng.randrange(300)}"]), rng.randrange(-2, 9)) for _ in range(n)]


def distinct(found, keep):
    return len({r[2] for r in found if keep(r) and r[2] is not None})


def test_subtotals_match_plain_counting(frame):
    found = facts(1500) + [(2099, 1, None, 5)]
    df = frame(found, DDL)
    numbers = people.number_people(df, "who")
    assert rows(numbers.agg(F.min("_person_number"), F.max("_person_number"), F.count_distinct("_person_number"))) == [(1, numbers.count(), numbers.count())]
    bitmaps = people.person_bitmaps(df, numbers, "who", ["year", "month"], {"anyone": None, "givers": F.col("amount") > 0})
    got = rows(people.people_subtotals(bitmaps, ["year", "month"], ["anyone", "givers"]))
    want = [(None, None, 0, distinct(found, lambda r: True), distinct(found, lambda r: r[3] > 0))]
    for y in {r[0] for r in found}:
        want.append((y, None, 1, distinct(found, lambda r: r[0] == y), distinct(found, lambda r: r[0] == y and r[3] > 0)))
        for m in {r[1] for r in found if r[0] == y}:
            here = [r for r in found if r[:2] == (y, m)]
            want.append((y, m, 2, distinct(here, lambda r: True), distinct(here, lambda r: r[3] > 0)))
    assert got == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_numbers_beyond_one_block(spark):
    df = spark.range(100_000).select((F.col("id") % 70_000).alias("who"), (F.col("id") % 3).alias("k"))
    numbers = people.number_people(df, "who")
    bitmaps = people.person_bitmaps(df, numbers, "who", ["k"], {"n": None})
    assert bitmaps.select("_block").distinct().count() == 3
    assert rows(people.count_people(bitmaps, ["k"], ["n"])) == rows(df.groupBy("k").agg(F.count_distinct("who")))
    assert rows(people.count_people(bitmaps, [], ["n"])) == [(70_000,)]


def test_bitmaps_are_dealt_by_blocks_and_not_merged_by_their_compressed_size(spark):
    df = spark.range(100_000).select(F.col("id").alias("who"), (F.col("id") % 3).alias("k"))
    bitmaps = people.person_bitmaps(df, people.number_people(df, "who"), "who", ["k"], {"n": None})
    assert bitmaps.count() == 12
    assert bitmaps.select(F.spark_partition_id()).distinct().count() > 2
    plan = people.people_subtotals(bitmaps, ["k"], ["n"])._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan


def test_known_numbers_stay(frame):
    first = people.number_people(frame([("b",), ("d",), (None,)], "who string"), "who")
    second = people.number_people(frame([("a",), ("d",), ("e",), ("a",)], "who string"), "who", first)
    assert rows(second) == [("a", 3), ("b", 1), ("d", 2), ("e", 4)]


def test_empty_facts(frame):
    df = frame([], DDL)
    bitmaps = people.person_bitmaps(df, people.number_people(df, "who"), "who", ["year"], {"n": None})
    assert rows(people.people_subtotals(bitmaps, ["year"], ["n"])) == [(None, 0, 0)]


def test_neither_expand_nor_distinct_rows_in_the_plan(frame):
    df = frame(facts(50), DDL)
    bitmaps = people.person_bitmaps(df, people.number_people(df, "who"), "who", ["year", "month"], {"anyone": None, "givers": F.col("amount") > 0})
    plan = people.people_subtotals(bitmaps, ["year", "month"], ["anyone", "givers"])._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "distinct" not in plan.lower()
    built = bitmaps._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in built


def test_measures_take_bitmaps_where_they_have_the_keys(frame):
    gifts = frame([(2020, "a", 5, "x"), (2020, "a", 6, "y"), (2020, "b", -1, "x"), (2021, "c", 7, "x"), (2022, None, 7, "x")], "fiscal_year int, patron_id string, amount int, fund string")
    bitmaps = people.person_bitmaps(gifts, people.number_people(gifts, "patron_id"), "patron_id", ["fiscal_year"], {"donors": F.col("amount") > 0})
    for keys in (["fiscal_year"], []):
        plain = measure({"gifts": gifts}, ["gift_revenue", "donors"], keys)
        mine = measure({"gifts": gifts}, ["gift_revenue", "donors"], keys, people={"gifts": bitmaps})
        assert rows(mine) == rows(plain)
        assert rows(measure({"gifts": gifts}, ["donors"], keys, people={"gifts": bitmaps})) == rows(plain, *keys, "donors")
    by_fund = measure({"gifts": gifts}, ["donors"], ["fund"], people={"gifts": bitmaps})  # the bitmaps know no fund
    assert rows(by_fund) == [("x", 2), ("y", 1)]
    filtered = measure({"gifts": gifts}, ["donors"], [], {"fiscal_year": [2020, 2021]}, people={"gifts": bitmaps})
    assert rows(filtered) == [(2,)]
