from __future__ import annotations

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from boxledger.operators import aggregate, dimensions, facts, identity, joins
from conftest import d, rows, ts


def bounds(frame, start, end):
    return frame([(d(start), d(end))], "start date, end date")


def test_fiscal_calendar(frame):
    calendar = dimensions.fiscal_calendar(bounds(frame, "2024-02-28", "2024-07-01"))
    by_key = {r["date_key"]: r for r in calendar.collect()}
    assert by_key[20240229]["fiscal_year_label"] == "FY2024"
    june, july = by_key[20240630], by_key[20240701]
    assert (june["fiscal_month_num"], june["fiscal_quarter"], june["season_label"], june["is_weekend"], june["weekday_num"]) == (12, 4, "2023-24", True, 1)
    assert (july["fiscal_year"], july["fiscal_month_num"], july["fiscal_quarter"], july["season_label"]) == (2025, 1, 1, "2024-25")
    assert by_key[20240629]["is_weekend"] and not by_key[20240701]["is_weekend"]
    assert by_key[-1]["date"] == d("1900-01-01") and by_key[-1]["fiscal_year"] == 1900


def test_calendar_bounds_without_facts(frame):
    empty = frame([], "x date")
    got = dimensions.calendar_bounds([(empty, "x")], [(empty, "x")], (frame([(d("2026-07-01"),)], "p date"), "p"), "2025-03-01").first()
    assert tuple(got) == (d("2024-07-01"), d("2027-06-30"))


def test_surrogate_keys_are_stable_and_dense(frame):
    dim = frame([(-1, "N/A"), (7, "m")], "key int, id string")
    new = frame([("z",), ("a",), ("m",), (None,)], "id string")
    keyed = dimensions.assign_surrogate_keys(dim, new, "id", "key")
    assert rows(keyed) == [(-1, "N/A"), (7, "m"), (8, "a"), (9, "z")]
    assert rows(dimensions.assign_surrogate_keys(keyed, new, "id", "key")) == rows(keyed)


def test_number_in_order_over_many_partitions(spark):
    df = spark.range(0, 5000, 1, 16).select((F.col("id") * 7919 % 5003).alias("k"))
    numbered = dimensions.number_in_order(df, "k", "n").orderBy("k").collect()
    assert [r["n"] for r in numbered] == list(range(1, 5001))


DIM = ("patron_key int, patron_id string, first_name string, last_name string, full_name string, email string, phone string, address_line1 string, city string, state string, postal_code string, "
       "country string, region string, patron_type string, email_opt_in boolean, source_systems string, first_seen_date date, scd_hash string, valid_from timestamp, valid_to timestamp, is_current boolean")
SNAP = ("patron_id string, first_name string, last_name string, email string, phone string, address_line1 string, city string, state string, postal_code string, country string, patron_type string, "
        "email_opt_in boolean, source_systems string, first_seen_date date")


def person(pid, email="e", address="1 Main", city="Brooklyn", state="NY"):
    return (pid, "Ann", "Lee", email, "555", address, city, state, "10001", "USA", "Individual", True, "tessitura", d("2020-01-01"))


def test_scd2(frame):
    first = dimensions.scd2_patron(frame([], DIM), frame([person("same"), person("moves"), person("mail"), person("both"), person("shift", address="A", city=None, state=None)], SNAP), "2024-01-01 00:00:00")
    second = dimensions.scd2_patron(first, frame([person("same"), person("moves", address="2 New"), person("mail", email="n"), person("both", email="n", address="2 New"), person("new"),
                                                  person("shift", address=None, city="A", state=None)], SNAP), "2025-01-01 00:00:00")
    versions: dict = {}
    for r in second.where("patron_key > 0").orderBy("valid_from").collect():
        versions.setdefault(r["patron_id"], []).append(r)
    assert {k: len(v) for k, v in versions.items()} == {"same": 1, "moves": 2, "mail": 1, "both": 2, "new": 1, "shift": 1}
    for chain in versions.values():
        assert [v["is_current"] for v in chain] == [False] * (len(chain) - 1) + [True]
        assert all(a["valid_to"] == b["valid_from"] for a, b in zip(chain, chain[1:])), "half-open and disjoint"
        assert chain[0]["valid_from"] == ts("1900-01-01 00:00:00")
    assert versions["mail"][0]["email"] == "n" and [v["email"] for v in versions["both"]] == ["n", "n"]
    assert versions["moves"][0]["address_line1"] == "1 Main" and versions["moves"][1]["region"] == "NYC"
    assert second.where("patron_key = -1").count() == 1
    again = dimensions.scd2_patron(second, frame([person("same"), person("moves", address="2 New")], SNAP), "2026-01-01 00:00:00")
    assert rows(again, "patron_key", "valid_from", "valid_to") == rows(second, "patron_key", "valid_from", "valid_to")


def test_point_in_time(frame):
    versions = frame([(1, "p", ts("1900-01-01 00:00:00"), ts("2020-01-01 00:00:00")), (2, "p", ts("2020-01-01 00:00:00"), ts("2021-01-01 00:00:00"))], "patron_key int, patron_id string, valid_from timestamp, valid_to timestamp")
    fact = frame([(1, "p", ts("2020-01-01 00:00:00")), (2, "p", ts("2019-12-31 00:00:00")), (3, "p", ts("2021-01-01 00:00:00")), (4, "p", None), (5, "q", ts("2020-01-01 00:00:00"))], "f int, patron_id string, at timestamp")
    assert rows(joins.point_in_time_join(fact, versions, "patron_id", "at"), "f", "patron_key") == [(1, 2), (2, 1), (3, -1), (4, -1), (5, -1)]


def test_interval_join(frame):
    clicks = frame([(1, "p", d("2025-01-01"), "A"), (1, "p", d("2025-01-03"), "A"), (2, "p", d("2025-01-01"), None)], "c int, who string, day date, wants string")
    sales = frame([("p", d("2025-01-01"), "A", 1), ("p", d("2025-01-08"), "A", 10), ("p", d("2025-01-09"), "B", 100), ("p", d("2025-01-02"), None, 1000), ("q", d("2025-01-01"), "A", 5)], "who string, sold date, series string, amount int")
    got = joins.interval_join(clicks, sales, "who", "day", "sold", 7, ["amount"], series=("wants", "series"))
    assert rows(got, "c", "day", "sales_matched", "amount") == [(1, d("2025-01-01"), 2, 11), (1, d("2025-01-03"), 1, 10), (2, d("2025-01-01"), 3, 1011)]


def test_interval_join_output_does_not_grow_with_pairs(spark):
    """One busy person: a thousand clicks on one day and a thousand sales on the next give one joined row per click."""
    clicks = spark.range(1000).select(F.lit("p").alias("who"), F.lit("2025-01-01").cast("date").alias("day"), "id")
    sales = spark.range(1000).select(F.lit("p").alias("who"), F.lit("2025-01-02").cast("date").alias("sold"), F.lit(1).alias("amount"))
    got = joins.interval_join(clicks, sales, "who", "day", "sold", 7, ["amount"])
    assert got.agg(F.count("*"), F.sum("amount")).first()[:] == (1000, 1_000_000)


def test_theta_join_years_without_gifts_are_absent(frame):
    grid = joins.theta_join(frame([("a", 2020, 5), ("b", 2023, 1), ("a", 2020, 2)], "patron_id string, fiscal_year int, amount int"))
    assert rows(grid, "patron_id", "fiscal_year") == [("a", 2020), ("a", 2023), ("b", 2023)]


def test_align_facts_matches_null_keys(frame):
    a, b = frame([(None, 1), ("x", 2)], "k string, m int"), frame([(None, 3), ("y", 4)], "k string, n int")
    assert rows(joins.align_facts([a, b], ["k"])) == [("x", 2, None), ("y", None, 4), (None, 1, 3)]


def test_full_outer_align_does_not_match_null_keys(frame):
    a, b = frame([(None, 1), ("x", 2)], "k string, m int"), frame([(None, 3), ("x", 4)], "k string, n int")
    assert rows(joins.full_outer_align(a, b, ["k"], ["m", "n"])) == [("x", 2, 4), (None, 0, 3), (None, 1, 0)]


def test_fallback_match_prefers_the_first_key_and_smallest_id(frame):
    known = frame([("e1", "n1", "P2"), ("e1", "n2", "P1"), (None, "n3", "P3")], "email_key string, name_zip_key string, patron_id string")
    new = frame([(1, "e1", "n3"), (2, None, "n3"), (3, "zz", "zz")], "k int, email_key string, name_zip_key string")
    got = joins.multi_key_fallback_match(new, known, ["email_key", "name_zip_key"], "patron_id")
    assert rows(got, "k", "patron_id", "match_rule") == [(1, "P1", "email_key"), (2, "P3", "name_zip_key"), (3, None, None)]


PEOPLE = "source_system string, source_id string, first_name string, last_name string, postal_code string, email string, address_line1 string, first_seen_date date, updated_at int"


def resolve(frame, data, xref=None):
    return identity.resolve_identities(frame([("s", i, f, l, z, e, a, d(day), u) for i, f, l, z, e, a, day, u in data], PEOPLE), xref if xref is not None else frame([], identity.XREF_SCHEMA), "2025-01-01 00:00:00")


def test_identity_rules(frame):
    data = [("1", "Ann", "Lee", "1", "A@X.org", None, "2020-01-05", 1), ("2", "Ann", "Lee", "1", " a@x.org", "1 Main", "2020-01-01", 0), ("3", "Ann", "Lee", "1", None, None, "2021-01-01", 2), ("4", None, None, None, " ", None, "2021-01-01", 1),
            ("5", None, None, None, None, None, "2021-01-01", 2)]
    xref, people = resolve(frame, data)
    ids = {r["source_id"]: r["patron_id"] for r in xref.collect()}
    assert ids["1"] == ids["2"] and ids["3"] != ids["1"], "within a batch a record without email stays apart"
    assert ids["4"] == ids["5"], "records without any name share the empty key"
    golden = {r["patron_id"]: r for r in people.collect()}
    assert golden[ids["1"]]["address_line1"] == "1 Main" and golden[ids["1"]]["first_seen_date"] == d("2020-01-01")
    later, _ = resolve(frame, [*data, ("6", "ann", "LEE", "1", None, None, "2022-01-01", 3), ("7", "Bob", "Ray", "2", "a@x.org", None, "2022-01-01", 3)], frame([tuple(r) for r in xref.collect()], identity.XREF_SCHEMA))
    after = {r["source_id"]: (r["patron_id"], r["match_rule"]) for r in later.collect()}
    assert {k: after[k][0] for k in ids} == ids, "ids never change"
    assert after["7"] == (ids["1"], "email") and after["6"] == (min(ids["1"], ids["3"]), "name_zip")


def test_fact_budget_sums_back(frame):
    lines = frame([(str(i), "4100", "GEN", "D", 2024, p, D("1000.00"), v) for i, (p, v) in enumerate([(d("2024-02-01"), "Adopted"), (d("2023-02-01"), "Adopted"), (d("2024-04-01"), "Adopted"), (d("2024-05-01"), "Draft")])] + [("u", "9999", "X", "Y", 2024, d("2024-01-01"), D("31.00"), "Adopted")],
                  "budget_line_id string, account_code string, fund_code string, department_code string, fiscal_year int, period_start date, amount decimal(14,2), budget_version string")
    calendar = dimensions.fiscal_calendar(bounds(frame, "2022-07-01", "2024-06-30"))
    loaded = facts.fact_budget(lines, calendar, frame([(1, "4100")], "account_key int, account_code string"), frame([(1, "GEN")], "fund_key int, ledger_fund_code string"), frame([(1, "D")], "department_key int, department_code string"))
    sums = {r["budget_line_id"]: (r["n"], float(r["s"])) for r in loaded.groupBy("budget_line_id").agg(F.count("*").alias("n"), F.sum("budget_amount").alias("s")).collect()}
    assert {k: v[0] for k, v in sums.items()} == {"0": 29, "1": 28, "2": 30, "u": 31}
    assert all(abs(sums[k][1] - 1000) <= 31 * 0.00005 for k in "012")
    assert rows(loaded.where("budget_line_id = 'u'").select("account_key", "fund_key", "department_key").distinct()) == [(-1, -1, -1)]


def test_running_balance_in_slices(frame, spark):
    import random
    rng = random.Random(2)
    found = [(rng.choice([None, *range(500)]) if k % 9 else 7, rng.choice([None, 1, 2, -3]), k) for k in range(3000)]
    lines = frame(found, "m int, amount int, line int")
    for slices in (1, 2, 32):
        got = {r.line: r.balance for r in aggregate.running_balance(lines, "m", "amount", slices=slices).collect()}
        for m, _, line in found[::37]:
            below = [a for x, a, _ in found if (x is None or (m is not None and x <= m)) and a is not None]
            assert got[line] == (None if m is None else sum(below) if below else None)
    assert aggregate.running_balance(lines.where("false"), "m", "amount").collect() == []
    plan = aggregate.running_balance(lines, "m", "amount")._jdf.queryExecution().executedPlan().toString()
    lines_of = plan.split("\n")
    assert "Window" in plan and "hashpartitioning(_slice" in plan
    assert all("partial_percentile_approx" in lines_of[k + 1] for k, line in enumerate(lines_of) if "SinglePartition" in line), "only the sketch of the periods"


def test_partition_totals_without_gathering_a_partition(frame, spark):
    rng = spark.range(30_000).selectExpr("case when id % 3 = 0 then null when id % 3 = 1 then 'hot' else cast(id % 50 as string) end as k", "cast(id % 7 as int) as v", "id")
    got = aggregate.with_partition_total(rng, "v", ["k"], "total")
    want = {r.k: r.s for r in rng.groupBy("k").agg(F.sum("v").alias("s")).collect()}
    found = got.collect()
    assert len(found) == 30_000 and got.columns == ["k", "v", "id", "total"] and all(r.total == want[r.k] for r in found)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_sum" in plan


def test_running_balance_peers_share(frame):
    lines = frame([(1, "a", 5), (1, "b", 7), (3, "a", -2)], "m int, line string, amount int")
    assert rows(aggregate.running_balance(lines, "m", "amount"), "m", "line", "balance") == [(1, "a", 12), (1, "b", 12), (3, "a", 10)]


def test_top_n_keeps_ties_and_nulls_last(frame):
    df = frame([(1, 9), (2, 8), (3, 8), (4, 7), (5, None)], "k int, v int")
    assert rows(aggregate.top_n(df, 2, "v"), "k") == [(1,), (2,), (3,)]
    assert aggregate.top_n(df, 10, "v").count() == 5


def test_person_id_from_two_keys_fails(frame):
    """Short ids collide: within a batch, and with an id that the cross-reference gave to another key."""
    ddl = "source_system string, source_id string, patron_id string, email_key string, name_zip_key string, match_rule string"
    records = frame([("s", str(k), None, f"p{k}@x", "", None) for k in range(17)], ddl)  # 17 keys, 16 ids of one digit
    assert identity.cluster_new(records).select("patron_id").distinct().count() == 17
    with pytest.raises(Exception, match="hex digits come from two keys"):
        identity.cluster_new(records, digits=1).collect()
    one = records.where("source_id = '0'")
    pid = identity.cluster_new(one, digits=1).first().patron_id
    row = lambda email: frame([("s", "old", pid, email, "", "new:email", None)], identity.XREF_SCHEMA)
    assert identity.append_xref(row("p0@x"), one, "2025-01-01 00:00:00", digits=1).count() == 2
    with pytest.raises(Exception, match="hex digits come from two keys"):
        identity.append_xref(row("someone@else"), one, "2025-01-01 00:00:00", digits=1).collect()
