from __future__ import annotations

from decimal import Decimal as D

from pyspark.sql import functions as F

from boxledger import functions as fn
from conftest import d, rows, ts


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_fiscal_year_boundary(frame):
    days = frame([(d("2025-06-30"),), (d("2025-07-01"),), (d("2024-02-29"),)], "x date")
    got = rows(days, F.col("x"), fn.fiscal_year("x"), fn.fiscal_month("x"), fn.fiscal_quarter("x"))
    assert got == [(d("2024-02-29"), 2024, 8, 3), (d("2025-06-30"), 2025, 12, 4), (d("2025-07-01"), 2026, 1, 1)]


def test_date_key_null_and_back(frame):
    df = frame([(ts("2025-01-02 23:59:00"),), (None,)], "x timestamp")
    keyed = df.select(fn.date_key("x").alias("k"))
    assert sorted(r["k"] for r in keyed.collect()) == [-1, 20250102]
    assert rows(keyed.select(fn.key_to_date("k"))) == [(d("2025-01-02"),), (None,)]


def test_region_bucket(frame):
    df = frame([("Brooklyn", "NY", "USA"), ("Brooklyn", "CT", "USA"), ("Paris", None, "France"), (None, None, "USA"), (None, None, None)],
               "c string, s string, k string")
    got = [r[0] for r in df.select(fn.region_bucket("c", "s", "k")).collect()]
    assert got == ["NYC", "NY Metro", "Unknown", "Domestic", "Unknown"]


def test_hours_booked_counts_minute_boundaries(frame):
    df = frame([(ts("2025-01-01 10:00:59"), ts("2025-01-01 11:30:00")), (ts("2025-01-01 10:00:00"), ts("2025-01-01 09:00:00"))], "a timestamp, b timestamp")
    assert [r[0] for r in df.select(fn.hours_booked("a", "b")).collect()] == [D("1.50"), D("-1.00")]


def test_boundary_hours(frame):
    df = frame([(ts("2025-01-01 00:59:00"), ts("2025-01-01 01:01:00"))], "a timestamp, b timestamp")
    assert df.select(fn.boundary_hours("a", "b")).first()[0] == 1


def test_safe_ratio(frame):
    df = frame([(D("1.00"), 4), (D("1.00"), 0), (None, 2)], "n decimal(10,2), m int")
    assert [r[0] and float(r[0]) for r in df.select(fn.safe_ratio("n", "m")).collect()] == [0.25, None, None]


def test_amounts(frame):
    from boxledger.operators import amounts
    df = frame([(2, D("10.00"), D("3.00")), (None, D("5.00"), None), (1, None, D("1.00"))], "quantity int, unit_price decimal(12,2), discount_amount decimal(12,2)")
    assert [(float(r["gross_amount"]), float(r["net_amount"])) for r in amounts(df).collect()] == [(20, 17), (0, 0), (0, -1)]


def test_hashes(frame):
    df = frame([("a", None, "b"), (None, "a", "b")], "x string, y string, z string")
    assert len({r[0] for r in df.select(fn.row_hash("x", "y", "z")).collect()}) == 2
    tracked = [r[0] for r in df.select(fn.scd_hash("x", "y", "z")).collect()]
    assert tracked[0] == tracked[1] == tracked[0].upper(), "NULLs are skipped, so layouts can share a fingerprint"


def test_masks(frame):
    df = frame([("ann@example.org", "212-555-0147", "1 Main St"), (None, "123", None)], "e string, p string, a string")
    got = [tuple(r) for r in df.select(fn.mask_email("e"), fn.mask_partial("p"), fn.mask_default("a")).collect()]
    assert got == [("aXXX@XXXX.com", "XXX-XXX-0147", "xxxx"), (None, "XXX-XXX-", None)]


def test_fmt_change(spark):
    def text(a, b, kind):
        return one(spark, fn.fmt_change(F.lit(a), F.lit(b), kind))

    assert text(1500000.0, 300000.0, "money_only") == " +$1.2M ▲ "
    assert text(90000.0, 100000.0, "money") == " -$10K | -10.0% ▼ "
    assert text(0.5, 0.488, "pct") == " +1.2 pts ▲ "
    assert text(10.0, 10.0, "days") == " 0 days ─ "
    assert text(None, 1.0, "money") == "No prior year"


def test_fmt_change_rounds_halves_up_as_its_sql_does(spark):
    def text(a, b, kind):
        return one(spark, fn.fmt_change(F.lit(a), F.lit(b), kind))

    assert text(250500.0, 250000.0, "money_only") == "\u00a0+$1K\u00a0▲\u00a0"
    assert text(247500.0, 250000.0, "money_only") == "\u00a0-$3K\u00a0▼\u00a0"
    assert text(1250000.0, 0.0, "money_only") == "\u00a0+$1.3M\u00a0▲\u00a0"
    assert text(0.5, 0.0, "days") == "\u00a0+1 days\u00a0▲\u00a0"


def test_favourable(spark):
    assert one(spark, fn.favourable(F.lit(5), F.lit(3))) == 1
    assert one(spark, fn.favourable(F.lit(5), F.lit(3), up_is_good=False)) == -1
    assert one(spark, fn.favourable(F.lit(None).cast("int"), F.lit(3))) is None


def test_ordered_string_agg(frame):
    df = frame([("b", "2"), ("a", "1"), ("c", None)], "o string, v string")
    assert df.agg(fn.ordered_string_agg("v", "o")).first()[0] == "1 · 2"
