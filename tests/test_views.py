from __future__ import annotations

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from boxledger.operators.dimensions import fiscal_calendar
from boxledger.plans import access, audience, finance, marketing, statement, time_intelligence as ti, trust, venue
from boxledger.plans.measures import MEASURES, donor_years, measure
from conftest import d, rows, ts


def gifts_for(frame, data):
    """(person, fiscal year, amount) as a gift fact with its dimensions; one day per year is enough."""
    gifts = frame([(i, p, y * 10000 + 101, D(a)) for i, (p, y, a) in enumerate(data)], "gift_id int, patron_key int, gift_date_key int, amount decimal(14,2)")
    years = sorted({y for _, y, _ in data})
    calendar = frame([(y * 10000 + 101, y) for y in years], "date_key int, fiscal_year int")
    patrons = frame([(p, f"P{p}") for p in sorted({p for p, _, _ in data if p > 0})], "patron_key int, patron_id string")
    return gifts, calendar, patrons


def test_donor_status(frame):
    status = audience.donor_status_by_fy(*gifts_for(frame, [
        (1, 2020, 10), (1, 2021, 5), (1, 2021, -3), (2, 2020, 1), (2, 2022, 4), (3, 2022, 1), (4, 2021, -9), (-1, 2022, 50), (5, 2020, 7)]))
    got = {(r["patron_id"], r["fiscal_year"]): r["donor_status"] for r in status.collect()}
    assert got == {("P1", 2020): "New", ("P1", 2021): "Retained", ("P1", 2022): "LYBUNT", ("P2", 2020): "New", ("P2", 2021): "LYBUNT", ("P2", 2022): "Reactivated",
                   ("P3", 2022): "New", ("P5", 2020): "New", ("P5", 2021): "LYBUNT", ("P5", 2022): "SYBUNT"}
    kept = {r["fiscal_year"]: r for r in audience.donor_retention(status).collect()}
    assert (kept[2021]["retained_donors"], kept[2021]["donors_last_year"], float(kept[2021]["lybunt_revenue_at_risk"])) == (1, 3, 8.0)
    assert kept[2020]["donor_retention_rate"] is None


def test_donor_years(frame):
    gifts = frame([("a", 2020, 5), ("a", 2021, -1), ("b", 2021, 2)], "patron_id string, fiscal_year int, amount int")
    years = frame([(2020,), (2021,)], "fiscal_year int")
    assert rows(donor_years(gifts, years), "patron_id", "fiscal_year", "gave", "gave_last_year", "amount_last_year") == [
        ("a", 2020, True, False, None), ("a", 2021, False, True, 5), ("b", 2021, True, False, None)]


LEG = "month_start date, revenue_stream string, fund_code string, source_system string, gl_account_code string, {} decimal(16,2)"


def test_reconciliation_statuses(frame):
    months = [d(f"2024-{m:02d}-01") for m in range(1, 10)]
    cases = [("exact", D("100.00"), D("100.00"), "Matched"), ("under a cent", D("100.00"), D("100.00"), "Matched"), ("thousand", D("5000.00"), D("6000.00"), "Within tolerance"), ("one percent", D("500000.00"), D("505000.00"), "Within tolerance"),
             ("outside", D("500000.00"), D("505000.01"), "Investigate"), ("source only", D("2000.00"), None, "Investigate"), ("ledger only", None, D("900.00"), "Within tolerance")]
    keys = [(months[i], n, "GEN", "T", "4100") for i, (n, *_) in enumerate(cases)]
    source = frame([(*k, s) for k, (_, s, _, _) in zip(keys, cases) if s is not None] + [(d("2030-01-01"), "later", "GEN", "T", "4100", D("1.00"))], LEG.format("source_amount"))
    ledger = frame([(*k, g) for k, (_, _, g, _) in zip(keys, cases) if g is not None], LEG.format("gl_amount"))
    notes = frame([(months[4], "outside", "GEN", "timing", "n", "Explained")], "month_start date, revenue_stream string, fund_code string, cause string, note string, resolution string")
    got = {r["revenue_stream"]: r for r in finance.compare_legs(source, ledger, F.lit(months[0]), F.lit(months[-1]), notes, "2025-01-01 00:00:00").collect()}
    assert {n: r["status"] for n, r in got.items()} == {n: s for n, _, _, s in cases}, "months outside the ledger are left out"
    assert got["outside"]["resolution"] == "Explained" and got["source only"]["resolution"] == "Open" and got["exact"]["resolution"] is None
    assert got["ledger only"]["source_amount"] == D("0.00")


def calendar(frame, start="2023-07-01", end="2026-06-30"):
    return fiscal_calendar(frame([(d(start), d(end))], "start date, end date"))


def test_time_intelligence_partial_year(frame):
    daily = frame([(d("2023-08-10"), 10), (d("2024-02-29"), 20), (d("2024-07-05"), 1), (d("2025-02-15"), 5)], "date date, v int")
    cap = ti.as_of_date(daily)
    table = ti.period_table(daily, ["v"], ["current", "py", "fytd", "py_fytd"], cap=cap, calendar=calendar(frame))
    got = {r["month_start"]: (r["v"], r["v_py"], r["v_fytd"], r["v_py_fytd"]) for r in table.collect()}
    assert got[d("2025-02-01")] == (5, 20, 6, 10), "the leap day lies after the capped prior year"
    assert got[d("2024-07-01")] == (1, None, 1, None)
    assert got[d("2025-06-01")] == (None, None, 6, 10), "a month without postings still shows its year to date"
    assert got[d("2023-09-01")] == (None, None, 10, None)
    compared = ti.ti_yoy(daily, ["v"], cap=cap, calendar=calendar(frame))
    assert {r["month_start"]: r["v_yoy"] for r in compared.collect()}[d("2025-02-01")] == -15


def test_balances_and_trailing_year(frame):
    daily = frame([(d("2024-01-10"), 100), (d("2024-03-10"), -30), (d("2025-03-05"), 7)], "date date, v int")
    cap = ti.as_of_date(daily)
    held = ti.period_table(daily, ["v"], ["balance", "balance_py", "balance_py_fytd"], cap=cap, calendar=calendar(frame))
    got = {r["month_start"]: (r["v_balance"], r["v_balance_py"], r["v_balance_py_fytd"]) for r in held.collect()}
    assert got[d("2024-02-01")][0] == 100 and got[d("2024-06-01")][0] == 70 and got[d("2025-03-01")] == (77, 70, 100)
    assert got[d("2025-04-01")][0] is None, "nothing after the ledger ends"
    spent = {r["month_start"]: r["s"] for r in ti.trailing_year(daily, F.col("v"), "s", cap).collect()}
    assert spent[d("2024-12-01")] == 70 and spent[d("2025-01-01")] == -30 and spent[d("2025-03-01")] == -23


def gl_rows(frame, data):
    """(date, account, type, group, net)."""
    return frame([(d(day), code, kind, group, D(net), D(max(-net, 0)), D(max(net, 0)), None) for day, code, kind, group, net in data],
                 "date date, account_code string, account_type string, account_group string, net_amount decimal(14,2), debit_amount decimal(14,2), credit_amount decimal(14,2), cash_direction string")


def test_statement_of_activities(frame):
    gl = gl_rows(frame, [("2024-08-01", "4100", "Revenue", "Earned Revenue", 100), ("2024-08-02", "5100", "Expense", "Program", -40), ("2023-08-01", "4100", "Revenue", "Earned Revenue", 80)])
    budget = frame([(d("2024-08-01"), "4100", "Revenue", "Earned Revenue", D("90.0000")), (d("2024-08-01"), "5100", "Expense", "Program", D("50.0000"))], "date date, account_code string, account_type string, account_group string, budget_amount decimal(18,4)")
    table = statement.statement_of_activities(gl, budget, calendar(frame)).where("month_start = '2024-08-01'")
    got = {r["line"].strip(): r for r in table.collect()}
    assert len(got) == 16 and table.count() == 16
    assert (got["Single ticket sales"]["actual"], got["Single ticket sales"]["vs_budget"], got["Single ticket sales"]["last_year"]) == (100, 10, 80)
    assert (got["Artist fees"]["actual"], got["Artist fees"]["vs_budget"], got["Artist fees"]["vs_last_year"]) == (40, 10, None)
    assert (got["Change in net assets"]["actual"], got["Change in net assets"]["vs_budget_pct"]) == (60, None)
    assert got["Surplus margin"]["actual"] == pytest.approx(0.6)
    assert got["Revenue"]["actual"] is None and got["Hall rentals"]["actual"] is None


def test_measures_are_ratios_of_sums(frame):
    sales = frame([(2024, 1, 10, False), (2024, 3, 30, False), (2024, 5, 99, True), (2025, 2, 50, False)], "fiscal_year int, quantity int, net_amount int, is_returned boolean")
    got = {r["fiscal_year"]: r for r in measure({"sales": sales}, ["tickets_sold", "average_ticket_price", "return_rate_share"], ["fiscal_year"]).collect()}
    assert (got[2024]["tickets_sold"], got[2024]["average_ticket_price"]) == (4, 10.0)
    assert got[2024]["return_rate_share"] == pytest.approx(5 / 9)
    total = measure({"sales": sales}, ["tickets_sold"], filters={"fiscal_year": [2025]}).first()
    assert total["tickets_sold"] == 2


def test_average_gift_divides_all_amounts_by_positive_gifts(frame):
    gifts = frame([("a", 10), ("b", 20), ("a", -6)], "patron_id string, amount int")
    assert measure({"gifts": gifts}, ["average_gift"]).first()["average_gift"] == 12.0


def test_every_measure_is_reachable():
    for name, m in MEASURES.items():
        assert (m.fact is None) == bool(m.uses), name
        assert all(u in MEASURES for u in m.uses), name


def test_freshness(frame):
    through = frame([(s, s.upper(), s, d("2025-01-01"), "x") for s in ("new", "edge", "late", "weekly")], "source_system string, source_label string, source_name string, data_through date, measured_by string")
    log = frame([("edge.t", "silver", "Succeeded", ts("2025-01-01 10:00:00")), ("late.t", "silver", "Succeeded", ts("2025-01-01 09:59:00")), ("weekly.t", "silver", "Succeeded", ts("2024-12-30 00:00:00")),
                 ("new.t", "silver", "Failed", ts("2025-01-02 00:00:00")), ("new.t", "bronze", "Succeeded", ts("2025-01-02 00:00:00"))], "entity string, stage string, status string, ended_at timestamp")
    config = frame([("weekly", "w", "weekly", 192)], "source_system string, source string, expected_refresh string, sla_hours int")
    got = {r["source_system"]: r for r in trust.source_freshness(through, log, config, "2025-01-02 12:30:00").collect()}
    assert {k: r["freshness_status"] for k, r in got.items()} == {"new": "Never loaded", "edge": "Fresh", "late": "Stale", "weekly": "Fresh"}
    assert got["edge"]["hours_since_load"] == 26 and got["edge"]["last_loaded_et"] == ts("2025-01-01 05:00:00")


def test_email_attribution_counts_revenue_per_click_day(frame):
    days = frame([(20250101, d("2025-01-01"), 2025), (20250102, d("2025-01-02"), 2025), (20250103, d("2025-01-03"), 2025)], "date_key int, date date, fiscal_year int")
    clicks = frame([(1, 1, 20250101), (1, 1, 20250101), (1, 1, 20250102), (1, -1, 20250101)], "email_campaign_key int, patron_key int, click_date_key int")
    campaigns = frame([(1, "A")], "email_campaign_key int, series_promoted string")
    patrons = frame([(1, "P"), (2, "P")], "patron_key int, patron_id string")
    sales = frame([(2, 20250103, 9, D("40.00"), False), (2, 20250103, 8, D("1.00"), False), (1, 20250103, 9, D("5.00"), True)], "patron_key int, order_date_key int, performance_key int, net_amount decimal(14,2), is_returned boolean")
    shows = frame([(9, "A"), (8, "B")], "performance_key int, series string")
    row = marketing.email_conversions(clicks, campaigns, patrons, sales, shows, days).first()
    assert (row["buyers_7d"], row["ticket_revenue_7d"]) == (1, D("80.00"))


def test_access(frame):
    gifts = frame([(1, True), (2, False)], "gift_id int, is_anonymous boolean")
    listed = frame([("boss", "r")], "user_principal_name string, reason string")
    assert access.row_filter_anonymous(gifts, listed, "boss").count() == 2
    assert rows(access.row_filter_anonymous(gifts, listed, "temp"), "gift_id") == [(2,)]
    assert access.apply_role("gifts", gifts, access.ROLES["Audience"], "x").count() == 0
    assert rows(access.apply_role("gifts", gifts, access.ROLES["Venue Manager"], "x"), "gift_id") == [(2,)]
    shows = frame([("p1", "V1"), ("p2", "V2")], "performance_id string, venue_id string")
    mine = frame([("m", "V2")], "user_principal_name string, venue_id string")
    assert rows(access.apply_role("performance", shows, access.ROLES["Venue Manager"], "m", mine), "performance_id") == [("p2",)]
    people = frame([("P", "e", "p", "a")], "patron_id string, email string, phone string, address_line1 string")
    assert access.apply_role("patron", people, access.ROLES["Audience"], "x").columns == ["patron_id"]
    assert access.permit_columns(people, "patron").columns == ["patron_id"]


def test_room_utilisation_of_many_overlapping_bookings(spark, frame):
    bookings = spark.range(600).selectExpr("1 as event_key", "1 as room_key", "20240115 as booking_date_key", "cast(1000 as decimal(6,2)) as hours_booked",
                                           "cast(1 as decimal(12,2)) as rental_fee")
    events = frame([(1, "Rental", "Confirmed")], "event_key int, event_type string, status string")
    rooms = frame([(1, "Room 1", "Hall")], "room_key int, room_name string, room_type string")
    calendar = frame([(20240115, d("2024-01-15"), 2024, 2024, 1, "Jan")],
                     "date_key int, date date, fiscal_year int, calendar_year int, month_num int, month_name string")
    assert rows(venue.room_utilisation(bookings, events, rooms, calendar), "hours_booked", "utilisation") == [(D("600000.00"), D("1382.488"))]
