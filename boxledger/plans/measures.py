"""Measures: named aggregates over a star, evaluated for any grouping.

A base measure is an aggregate over one fact; a derived measure is arithmetic on others after grouping, so ratios are
ratios of sums.  :func:`measure` folds each fact to the requested keys on its own and aligns the results; a fact is
never joined to another fact.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import boundary_hours, distinct_when, fiscal_start, ordered_string_agg, safe_ratio
from ..operators.joins import align_facts
from ..operators.people import count_people
from .trust import freshness_status

__all__ = ["Measure", "MEASURES", "measure", "GL_VALUES", "BUDGET_VALUES", "CASH_VALUES", "donor_years",
           "subscriber_years", "promoted_sales", "sales_star", "HOURS_PER_DAY"]

HOURS_PER_DAY = 14


@dataclass(frozen=True)
class Measure:
    """``fact`` and ``aggregate`` for a base measure, ``uses`` and ``derive`` for a derived one.

    ``aggregate`` receives the report's ``as_of``, which only the freshness measures look at.
    """

    label: str
    fact: str | None = None
    aggregate: Callable[[object], Column] | None = None
    uses: tuple[str, ...] = ()
    derive: Callable[..., Column] | None = None


# The labels of all measures below are the display names that reports show.
MEASURES: dict[str, Measure] = {}


def _base(name: str, label: str, fact: str, aggregate: Callable[[], Column]) -> None:
    MEASURES[name] = Measure(label, fact, lambda _as_of: aggregate())


def _derived(name: str, label: str, uses: Sequence[str], derive: Callable[..., Column]) -> None:
    MEASURES[name] = Measure(label, uses=tuple(uses), derive=derive)


def _ratio(name: str, label: str, num: str, den: str) -> None:
    _derived(name, label, (num, den), lambda a, b: safe_ratio(a.cast("double"), b.cast("double")))


def _difference(name: str, label: str, left: str, right: str) -> None:
    """Left less right; a missing side counts as zero unless both are missing."""
    def blank_as_zero(a: Column, b: Column) -> Column:
        return F.when(a.isNotNull() | b.isNotNull(), F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0)))

    _derived(name, label, (left, right), blank_as_zero)


# ---------------------------------------------------------------- ledger, budget, cash

def _is(column: str, *values: str) -> Column:
    return F.col(column).isin(*values)


def _profit_loss(value: str, expense_sign: int) -> dict[str, Callable[[], Column]]:
    revenue = lambda: F.when(_is("account_type", "Revenue"), F.col(value))
    return {
        "revenue": revenue,
        "expenses": lambda: F.when(_is("account_type", "Expense"), F.col(value) * expense_sign),
        "earned_revenue": lambda: F.when(_is("account_group", "Earned Revenue"), revenue()),
        "contributed_revenue": lambda: F.when(_is("account_group", "Contributed Revenue"), revenue()),
    }


#: Row values of the ledger: what one journal line adds to each measure.
GL_VALUES = _profit_loss("net_amount", -1)
#: The same over budget lines, which are positive for both account types.
BUDGET_VALUES = _profit_loss("budget_amount", 1)


def _cash(*directions: str) -> Callable[[], Column]:
    def value() -> Column:
        moved = F.when(_is("account_code", "1010"), F.col("debit_amount") - F.col("credit_amount"))
        return F.when(_is("cash_direction", *directions), moved) if directions else moved
    return value


def _owed(account: str) -> Callable[[], Column]:
    return lambda: F.when(_is("account_code", account), F.col("credit_amount") - F.col("debit_amount"))


CASH_VALUES = {
    "cash_movement": _cash(), "cash_received": _cash("In"), "cash_paid": lambda: -_cash("Out")(),
    "cash_flow_amount": _cash("In", "Out"), "accounts_payable": _owed("2100"), "accrued_payroll": _owed("2200"),
}

_LABELS = {"revenue": "Revenue", "expenses": "Expenses", "earned_revenue": "Earned Revenue",
           "contributed_revenue": "Contributed Revenue"}
for _name, _value in GL_VALUES.items():
    _base(_name, _LABELS[_name], "gl", lambda v=_value: F.sum(v()))
_difference("net_surplus", "Net Surplus", "revenue", "expenses")
_ratio("earned_revenue_share", "Earned Revenue %", "earned_revenue", "revenue")
_ratio("surplus_margin", "Surplus Margin", "net_surplus", "revenue")
_base("debits", "Debits", "gl", lambda: F.sum("debit_amount"))
_base("credits", "Credits", "gl", lambda: F.sum("credit_amount"))
_difference("out_of_balance", "Out of Balance", "debits", "credits")
_base("as_of_date", "As Of Date", "gl", lambda: F.max("date"))

_BUDGET_NAMES = {"revenue": ("revenue_budget", "Revenue Budget"), "expenses": ("expense_budget", "Expense Budget"),
                 "earned_revenue": ("earned_revenue_budget", "Earned Revenue Budget"),
                 "contributed_revenue": ("contributed_revenue_budget", "Contributed Revenue Budget")}
for _name, _value in BUDGET_VALUES.items():
    _base(*_BUDGET_NAMES[_name], "budget", lambda v=_value: F.sum(v()))
_difference("net_surplus_budget", "Net Surplus Budget", "revenue_budget", "expense_budget")
_ratio("surplus_margin_budget", "Surplus Margin Budget", "net_surplus_budget", "revenue_budget")

for _name, _label in (("cash_movement", "Cash Movement"), ("cash_received", "Cash Received"),
                      ("cash_paid", "Cash Paid"), ("cash_flow_amount", "Cash Flow Amount")):
    _base(_name, _label, "gl", lambda v=CASH_VALUES[_name]: F.sum(v()))
_difference("net_cash_flow", "Net Cash Flow", "cash_received", "cash_paid")

# ---------------------------------------------------------------- reconciliation

_base("source_amount", "Source Amount", "recon", lambda: F.sum("source_amount"))
_base("ledger_amount", "Ledger Amount", "recon", lambda: F.sum("gl_amount"))
_difference("variance", "Variance", "ledger_amount", "source_amount")
_ratio("variance_share", "Variance %", "variance", "source_amount")
_derived("abs_variance", "Abs Variance", ("variance",), F.abs)
_base("lines_to_investigate", "Lines to Investigate", "recon", lambda: F.count_if(_is("status", "Investigate")))
_base("open_items", "Open Items", "recon", lambda: F.count_if(_is("resolution", "Open")))
_base("recon_lines", "Reconciliation Lines", "recon", lambda: F.count(F.lit(1)))
_base("reconciled_lines", "Reconciled Lines", "recon", lambda: F.count_if(~_is("status", "Investigate")))
_ratio("reconciled_share", "Reconciled %", "reconciled_lines", "recon_lines")

# ---------------------------------------------------------------- data trust

_base("last_loaded_utc", "Last Loaded (UTC)", "freshness", lambda: F.max("last_loaded_utc"))
_base("data_through", "Data Through", "freshness", lambda: F.max("data_through"))
MEASURES["hours_since_load"] = Measure(
    "Hours Since Load", "freshness",
    lambda as_of: boundary_hours(F.max("last_loaded_utc"), F.lit(as_of).cast("timestamp")))
MEASURES["freshness_status"] = Measure(
    "Freshness Status", "freshness",
    lambda as_of: freshness_status(F.max("last_loaded_utc"), F.max("sla_hours"), as_of))


def _sources_fresh(as_of) -> Column:
    fresh = distinct_when("source_name", freshness_status("last_loaded_utc", "sla_hours", as_of) == "Fresh")
    return F.concat_ws(" of ", fresh, F.count_distinct("source_name"))


def _banner(as_of) -> Column:
    # The wording of the banner.
    late = boundary_hours("last_loaded_utc", F.lit(as_of).cast("timestamp")) > F.col("sla_hours")
    note = F.when(late, F.concat(F.lit(" STALE (expected "), F.col("expected_refresh"), F.lit(")"))).otherwise("")
    loaded = F.coalesce(F.date_format("last_loaded_et", "MMM d h:mm a"), F.lit(""))
    line = F.concat(F.col("source_label"), F.lit(" "), loaded, note)
    return F.concat(F.lit("Data as of: "), ordered_string_agg(line, "source_label"), F.lit(" (ET)"))


MEASURES["sources_fresh"] = Measure("Sources Fresh", "freshness", _sources_fresh)
MEASURES["data_freshness_banner"] = Measure("Data Freshness Banner", "freshness", _banner)

# ---------------------------------------------------------------- venue

def _live() -> Column:
    return ~_is("status", "Cancelled")


_base("hours_booked", "Hours Booked", "bookings", lambda: F.sum(F.when(_live(), F.col("hours_booked"))))
for _kind in ("Concert", "Rental", "Rehearsal"):
    _base(f"{_kind.lower()}_hours", f"{_kind} Hours", "bookings",
          lambda k=_kind: F.sum(F.when(_live() & _is("event_type", k), F.col("hours_booked"))))
_base("days_in_context", "Days in Context", "calendar", lambda: F.count(F.lit(1)))
_base("rooms_in_context", "Rooms in Context", "rooms", lambda: distinct_when("room_key", F.col("room_key") > 0))
_derived("hours_available", "Hours Available", ("days_in_context", "rooms_in_context"),
         lambda days, rooms: days * rooms * HOURS_PER_DAY)
_ratio("hall_utilization_share", "Hall Utilization %", "hours_booked", "hours_available")
_base("booked_days", "Booked Days", "bookings", lambda: F.count_distinct(
    F.when(_live() & (F.col("room_key") > 0), F.struct("room_key", "booking_date_key"))))
_base("events_booked", "Events Booked", "bookings", lambda: distinct_when("event_key", _live()))
_base("cancelled_events", "Cancelled Events", "bookings", lambda: distinct_when("event_key", _is("status", "Cancelled")))
_base("rental_fees", "Rental Fees", "bookings", lambda: F.sum(F.when(_live(), F.col("rental_fee"))))
_base("rental_events", "Rental Events", "bookings",
      lambda: distinct_when("event_key", _live() & _is("event_type", "Rental")))
_base("rental_revenue", "Rental Revenue", "bookings",
      lambda: F.sum(F.when(_live() & _is("event_type", "Rental"), F.col("rental_fee"))))
_ratio("average_rental_fee", "Average Rental Fee", "rental_revenue", "rental_events")
_base("unlinked_concerts", "Unlinked Concerts", "events",
      lambda: F.count_if(_is("event_type", "Concert") & ~F.col("is_linked")))

# ---------------------------------------------------------------- ticketing

def _sold(value: str, also: Column | None = None) -> Column:
    kept = ~F.col("is_returned")
    return F.sum(F.when(kept if also is None else kept & also, F.col(value)))


_base("tickets_sold", "Tickets Sold", "sales", lambda: _sold("quantity"))
_base("net_ticket_revenue", "Net Ticket Revenue", "sales", lambda: _sold("net_amount"))
_base("gross_ticket_revenue", "Gross Ticket Revenue", "sales", lambda: _sold("gross_amount"))
_base("capacity", "Capacity", "performances", lambda: F.sum(
    F.when(~_is("status", "Cancelled") & (F.col("performance_key") > 0), F.col("capacity"))))
_ratio("sell_through_share", "Sell-Through %", "tickets_sold", "capacity")
_ratio("revenue_per_available_seat", "Revenue per Available Seat", "net_ticket_revenue", "capacity")
_ratio("average_ticket_price", "Average Ticket Price", "net_ticket_revenue", "tickets_sold")
_base("comp_tickets", "Comp Tickets", "sales", lambda: _sold("quantity", F.col("is_comp")))
_ratio("comp_share", "Comp %", "comp_tickets", "tickets_sold")
_base("returned_tickets", "Returned Tickets", "sales", lambda: F.sum(F.when(F.col("is_returned"), F.col("quantity"))))
_base("all_tickets", "Tickets incl. Returned", "sales", lambda: F.sum("quantity"))
_ratio("return_rate_share", "Return Rate %", "returned_tickets", "all_tickets")
_base("tickets_sold_by_order_date", "Tickets Sold by Order Date", "sales_by_order_date", lambda: _sold("quantity"))
_base("avg_days_booked_ahead", "Avg Days Booked Ahead", "sales",
      lambda: F.avg(F.when(~F.col("is_returned"), F.col("days_before_show"))))
_base("ticket_buyers", "Ticket Buyers", "sales", lambda: distinct_when("patron_id"))
_base("first_time_buyers", "First-Time Buyers", "sales",
      lambda: distinct_when("patron_id", F.col("first_seen_date") >= F.col("period_start")))

# ---------------------------------------------------------------- fundraising

_base("gift_revenue", "Gift Revenue", "gifts", lambda: F.sum("amount"))
_base("donors", "Donors", "gifts", lambda: distinct_when("patron_id", F.col("amount") > 0))
_base("positive_gifts", "Positive Gifts", "gifts", lambda: F.count_if(F.col("amount") > 0))
# All amounts over the number of positive gifts: reversals lower the average but are not counted.
_ratio("average_gift", "Average Gift", "gift_revenue", "positive_gifts")
_base("campaign_goal", "Campaign Goal", "campaigns", lambda: F.sum("goal_amount"))
_ratio("campaign_goal_share", "% of Campaign Goal", "gift_revenue", "campaign_goal")
_base("retained_donors", "Retained Donors", "donor_years", lambda: F.count_if(F.col("gave") & F.col("gave_last_year")))
_base("donors_last_year", "Donors Last Year", "donor_years", lambda: F.count_if("gave_last_year"))
_ratio("donor_retention_share", "Donor Retention %", "retained_donors", "donors_last_year")
_base("lybunt_donors", "LYBUNT Donors", "donor_years", lambda: F.count_if(F.col("gave_last_year") & ~F.col("gave")))
_base("lybunt_revenue_at_risk", "LYBUNT Revenue at Risk", "donor_years",
      lambda: F.sum(F.when(F.col("gave_last_year") & ~F.col("gave"), F.col("amount_last_year"))))
_base("buyers_who_also_give", "Buyers Who Also Give", "sales",
      lambda: distinct_when("patron_id", F.col("is_donor") & ~F.col("is_returned")))
_ratio("buyer_to_donor_share", "Buyer-to-Donor Conversion %", "buyers_who_also_give", "ticket_buyers")

# ---------------------------------------------------------------- subscriptions

_base("subscribers", "Subscribers", "subscriptions", lambda: distinct_when("patron_id"))
_base("renewing_subscribers", "Renewing Subscribers", "subscriptions",
      lambda: distinct_when("patron_id", F.col("is_renewal")))
_base("prior_season_subscribers", "Prior Season Subscribers", "subscriber_years", lambda: F.count_if("subscribed_last_year"))
_ratio("subscriber_renewal_share", "Subscriber Renewal %", "renewing_subscribers", "prior_season_subscribers")
_base("subscription_revenue", "Subscription Revenue", "subscriptions", lambda: F.sum("package_amount"))

# ---------------------------------------------------------------- marketing

_base("emails_delivered", "Emails Delivered", "email_results", lambda: F.sum("delivered"))
for _column, _label in (("unique_opens", "Open"), ("unique_clicks", "Click"), ("unsubscribes", "Unsubscribe")):
    _base(_column, _label + "s", "email_results", lambda c=_column: F.sum(c))
    _ratio(f"{_label.lower()}_rate", f"{_label} Rate %", _column, "emails_delivered")
_base("clicking_patrons", "Clicking Patrons", "email_clicks",
      lambda: distinct_when("patron_id", F.col("patron_key") > 0))
_base("ad_spend", "Ad Spend", "ad_spend", lambda: F.sum("spend"))
_base("ad_clicks", "Ad Clicks", "ad_spend", lambda: F.sum("clicks"))
_ratio("cost_per_click", "Cost per Click", "ad_spend", "ad_clicks")
_base("promoted_revenue", "Promoted Revenue", "promoted_sales", lambda: _sold("net_amount"))
_ratio("revenue_per_ad_dollar", "Revenue per Ad Dollar", "promoted_revenue", "ad_spend")

# ---------------------------------------------------------------- education

_base("sessions", "Sessions", "education", lambda: F.count(F.lit(1)))
_base("participant_touchpoints", "Participant Touchpoints", "education", lambda: F.sum("participants"))
_base("schools_served", "Schools Served", "education", lambda: distinct_when("school_id", F.col("school_key") > 0))
_base("title_i_participants", "Title I Participants", "education",
      lambda: F.sum(F.when(F.coalesce("is_title_i", F.lit(False)), F.col("participants"))))
_ratio("title_i_share", "Title I Share %", "title_i_participants", "participant_touchpoints")
_base("teaching_artist_hours", "Teaching Artist Hours", "education", lambda: F.sum("teaching_artist_hours"))


# ---------------------------------------------------------------- evaluation

def _needed(names: Sequence[str]) -> list[str]:
    """Names and everything they are derived from, dependencies first."""
    ordered: dict[str, None] = {}

    def visit(name: str) -> None:
        for part in MEASURES[name].uses:
            visit(part)
        ordered.setdefault(name)

    for name in names:
        visit(name)
    return list(ordered)


def measure(star: Mapping[str, DataFrame], names: Sequence[str], keys: Sequence[str] = (),
            filters: Mapping[str, Sequence] | None = None, as_of=None, people: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """One row per key with the named measures.

    A filter applies to every fact that has its column.  A fact that lacks some of the keys (rooms have no date) is
    folded to the keys it has and repeated over the others.

    ``people`` gives bitmaps per fact (:func:`boxledger.operators.people.person_bitmaps`) with a column per distinct count
    named like its measure.  Where they have the keys and filter columns that the fact has, those measures are counted from
    them and the fact is not asked for distinct people.
    """
    needed = _needed(names)
    by_fact: dict[str, list[str]] = {}
    for name in needed:
        if MEASURES[name].fact:
            by_fact.setdefault(MEASURES[name].fact, []).append(name)
    full, partial = [], []
    for fact, members in by_fact.items():
        frame = star[fact]
        for column, values in (filters or {}).items():
            if column in frame.columns:
                frame = frame.where(F.col(column).isin(*values))
        have = [k for k in keys if k in frame.columns]
        bitmaps = (people or {}).get(fact)
        needs = {*have, *(c for c in filters or {} if c in frame.columns)}
        if bitmaps is not None and needs <= set(bitmaps.columns):
            counted = [m for m in members if m in bitmaps.columns]
            for column, values in (filters or {}).items():
                if column in bitmaps.columns:
                    bitmaps = bitmaps.where(F.col(column).isin(*values))
            if counted:
                (full if len(have) == len(keys) else partial).append((count_people(bitmaps, have, counted), have))
            members = [m for m in members if m not in counted]
            if not members:
                continue
        folded = frame.groupBy(*have).agg(*[MEASURES[m].aggregate(as_of).alias(m) for m in members])
        (full if len(have) == len(keys) else partial).append((folded, have))
    if full:
        table = align_facts([f for f, _ in full], keys)
    else:
        table = _key_grid(partial, keys)
    for folded, have in partial:
        if have:
            table = table.join(folded, have, "left")
        else:
            table = table.withColumns({m: folded.select(m).scalar() for m in folded.columns})
    for name in needed:
        if MEASURES[name].derive:
            value = MEASURES[name].derive(*[F.col(u) for u in MEASURES[name].uses])
            table = table.withColumn(name, value)
    return table.select(*keys, *names)


def _key_grid(partial: Sequence[tuple[DataFrame, list[str]]], keys: Sequence[str]) -> DataFrame:
    """All keys of facts none of which has every key, joined on the keys they share."""
    missing = [k for k in keys if not any(k in have for _, have in partial)]
    if missing:
        raise ValueError(f"no fact of these measures has the key(s) {', '.join(missing)}")
    grid, seen = None, []
    for folded, have in sorted(partial, key=lambda x: -len(x[1])):
        if not have or set(have) <= set(seen):
            continue
        own = folded.select(*have).distinct()
        shared = [k for k in have if k in seen]
        if grid is not None and not shared:
            raise ValueError(f"these measures' facts share none of the keys {', '.join(keys)}")
        grid = own if grid is None else grid.join(own, shared, "full_outer")
        seen += [k for k in have if k not in seen]
    return grid.select(*keys)


# ---------------------------------------------------------------- prepared facts

def donor_years(gifts: DataFrame, years: DataFrame) -> DataFrame:
    """Per person and fiscal year: gave, gave the year before, and last year's total.

    Each giving year speaks for itself and for the next one, so one grouping replaces a self join.  ``years`` are the
    fiscal years of the report.
    """
    yearly = gifts.groupBy("patron_id", "fiscal_year").agg(
        F.sum("amount").alias("amount"), F.bool_or(F.col("amount") > 0).alias("gave"))
    said = F.array(F.struct(F.col("fiscal_year").alias("y"), F.lit(0).alias("lag")),
                   F.struct((F.col("fiscal_year") + 1).alias("y"), F.lit(1).alias("lag")))
    spread = yearly.withColumn("_s", F.explode(said))

    def at(lag: int, value: str) -> Column:
        return F.when(F.col("_s.lag") == lag, F.col(value))

    folded = spread.groupBy("patron_id", F.col("_s.y").alias("fiscal_year")).agg(
        F.coalesce(F.bool_or(at(0, "gave")), F.lit(False)).alias("gave"),
        F.coalesce(F.bool_or(at(1, "gave")), F.lit(False)).alias("gave_last_year"),
        F.sum(at(1, "amount")).alias("amount_last_year"))
    return folded.join(years.select("fiscal_year").distinct(), "fiscal_year", "left_semi")


def subscriber_years(subscriptions: DataFrame) -> DataFrame:
    """Per person and the fiscal year after a subscription, for years that have subscriptions themselves."""
    nxt = subscriptions.select("patron_id", (F.col("fiscal_year") + 1).alias("fiscal_year")).distinct()
    years = subscriptions.select("fiscal_year").distinct()
    return nxt.join(years, "fiscal_year", "left_semi").withColumn("subscribed_last_year", F.lit(True))


def promoted_sales(sales: DataFrame, ads: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sales of the series that had ad spend in the same context."""
    promoted = ads.select(*keys, F.col("series_promoted").alias("series")).distinct()
    return sales.join(promoted, [*keys, "series"], "left_semi")


def sales_star(sales: DataFrame, donors: DataFrame) -> DataFrame:
    """Sales with the flag ``is_donor`` (gave at any time) and the first day of the report's fiscal year."""
    givers = donors.where(F.col("amount") > 0).select("patron_id").distinct().withColumn("_gives", F.lit(True))
    flagged = sales.join(givers, "patron_id", "left")
    return flagged.withColumns({"is_donor": F.col("_gives").isNotNull(),
                                "period_start": fiscal_start(F.col("fiscal_year"))}).drop("_gives")
