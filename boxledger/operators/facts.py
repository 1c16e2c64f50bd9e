"""Fact loads.

Each function returns the rows to load; incremental facts are then applied with
:func:`boxledger.operators.changes.delete_insert`, the others replace their table.  A reference that cannot be resolved
becomes key -1, never a dropped row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import (date_key, days_before_event, gross_amount, hours_booked, money, net_amount, nullif_blank,
                         signed_ledger_amount)
from .changes import EPOCH_MARK
from .clean import filter_pending
from .joins import UNKNOWN_KEY, bridge_lookup, lookup_or_unknown, one_person_per_email, point_in_time_join, range_expand_join

__all__ = ["amounts", "fact_ticket_sales", "fact_gifts", "fact_subscriptions", "fact_education_sessions",
           "fact_gl_entry", "fact_venue_booking", "fact_budget", "fact_email_campaign_results", "fact_email_click",
           "fact_ad_spend_daily", "changed_lines"]

UPDATED = "_silver_updated_at"
SYSTEM = "tessitura"


def amounts(df: DataFrame, quantity: str = "quantity", unit_price: str = "unit_price",
            discount: str = "discount_amount") -> DataFrame:
    """Gross, discount and net as decimal(14,2); missing parts count as zero."""
    return df.withColumns({
        "gross_amount": gross_amount(quantity, unit_price),
        "net_amount": net_amount(quantity, unit_price, discount),
        discount: money(discount),
    })


def _flag(column: str):
    return F.coalesce(F.col(column).cast("boolean"), F.lit(False))


def _stamp(as_of):
    return F.lit(as_of).cast("timestamp")


def changed_lines(lines: DataFrame, orders: DataFrame, mark=EPOCH_MARK) -> DataFrame:
    """Order lines that changed after the mark, or whose order did.

    The changed orders are cut to their ids under a filter the scan can use; only lines that qualify go on to the
    wide joins.
    """
    moved = filter_pending(orders, UPDATED, mark).select(F.col("order_id").alias("_order"), F.lit(True).alias("_moved"))
    marked = lines.join(moved, lines["order_id"] == moved["_order"], "left")
    own = F.coalesce(F.col(UPDATED) > F.lit(mark).cast(lines.schema[UPDATED].dataType), F.lit(False))
    return marked.where(own | F.col("_moved").isNotNull()).drop("_order", "_moved")


def fact_ticket_sales(lines: DataFrame, orders: DataFrame, xref: DataFrame, patrons: DataFrame, performances: DataFrame,
                      venues: DataFrame, channels: DataFrame, mark=EPOCH_MARK, as_of=None) -> DataFrame:
    """Ticket lines to load, linked to the buyer as they were when ordering.

    Buyer and channel belong to the order and are looked up there, before its lines multiply them.
    """
    header = orders.select("order_id", F.col("constituent_id").alias("_buyer"), F.col("channel").alias("_channel"),
                           F.col("status").alias("_status"), F.col("order_datetime").alias("_ordered"))
    header = bridge_lookup(header, xref, patrons, "_buyer", "_ordered", SYSTEM)
    header = lookup_or_unknown(header, channels, {"_channel": "channel_name"}, "channel_key").drop("_buyer", "_channel")
    rows = changed_lines(lines, orders, mark).join(header, "order_id", "left")
    rows = rows.withColumns({c: F.coalesce(c, F.lit(UNKNOWN_KEY)) for c in ("patron_key", "channel_key")})
    shows = performances.select("performance_id", F.col("performance_key").alias("_show_key"),
                                F.col("performance_date_key").alias("_show_day"),
                                F.col("performance_datetime").alias("_show_time"), "venue_id")
    shows = lookup_or_unknown(shows, venues, "venue_id", "venue_key").drop("venue_id")
    rows = rows.join(shows, "performance_id", "left").withColumn("venue_key", F.coalesce("venue_key", F.lit(UNKNOWN_KEY)))
    return amounts(rows).select(
        "order_line_id", "order_id", "patron_key",
        F.coalesce("_show_key", F.lit(-1)).alias("performance_key"), "venue_key", "channel_key",
        date_key("_ordered").alias("order_date_key"), F.coalesce("_show_day", F.lit(-1)).alias("performance_date_key"),
        days_before_event("_ordered", "_show_time").alias("days_before_show"), "price_zone",
        F.coalesce("quantity", F.lit(0)).alias("quantity"), money("unit_price", 12).alias("unit_price"),
        "gross_amount", "discount_amount", "net_amount", _flag("is_comp").alias("is_comp"),
        F.coalesce(F.col("_status") == "Returned", F.lit(False)).alias("is_returned"), _stamp(as_of).alias("loaded_at"))


def fact_gifts(contributions: DataFrame, xref: DataFrame, patrons: DataFrame, campaigns: DataFrame, funds: DataFrame,
               mark=EPOCH_MARK, as_of=None) -> DataFrame:
    """Gifts to load, linked to the giver as they were on the gift day."""
    rows = filter_pending(contributions, UPDATED, mark)
    rows = rows.withColumn("_given", F.col("contribution_date").cast(patrons.schema["valid_from"].dataType))
    rows = bridge_lookup(rows, xref, patrons, "constituent_id", "_given", SYSTEM)
    rows = lookup_or_unknown(rows, campaigns, "campaign_id", "campaign_key")
    rows = lookup_or_unknown(rows, funds, "fund_id", "fund_key")
    return rows.select(
        F.col("contribution_id").alias("gift_id"), "patron_key", date_key("contribution_date").alias("gift_date_key"),
        "campaign_key", "fund_key", money("amount").alias("amount"), F.col("contribution_type").alias("gift_type"),
        _flag("is_anonymous").alias("is_anonymous"), _stamp(as_of).alias("loaded_at"))


def fact_subscriptions(subscriptions: DataFrame, seasons: DataFrame, xref: DataFrame, patrons: DataFrame,
                       as_of=None) -> DataFrame:
    """All subscriptions; one without a known season is left out."""
    rows = subscriptions.join(seasons.select("season_id", "fiscal_year"), "season_id", "inner")
    rows = bridge_lookup(rows, xref, patrons, "constituent_id", "purchased_at", SYSTEM)
    return rows.select(
        "subscription_id", "patron_key", date_key("purchased_at").alias("purchase_date_key"), "season_id",
        "fiscal_year", "package_name", F.coalesce("seats", F.lit(0)).alias("seats"),
        money("package_amount", 12).alias("package_amount"), _flag("is_renewal").alias("is_renewal"),
        _stamp(as_of).alias("loaded_at"))


def fact_education_sessions(enrollments: DataFrame, programs: DataFrame, schools: DataFrame, as_of=None) -> DataFrame:
    rows = lookup_or_unknown(enrollments, programs, "program_id", "program_key")
    rows = lookup_or_unknown(rows, schools, "school_id", "school_key")
    return rows.select(
        "enrollment_id", "program_key", "school_key", date_key("session_date").alias("session_date_key"),
        F.coalesce("participants", F.lit(0)).alias("participants"), "teaching_artist_hours",
        _stamp(as_of).alias("loaded_at"))


def fact_gl_entry(journal: DataFrame, accounts: DataFrame, funds: DataFrame, departments: DataFrame,
                  mark=EPOCH_MARK, as_of=None) -> DataFrame:
    """Journal lines to load, with their effective and posting days."""
    rows = filter_pending(journal, UPDATED, mark)
    rows = lookup_or_unknown(rows, accounts, "account_code", "account_key")
    coded = funds.where(F.col("ledger_fund_code").isNotNull())
    rows = lookup_or_unknown(rows, coded, {"fund_code": "ledger_fund_code"}, "fund_key")
    rows = lookup_or_unknown(rows, departments, "department_code", "department_key")
    return rows.select(
        "gl_transaction_id", "journal_id", "line_number", "session_id", "source_module",
        date_key("effective_date").alias("effective_date_key"), date_key("posted_at").alias("posted_date_key"),
        "account_key", "fund_key", "department_key", money("debit_amount").alias("debit_amount"),
        money("credit_amount").alias("credit_amount"),
        signed_ledger_amount("debit_amount", "credit_amount").alias("net_amount"),
        "description", "reference", _stamp(as_of).alias("loaded_at"))


def fact_venue_booking(bookings: DataFrame, events: DataFrame, rooms: DataFrame, as_of=None) -> DataFrame:
    rows = lookup_or_unknown(bookings, events, "event_id", "event_key")
    halls = rooms.select("room_id", "room_key", F.col("venue_key").alias("_hall"))
    rows = rows.join(halls, "room_id", "left")
    return rows.select(
        "booking_id", "event_key", F.coalesce("room_key", F.lit(-1)).alias("room_key"),
        F.coalesce("_hall", F.lit(-1)).alias("venue_key"), date_key("start_datetime").alias("booking_date_key"),
        "booking_type", "start_datetime", "end_datetime",
        hours_booked("start_datetime", "end_datetime").alias("hours_booked"),
        money("rental_fee", 12).alias("rental_fee"), _stamp(as_of).alias("loaded_at"))


def fact_budget(budget: DataFrame, calendar: DataFrame, accounts: DataFrame, funds: DataFrame, departments: DataFrame,
                version: str = "Adopted", as_of=None) -> DataFrame:
    """The adopted budget spread evenly over the days of each month, rounded to four decimals a day."""
    lines = budget.where(F.col("budget_version") == version)
    per_day = (F.col("amount").cast("decimal(14,2)") / F.day(F.last_day("period_start"))).cast("decimal(18,4)")
    lines = lines.withColumn("budget_amount", per_day)
    lines = lookup_or_unknown(lines, accounts, "account_code", "account_key")
    coded = funds.where(F.col("ledger_fund_code").isNotNull())
    lines = lookup_or_unknown(lines, coded, {"fund_code": "ledger_fund_code"}, "fund_key")
    lines = lookup_or_unknown(lines, departments, "department_code", "department_key")
    return range_expand_join(lines, calendar).select(
        "budget_line_id", "date_key", "fiscal_year", "budget_version", "account_key", "fund_key", "department_key",
        "budget_amount", _stamp(as_of).alias("loaded_at"))


def fact_email_campaign_results(campaigns: DataFrame, dim: DataFrame, as_of=None) -> DataFrame:
    """Latest delivery numbers per campaign."""
    counts = ["recipients", "delivered", "bounces", "unique_opens", "unique_clicks", "unsubscribes"]
    keyed = campaigns.join(dim.select("email_campaign_id", "email_campaign_key", "send_date_key"), "email_campaign_id")
    return keyed.select("email_campaign_key", "send_date_key", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
                        F.col("updated_at").alias("stats_updated_at"), _stamp(as_of).alias("loaded_at"))


def fact_email_click(clicks: DataFrame, campaigns: DataFrame, patrons: DataFrame, mark=EPOCH_MARK,
                     as_of=None) -> DataFrame:
    """Clicks linked to the person as they were when clicking.  The address finds the person and is then dropped."""
    rows = filter_pending(clicks, UPDATED, mark)
    rows = lookup_or_unknown(rows, campaigns, "email_campaign_id", "email_campaign_key")
    owners = one_person_per_email(patrons).select(F.col("email_key").alias("_address"), "patron_id")
    rows = rows.join(owners, F.lower(rows["email"]) == owners["_address"], "left")
    rows = point_in_time_join(rows, patrons, "patron_id", "clicked_at")
    return rows.select("click_id", "email_campaign_key", "patron_key", date_key("clicked_at").alias("click_date_key"),
                       "clicked_at", _stamp(as_of).alias("loaded_at"))


def fact_ad_spend_daily(ads: DataFrame, as_of=None) -> DataFrame:
    return ads.select(
        date_key("ad_date").alias("ad_date_key"), "platform", "ad_campaign_id", "ad_campaign_name", "utm_campaign",
        nullif_blank("series_promoted").alias("series_promoted"), F.coalesce("impressions", F.lit(0)).alias("impressions"),
        F.coalesce("clicks", F.lit(0)).alias("clicks"), money("spend", 12).alias("spend"),
        _stamp(as_of).alias("loaded_at"))
