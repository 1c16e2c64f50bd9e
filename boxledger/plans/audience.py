"""Ticketing, fundraising, subscription and education views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import conditional_sum, distinct_when, safe_ratio
from ..operators.aggregate import sort_by_measure
from ..operators.joins import dim_left_fact, inner_star, self_join_prior, theta_join

__all__ = ["performance_sell_through", "donor_status_by_fy", "donor_retention", "subscriber_renewal",
           "education_impact", "sales_pacing", "audience_mix", "lybunt_list", "gift_bands", "campaign_progress"]

SHOW_COLUMNS = ["performance_id", "title", "series", "genre", "season_name", "fiscal_year", "venue_name",
                "performance_datetime", "day_part", "capacity", "status"]


def performance_sell_through(performance: DataFrame, sales: DataFrame) -> DataFrame:
    """Per show: tickets, comps and net revenue without returns, against capacity.  Shows without sales stay.

    Sales are folded to one row per show before the join, so the join moves shows, not tickets.
    """
    kept = ~F.col("is_returned")
    per_show = sales.groupBy("performance_key").agg(
        conditional_sum("quantity", kept).alias("tickets_sold"),
        conditional_sum("quantity", kept & F.col("is_comp")).alias("comps"),
        conditional_sum("net_amount", kept).alias("net_revenue"))
    shows = performance.where(F.col("performance_key") > 0).select("performance_key", *SHOW_COLUMNS)
    joined = dim_left_fact(shows, per_show, "performance_key")
    zero = F.lit(0)
    tickets, revenue = F.coalesce("tickets_sold", zero), F.coalesce("net_revenue", zero)
    return joined.select(
        *SHOW_COLUMNS, tickets.alias("tickets_sold"), F.coalesce("comps", zero).alias("comps"),
        revenue.alias("net_revenue"),
        safe_ratio(tickets.cast("decimal(12,4)"), "capacity").alias("sell_through_pct"),
        safe_ratio(revenue.cast("decimal(14,2)"), "capacity").alias("revenue_per_available_seat"))


def donor_status_by_fy(gifts: DataFrame, calendar: DataFrame, patrons: DataFrame) -> DataFrame:
    """Every person with positive giving so far, per fiscal year: New, Retained, Reactivated, LYBUNT or SYBUNT."""
    positive = gifts.where((F.col("patron_key") > 0) & (F.col("amount") > 0))
    giving = inner_star(positive, [
        (calendar.select(F.col("date_key").alias("gift_date_key"), "fiscal_year"), "gift_date_key"),
        (patrons.select("patron_key", "patron_id"), "patron_key")])
    grid = theta_join(giving)
    this_year = F.col("by_year")[F.col("fiscal_year")]
    last_year = F.col("by_year")[F.col("fiscal_year") - 1]
    earlier = F.col("first_year") < F.col("fiscal_year") - 1
    status = (F.when(this_year.isNotNull() & last_year.isNotNull(), "Retained")
              .when(this_year.isNotNull() & earlier, "Reactivated")
              .when(this_year.isNotNull(), "New")
              .when(last_year.isNotNull(), "LYBUNT").otherwise("SYBUNT"))
    zero = F.lit(0)
    return grid.select("fiscal_year", "patron_id", F.coalesce(this_year, zero).alias("amount_this_year"),
                       F.coalesce(last_year, zero).alias("amount_last_year"), status.alias("donor_status"))


def donor_retention(status: DataFrame) -> DataFrame:
    """Donors who gave again against donors of last year, and the money at risk."""
    is_retained, is_lybunt = F.col("donor_status") == "Retained", F.col("donor_status") == "LYBUNT"
    counted = status.groupBy("fiscal_year").agg(
        F.count_if(is_retained).alias("retained_donors"),
        F.count_if(is_retained | is_lybunt).alias("donors_last_year"),
        F.count_if(is_lybunt).alias("lybunt_donors"),
        conditional_sum("amount_last_year", is_lybunt).alias("lybunt_revenue_at_risk"))
    rate = safe_ratio(F.col("retained_donors").cast("decimal(12,4)"), "donors_last_year")
    return counted.withColumn("donor_retention_rate", rate)


def subscriber_renewal(subscriptions: DataFrame, patrons: DataFrame) -> DataFrame:
    """Subscribers, those renewing, and last season's subscribers per fiscal year."""
    known = subscriptions.where(F.col("patron_key") > 0).join(patrons.select("patron_key", "patron_id"), "patron_key")
    # One row per person and year first: the distinct counts below then need no second expansion.
    people = known.groupBy("fiscal_year", "patron_id").agg(F.bool_or("is_renewal").alias("renews"))
    yearly = people.groupBy("fiscal_year").agg(F.count(F.lit(1)).alias("subscribers"),
                                               F.count_if("renews").alias("renewing_subscribers"))
    compared = self_join_prior(yearly, "fiscal_year", {"subscribers": "prior_year_subscribers"})
    rate = safe_ratio(F.col("renewing_subscribers").cast("decimal(12,4)"), "prior_year_subscribers")
    return compared.withColumn("renewal_rate", rate)


def education_impact(sessions: DataFrame, calendar: DataFrame, programs: DataFrame, schools: DataFrame) -> DataFrame:
    """Sessions, reach, hours and schools per year, program, borough and Title I flag."""
    star = inner_star(sessions, [
        (calendar.select(F.col("date_key").alias("session_date_key"), "fiscal_year"), "session_date_key"),
        (programs.select("program_key", "program_type", "program_name"), "program_key"),
        (schools.select("school_key", "borough", F.coalesce("is_title_i", F.lit(False)).alias("is_title_i_school")),
         "school_key")])
    return star.groupBy("fiscal_year", "program_type", "program_name", "borough", "is_title_i_school").agg(
        F.count(F.lit(1)).alias("sessions"), F.sum("participants").alias("participant_touchpoints"),
        F.sum("teaching_artist_hours").alias("teaching_artist_hours"),
        distinct_when("school_key").alias("schools_served"))


def sales_pacing(sales: DataFrame) -> DataFrame:
    """Tickets by days before the show, and the running total from the earliest order on.

    The window runs over one row per distance in days.
    """
    per_day = sales.where(~F.col("is_returned")).groupBy("days_before_show").agg(F.sum("quantity").alias("tickets"))
    earliest_first = Window.orderBy(F.col("days_before_show").desc_nulls_first())
    return per_day.withColumn("tickets_to_date", F.sum("tickets").over(earliest_first))


def audience_mix(sales: DataFrame, patrons: DataFrame, channels: DataFrame, period_start) -> DataFrame:
    """Buyers per region and channel, split into new (first seen in the period) and returning."""
    star = inner_star(sales, [(patrons.select("patron_key", "patron_id", "region", "first_seen_date"), "patron_key"),
                              (channels, "channel_key")])
    is_new = F.coalesce(F.col("first_seen_date") >= F.lit(period_start).cast("date"), F.lit(False))
    # One row per person first, so that people are counted without multiplying the sales rows.
    people = star.groupBy("region", "channel_name", "patron_id").agg(
        F.bool_or(is_new).alias("_new"), F.bool_or(~is_new).alias("_returning"), conditional_sum("quantity", ~F.col("is_returned")).alias("_tickets"))
    known = F.col("patron_id").isNotNull()
    return people.groupBy("region", "channel_name").agg(
        F.count("patron_id").alias("buyers"), F.count_if(known & F.col("_new")).alias("new_buyers"),
        F.count_if(known & F.col("_returning")).alias("returning_buyers"), F.sum("_tickets").alias("tickets"))


def lybunt_list(status: DataFrame, fiscal_year: int | None = None) -> DataFrame:
    """Call list: who gave last year and not this year, largest gift first."""
    lapsed = status.where(F.col("donor_status") == "LYBUNT")
    if fiscal_year is not None:
        lapsed = lapsed.where(F.col("fiscal_year") == fiscal_year)
    return sort_by_measure(lapsed.select("fiscal_year", "patron_id", "amount_last_year"), "amount_last_year",
                           "fiscal_year", "patron_id")


def gift_bands(gifts: DataFrame, bands: Sequence[tuple[str, float]], person: str = "patron_id") -> DataFrame:
    """Donor pyramid.  ``bands`` are (label, lowest total), in any order; totals below all of them are 'Below'."""
    totals = gifts.groupBy(person).agg(F.sum("amount").alias("total"))
    ladder = F
    for label, floor in sorted(bands, key=lambda b: -b[1]):
        ladder = ladder.when(F.col("total") >= floor, label)
    banded = totals.withColumn("band", ladder.otherwise("Below"))
    return banded.groupBy("band").agg(F.count(F.lit(1)).alias("donors"), F.sum("total").alias("amount"))


def campaign_progress(gifts: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Gifts against goal per campaign; campaigns without gifts stay."""
    raised = gifts.groupBy("campaign_key").agg(F.sum("amount").alias("raised"), F.count(F.lit(1)).alias("gifts"))
    joined = dim_left_fact(campaigns.where(F.col("campaign_key") > 0), raised, "campaign_key")
    total = F.coalesce("raised", F.lit(0))
    return joined.select("campaign_id", "campaign_name", "goal_amount", total.alias("raised"),
                         F.coalesce("gifts", F.lit(0)).alias("gifts"),
                         safe_ratio(total, "goal_amount").alias("share_of_goal"))
