"""Email and advertising views."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import safe_ratio
from ..operators.aggregate import window_sum_whole_partition
from ..operators.joins import inner_star, interval_join

__all__ = ["email_conversions", "email_campaign_performance", "ad_spend_by_series", "ATTRIBUTION_DAYS"]

ATTRIBUTION_DAYS = 7


def email_conversions(clicks: DataFrame, campaigns: DataFrame, patrons: DataFrame, sales: DataFrame,
                      performances: DataFrame, calendar: DataFrame) -> DataFrame:
    """Buyers and revenue within seven days of a click, per campaign.

    Clicks count once per campaign, person and day: a sale within reach of two click days counts twice in revenue but
    its buyer once.
    """
    people = patrons.select("patron_key", "patron_id")
    days = calendar.select("date_key", "date")
    clickers = inner_star(clicks.where(F.col("patron_key") > 0), [
        (people, "patron_key"),
        (days.select(F.col("date_key").alias("click_date_key"), F.col("date").alias("click_date")), "click_date_key"),
        (campaigns.select("email_campaign_key", "series_promoted"), "email_campaign_key"),
    ]).select("email_campaign_key", "series_promoted", "patron_id", "click_date").distinct()
    bought = inner_star(sales.where(~F.col("is_returned")), [
        (people, "patron_key"),
        (days.select(F.col("date_key").alias("order_date_key"), F.col("date").alias("order_date")), "order_date_key"),
        (performances.select("performance_key", "series"), "performance_key")])
    hits = interval_join(clickers, bought, "patron_id", "click_date", "order_date", ATTRIBUTION_DAYS, ["net_amount"],
                         series=("series_promoted", "series"))
    return hits.groupBy("email_campaign_key").agg(F.count_distinct("patron_id").alias("buyers_7d"),
                                                  F.sum("net_amount").alias("ticket_revenue_7d"))


def email_campaign_performance(clicks: DataFrame, results: DataFrame, sales: DataFrame, campaigns: DataFrame,
                               patrons: DataFrame, performances: DataFrame, calendar: DataFrame) -> DataFrame:
    """Delivery rates per campaign and what its clickers bought."""
    converted = email_conversions(clicks, campaigns, patrons, sales, performances, calendar)
    sent = inner_star(campaigns.where(F.col("email_campaign_key") > 0).drop("send_date_key"), [
        (results, "email_campaign_key"),
        (calendar.select(F.col("date_key").alias("send_date_key"), "fiscal_year"), "send_date_key")])
    joined = sent.join(converted, "email_campaign_key", "left")

    def rate(part: str, whole: str):
        return safe_ratio(F.col(part).cast("decimal(12,4)"), whole)

    return joined.select(
        "email_campaign_id", "campaign_name", "campaign_type", "series_promoted", "audience_segment",
        F.to_date("send_datetime").alias("send_date"), "fiscal_year", "recipients", "delivered", "unique_opens",
        "unique_clicks", "unsubscribes", rate("delivered", "recipients").alias("delivery_rate"),
        rate("unique_opens", "delivered").alias("open_rate"), rate("unique_clicks", "delivered").alias("click_rate"),
        rate("unsubscribes", "delivered").alias("unsubscribe_rate"),
        F.coalesce("buyers_7d", F.lit(0)).alias("buyers_within_7_days"),
        F.coalesce("ticket_revenue_7d", F.lit(0)).alias("ticket_revenue_within_7_days"))


def ad_spend_by_series(ads: DataFrame, sales: DataFrame, performances: DataFrame, calendar: DataFrame) -> DataFrame:
    """Spend, clicks and the promoted series' revenue per ad dollar, by fiscal year and platform.

    A NULL series meets no sales but still forms its own total.
    """
    spent = ads.join(calendar.select(F.col("date_key").alias("ad_date_key"), "fiscal_year"), "ad_date_key").groupBy(
        "fiscal_year", "series_promoted", "platform").agg(
        F.sum("spend").alias("spend"), F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"))
    revenue = sales.where(~F.col("is_returned")).join(
        performances.select("performance_key", "fiscal_year", F.col("series").alias("series_promoted")),
        "performance_key").groupBy("fiscal_year", "series_promoted").agg(
        F.sum("net_amount").alias("series_net_ticket_revenue"))
    joined = spent.join(revenue, ["fiscal_year", "series_promoted"], "left")
    series_spend = window_sum_whole_partition("spend", ["fiscal_year", "series_promoted"])
    return joined.withColumn("_series_spend", series_spend).select(
        "fiscal_year", "series_promoted", "platform", "spend", "impressions", "clicks",
        safe_ratio(F.col("clicks").cast("decimal(14,4)"), "impressions").alias("click_through_rate"),
        safe_ratio("spend", "clicks").alias("cost_per_click"), "series_net_ticket_revenue",
        safe_ratio("series_net_ticket_revenue", "_series_spend").alias("series_revenue_per_ad_dollar"))
