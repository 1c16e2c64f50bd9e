"""Fact loads from silver-shaped frames over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import changes, facts
from ..sources import tables
from .queries_model import XREF, xref
from .registry import query
from .sql import dkey, fy
from .tables import AS_OF, Showcase, dec

MARK = "1998-01-01 00:00:00"

#: One line per (order, line number): the newest shipment, changed when it shipped.
LINES = """
    SELECT l_orderkey * 10 + l_linenumber AS order_line_id, l_orderkey AS order_id, max_by(l_partkey, k) AS part, max_by(CAST(l_quantity AS INTEGER), k) AS quantity,
           max_by(CAST(l_extendedprice AS DECIMAL(12,2)), k) AS unit_price, max_by(l_discount > 0.05, k) AS is_comp, max(l_shipdate) AS updated
    FROM (SELECT *, (l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS k FROM lineitem) GROUP BY l_orderkey, l_linenumber"""


def ticket_lines(t: Showcase):
    newest = F.max(F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount")).alias("_n")
    # Dealt by order, so neither the grouping by line nor the join with the orders moves the lines again.
    lines = t.lineitem.repartition("l_orderkey").groupBy((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_line_id"), F.col("l_orderkey").alias("order_id")).agg(newest)
    return lines.select(
        "order_line_id", "order_id", F.concat(F.lit("P"), F.col("_n.l_partkey")).alias("performance_id"), F.col("_n.l_quantity").cast("int").alias("quantity"),
        dec("_n.l_extendedprice", 12).alias("unit_price"), (F.col("_n.l_discount") > 0.05).alias("is_comp"), F.col("_n.l_shipdate").alias("_silver_updated_at"),
        F.lit("A").alias("price_zone"), F.lit(None).cast("decimal(12,2)").alias("discount_amount"))


def ticket_orders(t: Showcase):
    channel = F.nullif(F.col("o_orderpriority"), F.lit("3-MEDIUM"))
    return t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("constituent_id"), channel.alias("channel"),
                           F.when(F.col("o_orderstatus") == "F", "Returned").otherwise("Paid").alias("status"), F.col("o_orderdate").alias("order_datetime"),
                           F.col("o_orderdate").alias("_silver_updated_at"))


def channels(t: Showcase):
    return t.orders.select(F.col("o_orderpriority").alias("channel_name")).distinct().withColumn("channel_key", F.substring("channel_name", 1, 1).cast("int"))


def venues(t: Showcase):
    return t.performance.where(F.col("venue_id") != "V3").select("venue_id", F.substring("venue_id", 2, 1).cast("int").alias("venue_key")).distinct()


def ticket_sales(t: Showcase, mark=MARK):
    return facts.fact_ticket_sales(ticket_lines(t), ticket_orders(t), xref(t), t.patrons, t.performance, venues(t), channels(t), mark, AS_OF)


#: The person's version is the latest that began by the order's time (ASOF); every other lookup is an equality.
SALES = f"""
    SELECT order_line_id, order_id, coalesce(patron_key, -1) AS patron_key, coalesce(performance_key, -1) AS performance_key,
           coalesce(TRY_CAST(nullif(venue_id, 'V3')[2:] AS INTEGER), -1) AS venue_key, coalesce(TRY_CAST(nullif(channel, '3-MEDIUM')[1:1] AS INTEGER), -1) AS channel_key,
           {dkey('bought')} AS order_date_key, coalesce(performance_date_key, -1) AS performance_date_key,
           date_diff('day', CAST(bought AS DATE), CAST(performance_datetime AS DATE)) AS days_before_show, 'A' AS price_zone, quantity, unit_price,
           worth AS gross_amount, 0 AS discount_amount, worth AS net_amount, is_comp, returned AS is_returned
    FROM placed ASOF LEFT JOIN versions ON versions.source_id = placed.buyer AND placed.bought >= versions.valid_from
    LEFT JOIN performance USING (performance_id)"""
PLACED = """
    SELECT order_line_id, order_id, quantity, unit_price, is_comp, 'P' || part AS performance_id, CAST(quantity * unit_price AS DECIMAL(14,2)) AS worth,
           o_custkey AS buyer, o_orderdate AS bought, o_orderpriority AS channel, o_orderstatus = 'F' AS returned, greatest(updated, o_orderdate) AS touched
    FROM lines LEFT JOIN orders ON o_orderkey = order_id"""
ALL_SALES_CTE = {"xref": XREF, "lines": LINES, "versions": "SELECT source_id, patron_key, valid_from FROM patrons JOIN xref USING (patron_id)", "placed": PLACED}
SALES_CTE = {**ALL_SALES_CTE, "placed": f"FROM ({PLACED}) WHERE touched > TIMESTAMP '{MARK}'"}
AMOUNTS = "gross_amount discount_amount net_amount unit_price"


@query("fact_ticket_sales", SALES, ["patrons", "performance"], SALES_CTE, money=AMOUNTS)
def fact_ticket_sales(t: Showcase):
    return ticket_sales(t).drop("loaded_at")


@query("changed_lines", f"SELECT order_line_id FROM lines LEFT JOIN orders ON o_orderkey = order_id WHERE updated > TIMESTAMP '{MARK}' OR o_orderdate > TIMESTAMP '{MARK}'", local={"lines": LINES})
def changed_lines(t: Showcase):
    return facts.changed_lines(ticket_lines(t), ticket_orders(t), MARK).select("order_line_id")


@query("ticket_sales_increment", f"SELECT order_line_id, net_amount, is_returned FROM ({SALES})", ["patrons", "performance"], ALL_SALES_CTE, money="net_amount")
def ticket_sales_increment(t: Showcase):
    """A full load, then the increment after the mark applied to it: the result is the full load again."""
    shown = ["order_line_id", "net_amount", "is_returned"]
    increment = tables.stage_table(ticket_sales(t).select(*shown), tables.work_table(t.spark, "sales_increment"))
    return changes.delete_insert(ticket_sales(t, "1900-01-01 00:00:00").select(*shown), increment, "order_line_id")


@query("fact_gifts", f"""
    SELECT o_orderkey AS gift_id, coalesce(p.patron_key, -1) AS patron_key, {dkey('o_orderdate')} AS gift_date_key, CASE WHEN o_orderkey % 12 + 1 <= 10 THEN o_orderkey % 12 + 1 ELSE -1 END AS campaign_key,
           CASE WHEN o_custkey % 5 < 4 THEN o_custkey % 5 + 1 ELSE -1 END AS fund_key, CAST(o_totalprice AS DECIMAL(14,2)) AS amount, o_orderpriority AS gift_type, o_orderstatus = 'O' AS is_anonymous
    FROM orders LEFT JOIN xref ON xref.source_id = o_custkey
    LEFT JOIN patrons p ON p.patron_id = xref.patron_id AND o_orderdate >= p.valid_from AND o_orderdate < p.valid_to WHERE o_orderdate > TIMESTAMP '{MARK}'""",
       ["patrons"], {"xref": XREF}, money="amount")
def fact_gifts(t: Showcase):
    rows = t.orders.select(F.col("o_orderkey").alias("contribution_id"), F.col("o_custkey").alias("constituent_id"), F.to_date("o_orderdate").alias("contribution_date"),
                           F.concat(F.lit("C"), F.col("o_orderkey") % 12 + 1).alias("campaign_id"), F.concat(F.lit("F"), F.col("o_custkey") % 5 + 1).alias("fund_id"),
                           dec("o_totalprice").alias("amount"), F.col("o_orderpriority").alias("contribution_type"),
                           F.when(F.col("o_orderstatus") == "O", True).when(F.col("o_orderstatus") == "F", False).alias("is_anonymous"), F.col("o_orderdate").alias("_silver_updated_at"))
    return facts.fact_gifts(rows, xref(t), t.patrons, t.campaigns.where(F.col("goal_amount") < 100000000), t.funds, MARK, AS_OF).drop("loaded_at")


@query("fact_subscriptions", f"""
    SELECT o_orderkey AS subscription_id, coalesce(p.patron_key, -1) AS patron_key, {dkey('o_orderdate')} AS purchase_date_key, 'S' || {fy('o_orderdate')} AS season_id, {fy('o_orderdate')} AS fiscal_year,
           o_orderpriority AS package_name, 0 AS seats, CAST(o_totalprice AS DECIMAL(12,2)) AS package_amount, false AS is_renewal
    FROM orders LEFT JOIN xref ON xref.source_id = o_custkey LEFT JOIN patrons p ON p.patron_id = xref.patron_id AND o_orderdate >= p.valid_from AND o_orderdate < p.valid_to
    WHERE {fy('o_orderdate')} <= 2000""", ["patrons"], {"xref": XREF}, money="package_amount")
def fact_subscriptions(t: Showcase):
    from ..functions import fiscal_year
    year = fiscal_year("o_orderdate")
    seasons = t.orders.select(year.alias("fiscal_year")).distinct().where(F.col("fiscal_year") <= 2000).withColumn("season_id", F.concat(F.lit("S"), "fiscal_year"))
    rows = t.orders.select(F.col("o_orderkey").alias("subscription_id"), F.col("o_custkey").alias("constituent_id"), F.concat(F.lit("S"), year).alias("season_id"), F.col("o_orderpriority").alias("package_name"),
                           F.lit(None).cast("int").alias("seats"), dec("o_totalprice", 12).alias("package_amount"), F.lit(None).cast("boolean").alias("is_renewal"), F.col("o_orderdate").alias("purchased_at"))
    return facts.fact_subscriptions(rows, seasons, xref(t), t.patrons, AS_OF).drop("loaded_at")


@query("fact_education_sessions", f"""
    SELECT event_id AS enrollment_id, CASE WHEN user_id % 12 < 10 THEN user_id % 12 + 1 ELSE -1 END AS program_key, CASE WHEN event_id % 15 = 0 THEN -1 ELSE event_id % 15 END AS school_key,
           {dkey('ts')} AS session_date_key, CASE WHEN value < 5 THEN 0 ELSE CAST(floor(value) AS INTEGER) END AS participants, CAST(floor(value) / 2 AS DECIMAL(6,1)) AS teaching_artist_hours
    FROM events WHERE event_type = 'signup'""", money="teaching_artist_hours")
def fact_education_sessions(t: Showcase):
    programs = t.programs.select("program_key", F.concat(F.lit("G"), "program_key").alias("program_id"))
    schools = t.schools.where(F.col("school_key") > 0)
    k = F.col("event_id") % 15
    rows = t.events.where(F.col("event_type") == "signup").select(
        F.col("event_id").alias("enrollment_id"), F.concat(F.lit("G"), F.col("user_id") % 12 + 1).alias("program_id"), F.when(k != 0, F.concat(F.lit("S"), k)).alias("school_id"), F.to_date("ts").alias("session_date"),
        F.when(F.col("value") >= 5, F.floor("value").cast("int")).alias("participants"), (F.floor("value") / 2).cast("decimal(6,1)").alias("teaching_artist_hours"))
    return facts.fact_education_sessions(rows, programs, schools, AS_OF).drop("loaded_at")


@query("fact_gl_entry", f"""
    SELECT journal_id || ':' || account_code AS gl_transaction_id, source_module, {dkey('date')} AS effective_date_key, {dkey('date')} AS posted_date_key,
           coalesce(CASE WHEN account_code <> '5600' THEN account_key END, -1) AS account_key, CASE WHEN fund_key < 4 THEN fund_key ELSE -1 END AS fund_key,
           CASE WHEN department_key < 5 THEN department_key ELSE -1 END AS department_key, debit_amount, credit_amount, net_amount FROM gl WHERE date > DATE '1998-01-01'""",
       ["gl"], money="debit_amount credit_amount net_amount")
def fact_gl_entry(t: Showcase):
    codes = F.element_at(F.array(*[F.lit(c) for c in ("GEN", "EDU", "END", "NONE")]), F.col("fund_key").cast("int"))
    journal = t.journal.select(
        F.concat("journal_id", F.lit(":"), "account_code").alias("gl_transaction_id"), "journal_id", F.lit(1).alias("line_number"), F.lit("s").alias("session_id"), "source_module",
        F.col("date").alias("effective_date"), F.col("date").cast("timestamp_ntz").alias("posted_at"), "account_code", codes.alias("fund_code"),
        F.concat(F.lit("D"), "department_key").alias("department_code"), "debit_amount", "credit_amount", F.lit("d").alias("description"), F.lit("r").alias("reference"),
        F.col("date").cast("timestamp_ntz").alias("_silver_updated_at"))
    loaded = facts.fact_gl_entry(journal, t.accounts.where(F.col("account_code") != "5600"), t.funds, t.departments.where(F.col("department_name") != "Department 5"), MARK, AS_OF)
    return loaded.drop("loaded_at", "journal_id", "line_number", "session_id", "description", "reference")


@query("fact_venue_booking", f"""
    SELECT event_id AS booking_id, CASE WHEN user_id % 10 <> 0 THEN user_id + 1 ELSE -1 END AS event_key, CASE WHEN event_id % 6 + 1 > 2 THEN event_id % 6 + 1 ELSE -1 END AS room_key,
           CASE WHEN event_id % 6 + 1 > 2 THEN (event_id % 6 + 1) % 4 + 1 ELSE -1 END AS venue_key, {dkey('ts')} AS booking_date_key, event_type AS booking_type,
           CAST(datediff('minute', ts, ts + INTERVAL 95 MINUTE) / 60.0 AS DECIMAL(6,2)) AS hours_booked, CASE WHEN value > 10 THEN CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE) ELSE 0 END AS rental_fee FROM events""",
       money="hours_booked rental_fee")
def fact_venue_booking(t: Showcase):
    rows = t.events.select(F.col("event_id").alias("booking_id"), F.concat(F.lit("E"), "user_id").alias("event_id"), F.concat(F.lit("R"), F.col("event_id") % 6 + 1).alias("room_id"), F.col("event_type").alias("booking_type"),
                           F.col("ts").alias("start_datetime"), F.timestamp_add("MINUTE", F.lit(95), F.col("ts")).alias("end_datetime"), F.when(F.col("value") > 10, dec("value", 12)).alias("rental_fee"))
    known = t.venue_events.where(F.col("status") != "Cancelled")
    return facts.fact_venue_booking(rows, known, t.rooms.where(F.col("room_type") == "Studio"), AS_OF).drop("loaded_at", "start_datetime", "end_datetime")


@query("fact_budget", "SELECT budget_line_id, date_key, fiscal_year, budget_version, account_key, CASE WHEN account_code < '5000' THEN 1 ELSE 2 END AS fund_key, CASE WHEN account_code < '5000' THEN 1 ELSE 2 END AS department_key, budget_amount FROM budget", ["budget"], money="budget_amount")
def fact_budget(t: Showcase):
    return t.budget.drop("loaded_at")


@query("fact_email_campaign_results", "SELECT email_campaign_key, send_date_key, recipients, delivered, 0 AS bounces, unique_opens, unique_clicks, unsubscribes FROM email_campaigns", ["email_campaigns"])
def fact_email_campaign_results(t: Showcase):
    source = t.email_campaigns.drop("email_campaign_key", "send_date_key").withColumns({"bounces": F.lit(None).cast("bigint"), "updated_at": F.col("send_datetime")})
    return facts.fact_email_campaign_results(source, t.email_campaigns, AS_OF).drop("loaded_at", "stats_updated_at")


@query("fact_email_click", f"""
    SELECT click_id, coalesce(list_position(range(20), mailing), -1) AS email_campaign_key, coalesce(patron_key, -1) AS patron_key, {dkey('at_time')} AS click_date_key
    FROM clicked LEFT JOIN owners USING (address) ASOF LEFT JOIN patrons ON patrons.patron_id = owners.owner AND clicked.at_time >= patrons.valid_from""", ["patrons"], {
    "clicked": """SELECT event_id AS click_id, event_id % 25 AS mailing, 'cust' || user_id || '@mail.org' AS address, ts AS at_time
                  FROM events WHERE event_type = 'click' AND ts > TIMESTAMP '2024-01-10'""",
    "owners": "SELECT lower(email) AS address, min(patron_id) AS owner FROM patrons WHERE is_current GROUP BY lower(email)"})
def fact_email_click(t: Showcase):
    clicks = t.events.where(F.col("event_type") == "click").select(
        F.col("event_id").alias("click_id"), F.concat(F.lit("EM"), F.col("event_id") % 25).alias("email_campaign_id"), F.concat(F.lit("CUST"), "user_id", F.lit("@mail.org")).alias("email"), F.col("ts").alias("clicked_at"),
        F.col("ts").alias("_silver_updated_at"))
    return facts.fact_email_click(clicks, t.email_campaigns, t.patrons, "2024-01-10 00:00:00", AS_OF).drop("loaded_at", "clicked_at")


@query("fact_ad_spend_daily", "SELECT ad_date_key, platform, series_promoted, sum(impressions) AS impressions, sum(clicks) AS clicks, sum(spend) AS spend FROM ads GROUP BY 1, 2, 3", ["ads"], money="spend", whole="impressions clicks")
def fact_ad_spend_daily(t: Showcase):
    raw = t.lineitem.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey", "left").select(
        F.to_date("l_shipdate").alias("ad_date"), F.when(F.col("l_linestatus") == "O", "Meta Ads").otherwise("Google Ads").alias("platform"), F.lit("a").alias("ad_campaign_id"), F.lit("n").alias("ad_campaign_name"),
        F.lit("u").alias("utm_campaign"), F.when(F.col("l_suppkey") % 10 == 0, "").otherwise(F.col("p_type")).alias("series_promoted"), (F.col("l_quantity").cast("int") * 100).alias("impressions"),
        F.col("l_quantity").cast("int").alias("clicks"), dec(dec("l_extendedprice") * dec(F.lit(0.01), 3, 2), 12).alias("spend"))
    loaded = facts.fact_ad_spend_daily(raw, AS_OF)
    return loaded.groupBy("ad_date_key", "platform", "series_promoted").agg(F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"), F.sum("spend").alias("spend"))
