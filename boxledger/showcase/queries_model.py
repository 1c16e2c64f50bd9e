"""Joins, calendar, keys, dimensions and fact loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fiscal_year, month_start
from ..operators import changes, dimensions, joins
from .registry import query
from .sql import dkey, fy, money, mstart
from .tables import Showcase, dec

# ---------------------------------------------------------------- joins

LINE_KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


@query("lookup_or_unknown", f"SELECT {LINE_KEY}, coalesce(s.k, -1) AS supplier_key FROM lineitem LEFT JOIN (SELECT s_suppkey, s_suppkey + 1 AS k FROM supplier WHERE s_acctbal > 0) s ON s.s_suppkey = l_suppkey")
def lookup_or_unknown(t: Showcase):
    dim = t.supplier.where(F.col("s_acctbal") > 0).select("s_suppkey", (F.col("s_suppkey") + 1).alias("supplier_key"))
    found = joins.lookup_or_unknown(t.lineitem, dim, {"l_suppkey": "s_suppkey"}, "supplier_key")
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "supplier_key")


@query("point_in_time_join", "SELECT o_orderkey, coalesce(patron_key, -1) AS patron_key FROM orders LEFT JOIN patrons p ON p.patron_id = o_custkey AND o_orderdate >= valid_from AND o_orderdate < valid_to", ["patrons"])
def point_in_time_join(t: Showcase):
    orders = t.orders.withColumn("patron_id", F.col("o_custkey"))
    return joins.point_in_time_join(orders, t.patrons, "patron_id", "o_orderdate").select("o_orderkey", "patron_key")


XREF = "SELECT 'tessitura' AS source_system, c_custkey AS source_id, c_custkey // 2 * 2 AS patron_id FROM customer WHERE c_nationkey <> 7"


def xref(t: Showcase):
    """Neighbouring customers are one person; those of one nation were never matched."""
    return t.customer.where(F.col("c_nationkey") != 7).select(
        F.lit("tessitura").alias("source_system"), F.col("c_custkey").alias("source_id"), (F.floor(F.col("c_custkey") / 2) * 2).alias("patron_id"))


@query("bridge_lookup", "SELECT o_orderkey, coalesce(patron_key, -1) AS patron_key FROM orders LEFT JOIN xref ON source_id = o_custkey LEFT JOIN patrons p ON p.patron_id = xref.patron_id AND o_orderdate >= valid_from AND o_orderdate < valid_to",
       ["patrons"], {"xref": XREF})
def bridge_lookup(t: Showcase):
    return joins.bridge_lookup(t.orders, xref(t), t.patrons, "o_custkey", "o_orderdate", "tessitura").select("o_orderkey", "patron_key")


@query("inner_star", "SELECT n_name, r_name, count(*) AS customers FROM customer JOIN (SELECT * FROM nation WHERE n_nationkey <> 3) ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2")
def inner_star(t: Showcase):
    nation = t.nation.where(F.col("n_nationkey") != 3).withColumnRenamed("n_nationkey", "c_nationkey")
    star = joins.inner_star(t.customer, [(nation, "c_nationkey"), (t.region.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")])
    return star.groupBy("n_name", "r_name").agg(F.count(F.lit(1)).alias("customers"))


@query("dim_left_fact", "SELECT o_orderkey, count(l_orderkey) AS lines FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def dim_left_fact(t: Showcase):
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("lines"))
    joined = joins.dim_left_fact(t.orders.select("o_orderkey"), lines, "o_orderkey")
    return joined.select("o_orderkey", F.coalesce("lines", F.lit(0)).alias("lines"))


ORDER_SHIP = {
    "o": f"SELECT {mstart('o_orderdate')} AS month_start, o_orderpriority AS grp, sum({money('o_totalprice')}) AS ordered FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1, 2",
    "s": f"SELECT {mstart('l_shipdate')} AS month_start, o_orderpriority AS grp, sum({money('l_extendedprice')}) AS shipped FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2"}
ALIGNED = "SELECT coalesce(o.month_start, s.month_start) AS month_start, coalesce(o.grp, s.grp) AS grp, {o} AS ordered, {s} AS shipped FROM o FULL JOIN s ON s.month_start = o.month_start AND s.grp = o.grp"


def order_ship(t: Showcase):
    ordered = t.orders.where(F.col("o_orderstatus") != "F").groupBy(month_start("o_orderdate").alias("month_start"), F.col("o_orderpriority").alias("grp")).agg(F.sum(dec("o_totalprice")).alias("ordered"))
    lines = t.lineitem.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("grp")), "l_orderkey")
    return ordered, lines.groupBy(month_start("l_shipdate").alias("month_start"), "grp").agg(F.sum(dec("l_extendedprice")).alias("shipped"))


@query("full_outer_align", ALIGNED.format(o="coalesce(ordered, 0)", s="coalesce(shipped, 0)"), local=ORDER_SHIP, money="ordered shipped", text="month_start")
def full_outer_align(t: Showcase):
    return joins.full_outer_align(*order_ship(t), ["month_start", "grp"], ["ordered", "shipped"])


@query("align_facts", ALIGNED.format(o="ordered", s="shipped"), local=ORDER_SHIP, money="ordered shipped", text="month_start")
def align_facts(t: Showcase):
    return joins.align_facts(order_ship(t), ["month_start", "grp"])


@query("range_expand_join", "SELECT b.budget_line_id, c.date_key FROM budget_lines b JOIN calendar c ON c.date BETWEEN b.period_start AND last_day(b.period_start)", ["budget_lines", "calendar"])
def range_expand_join(t: Showcase):
    return joins.range_expand_join(t.budget_lines, t.calendar).select("budget_line_id", "date_key")


CLICK_DAYS = {"c": "SELECT DISTINCT user_id, CAST(ts AS DATE) AS click_day, event_id % 3 AS kind FROM events WHERE event_type = 'click'",
              "p": "SELECT user_id, CAST(ts AS DATE) AS sale_day, event_id % 4 AS kind, CAST(value AS DECIMAL(14,2)) AS amount FROM events WHERE event_type = 'purchase'"}


def click_days(t: Showcase):
    clicks = t.events.where(F.col("event_type") == "click").select("user_id", F.to_date("ts").alias("click_day"), (F.col("event_id") % 3).alias("kind")).distinct()
    sales = t.events.where(F.col("event_type") == "purchase").select("user_id", F.to_date("ts").alias("sale_day"), (F.col("event_id") % 4).alias("kind"), dec("value").alias("amount"))
    return clicks, sales


@query("interval_join", "SELECT c.user_id, c.click_day, c.kind, count(*) AS sales_matched, sum(amount) AS amount FROM c JOIN p ON p.user_id = c.user_id AND sale_day BETWEEN click_day AND click_day + 7 GROUP BY 1, 2, 3",
       local=CLICK_DAYS, money="amount", text="click_day")
def interval_join(t: Showcase):
    clicks, sales = click_days(t)
    return joins.interval_join(clicks, sales.drop("kind"), "user_id", "click_day", "sale_day", 7, ["amount"])


@query("conditional_match", "SELECT c.user_id, c.click_day, nullif(c.kind, 0) AS wanted, count(*) AS sales_matched, sum(amount) AS amount FROM c JOIN p ON p.user_id = c.user_id AND sale_day BETWEEN click_day AND click_day + 7 AND (nullif(c.kind, 0) IS NULL OR p.kind = nullif(c.kind, 0)) GROUP BY 1, 2, 3",
       local=CLICK_DAYS, money="amount", text="click_day")
def conditional_match(t: Showcase):
    clicks, sales = click_days(t)
    clicks = clicks.select("user_id", "click_day", F.nullif(F.col("kind"), F.lit(0)).alias("wanted"))
    return joins.interval_join(clicks, sales, "user_id", "click_day", "sale_day", 7, ["amount"], series=("wanted", "kind"))


@query("conditional_match_predicate", "SELECT c_custkey, n_nationkey FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE nullif(c_nationkey % 4, 0) IS NULL OR n_regionkey = nullif(c_nationkey % 4, 0)")
def conditional_match_predicate(t: Showcase):
    joined = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey")).withColumn("wanted", F.nullif(F.col("c_nationkey") % 4, F.lit(0)))
    return joined.where(joins.conditional_match("wanted", "n_regionkey")).select("c_custkey", "n_nationkey")


@query("theta_join", "SELECT y.fiscal_year, g.patron_id, count(*) AS years_given, min(g.fiscal_year) AS first_year, sum(g.amount) AS amount FROM (SELECT DISTINCT fiscal_year FROM giving) y JOIN giving g ON g.fiscal_year <= y.fiscal_year GROUP BY 1, 2",
       ["giving"], money="amount", whole="first_year years_given")
def theta_join(t: Showcase):
    grid = joins.theta_join(t.gifts.where((F.col("patron_key") > 0) & (F.col("amount") > 0)))
    past = F.filter(F.map_entries("by_year"), lambda e: e["key"] <= F.col("fiscal_year"))
    total = F.aggregate(past, F.lit(0).cast("decimal(34,2)"), lambda acc, e: (acc + e["value"]).cast("decimal(34,2)"))
    return grid.select("fiscal_year", "patron_id", F.size(past).alias("years_given"), "first_year", total.alias("amount"))


@query("self_join_prior", "SELECT c.*, p.n AS n_before FROM y c LEFT JOIN y p ON p.c = c.c AND p.fiscal_year = c.fiscal_year - 1", local={"y": f"SELECT o_custkey AS c, {fy('o_orderdate')} AS fiscal_year, count(*) AS n FROM orders GROUP BY 1, 2"})
def self_join_prior(t: Showcase):
    yearly = t.orders.groupBy(F.col("o_custkey").alias("c"), fiscal_year("o_orderdate").alias("fiscal_year")).agg(F.count(F.lit(1)).alias("n"))
    return joins.self_join_prior(yearly, "fiscal_year", {"n": "n_before"}, ["c"])


@query("left_anti", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def left_anti(t: Showcase):
    return joins.left_anti(t.orders.select("o_orderkey"), t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey")


@query("left_semi", "SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def left_semi(t: Showcase):
    returned = t.lineitem.where(F.col("l_returnflag") == "R").withColumnRenamed("l_orderkey", "o_orderkey")
    return joins.left_semi(t.orders.select("o_orderkey"), returned, "o_orderkey")


@query("exists_predicate", "SELECT c_custkey FROM customer c WHERE EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = c.c_nationkey AND s_acctbal > 5000)")
def exists_predicate(t: Showcase):
    return joins.exists_predicate(t.customer, t.supplier.where(F.col("s_acctbal") > 5000), {"c_nationkey": "s_nationkey"}).select("c_custkey")


@query("multi_key_fallback_match", """
    SELECT c_custkey, coalesce(a.p, b.p) AS best, CASE WHEN a.p IS NOT NULL THEN 'name' WHEN b.p IS NOT NULL THEN 'nation' END AS match_rule
    FROM (SELECT c_custkey, 'Supplier#' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS name, c_nationkey AS nation FROM customer)
    LEFT JOIN (SELECT s_name AS name, min(s_suppkey) AS p FROM supplier GROUP BY 1) a USING (name)
    LEFT JOIN (SELECT s_nationkey AS nation, min(s_suppkey) AS p FROM supplier GROUP BY 1) b USING (nation)""")
def multi_key_fallback_match(t: Showcase):
    known = t.supplier.select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("best"))
    new = t.customer.select("c_custkey", F.concat(F.lit("Supplier#"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias("name"), F.col("c_nationkey").alias("nation"))
    return joins.multi_key_fallback_match(new, known, ["name", "nation"], "best").select("c_custkey", "best", "match_rule")


@query("note_join", "SELECT r.month_start, r.revenue_stream, r.gl_amount, n.note FROM recon r LEFT JOIN notes n USING (month_start, revenue_stream, fund_code)", ["recon", "notes"], money="gl_amount", text="month_start")
def note_join(t: Showcase):
    noted = joins.note_join(t.recon.drop("cause", "note", "resolution"), t.notes)
    return noted.select("month_start", "revenue_stream", "gl_amount", "note")


@query("one_person_per_email", "SELECT lower(email) AS email_key, min(patron_id) AS patron_id FROM (SELECT patron_id // 5 || '@Mail.org' AS email, patron_id FROM patrons WHERE is_current AND email IS NOT NULL) GROUP BY 1", ["patrons"])
def one_person_per_email(t: Showcase):
    shared = F.when(F.col("email").isNotNull(), F.concat(F.floor(F.col("patron_id") / 5), F.lit("@Mail.org")))
    return joins.one_person_per_email(t.patrons.withColumn("email", shared))


# ---------------------------------------------------------------- calendar and keys

@query("fiscal_calendar", "SELECT * FROM calendar", ["calendar"], text="date", whole="date_key weekday_num fiscal_quarter fiscal_year month_num quarter_num calendar_year fiscal_month_num")
def fiscal_calendar(t: Showcase):
    return t.calendar


@query("calendar_bounds", "SELECT make_date(year(f) - CASE WHEN month(f) >= 7 THEN 0 ELSE 1 END, 7, 1) AS start_day, make_date(year(l) + CASE WHEN month(l) >= 7 THEN 1 ELSE 0 END, 6, 30) AS end_day FROM (SELECT min(CAST(o_orderdate AS DATE)) AS f, greatest(DATE '1999-01-01', max(last_day(CAST(o_orderdate AS DATE)))) AS l FROM orders)", text="start_day end_day")
def calendar_bounds(t: Showcase):
    bounds = dimensions.calendar_bounds([(t.orders, "o_orderdate"), (t.lineitem, "l_shipdate")], [(t.orders, "o_orderdate")], (t.orders, "o_orderdate"), "1999-01-01")
    return bounds.select(F.col("start").alias("start_day"), F.col("end").alias("end_day"))


@query("assign_surrogate_keys", """
    SELECT s_suppkey + 1 AS member_key, s_name AS member_id FROM supplier
    UNION ALL SELECT (SELECT max(s_suppkey) + 1 FROM supplier) + row_number() OVER (ORDER BY p_id), p_id FROM (SELECT DISTINCT p_brand || '/' || p_name AS p_id FROM part)""")
def assign_surrogate_keys(t: Showcase):
    dim = t.supplier.select((F.col("s_suppkey") + 1).alias("member_key"), F.col("s_name").alias("member_id"))
    arriving = t.part.select(F.concat("p_brand", F.lit("/"), "p_name").alias("member_id")).distinct().unionByName(t.supplier.select(F.col("s_name").alias("member_id")))
    return dimensions.assign_surrogate_keys(dim, arriving, "member_id", "member_key")


@query("number_in_order", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders")
def number_in_order(t: Showcase):
    return dimensions.number_in_order(t.orders.select("o_orderkey"), "o_orderkey", "n")


@query("unknown_member", "SELECT c_custkey AS member_key, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT -1, 'Unknown', NULL")
def unknown_member(t: Showcase):
    dim = t.customer.select(F.col("c_custkey").alias("member_key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    once = dimensions.unknown_member(dim, "member_key", {"name": "Unknown"})
    return dimensions.unknown_member(once, "member_key", {"name": "Unknown"})


# ---------------------------------------------------------------- versioned people

PATRON_DDL = ("patron_key bigint, patron_id string, first_name string, last_name string, full_name string, email string, phone string, address_line1 string, city string, "
              "state string, postal_code string, country string, region string, patron_type string, email_opt_in boolean, source_systems string, first_seen_date date, "
              "scd_hash string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean")


def person_rows(t: Showcase, second: bool):
    """Customers as people.  In the second delivery some move house, some change email only, suppliers are new."""
    def rows(df, key, prefix, name, segment):
        address = F.concat(key, F.lit(" Main St"))
        city = F.when(key % 3 == 0, "Brooklyn").otherwise("Albany")
        mail = F.concat(F.lit("p"), key, F.lit("@mail.org"))
        if second:
            address = F.when(key % 10 == 0, F.concat(key, F.lit(" New Rd"))).otherwise(address)
            mail = F.when(key % 4 == 0, F.concat(F.lit("new"), key, F.lit("@mail.org"))).otherwise(mail)
        return df.select(
            F.concat(F.lit(prefix), key).alias("patron_id"), F.lit("Ann").alias("first_name"), name.alias("last_name"), mail.alias("email"), F.lit("555").alias("phone"),
            address.alias("address_line1"), city.alias("city"), F.lit("NY").alias("state"), F.when(key % 5 != 0, "10001").alias("postal_code"), F.lit("USA").alias("country"),
            segment.alias("patron_type"), (key % 2 == 0).alias("email_opt_in"), F.lit("tessitura").alias("source_systems"), F.lit("1995-01-01").cast("date").alias("first_seen_date"))

    known = rows(t.customer, F.col("c_custkey"), "C", F.col("c_name"), F.col("c_mktsegment"))
    if not second:
        return known
    return known.unionByName(rows(t.supplier, F.col("s_suppkey"), "S", F.col("s_name"), F.lit("SUPPLIER")))


def scd2(t: Showcase):
    empty = t.literal([], PATRON_DDL)
    first = dimensions.scd2_patron(empty, person_rows(t, False), "2020-01-01 00:00:00")
    return dimensions.scd2_patron(first, person_rows(t, True), "2021-06-01 00:00:00")


@query("scd2_patron", """
    WITH c AS (SELECT *, row_number() OVER (ORDER BY 'C' || c_custkey) AS k, c_custkey % 10 = 0 AS moved, CASE WHEN c_custkey % 4 = 0 THEN 'new' ELSE 'p' END || c_custkey || '@mail.org' AS mail FROM customer),
    added AS (SELECT 'C' || c_custkey AS patron_id, c_custkey AS id, c_custkey || ' New Rd' AS address_line1, mail AS email, '2021-06-01' AS since FROM c WHERE moved
              UNION ALL SELECT 'S' || s_suppkey, s_suppkey, s_suppkey || CASE WHEN s_suppkey % 10 = 0 THEN ' New Rd' ELSE ' Main St' END,
                               CASE WHEN s_suppkey % 4 = 0 THEN 'new' ELSE 'p' END || s_suppkey || '@mail.org', '1900-01-01' FROM supplier)
    SELECT k AS patron_key, 'C' || c_custkey AS patron_id, c_custkey || ' Main St' AS address_line1, mail AS email, CASE WHEN c_custkey % 3 = 0 THEN 'NYC' ELSE 'NY Metro' END AS region,
           '1900-01-01' AS since, CASE WHEN moved THEN '2021-06-01' ELSE '9999-12-31' END AS until, NOT moved AS is_current FROM c
    UNION ALL SELECT (SELECT max(k) FROM c) + row_number() OVER (ORDER BY patron_id), patron_id, address_line1, email, CASE WHEN id % 3 = 0 THEN 'NYC' ELSE 'NY Metro' END, since, '9999-12-31', true FROM added
    UNION ALL SELECT -1, 'N/A', NULL, NULL, 'Unknown', '1900-01-01', '9999-12-31', true""")
def scd2_patron(t: Showcase):
    return scd2(t).select("patron_key", "patron_id", "address_line1", "email", "region", F.to_date("valid_from").cast("string").alias("since"),
                          F.to_date("valid_to").cast("string").alias("until"), "is_current")


# ---------------------------------------------------------------- dimensions

def dim_sql(existing: str, source: str, business_id: str, key: str, attributes: list[str], watched: list[str], unknown: str, insert: dict[str, str] | None = None) -> str:
    """Update watched changes, insert unseen members, ensure the unknown one."""
    moved = " OR ".join(f"e.{w} IS DISTINCT FROM s.{w}" for w in watched) or "false"
    shown = "".join(f", CASE WHEN s.{business_id} IS NOT NULL AND ({moved}) THEN s.{a} ELSE e.{a} END AS {a}" for a in attributes)
    new = "".join(f", {(insert or {}).get(a, a)}" for a in attributes)
    return f"""WITH e AS ({existing}), s AS ({source})
      SELECT e.{key}, e.{business_id}{shown} FROM e LEFT JOIN s USING ({business_id})
      UNION ALL SELECT (SELECT coalesce(max({key}), 0) FROM e WHERE {key} > 0) + row_number() OVER (ORDER BY {business_id}), {business_id}{new}
                FROM s WHERE {business_id} NOT IN (SELECT {business_id} FROM e)
      UNION ALL SELECT {unknown}"""


@query("dim_venue", dim_sql("SELECT n_nationkey + 1 AS venue_key, 'V' || n_nationkey AS venue_id, n_name AS venue_name, n_nationkey * 100 AS capacity FROM nation",
                            "SELECT 'V' || n_nationkey AS venue_id, n_name AS venue_name, CASE WHEN n_regionkey = 0 THEN n_nationkey * 100 + 5 ELSE n_nationkey * 100 END AS capacity FROM nation UNION ALL SELECT 'W' || r_regionkey, r_name, NULL FROM region",
                            "venue_id", "venue_key", ["venue_name", "capacity"], ["venue_name", "capacity"], "-1, 'N/A', 'Unknown', NULL"))
def dim_venue(t: Showcase):
    k = F.col("n_nationkey")
    existing = t.nation.select((k + 1).alias("venue_key"), F.concat(F.lit("V"), k).alias("venue_id"), F.col("n_name").alias("venue_name"), (k * 100).alias("capacity"))
    source = t.nation.select(F.concat(F.lit("V"), k).alias("venue_id"), F.col("n_name").alias("venue_name"), F.when(F.col("n_regionkey") == 0, k * 100 + 5).otherwise(k * 100).alias("capacity"))
    halls = t.region.select(F.concat(F.lit("W"), "r_regionkey").alias("venue_id"), F.col("r_name").alias("venue_name"), F.lit(None).cast("int").alias("capacity"))
    return dimensions.dim_venue(source.unionByName(halls), existing)


PERF_ATTR = ["title", "series", "season_name", "fiscal_year", "venue_id", "venue_name", "performance_date_key", "day_part", "capacity", "status"]
PERF_SOURCE = f"""SELECT performance_id, title, CASE WHEN genre = 'Brand#1' THEN 'RELABELLED' ELSE series END AS series, 'Season ' || fiscal_year AS season_name, fiscal_year, venue_id, venue_name, performance_date_key,
    CASE WHEN hour(performance_datetime) < 17 THEN 'Matinee' ELSE 'Evening' END AS day_part, capacity, CASE WHEN capacity > 1200 THEN 'Rescheduled' ELSE status END AS status FROM performance
    UNION ALL SELECT 'N' || s_suppkey, s_name, 'NEW', NULL, NULL, 'V9', NULL, 19990101, 'Evening', 100, 'Scheduled' FROM supplier"""


@query("dim_performance", dim_sql(f"SELECT performance_key, performance_id, {', '.join(PERF_ATTR)} FROM performance", PERF_SOURCE, "performance_id", "performance_key", PERF_ATTR, ["status", "capacity", "title"],
                                  "-1, 'N/A', 'Unknown performance', NULL, NULL, NULL, NULL, NULL, -1, NULL, 0, NULL"), ["performance"])
def dim_performance(t: Showcase):
    shows = t.performance
    existing = shows.select("performance_key", "performance_id", *PERF_ATTR, "performance_datetime", F.concat(F.lit("S"), "fiscal_year").alias("season_id"), "genre")
    source = shows.select("performance_id", "title", F.when(F.col("genre") == "Brand#1", "RELABELLED").otherwise(F.col("series")).alias("series"), "genre", F.concat(F.lit("S"), "fiscal_year").alias("season_id"), "venue_id",
                          "performance_datetime", "capacity", F.when(F.col("capacity") > 1200, "Rescheduled").otherwise(F.col("status")).alias("status"))
    new = t.supplier.select(F.concat(F.lit("N"), "s_suppkey").alias("performance_id"), F.col("s_name").alias("title"), F.lit("NEW").alias("series"), F.lit(None).cast("string").alias("genre"), F.lit("S0").alias("season_id"),
                            F.lit("V9").alias("venue_id"), F.lit("1999-01-01 20:00:00").cast("timestamp_ntz").alias("performance_datetime"), F.lit(100).alias("capacity"), F.lit("Scheduled").alias("status"))
    season = shows.select(F.concat(F.lit("S"), "fiscal_year").alias("season_id"), "season_name", "fiscal_year").distinct()
    venues = shows.select("venue_id", "venue_name").distinct()
    return dimensions.dim_performance(source.unionByName(new), season, venues, existing).select("performance_key", "performance_id", *PERF_ATTR)


@query("dim_channel", dim_sql("SELECT r_regionkey + 1 AS channel_key, r_name AS channel_name FROM region", "SELECT DISTINCT o_orderpriority AS channel_name FROM orders WHERE o_orderpriority <> '3-MEDIUM'", "channel_name", "channel_key", [], [], "-1, 'Unknown'"))
def dim_channel(t: Showcase):
    existing = t.region.select((F.col("r_regionkey") + 1).alias("channel_key"), F.col("r_name").alias("channel_name"))
    orders = t.orders.select(F.nullif(F.col("o_orderpriority"), F.lit("3-MEDIUM")).alias("channel"))
    return dimensions.dim_channel(orders, existing)


@query("dim_campaign", dim_sql("SELECT campaign_key, campaign_id, campaign_name, 'Annual' AS campaign_type, goal_amount FROM campaigns",
                               "SELECT campaign_id, campaign_name, 'Capital' AS campaign_type, CASE WHEN campaign_key % 2 = 0 THEN goal_amount + 1 ELSE goal_amount END AS goal_amount FROM campaigns UNION ALL SELECT 'X' || n_nationkey, n_name, 'New', 100 FROM nation",
                               "campaign_id", "campaign_key", ["campaign_name", "campaign_type", "goal_amount"], ["goal_amount", "campaign_name"], "-1, 'N/A', 'Unknown campaign', 'Unknown', NULL"), ["campaigns"], money="goal_amount")
def dim_campaign(t: Showcase):
    existing = t.campaigns.select("campaign_key", "campaign_id", "campaign_name", F.lit("Annual").alias("campaign_type"), "goal_amount")
    goal = dec(F.when(F.col("campaign_key") % 2 == 0, F.col("goal_amount") + 1).otherwise(F.col("goal_amount")))
    source = t.campaigns.select("campaign_id", "campaign_name", F.lit("Capital").alias("campaign_type"), goal.alias("goal_amount"))
    new = t.nation.select(F.concat(F.lit("X"), "n_nationkey").alias("campaign_id"), F.col("n_name").alias("campaign_name"), F.lit("New").alias("campaign_type"), dec(F.lit(100)).alias("goal_amount"))
    return dimensions.dim_campaign(source.unionByName(new), existing)


@query("dim_fund", """
    WITH e AS (SELECT r_regionkey + 1 AS fund_key, 'F' || r_regionkey AS fund_id, r_name AS fund_name FROM region), s AS (SELECT 'F' || n_nationkey AS fund_id, n_name AS fund_name FROM nation),
    a AS (SELECT * FROM e UNION ALL SELECT (SELECT max(fund_key) FROM e) + row_number() OVER (ORDER BY fund_id), fund_id, fund_name FROM s WHERE fund_id NOT IN (SELECT fund_id FROM e) UNION ALL SELECT -1, 'N/A', 'Unknown fund')
    SELECT a.*, x.code AS ledger_fund_code FROM a LEFT JOIN (SELECT 'F' || s_nationkey AS fund_id, max('L' || s_nationkey) AS code FROM supplier GROUP BY 1) x USING (fund_id)""")
def dim_fund(t: Showcase):
    existing = t.region.select((F.col("r_regionkey") + 1).alias("fund_key"), F.concat(F.lit("F"), "r_regionkey").alias("fund_id"), F.col("r_name").alias("fund_name"), F.lit(None).cast("string").alias("ledger_fund_code"))
    source = t.nation.select(F.concat(F.lit("F"), "n_nationkey").alias("fund_id"), F.col("n_name").alias("fund_name"))
    crosswalk = t.supplier.select(F.concat(F.lit("F"), "s_nationkey").alias("source_fund_id"), F.concat(F.lit("L"), "s_nationkey").alias("fund_code"))
    return dimensions.dim_fund(source, crosswalk, existing)


@query("crosswalk_update", "SELECT fund_key, fund_id, coalesce(x.code, old_code) AS ledger_fund_code FROM (SELECT n_nationkey AS fund_key, 'F' || n_nationkey AS fund_id, CASE WHEN n_regionkey = 1 THEN 'OLD' END AS old_code FROM nation) LEFT JOIN (SELECT 'F' || s_nationkey AS fund_id, max('L' || s_nationkey) AS code FROM supplier WHERE s_acctbal > 0 GROUP BY 1) x USING (fund_id)")
def crosswalk_update(t: Showcase):
    dim = t.nation.select(F.col("n_nationkey").alias("fund_key"), F.concat(F.lit("F"), "n_nationkey").alias("fund_id"), F.when(F.col("n_regionkey") == 1, "OLD").alias("ledger_fund_code"))
    crosswalk = t.supplier.where(F.col("s_acctbal") > 0).select(F.concat(F.lit("F"), "s_nationkey").alias("source_fund_id"), F.concat(F.lit("L"), "s_nationkey").alias("fund_code"))
    return changes.crosswalk_update(dim, crosswalk)


ACCT_ATTR = ["account_name", "account_type", "account_group"]


@query("dim_account", dim_sql("SELECT account_key, account_code, account_name, account_type, account_group FROM (SELECT row_number() OVER (ORDER BY p_brand) AS account_key, p_brand AS account_code, 'Account ' || p_brand AS account_name, 'Revenue' AS account_type, 'Earned' AS account_group FROM (SELECT DISTINCT p_brand FROM part))",
                              "SELECT DISTINCT p_brand AS account_code, CASE WHEN p_brand IN ('Brand#3', 'Brand#7') THEN 'Renamed' ELSE 'Account ' || p_brand END AS account_name, 'Expense' AS account_type, 'Earned' AS account_group FROM part UNION ALL SELECT DISTINCT p_type, p_type, 'Revenue', 'New' FROM part",
                              "account_code", "account_key", ACCT_ATTR, ["account_name", "account_group"], "-1, 'N/A', 'Unknown account', 'Unknown', 'Unknown'"), whole="account_key")
def dim_account(t: Showcase):
    brand = F.col("p_brand")
    brands = t.part.select(brand).distinct()
    existing = dimensions.number_in_order(brands, "p_brand", "account_key").select("account_key", brand.alias("account_code"), F.concat(F.lit("Account "), brand).alias("account_name"), F.lit("Revenue").alias("account_type"), F.lit("Earned").alias("account_group"))
    renamed = F.when(brand.isin("Brand#3", "Brand#7"), "Renamed").otherwise(F.concat(F.lit("Account "), brand))
    source = brands.select(brand.alias("account_code"), renamed.alias("account_name"), F.lit("Expense").alias("account_type"), F.lit("Earned").alias("account_group"))
    new = t.part.select("p_type").distinct().select(F.col("p_type").alias("account_code"), F.col("p_type").alias("account_name"), F.lit("Revenue").alias("account_type"), F.lit("New").alias("account_group"))
    return dimensions.dim_account(source.unionByName(new), existing)


@query("dim_department", dim_sql("SELECT n_nationkey + 1 AS department_key, n_name AS department_code, 'Dept ' || n_regionkey AS department_name FROM nation",
                                 "SELECT n_name AS department_code, CASE WHEN n_regionkey = 2 THEN 'Dept two' ELSE 'Dept ' || n_regionkey END AS department_name FROM nation UNION ALL SELECT DISTINCT c_mktsegment, lower(c_mktsegment) FROM customer",
                                 "department_code", "department_key", ["department_name"], ["department_name"], "-1, 'N/A', 'Unknown department'"))
def dim_department(t: Showcase):
    existing = t.nation.select((F.col("n_nationkey") + 1).alias("department_key"), F.col("n_name").alias("department_code"), F.concat(F.lit("Dept "), "n_regionkey").alias("department_name"))
    source = t.nation.select(F.col("n_name").alias("department_code"), F.when(F.col("n_regionkey") == 2, "Dept two").otherwise(F.concat(F.lit("Dept "), "n_regionkey")).alias("department_name"))
    new = t.customer.select(F.col("c_mktsegment").alias("department_code"), F.lower("c_mktsegment").alias("department_name")).distinct()
    return dimensions.dim_department(source.unionByName(new), existing)


@query("dim_room", dim_sql("SELECT room_key, room_id, room_name, room_type, 0 AS venue_key, 100 AS capacity FROM rooms",
                           "SELECT room_id, room_name, 'Rebuilt' AS room_type, coalesce(CASE WHEN room_key < 4 THEN room_key + 1 END, -1) AS venue_key, CASE WHEN room_key % 2 = 0 THEN 120 ELSE 100 END AS capacity FROM rooms UNION ALL SELECT 'Z' || n_nationkey, n_name, 'Hall', coalesce(CASE WHEN n_nationkey BETWEEN 1 AND 3 THEN n_nationkey + 1 END, -1), 50 FROM nation",
                           "room_id", "room_key", ["room_name", "room_type", "venue_key", "capacity"], ["room_name", "capacity"], "-1, 'N/A', 'Unknown room', 'Unknown', -1, NULL"), ["rooms"], whole="venue_key")
def dim_room(t: Showcase):
    existing = t.rooms.select("room_key", "room_id", "room_name", "room_type", F.lit(0).cast("bigint").alias("venue_key"), F.lit(100).alias("capacity"), F.lit(None).cast("decimal(10,2)").alias("hourly_rate"))
    source = t.rooms.select("room_id", "room_name", F.lit("Rebuilt").alias("room_type"), F.col("room_key").alias("venue_id"), F.when(F.col("room_key") % 2 == 0, 120).otherwise(100).alias("capacity"))
    new = t.nation.select(F.concat(F.lit("Z"), "n_nationkey").alias("room_id"), F.col("n_name").alias("room_name"), F.lit("Hall").alias("room_type"), F.col("n_nationkey").cast("bigint").alias("venue_id"), F.lit(50).alias("capacity"))
    rows = source.unionByName(new).withColumn("hourly_rate", F.lit(None).cast("decimal(10,2)"))
    venues = t.nation.where(F.col("n_nationkey").between(1, 3)).select(F.col("n_nationkey").cast("bigint").alias("venue_id"), (F.col("n_nationkey") + 1).cast("bigint").alias("venue_key"))
    return dimensions.dim_room(rows, venues, existing).drop("hourly_rate")


EVENT_ATTR = ["event_name", "event_type", "client_name", "status", "event_date_key", "performance_key", "is_linked"]


@query("dim_event", dim_sql(f"SELECT event_key, event_id, event_name, event_type, client_name, status, {dkey('event_date')} AS event_date_key, -1 AS performance_key, false AS is_linked FROM venue_events",
                            f"""SELECT event_id, event_name, event_type, client_name || '!' AS client_name, CASE WHEN event_key % 9 = 0 THEN 'Cancelled' ELSE venue_events.status END AS status, {dkey('event_date')} AS event_date_key,
                                coalesce(p.performance_key, -1) AS performance_key, p.performance_key IS NOT NULL AS is_linked FROM venue_events LEFT JOIN performance p ON p.performance_id = 'P' || CASE WHEN event_key % 4 = 0 THEN event_key END
                                UNION ALL SELECT 'NEW' || r_regionkey, r_name, 'Concert', NULL, 'Tentative', -1, -1, false FROM region""",
                            "event_id", "event_key", EVENT_ATTR, ["status", "event_date_key", "performance_key", "event_name"], "-1, 'N/A', 'Unknown event', 'Unknown', NULL, NULL, -1, -1, false"), ["venue_events", "performance"])
def dim_event(t: Showcase):
    from ..functions import date_key
    existing = t.venue_events.select("event_key", "event_id", "event_name", "event_type", "client_name", "status", date_key("event_date").alias("event_date_key"), F.lit(-1).cast("bigint").alias("performance_key"), F.lit(False).alias("is_linked"))
    k = F.col("event_key")
    source = t.venue_events.select("event_id", "event_name", "event_type", F.concat("client_name", F.lit("!")).alias("client_name"), F.when(k % 9 == 0, "Cancelled").otherwise(F.col("status")).alias("status"), "event_date",
                                   F.when(k % 4 == 0, F.concat(F.lit("P"), k)).alias("performance_id"))
    null = F.lit(None)
    new = t.region.select(F.concat(F.lit("NEW"), "r_regionkey").alias("event_id"), F.col("r_name").alias("event_name"), F.lit("Concert").alias("event_type"), null.cast("string").alias("client_name"), F.lit("Tentative").alias("status"),
                          null.cast("date").alias("event_date"), null.cast("string").alias("performance_id"))
    return dimensions.dim_event(source.unionByName(new), t.performance, existing)


@query("dim_program", "WITH e AS (SELECT r_regionkey + 1 AS k, r_name AS id FROM region), s AS (SELECT n_name AS id, 'T' || n_regionkey AS ty FROM nation) SELECT k AS program_key, id AS program_id, 'old' AS program_name, NULL AS program_type FROM e UNION ALL SELECT 5 + row_number() OVER (ORDER BY id), id, 'new', ty FROM s UNION ALL SELECT -1, 'N/A', 'Unknown program', 'Unknown'")
def dim_program(t: Showcase):
    existing = t.region.select((F.col("r_regionkey") + 1).alias("program_key"), F.col("r_name").alias("program_id"), F.lit("old").alias("program_name"), F.lit(None).cast("string").alias("program_type"))
    source = t.nation.select(F.col("n_name").alias("program_id"), F.lit("new").alias("program_name"), F.concat(F.lit("T"), "n_regionkey").alias("program_type"))
    again = t.region.select(F.col("r_name").alias("program_id"), F.lit("changed").alias("program_name"), F.lit("x").alias("program_type"))
    return dimensions.dim_program(source.unionByName(again), existing)


@query("dim_school", "SELECT school_key, school_id, borough, is_title_i, CAST(NULL AS VARCHAR) AS school_name FROM schools WHERE school_key > 0 UNION ALL SELECT (SELECT max(school_key) FROM schools) + row_number() OVER (ORDER BY n_name), n_name, NULL, n_regionkey = 1, n_name FROM nation UNION ALL SELECT -1, 'N/A', NULL, NULL, 'Community / not school-based'", ["schools"])
def dim_school(t: Showcase):
    existing = t.schools.where(F.col("school_key") > 0).withColumn("school_name", F.lit(None).cast("string"))
    source = t.nation.select(F.col("n_name").alias("school_id"), F.lit(None).cast("string").alias("borough"), (F.col("n_regionkey") == 1).alias("is_title_i"), F.col("n_name").alias("school_name"))
    return dimensions.dim_school(source, existing)


EMAIL_ATTR = ["campaign_name", "series_promoted", "send_date_key"]


@query("dim_email_campaign", dim_sql("SELECT email_campaign_key, email_campaign_id, campaign_name, series_promoted, send_date_key FROM email_campaigns",
                                     "SELECT email_campaign_id, CASE WHEN email_campaign_key % 3 = 0 THEN 'Renamed' ELSE campaign_name END AS campaign_name, '' AS series_promoted, send_date_key FROM email_campaigns UNION ALL SELECT 'R' || r_regionkey, r_name, CASE WHEN r_regionkey = 0 THEN '' ELSE 'PROMO' END, 20240115 FROM region",
                                     "email_campaign_id", "email_campaign_key", EMAIL_ATTR, ["campaign_name"], "-1, 'N/A', 'Unknown campaign', NULL, -1", {"series_promoted": "nullif(series_promoted, '')"}), ["email_campaigns"])
def dim_email_campaign(t: Showcase):
    existing = t.email_campaigns.select("email_campaign_key", "email_campaign_id", "campaign_name", "series_promoted", "send_datetime", "send_date_key")
    source = t.email_campaigns.select("email_campaign_id", F.when(F.col("email_campaign_key") % 3 == 0, "Renamed").otherwise(F.col("campaign_name")).alias("campaign_name"), F.lit("").alias("series_promoted"), "send_datetime")
    new = t.region.select(F.concat(F.lit("R"), "r_regionkey").alias("email_campaign_id"), F.col("r_name").alias("campaign_name"), F.when(F.col("r_regionkey") == 0, "").otherwise("PROMO").alias("series_promoted"),
                          F.lit("2024-01-15 09:00:00").cast("timestamp_ntz").alias("send_datetime"))
    return dimensions.dim_email_campaign(source.unionByName(new), existing).drop("send_datetime")


@query("dim_source_module", "SELECT m.*, coalesce(n, 0) AS postings FROM modules m LEFT JOIN (SELECT source_module, count(*) AS n FROM journal_raw GROUP BY 1) USING (source_module)", ["modules", "journal_raw"])
def dim_source_module(t: Showcase):
    posted = t.journal.groupBy("source_module").agg(F.count(F.lit(1)).alias("postings"))
    return joins.dim_left_fact(dimensions.dim_source_module(t.spark), posted, "source_module").withColumn("postings", F.coalesce("postings", F.lit(0)))


@query("update_changed_then_insert", dim_sql("SELECT c_custkey + 1 AS member_key, c_name AS member_id, c_mktsegment AS segment, c_nationkey AS nation FROM customer",
                                             "SELECT c_name AS member_id, CASE WHEN c_custkey % 10 = 0 THEN 'MOVED' ELSE c_mktsegment END AS segment, c_nationkey + 100 AS nation FROM customer UNION ALL SELECT s_name, 'SUPPLIER', s_nationkey FROM supplier",
                                             "member_id", "member_key", ["segment", "nation"], ["segment"], "-1, 'N/A', NULL, NULL"))
def update_changed_then_insert(t: Showcase):
    existing = t.customer.select((F.col("c_custkey") + 1).alias("member_key"), F.col("c_name").alias("member_id"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"))
    source = t.customer.select(F.col("c_name").alias("member_id"), F.when(F.col("c_custkey") % 10 == 0, "MOVED").otherwise(F.col("c_mktsegment")).alias("segment"), (F.col("c_nationkey") + 100).alias("nation"))
    new = t.supplier.select(F.col("s_name").alias("member_id"), F.lit("SUPPLIER").alias("segment"), F.col("s_nationkey").alias("nation"))
    return changes.update_changed_then_insert(existing, source.unionByName(new), "member_id", "member_key", ["segment"], unknown={"member_id": "N/A"})


@query("insert_only_dim", "SELECT n_nationkey + 1 AS member_key, n_name AS member_id, 'old' AS label FROM nation UNION ALL SELECT 25 + row_number() OVER (ORDER BY s_name), s_name, 'new' FROM supplier")
def insert_only_dim(t: Showcase):
    existing = t.nation.select((F.col("n_nationkey") + 1).alias("member_key"), F.col("n_name").alias("member_id"), F.lit("old").alias("label"))
    source = t.nation.select(F.col("n_name").alias("member_id"), F.lit("new").alias("label")).unionByName(t.supplier.select(F.col("s_name").alias("member_id"), F.lit("new").alias("label")))
    return changes.insert_only_dim(existing, source, "member_id", "member_key")
