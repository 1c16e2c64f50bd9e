"""Aggregates, windows, sorts, limits and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as fn
from ..functions import fiscal_year, month_start
from ..operators import aggregate
from ..plans import access, row_policies
from .registry import query
from .sql import fy, money, mstart
from .tables import Showcase, dec

SUM = F.sum


@query("grouped", f"SELECT l_returnflag, l_linestatus, sum({money('l_extendedprice')}) AS amount, count(*) AS lines, min(l_quantity) AS low, max(l_quantity) AS high FROM lineitem GROUP BY 1, 2", money="amount")
def grouped(t: Showcase):
    return aggregate.grouped(t.lineitem, ["l_returnflag", "l_linestatus"], amount=F.sum(dec("l_extendedprice")), lines=F.count(F.lit(1)), low=F.min("l_quantity"), high=F.max("l_quantity"))


@query("conditional_agg", f"SELECT o_orderpriority, sum(CASE WHEN o_orderstatus = 'F' THEN {money('o_totalprice')} ELSE 0 END) AS finished, count(*) FILTER (o_orderstatus = 'O') AS open_orders, max(CASE WHEN o_totalprice > 499000 THEN 1 ELSE 0 END) AS any_large FROM orders GROUP BY 1", money="finished")
def conditional_agg(t: Showcase):
    return aggregate.grouped(t.orders, ["o_orderpriority"], finished=fn.conditional_sum(dec("o_totalprice"), F.col("o_orderstatus") == "F"),
                             open_orders=fn.conditional_count(F.col("o_orderstatus") == "O"), any_large=F.max(F.when(F.col("o_totalprice") > 499000, 1).otherwise(0)))


@query("count_distinct", "SELECT o_orderpriority, count(DISTINCT o_custkey) AS buyers, count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_custkey END) AS finished_buyers FROM orders GROUP BY 1")
def count_distinct(t: Showcase):
    return aggregate.grouped(t.orders, ["o_orderpriority"], buyers=fn.distinct_when("o_custkey"), finished_buyers=fn.distinct_when("o_custkey", F.col("o_orderstatus") == "F"))


@query("distinct_rows", f"SELECT DISTINCT o_orderpriority, {fy('o_orderdate')} AS fiscal_year FROM orders")
def distinct_rows(t: Showcase):
    return aggregate.distinct_rows(t.orders.withColumn("fiscal_year", fiscal_year("o_orderdate")), ["o_orderpriority", "fiscal_year"])


@query("having", "SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def having(t: Showcase):
    return aggregate.having(t.lineitem, ["l_orderkey", "l_linenumber"], F.count(F.lit(1)) > 1)


@query("safe_ratio", f"SELECT c_nationkey, c_mktsegment, CAST(sum({money('c_acctbal')}) AS DOUBLE) / nullif(count(*) FILTER (c_acctbal > 9500), 0) AS per_rich FROM customer GROUP BY 1, 2", ratio="per_rich")
def safe_ratio(t: Showcase):
    folded = aggregate.grouped(t.customer, ["c_nationkey", "c_mktsegment"], total=F.sum(dec("c_acctbal")), rich=F.count_if(F.col("c_acctbal") > 9500))
    return folded.select("c_nationkey", "c_mktsegment", fn.safe_ratio("total", "rich").alias("per_rich"))


@query("ordered_string_agg", "SELECT r_name, string_agg(n_name, ' · ' ORDER BY n_name) AS nations FROM nation JOIN region ON r_regionkey = n_regionkey GROUP BY 1")
def ordered_string_agg(t: Showcase):
    joined = t.nation.join(t.region, F.col("r_regionkey") == F.col("n_regionkey"))
    return joined.groupBy("r_name").agg(fn.ordered_string_agg("n_name", "n_name").alias("nations"))


@query("collect_set_rollup", "SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS priorities FROM orders GROUP BY 1")
def collect_set_rollup(t: Showcase):
    return t.orders.groupBy("o_custkey").agg(F.array_join(F.sort_array(F.collect_set("o_orderpriority")), ",").alias("priorities"))


EXPECTED = {"expected": "SELECT 'shop.' || event_type AS entity, CAST(CAST(ts AS DATE) AS VARCHAR) AS load_date, count(*) + CASE WHEN event_type = 'error' AND day(CAST(ts AS DATE)) = 3 THEN 1 ELSE 0 END AS expected_rows FROM events GROUP BY 1, 2, event_type, CAST(ts AS DATE)",
            "loaded": "SELECT 'shop.' || event_type AS entity, CAST(CAST(ts AS DATE) AS VARCHAR) AS load_date, count(*) AS loaded_rows FROM events WHERE NOT (event_type = 'view' AND day(ts) = 5) GROUP BY 1, 2",
            "compared": "SELECT e.*, loaded_rows, CASE WHEN loaded_rows IS NULL THEN 'NOT_LOADED' WHEN loaded_rows = expected_rows THEN 'OK' ELSE 'MISMATCH' END AS status FROM expected e LEFT JOIN loaded USING (entity, load_date)"}


def reconciled(t: Showcase):
    day = F.to_date("ts")
    counted = t.events.groupBy(F.concat(F.lit("shop."), "event_type").alias("entity"), day.cast("string").alias("load_date")).agg(F.count(F.lit(1)).alias("n"))
    planted = F.when((F.col("entity") == "shop.error") & F.col("load_date").endswith("-03"), 1).otherwise(0)
    expected = counted.select("entity", "load_date", (F.col("n") + planted).alias("expected_rows"))
    log = counted.where(~((F.col("entity") == "shop.view") & F.col("load_date").endswith("-05"))).select("entity", "load_date", F.col("n").alias("rows"))
    return aggregate.rowcount_reconcile(expected, log)


@query("rowcount_reconcile", "SELECT * FROM compared", local=EXPECTED)
def rowcount_reconcile(t: Showcase):
    return reconciled(t)


@query("status_histogram", "SELECT status, count(*) AS n FROM compared GROUP BY 1", local=EXPECTED)
def status_histogram(t: Showcase):
    return aggregate.status_histogram(reconciled(t))


@query("subtotals", "SELECT account_type, account_group, account_code, 3 - (grouping(account_type) + grouping(account_group) + grouping(account_code)) AS level, sum(net_amount) AS net, count(*) AS lines FROM gl GROUP BY ROLLUP (account_type, account_group, account_code)", ["gl"], money="net", whole="level")
def subtotals(t: Showcase):
    return aggregate.subtotals(t.gl_star, ["account_type", "account_group", "account_code"], net=F.sum("net_amount"), lines=F.count(F.lit(1)))


STREAMS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("pivot", "SELECT month_start, " + ", ".join(f"""sum(CASE WHEN revenue_stream = '{s}' THEN variance END) AS "{s}" """ for s in STREAMS) + "FROM recon GROUP BY 1", ["recon"], text="month_start")
def pivot(t: Showcase):
    grid = aggregate.pivot_grid(t.recon, ["month_start"], "revenue_stream", STREAMS, F.sum("variance"))
    return grid.select("month_start", *[F.col(f"`{s}`").cast("double").alias(s) for s in STREAMS])


# ---------------------------------------------------------------- windows

@query("row_number_partitioned", "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) AS rn FROM orders) WHERE rn = 1")
def row_number_partitioned(t: Showcase):
    return aggregate.first_per_group(t.orders, ["o_custkey"], [F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey")]).select("o_custkey", "o_orderkey")


@query("window_sum_whole_partition", f"SELECT s.*, sum(spend) OVER (PARTITION BY fiscal_year, l_returnflag) AS total FROM (SELECT {fy('l_shipdate')} AS fiscal_year, l_returnflag, p_brand, sum({money('l_extendedprice')}) AS spend FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2, 3) s", money="spend total")
def window_sum_whole_partition(t: Showcase):
    joined = t.lineitem.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")
    folded = joined.groupBy(fiscal_year("l_shipdate").alias("fiscal_year"), "l_returnflag", "p_brand").agg(F.sum(dec("l_extendedprice")).alias("spend"))
    return folded.withColumn("total", aggregate.window_sum_whole_partition("spend", ["fiscal_year", "l_returnflag"]))


@query("with_partition_total", f"SELECT l_orderkey, l_linenumber, sum({money('l_extendedprice')}) OVER (PARTITION BY l_returnflag, l_linestatus) AS total FROM lineitem", money="total")
def with_partition_total(t: Showcase):
    """Raw lines beside the total of one of a handful of partitions."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", dec("l_extendedprice").alias("price"))
    return aggregate.with_partition_total(lines, "price", ["l_returnflag", "l_linestatus"], "total").select("l_orderkey", "l_linenumber", "total")


@query("running_balance_by_event", "SELECT event_id, sum(CAST(value AS DECIMAL(14,2))) OVER (ORDER BY ts) AS balance FROM events", money="balance")
def running_balance_by_event(t: Showcase):
    """A balance over time stamps, as many as there are rows: a prefix sum in slices."""
    lines = t.events.select("event_id", "ts", dec("value").alias("amount"))
    return aggregate.running_balance(lines, "ts", "amount").select("event_id", "balance")


@query("running_balance", f"SELECT m.*, sum(amount) OVER (ORDER BY month_start RANGE UNBOUNDED PRECEDING) AS balance FROM (SELECT {mstart('o_orderdate')} AS month_start, o_orderpriority, sum({money('o_totalprice')}) AS amount FROM orders GROUP BY 1, 2) m", money="amount balance", text="month_start")
def running_balance(t: Showcase):
    lines = t.orders.groupBy(month_start("o_orderdate").alias("month_start"), "o_orderpriority").agg(F.sum(dec("o_totalprice")).alias("amount"))
    return aggregate.running_balance(lines, "month_start", "amount")


@query("top_n", "SELECT booking_id, hours_booked FROM (SELECT *, rank() OVER (ORDER BY hours_booked DESC) AS r FROM bookings) WHERE r <= 40", ["bookings"], money="hours_booked")
def top_n(t: Showcase):
    return aggregate.top_n(t.bookings, 40, "hours_booked").select("booking_id", "hours_booked")


@query("top_1", "SELECT event_id, user_id FROM events ORDER BY ts DESC, event_id LIMIT 1")
def top_1(t: Showcase):
    return aggregate.top_1(t.events, "ts", ["event_id"]).select("event_id", "user_id")


@query("sort_by_measure", "SELECT c_mktsegment, sum(CAST(c_acctbal AS DECIMAL(14,2))) AS total FROM customer GROUP BY 1 ORDER BY total DESC, c_mktsegment", money="total")
def sort_by_measure(t: Showcase):
    folded = aggregate.grouped(t.customer, ["c_mktsegment"], total=F.sum(dec("c_acctbal")))
    return aggregate.sort_by_measure(folded, "total", "c_mktsegment")


# ---------------------------------------------------------------- sets

@query("union_all", "SELECT o_orderdate::DATE AS day, 'order' AS kind FROM orders UNION ALL SELECT l_shipdate::DATE, 'ship' FROM lineitem UNION ALL SELECT ts::DATE, 'event' FROM events", text="day")
def union_all(t: Showcase):
    return aggregate.union_all([t.orders.select(F.to_date("o_orderdate").alias("day"), F.lit("order").alias("kind")), t.lineitem.select(F.to_date("l_shipdate").alias("day"), F.lit("ship").alias("kind")),
                                t.events.select(F.to_date("ts").alias("day"), F.lit("event").alias("kind"))])


GIVERS = "SELECT o_custkey FROM orders WHERE {fy} = {year}"


def givers(t: Showcase, year: int):
    return t.orders.where(fiscal_year("o_orderdate") == year)


@query("intersect", f"{GIVERS.format(fy=fy('o_orderdate'), year=2000)} INTERSECT {GIVERS.format(fy=fy('o_orderdate'), year=1999)}")
def intersect(t: Showcase):
    return aggregate.intersect_rows(givers(t, 2000), givers(t, 1999), ["o_custkey"])


@query("except", f"{GIVERS.format(fy=fy('o_orderdate'), year=1999)} EXCEPT {GIVERS.format(fy=fy('o_orderdate'), year=2000)}")
def except_(t: Showcase):
    return aggregate.except_rows(givers(t, 1999), givers(t, 2000), ["o_custkey"])


# ---------------------------------------------------------------- access

LISTED = "SELECT s_name AS user_principal_name FROM supplier WHERE s_acctbal > 8000"


def listed(t: Showcase):
    return t.supplier.where(F.col("s_acctbal") > 8000).select(F.col("s_name").alias("user_principal_name"))


for _user in ("Supplier#000000000", "nobody"):
    @query(f"row_filter_anonymous_{'listed' if _user != 'nobody' else 'unlisted'}", f"SELECT gift_id, is_anonymous FROM gifts WHERE NOT is_anonymous OR EXISTS (SELECT 1 FROM listed WHERE user_principal_name = '{_user}')", ["gifts"], {"listed": LISTED})
    def row_filter_anonymous(t: Showcase, user=_user):
        return access.row_filter_anonymous(t.gifts, listed(t), user).select("gift_id", "is_anonymous")


@query("row_filter_venue", "SELECT performance_id FROM performance WHERE venue_id IN (SELECT 'V' || (s_suppkey % 4 + 1) FROM supplier WHERE s_nationkey = 3)", ["performance"])
def row_filter_venue(t: Showcase):
    mapping = t.supplier.select(F.concat(F.lit("user"), "s_nationkey").alias("user_principal_name"), F.concat(F.lit("V"), F.col("s_suppkey") % 4 + 1).alias("venue_id"))
    return access.row_filter_venue(t.performance, mapping, "user3").select("performance_id")


READERS = [("head@house.org", True, False), ("fundraiser@house.org", True, False), ("box.office@house.org", False, False), ("hall.one@house.org", True, True)]


def policies(t: Showcase) -> None:
    """The rules over gifts and shows, for a head of fundraising, a fundraiser, the box office and a hall's manager."""
    readers = t.literal(READERS, "user_principal_name string, sees_gifts boolean, by_venue boolean")
    row_policies.gift_policy(t.gifts, readers, t.literal([("head@house.org",)], "user_principal_name string"))
    mapped = t.performance.where("performance_key % 3 = 0").select(F.lit("hall.one@house.org").alias("user_principal_name"), "venue_id").distinct()
    row_policies.venue_policy(t.performance, readers, mapped)


def seen(t: Showcase, policy: str, readers: list[str], amount: str):
    """What each reader sees of the whole table: rows and a sum; a reader without rows counts 0."""
    policies(t)
    return aggregate.union_all([row_policies.read_as(t.spark, policy, r).agg(F.count(F.lit(1)).alias("rows_seen"), F.sum(amount).alias("total")).select(F.lit(r).alias("reader"), "rows_seen", "total") for r in readers])


def seen_sql(source: str, amount: str, conditions: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{r}' AS reader, count(*) AS rows_seen, sum({amount}) AS total FROM {source} WHERE {c}" for r, c in conditions.items())


@query("row_filter_none", seen_sql("gifts", "amount", {"head@house.org": "true", "stranger@else.org": "false"}), ["gifts"], money="total")
def row_filter_none(t: Showcase):
    """The head of fundraising sees every gift, someone without a role none."""
    return seen(t, "gifts_for", ["head@house.org", "stranger@else.org"], "amount")


@query("row_filter_all", seen_sql("gifts", "amount", {"head@house.org": "true", "box.office@house.org": "false"}), ["gifts"], money="total")
def row_filter_all(t: Showcase):
    """The box office sees no gift."""
    return seen(t, "gifts_for", ["head@house.org", "box.office@house.org"], "amount")


@query("row_policy_anonymous", seen_sql("gifts", "amount", {"head@house.org": "true", "fundraiser@house.org": "NOT is_anonymous", "hall.one@house.org": "NOT is_anonymous"}), ["gifts"], money="total")
def row_policy_anonymous(t: Showcase):
    """Anonymous gifts are for listed readers."""
    return seen(t, "gifts_for", ["head@house.org", "fundraiser@house.org", "hall.one@house.org"], "amount")


@query("row_policy_venue", seen_sql("performance", "capacity", {"head@house.org": "true", "hall.one@house.org": "venue_id IN (SELECT venue_id FROM performance WHERE performance_key % 3 = 0)"}), ["performance"], whole="total")
def row_policy_venue(t: Showcase):
    """A hall's manager sees the shows of the venues mapped to them."""
    return seen(t, "performances_for", ["head@house.org", "hall.one@house.org"], "capacity")


@query("mask_email", "SELECT patron_key, left(email, 1) || 'XXX@XXXX.com' AS email FROM patrons", ["patrons"])
def mask_email(t: Showcase):
    return t.patrons.select("patron_key", fn.mask_email("email").alias("email"))


@query("mask_partial", "SELECT patron_key, 'XXX-XXX-' || right(phone, 4) AS phone FROM patrons", ["patrons"])
def mask_partial(t: Showcase):
    return t.patrons.select("patron_key", fn.mask_partial("phone").alias("phone"))


@query("mask_default", "SELECT patron_key, CASE WHEN email IS NOT NULL THEN 'xxxx' END AS email FROM patrons", ["patrons"])
def mask_default(t: Showcase):
    return t.patrons.select("patron_key", fn.mask_default("email").alias("email"))


@query("unmask", "SELECT patron_key, email, phone, address_line1 FROM patrons", ["patrons"])
def unmask(t: Showcase):
    return access.mask_contacts(t.patrons, "Development").select("patron_key", "email", "phone", "address_line1")


@query("mask_contacts", "SELECT patron_key, left(email, 1) || 'XXX@XXXX.com' AS email, 'XXX-XXX-' || right(phone, 4) AS phone, 'xxxx' AS address_line1 FROM patrons", ["patrons"])
def mask_contacts(t: Showcase):
    return access.mask_contacts(t.patrons, "Audience").select("patron_key", "email", "phone", "address_line1")


@query("permit_columns", "SELECT patron_id, first_seen_date FROM patrons", ["patrons"], text="first_seen_date")
def permit_columns(t: Showcase):
    return access.permit_columns(t.patrons, "patron")


@query("object_hide", "SELECT patron_id, patron_key, full_name, region FROM patrons", ["patrons"])
def object_hide(t: Showcase):
    return access.object_hide(t.patrons).drop("valid_from", "valid_to", "is_current", "first_seen_date")


@query("hash_restricted", "SELECT patron_key, sha256(email) AS email, sha256(phone) AS phone, full_name FROM patrons", ["patrons"])
def hash_restricted(t: Showcase):
    from ..operators.quality import hash_restricted as hashed
    return hashed(t.patrons, ["email", "phone"]).select("patron_key", "email", "phone", "full_name")


@query("fmt_change", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'No prior year' ELSE chr(160) || CASE WHEN o_totalprice - 250000 >= 0 THEN '+' ELSE '-' END || '$' || format('{:,}', CAST(floor(abs(o_totalprice - 250000) / 1000 + 0.5) AS BIGINT)) || 'K'
        || chr(160) || CASE WHEN o_totalprice > 250000 THEN '▲' WHEN o_totalprice < 250000 THEN '▼' ELSE '─' END || chr(160) END AS change FROM orders""")
def fmt_change(t: Showcase):
    comparison = F.when(F.col("o_orderstatus") != "P", F.lit(250000.0))
    return t.orders.select("o_orderkey", fn.fmt_change("o_totalprice", comparison, "money_only").alias("change"))


@query("favourable", "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN -CAST(sign(o_totalprice - 250000) AS INTEGER) END AS direction FROM orders")
def favourable(t: Showcase):
    comparison = F.when(F.col("o_orderstatus") != "P", F.lit(250000.0))
    return t.orders.select("o_orderkey", fn.favourable("o_totalprice", comparison, up_is_good=False).alias("direction"))
