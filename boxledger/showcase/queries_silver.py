"""Cleaning, quality gate, change capture and identity."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import changes, clean, identity, quality
from ..sources import tables
from .quality_rules import LINE_RULES, ORDER_RULES
from .registry import query
from .sql import dkey, money
from .tables import AS_OF, Showcase, dec


def sql_hash(*columns: str) -> str:
    return "sha256(concat_ws('||', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in columns) + "))"


# ---------------------------------------------------------------- cleaning

@query("conform", """
    SELECT TRY_CAST(o_orderkey AS BIGINT) AS order_id, TRY_CAST(CASE WHEN o_orderkey % 10 = 0 THEN 'abc' ELSE CAST(o_totalprice AS VARCHAR) END AS DECIMAL(12,2)) AS amount,
           CASE WHEN o_orderkey % 7 <> 0 THEN lower('Cust' || o_custkey || '@Mail.ORG') END AS email, CAST(o_orderdate AS DATE) AS order_date,
           CAST(NULL AS INTEGER) AS seats, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status, 'b1' AS _batch_id FROM orders""",
       money="amount", text="order_date")
def conform(t: Showcase):
    key = F.col("o_orderkey")
    raw = t.orders.select(
        F.concat(F.lit("  "), key, F.lit(" ")).alias("order_id"),
        F.when(key % 10 == 0, "abc").otherwise(F.col("o_totalprice").cast("string")).alias("amount"),
        F.when(key % 7 == 0, "  ").otherwise(F.concat(F.lit(" Cust"), F.col("o_custkey"), F.lit("@Mail.ORG "))).alias("email"),
        F.to_date("o_orderdate").cast("string").alias("order_date"), F.lit("x").alias("undeclared"),
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus")).alias("status"), F.lit("b1").alias("_batch_id"))
    return clean.conform(raw, {"order_id": "bigint", "amount": "decimal(12,2)", "email": "string", "order_date": "date",
                               "seats": "int", "status": "string"})


@query("add_missing_meta", """SELECT event_id, CAST(ts AS DATE) AS _load_date, CAST(ts AS DATE) AS _ingested_day FROM events""", text="_load_date _ingested_day")
def add_missing_meta(t: Showcase):
    return clean.add_missing_meta(t.events, "ts", AS_OF).select("event_id", "_load_date", F.to_date("_ingested_at").alias("_ingested_day"))


HASHED = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")


@query("with_row_hash", f"SELECT o_orderkey, {sql_hash(*HASHED)} AS _row_hash FROM orders")
def with_row_hash(t: Showcase):
    return clean.with_row_hash(t.orders, HASHED).select("o_orderkey", "_row_hash")


@query("scd_hash", """SELECT c_custkey, upper(sha256(concat_ws('|', c_name, CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END, CAST(c_nationkey AS VARCHAR)))) AS scd_hash
    FROM customer""")
def scd_hash(t: Showcase):
    segment = F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment"))
    return t.customer.select("c_custkey", fn.scd_hash("c_name", segment, "c_nationkey").alias("scd_hash"))


@query("date_key", f"SELECT event_id, {dkey('CASE WHEN event_id % 13 <> 0 THEN ts END')} AS date_key FROM events")
def date_key(t: Showcase):
    return t.events.select("event_id", fn.date_key(F.when(F.col("event_id") % 13 != 0, F.col("ts"))).alias("date_key"))


@query("full_name", "SELECT c_custkey, concat_ws(' ', c_name, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END) AS full_name FROM customer")
def full_name(t: Showcase):
    last = F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment"))
    return t.customer.select("c_custkey", fn.full_name("c_name", last).alias("full_name"))


CITIES = "CASE c_custkey % 4 WHEN 0 THEN 'Brooklyn' WHEN 1 THEN 'Albany' WHEN 2 THEN 'Newark' END"
STATES = "CASE c_custkey % 5 WHEN 0 THEN 'NY' WHEN 1 THEN 'NJ' WHEN 2 THEN 'CA' END"
COUNTRIES = "CASE WHEN c_custkey % 7 <> 0 THEN 'USA' END"


@query("region_bucket", f"""
    SELECT c_custkey, CASE WHEN city IN ('New York', 'Brooklyn', 'Queens', 'Bronx', 'Staten Island') AND state = 'NY' THEN 'NYC' WHEN state IN ('NY', 'NJ', 'CT') THEN 'NY Metro'
                           WHEN country = 'USA' THEN 'Domestic' ELSE 'Unknown' END AS region
    FROM (SELECT c_custkey, {CITIES} AS city, {STATES} AS state, {COUNTRIES} AS country FROM customer)""")
def region_bucket(t: Showcase):
    city, state, country = (F.expr(e) for e in (CITIES, STATES, COUNTRIES))
    return t.customer.select("c_custkey", fn.region_bucket(city, state, country).alias("region"))


@query("day_part", "SELECT event_id, CASE WHEN hour(ts) < 17 THEN 'Matinee' ELSE 'Evening' END AS day_part FROM events")
def day_part(t: Showcase):
    return t.events.select("event_id", fn.day_part("ts").alias("day_part"))


@query("amounts", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, q AS quantity, CAST(q * p AS DECIMAL(14,2)) AS gross_amount, d AS discount_amount, CAST(q * p - d AS DECIMAL(14,2)) AS net_amount
    FROM (SELECT *, coalesce(CASE WHEN l_linenumber <> 3 THEN CAST(l_quantity AS INTEGER) END, 0) AS q, CAST(l_extendedprice AS DECIMAL(12,2)) AS p,
                 coalesce(CASE WHEN l_linenumber <> 4 THEN {money('l_discount')} END, 0) AS d FROM lineitem)""", money="gross_amount discount_amount net_amount")
def amounts(t: Showcase):
    from ..operators.facts import amounts as with_amounts
    raw = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.when(F.col("l_linenumber") != 3, F.col("l_quantity").cast("int")).alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"), F.when(F.col("l_linenumber") != 4, F.col("l_discount")).alias("discount_amount"))
    done = with_amounts(raw)
    return done.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.coalesce("quantity", F.lit(0)).alias("quantity"),
                       "gross_amount", "discount_amount", "net_amount")


@query("signed_ledger_amount", "SELECT account_code, fund_key, sum(net_amount) AS net FROM gl GROUP BY 1, 2", ["gl"], money="net")
def signed_ledger_amount(t: Showcase):
    signed = fn.signed_ledger_amount("debit_amount", "credit_amount")
    return t.journal.groupBy("account_code", "fund_key").agg(F.sum(signed).alias("net"))


@query("hours_booked", "SELECT booking_id, hours_booked FROM bookings", ["bookings"], money="hours_booked")
def hours_booked(t: Showcase):
    return t.bookings.select("booking_id", fn.hours_booked("start_datetime", "end_datetime").alias("hours_booked"))


@query("days_before_event", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) AS days_before FROM lineitem JOIN orders ON o_orderkey = l_orderkey")
def days_before_event(t: Showcase):
    joined = t.lineitem.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey")
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", fn.days_before_event("o_orderdate", "l_shipdate").alias("days_before"))


@query("nullif_blank", "SELECT c_custkey, nullif(CASE WHEN c_nationkey = 3 THEN '' ELSE c_mktsegment END, '') AS segment FROM customer")
def nullif_blank(t: Showcase):
    blanked = F.when(F.col("c_nationkey") == 3, "").otherwise(F.col("c_mktsegment"))
    return t.customer.select("c_custkey", fn.nullif_blank(blanked).alias("segment"))


@query("filter_pending", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate > TIMESTAMP '1999-06-30 00:00:00'")
def filter_pending(t: Showcase):
    return clean.filter_pending(t.orders, "o_orderdate", "1999-06-30 00:00:00").select("o_orderkey", "o_custkey")


# ---------------------------------------------------------------- quality gate

def rule_query(name: str, table: str, key: str, condition: str, build):
    @query(name, f"SELECT {key} FROM {table} WHERE {condition}")
    def run(t: Showcase):
        return build(getattr(t, table)).select(*[k.strip() for k in key.split(",")])
    return run


LINE_KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
rule_query("dq_not_null", "customer", "c_custkey", "nullif(c_mktsegment, 'BUILDING') IS NULL",
           lambda df: df.where(quality.dq_not_null(F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")))))
rule_query("dq_regex", "orders", "o_orderkey", "NOT coalesce(regexp_matches(nullif(o_orderpriority, '1-URGENT'), '^[2-4]-[A-Z]'), false)",
           lambda df: df.where(quality.dq_regex(F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT")), "^[2-4]-[A-Z]")))
rule_query("dq_accepted_values", "lineitem", LINE_KEY, "nullif(l_returnflag, 'N') NOT IN ('A')",
           lambda df: df.where(quality.dq_accepted_values(F.nullif(F.col("l_returnflag"), F.lit("N")), ["A"])))
rule_query("dq_range", "lineitem", LINE_KEY, "nullif(l_quantity, 50) < 5 OR nullif(l_quantity, 50) > 45",
           lambda df: df.where(quality.dq_range(F.nullif(F.col("l_quantity"), F.lit(50.0)), 5, 45)))
rule_query("dq_not_future", "orders", "o_orderkey", "o_orderdate > TIMESTAMP '2000-01-01'",
           lambda df: df.where(quality.dq_not_future("o_orderdate", "2000-01-01 00:00:00")))
rule_query("dq_expression", "lineitem", LINE_KEY, "NOT coalesce(nullif(l_tax, 0) < l_discount, false)",
           lambda df: df.where(quality.dq_expression("nullif(l_tax, 0) < l_discount")))


@query("dq_foreign_key", f"SELECT {LINE_KEY}, l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F') AS _orphan FROM lineitem")
def dq_foreign_key(t: Showcase):
    reference = t.orders.where(F.col("o_orderstatus") != "F")
    flagged = quality.dq_foreign_key(t.lineitem, "l_orderkey", reference, "o_orderkey")
    return flagged.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "_orphan")


FLAGS = {
    "flags": """SELECT *, coalesce(l_quantity < 1 OR l_quantity > 48, false) AS r0, coalesce(l_discount < 0 OR l_discount > 0.09, false) AS r1,
                coalesce(l_returnflag NOT IN ('A', 'N', 'R'), false) AS r2, coalesce(l_linestatus NOT IN ('O'), false) AS r3,
                l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F') AS r4,
                NOT coalesce(l_extendedprice * (1 - l_discount) > 1000, false) AS r6 FROM lineitem"""}


def gate(t: Showcase):
    references = {"shop.orders": t.orders.where(F.col("o_orderstatus") != "F")}
    return quality.apply_dq(t.lineitem, "shop.lineitem", LINE_RULES, restricted=["l_extendedprice"], references=references,
                            run_id="run-1", as_of=AS_OF)


@query("dq_route", f"SELECT {LINE_KEY}, r0 OR r1 OR r2 OR r4 AS quarantined FROM flags", local=FLAGS)
def dq_route(t: Showcase):
    flagged, active = quality.flag_rules(t.lineitem, LINE_RULES, {"shop.orders": t.orders.where(F.col("o_orderstatus") != "F")}, AS_OF)
    valid, bad = quality.dq_route(flagged, active)
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return valid.select(*keys, F.lit(False).alias("quarantined")).unionByName(bad.select(*keys, F.lit(True).alias("quarantined")))


RESULT_LINES = [("range", "l_quantity", "error", "r0"), ("range", "l_discount", "error", "r1"), ("accepted_values", "l_returnflag", "error", "r2"),
                ("accepted_values", "l_linestatus", "warn", "r3"), ("foreign_key", "l_orderkey", "error", "r4"), ("expression", None, "warn", "r6")]
RESULTS_SQL = " UNION ALL ".join(
    f"SELECT 'run-1' AS run_id, 'shop.lineitem' AS entity, '{r}' AS rule, {'NULL' if c is None else repr(c)} AS column_name, '{s}' AS severity, "
    f"count(*) FILTER ({f}) AS failed_rows, count(*) AS total_rows, 1 - count(*) FILTER ({f}) / count(*) AS pass_rate FROM flags" for r, c, s, f in RESULT_LINES)


@query("dq_results", RESULTS_SQL, local=FLAGS, ratio="pass_rate")
def dq_results(t: Showcase):
    return gate(t).results.drop("checked_at")


@query("dq_alerts", f"SELECT * FROM ({RESULTS_SQL}) WHERE severity = 'error' AND failed_rows > 0", local=FLAGS, ratio="pass_rate")
def dq_alerts(t: Showcase):
    return quality.dq_alerts(gate(t).results).drop("checked_at")


@query("apply_dq", f"SELECT {LINE_KEY} FROM flags WHERE NOT (r0 OR r1 OR r2 OR r4)", local=FLAGS)
def apply_dq(t: Showcase):
    return gate(t).valid.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("dq_quarantine", """
    SELECT concat_ws(',', CASE WHEN r0 THEN 'range:l_quantity' END, CASE WHEN r1 THEN 'range:l_discount' END, CASE WHEN r2 THEN 'accepted_values:l_returnflag' END,
                     CASE WHEN r4 THEN 'foreign_key:l_orderkey' END) AS failed_rules,
           l_orderkey, l_linenumber, l_partkey, sha256(CAST(l_extendedprice AS VARCHAR)) AS l_extendedprice FROM flags WHERE r0 OR r1 OR r2 OR r4""", local=FLAGS)
def dq_quarantine(t: Showcase):
    record = F.from_json("record", "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_extendedprice string")
    return gate(t).quarantine.select("failed_rules", record.alias("r")).select("failed_rules", "r.*")


@query("dq_latest", """
    SELECT entity, failed_rows, total_rows FROM (
      SELECT CAST(o_orderdate AS DATE) AS run_day, o_orderpriority AS entity, count(*) FILTER (o_totalprice > 400000) AS failed_rows, count(*) AS total_rows
      FROM orders GROUP BY 1, 2) WHERE run_day = (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)""")
def dq_latest(t: Showcase):
    results = t.orders.groupBy(F.to_date("o_orderdate").alias("checked_at"), F.col("o_orderpriority").alias("entity")).agg(
        F.count_if(F.col("o_totalprice") > 400000).alias("failed_rows"), F.count(F.lit(1)).alias("total_rows"))
    results = results.withColumn("run_id", F.concat(F.lit("run-"), F.col("checked_at")))
    return quality.dq_latest(results).select("entity", "failed_rows", "total_rows")


@query("order_rules", """
    SELECT o_orderkey, o_orderpriority IS NULL OR NOT regexp_matches(o_orderpriority, '^[1-4]-') OR o_orderdate > TIMESTAMP '2000-01-01' AS quarantined FROM orders""")
def order_rules(t: Showcase):
    flagged, active = quality.flag_rules(t.orders, ORDER_RULES, None, "2000-01-01 00:00:00")
    valid, bad = quality.dq_route(flagged, active)
    return valid.select("o_orderkey", F.lit(False).alias("quarantined")).unionByName(bad.select("o_orderkey", F.lit(True).alias("quarantined")))


# ---------------------------------------------------------------- change capture

@query("latest_per_key", f"""
    SELECT * EXCLUDE (rn, l_shipdate), CAST(l_shipdate AS DATE) AS ship_day FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST,
        l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
      FROM lineitem) WHERE rn = 1""", text="ship_day")
def latest_per_key(t: Showcase):
    newest = changes.latest_per_key(t.lineitem, ["l_orderkey", "l_linenumber"], "l_shipdate")
    return newest.withColumn("ship_day", F.to_date("l_shipdate")).drop("l_shipdate")


#: Second delivery of the customers: some segments and balances move, suppliers arrive as new people.
BATCH2 = """
    SELECT c_custkey AS id, c_name AS name, CASE WHEN c_custkey % 10 = 0 THEN 'MOVED' WHEN c_custkey % 25 = 1 THEN NULL ELSE c_mktsegment END AS segment,
           CASE WHEN c_custkey % 7 = 0 THEN CAST(c_acctbal AS DECIMAL(14,2)) + 1 ELSE CAST(c_acctbal AS DECIMAL(14,2)) END AS balance FROM customer
    UNION ALL SELECT s_suppkey + 100000000, s_name, 'SUPPLIER', CAST(s_acctbal AS DECIMAL(14,2)) FROM supplier"""
BATCH1 = "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(c_acctbal AS DECIMAL(14,2)) AS balance FROM customer"
BATCHES = {"t": BATCH1, "s": BATCH2}


def batch1(t: Showcase):
    return t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
                             dec("c_acctbal").alias("balance"))


def batch2(t: Showcase):
    key = F.col("c_custkey")
    segment = F.when(key % 10 == 0, "MOVED").when(key % 25 == 1, F.lit(None)).otherwise(F.col("c_mktsegment"))
    balance = F.when(key % 7 == 0, dec(dec("c_acctbal") + 1)).otherwise(dec("c_acctbal"))
    known = t.customer.select(key.alias("id"), F.col("c_name").alias("name"), segment.alias("segment"), balance.alias("balance"))
    new = t.supplier.select((F.col("s_suppkey") + 100000000).alias("id"), F.col("s_name").alias("name"), F.lit("SUPPLIER").alias("segment"),
                            dec("s_acctbal").alias("balance"))
    return known.unionByName(new)


@query("upsert", """
    SELECT t.id, t.name, CASE WHEN d THEN s.segment ELSE t.segment END AS segment, CASE WHEN d THEN s.balance ELSE t.balance END AS balance, CASE WHEN d THEN 2 ELSE 1 END AS batch
    FROM t LEFT JOIN s USING (id), LATERAL (SELECT s.segment IS DISTINCT FROM t.segment OR s.balance <> t.balance AS d)
    UNION ALL SELECT id, name, segment, balance, 2 FROM s WHERE id NOT IN (SELECT id FROM t)""", local=BATCHES, money="balance")
def upsert(t: Showcase):
    columns = ["id", "name", "segment", "balance"]
    target = clean.with_row_hash(batch1(t), columns).withColumn("batch", F.lit(1))
    source = clean.with_row_hash(batch2(t), columns).withColumn("batch", F.lit(2))
    return changes.upsert(target, source, ["id"]).drop("_row_hash")


@query("upsert_newest_wins", """
    SELECT t.id, t.name, CASE WHEN t.segment = 'BUILDING' THEN t.segment ELSE s.segment END AS segment
    FROM t JOIN s USING (id) UNION ALL SELECT id, name, segment FROM s WHERE id NOT IN (SELECT id FROM t)""", local=BATCHES)
def upsert_newest_wins(t: Showcase):
    held = F.when(F.col("segment") == "BUILDING", 9).otherwise(1)
    target = clean.with_row_hash(batch1(t), ["segment"]).withColumn("version", held)
    source = clean.with_row_hash(batch2(t), ["segment"]).withColumn("version", F.lit(5))
    return changes.upsert(target, source, ["id"], newest_wins="version").select("id", "name", "segment")


NULL_SAFE = """
    SELECT t.id, CASE WHEN s.segment IS DISTINCT FROM t.segment OR s.balance IS DISTINCT FROM t.balance THEN 'update' ELSE 'same' END AS _action FROM t JOIN s USING (id)
    UNION ALL SELECT id, 'insert' FROM s WHERE id NOT IN (SELECT id FROM t)"""


@query("upsert_null_safe", NULL_SAFE, local=BATCHES)
def upsert_null_safe(t: Showcase):
    return changes.upsert_null_safe(batch1(t), batch2(t), ["id"], ["segment", "balance"]).select("id", "_action")


@query("change_counts", f"SELECT count(*) FILTER (_action = 'insert') AS inserted, count(*) FILTER (_action = 'update') AS updated FROM ({NULL_SAFE})", local=BATCHES)
def change_counts(t: Showcase):
    return changes.change_counts(changes.upsert_null_safe(batch1(t), batch2(t), ["id"], ["segment", "balance"]))


@query("delete_insert", """
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN 'late' ELSE 'old' END AS origin FROM orders
    UNION ALL SELECT -1 - s_suppkey, s_nationkey, 'late' FROM supplier""")
def delete_insert(t: Showcase):
    target = t.orders.select("o_orderkey", "o_custkey", F.lit("old").alias("origin"))
    late = t.orders.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", F.lit("late").alias("origin"))
    new = t.supplier.select((-1 - F.col("s_suppkey")).alias("o_orderkey"), F.col("s_nationkey").cast("bigint").alias("o_custkey"), F.lit("late").alias("origin"))
    return changes.delete_insert(target, late.unionByName(new), "o_orderkey")


MARKS = {"marks": "SELECT o_orderpriority AS object_name, max(o_orderdate) AS last_value FROM orders GROUP BY 1"}


@query("high_water_mark", """
    SELECT object_name, CAST(CASE WHEN object_name = '1-URGENT' THEN (SELECT greatest(max(o_orderdate), (SELECT max(l_shipdate) FROM lineitem)) FROM orders) ELSE last_value END AS DATE) AS mark_day FROM marks
    UNION ALL SELECT 'never set', NULL WHERE false""", local=MARKS, text="mark_day")
def high_water_mark(t: Showcase):
    marks = t.orders.groupBy(F.col("o_orderpriority").alias("object_name")).agg(F.max("o_orderdate").cast("timestamp").alias("last_value"))
    marks = marks.withColumn("updated_at", F.lit(AS_OF).cast("timestamp"))
    top = changes.next_mark((t.orders, "o_orderdate"), (t.lineitem, "l_shipdate"))
    return changes.set_mark(marks, "1-URGENT", top, AS_OF).select("object_name", F.to_date("last_value").alias("mark_day"))


@query("ingest_log", "SELECT DISTINCT 'shop.' || event_type AS entity, CAST(CAST(ts AS DATE) AS VARCHAR) AS load_date FROM events")
def ingest_log(t: Showcase):
    log = t.events.select(F.concat(F.lit("shop."), "event_type").alias("entity"), F.to_date("ts").cast("string").alias("load_date"), "value")
    return changes.loaded_days(log)


# ---------------------------------------------------------------- identity

PEOPLE = """
    SELECT 'tessitura' AS source_system, 'A' || c_custkey AS source_id, 'first' || (c_custkey % 500) AS first_name, c_name AS last_name, CAST(c_nationkey AS VARCHAR) AS postal_code,
           CASE WHEN c_custkey % 6 <> 0 THEN 'cust' || c_custkey || '@mail.org' END AS email, c_custkey || ' Main St' AS address_line1, DATE '1995-01-01' + CAST(c_custkey % 900 AS INTEGER) AS first_seen_date,
           c_custkey AS rank_no FROM customer
    UNION ALL SELECT CASE WHEN c_custkey % 2 = 0 THEN 'tessitura' ELSE 'marketing' END, 'B' || c_custkey, 'first' || (c_custkey % 500), CASE WHEN c_custkey % 4 = 0 THEN 'Renamed ' || c_custkey ELSE c_name END,
           CAST(c_nationkey AS VARCHAR), CASE WHEN c_custkey % 3 <> 0 THEN 'cust' || c_custkey || '@mail.org' END, NULL, DATE '1994-01-01' + CAST(c_custkey % 900 AS INTEGER), c_custkey + 1 FROM customer"""
KEYED = {"people": PEOPLE, "keyed": "SELECT *, email AS email_key, lower(concat_ws('|', first_name, last_name, postal_code)) AS name_zip_key FROM people"}
KNOWN = {**KEYED,
         "xref": """SELECT source_system, source_id, 'PAT-' || left(sha256(coalesce(email_key, name_zip_key)), 12) AS patron_id, email_key, name_zip_key,
                    CASE WHEN email_key IS NOT NULL THEN 'new:email' ELSE 'new:name_zip' END AS match_rule FROM keyed WHERE address_line1 IS NOT NULL""",
         "by_email": "SELECT email_key, min(patron_id) AS p FROM xref WHERE email_key IS NOT NULL GROUP BY 1",
         "by_name": "SELECT name_zip_key, min(patron_id) AS p FROM xref GROUP BY 1",
         "matched": """SELECT k.source_system, k.source_id, k.email_key, k.name_zip_key, coalesce(e.p, n.p) AS patron_id, CASE WHEN e.p IS NOT NULL THEN 'email' WHEN n.p IS NOT NULL THEN 'name_zip' END AS match_rule
                       FROM keyed k LEFT JOIN by_email e USING (email_key) LEFT JOIN by_name n USING (name_zip_key) WHERE NOT EXISTS (SELECT 1 FROM xref x WHERE x.source_system = k.source_system AND x.source_id = k.source_id)""",
         "linked": """SELECT source_system, source_id, patron_id, email_key, name_zip_key, match_rule FROM xref
                      UNION ALL SELECT source_system, source_id, coalesce(patron_id, 'PAT-' || left(sha256(coalesce(email_key, name_zip_key)), 12)), email_key, name_zip_key,
                                       coalesce(match_rule, CASE WHEN email_key IS NOT NULL THEN 'new:email' ELSE 'new:name_zip' END) FROM matched""",
         "rollup": "SELECT patron_id, min(first_seen_date) AS first_seen_date, string_agg(DISTINCT source_system, ',' ORDER BY source_system) AS source_systems FROM keyed JOIN linked USING (source_system, source_id) GROUP BY 1"}


def people(t: Showcase):
    """Two records per customer: one with an address, one later without; both lack an email now and then."""
    key = F.col("c_custkey")
    mail = F.concat(F.lit(" Cust"), key, F.lit("@Mail.org "))
    first = F.concat(F.lit("first"), key % 500)
    one = t.customer.select(
        F.lit("tessitura").alias("source_system"), F.concat(F.lit("A"), key).alias("source_id"), first.alias("first_name"), F.col("c_name").alias("last_name"),
        F.col("c_nationkey").cast("string").alias("postal_code"), F.when(key % 6 != 0, mail).alias("email"),
        F.concat(key, F.lit(" Main St")).alias("address_line1"), F.date_add(F.lit("1995-01-01").cast("date"), (key % 900).cast("int")).alias("first_seen_date"), key.alias("updated_at"))
    last = F.when(key % 4 == 0, F.concat(F.lit("Renamed "), key)).otherwise(F.col("c_name"))
    two = t.customer.select(
        F.when(key % 2 == 0, "tessitura").otherwise("marketing").alias("source_system"), F.concat(F.lit("B"), key).alias("source_id"), first.alias("first_name"), last.alias("last_name"),
        F.col("c_nationkey").cast("string").alias("postal_code"), F.when(key % 3 != 0, mail).otherwise(" ").alias("email"),
        F.lit(None).cast("string").alias("address_line1"), F.date_add(F.lit("1994-01-01").cast("date"), (key % 900).cast("int")).alias("first_seen_date"), (key + 1).alias("updated_at"))
    return one.unionByName(two)


def first_xref(t: Showcase, keyed):
    """The cross-reference of a first batch, everyone with an address, as a table."""
    empty = t.literal([], identity.XREF_SCHEMA)
    first = keyed.where(F.col("address_line1").isNotNull())
    return staged(t, "xref", identity.append_xref(empty, staged(t, "matched", identity.match_known(first, empty)), AS_OF))


def staged(t: Showcase, purpose: str, df):
    return tables.stage_table(df, tables.work_table(t.spark, purpose))


def linked(t: Showcase):
    """Keyed records and the cross-reference after a second batch, each batch matched once."""
    keyed = staged(t, "keyed", identity.match_keys(people(t)))
    known = first_xref(t, keyed)
    return keyed, identity.append_xref(known, staged(t, "matched", identity.match_known(keyed, known)), AS_OF)


@query("match_keys", "SELECT source_id, email_key, name_zip_key FROM keyed", local=KEYED)
def match_keys(t: Showcase):
    return identity.match_keys(people(t)).select("source_id", "email_key", "name_zip_key")


@query("match_known", "SELECT source_id, patron_id, match_rule FROM matched", local=KNOWN)
def match_known(t: Showcase):
    keyed = identity.match_keys(people(t))
    return identity.match_known(keyed, first_xref(t, keyed)).select("source_id", "patron_id", "match_rule")


@query("cluster_new", "SELECT source_id, 'PAT-' || left(sha256(coalesce(email_key, name_zip_key)), 12) AS patron_id, CASE WHEN email_key IS NOT NULL THEN 'new:email' ELSE 'new:name_zip' END AS match_rule FROM keyed", local=KEYED)
def cluster_new(t: Showcase):
    return identity.cluster_new(identity.match_keys(people(t))).select("source_id", "patron_id", "match_rule")


@query("append_xref", "SELECT * FROM linked", local=KNOWN)
def append_xref(t: Showcase):
    return linked(t)[1].drop("matched_at")


@query("golden_record", """
    SELECT patron_id, first_name, last_name, address_line1 FROM (SELECT *, row_number() OVER (PARTITION BY patron_id ORDER BY address_line1 IS NULL, rank_no DESC) AS rn
    FROM keyed JOIN linked USING (source_system, source_id)) WHERE rn = 1""", local=KNOWN)
def golden_record(t: Showcase):
    keyed, xref = linked(t)
    return identity.golden_record(keyed, xref).select("patron_id", "first_name", "last_name", "address_line1")


@query("golden_rollup", "SELECT * FROM rollup", local=KNOWN, text="first_seen_date")
def golden_rollup(t: Showcase):
    return identity.golden_rollup(*linked(t))


@query("dedupe_rate", "SELECT (SELECT count(*) FROM keyed) AS source_records, count(*) AS people, 1 - count(*) / (SELECT count(*) FROM keyed) AS deduplicated_share FROM rollup",
       local=KNOWN, ratio="deduplicated_share")
def dedupe_rate(t: Showcase):
    keyed, xref = linked(t)
    return identity.dedupe_rate(keyed, identity.golden_people(keyed, xref, AS_OF))


@query("resolve_identities", "SELECT patron_id, source_systems, first_seen_date FROM rollup", local=KNOWN, text="first_seen_date")
def resolve_identities(t: Showcase):
    records = people(t)
    known = first_xref(t, identity.match_keys(records))
    return identity.resolve_identities(records, known, AS_OF)[1].select("patron_id", "source_systems", "first_seen_date")
