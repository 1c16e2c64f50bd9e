"""Sources, sinks, logs and maintenance over files that Spark writes from the driver's tables.

Everything is written below the shared folder of the session and read back, so the work grows with the tables.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ..contracts import Rule, SourceContract, TableContract
from ..operators.aggregate import union_all
from ..operators.changes import delete_insert, upsert, upsert_null_safe
from ..operators.clean import with_row_hash
from ..plans import daily
from ..session import work_path
from ..sources import api_pages, databases, landing, logs, sheets, tables
from ..streaming import stream_landing, stream_upsert
from .registry import query
from .tables import AS_OF, Showcase, dec

NOW = datetime.fromisoformat(AS_OF)


def day():
    return F.to_date("ts").cast("string")


def land_events(t: Showcase, kind: str) -> str:
    """Events as day folders ``<root>/events/load_date=D`` in the given format."""
    root = work_path(t.spark, "landing")
    rows = t.events.select(F.col("event_id").cast("string").alias("event_id"), "event_type", F.col("value").cast("string").alias("value"),
                           F.concat(F.lit("line one\nline \"two\" "), "user_id").alias("note"), day().alias("load_date"))
    rows = rows.repartition("load_date")
    writer = rows.write.partitionBy("load_date").mode("overwrite")
    (writer.option("header", True).option("escape", '"').csv if kind == "csv" else writer.json)(f"{root}/events")
    return root


LANDED = "SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, CAST(value AS DOUBLE) AS value, 'line one' || chr(10) || 'line \"two\" ' || user_id AS note, CAST(CAST(ts AS DATE) AS VARCHAR) AS load_date FROM events"


def file_day():
    return F.regexp_extract("_source_file", "load_date=([0-9-]{10})", 1).alias("load_date")


@query("read_landing_csv", LANDED)
def read_landing_csv(t: Showcase):
    raw = landing.read_landing_csv(t.spark, land_events(t, "csv") + "/events")
    return raw.select("event_id", "event_type", F.col("value").cast("double").alias("value"), "note", file_day())


@query("read_landing_json", LANDED)
def read_landing_json(t: Showcase):
    raw = landing.read_landing_json(t.spark, land_events(t, "json") + "/events")
    return raw.select("event_id", "event_type", F.col("value").cast("double").alias("value"), "note", file_day())


@query("add_lineage", "SELECT o_orderkey, '2024-01-31' AS _load_date, '2024-02-01' AS ingested_day, 'batch-7' AS _batch_id, CAST(NULL AS VARCHAR) AS _source_file FROM orders", text="_load_date ingested_day")
def add_lineage(t: Showcase):
    stamped = landing.add_lineage(t.orders.select("o_orderkey"), "2024-01-31", "batch-7", AS_OF)
    return stamped.select("o_orderkey", "_load_date", F.to_date("_ingested_at").alias("ingested_day"), "_batch_id", "_source_file")


@query("pending_partitions", "SELECT DISTINCT 'shop.' || event_type AS entity, CAST(CAST(ts AS DATE) AS VARCHAR) AS load_date FROM events WHERE event_type IN ('click', 'view') EXCEPT SELECT 'shop.' || event_type, CAST(CAST(ts AS DATE) AS VARCHAR) FROM events WHERE value > 200")
def pending_partitions(t: Showcase):
    listed = t.events.select(F.concat(F.lit("shop."), "event_type").alias("entity"), day().alias("load_date")).distinct()
    log = t.events.where(F.col("value") > 200).select(F.concat(F.lit("shop."), "event_type").alias("entity"), day().alias("load_date"))
    return landing.pending_partitions(listed, log, ["shop.click", "shop.view"])


@query("available_days", "SELECT DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR) AS load_date FROM events")
def available_days(t: Showcase):
    days = landing.available_days(t.spark, land_events(t, "json"), "events")
    return t.literal([(d,) for d in days], "load_date string")


@query("append_bronze", "SELECT l_linestatus, count(*) AS lines, count(CASE WHEN l_linestatus = 'F' THEN 1 END) AS with_new_column FROM lineitem GROUP BY 1")
def append_bronze(t: Showcase):
    """Two deliveries; the second brings a column the first did not have, the third is empty."""
    path = work_path(t.spark, "bronze")
    slim = t.lineitem.select("l_orderkey", "l_linestatus")
    tables.append_bronze(slim.where("l_linestatus = 'O'"), path)
    tables.append_bronze(slim.where("l_linestatus = 'F'").withColumn("carrier", F.lit("x")), path)
    tables.append_bronze(slim.where("false"), path)
    return tables.read_bronze(t.spark, path).groupBy("l_linestatus").agg(F.count(F.lit(1)).alias("lines"), F.count("carrier").alias("with_new_column"))


def land_pages(t: Showcase) -> str:
    """Events as saved interface pages of at most five hundred records each."""
    root = work_path(t.spark, "pages")
    page = F.floor(F.col("event_id") / 500)
    record = F.struct(F.col("event_id"), F.col("event_type"), F.col("value"))
    pages = t.events.groupBy(day().alias("day"), page.alias("page")).agg(F.collect_list(record).alias("value"))
    totals = t.events.groupBy(day().alias("day")).agg(F.count(F.lit(1)).alias("count"), F.max(page).alias("last"))
    link = F.when(F.col("page") < F.col("last"), F.concat(F.lit("page-"), F.col("page") + 1, F.lit(".json")))
    body = pages.join(totals, "day").withColumn("next_link", link)
    text = F.to_json(F.struct("count", "value", "next_link"), {"ignoreNullFields": "false"})
    body.select("day", "page", text.alias("text")).write.partitionBy("day", "page").text(f"{root}/events")
    return root


RECORD = "event_id bigint, event_type string, value double"
PAGES = "SELECT event_id, event_type, value, CAST(CAST(ts AS DATE) AS VARCHAR) AS load_date FROM events"


@query("read_paged_json", PAGES)
def read_paged_json(t: Showcase):
    records, _ = api_pages.read_paged_json(t.spark, land_pages(t), "events", RECORD)
    return records.drop("entity")


@query("build_manifest", "SELECT 'events' AS entity, CAST(CAST(ts AS DATE) AS VARCHAR) AS load_date, count(*) AS rows, count(*) AS api_count FROM events GROUP BY 2")
def build_manifest(t: Showcase):
    return api_pages.build_manifest(*api_pages.read_paged_json(t.spark, land_pages(t), "events", RECORD))


@query("new_api_days", "SELECT DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR) AS load_date FROM events WHERE CAST(ts AS DATE) NOT IN (SELECT CAST(ts AS DATE) FROM events WHERE value > 300)")
def new_api_days(t: Showcase):
    index = t.events.agg(F.sort_array(F.collect_set(day())).alias("load_dates"))
    manifests = t.events.where(F.col("value") > 300).select(day().alias("load_date"))
    return api_pages.new_api_days(index, manifests)


@query("read_manifests", "SELECT 'shop.' || event_type AS entity, CAST(CAST(ts AS DATE) AS VARCHAR) AS load_date, count(*) AS expected_rows FROM events GROUP BY 1, 2")
def read_manifests(t: Showcase):
    root = work_path(t.spark, "manifests")
    per_table = t.events.groupBy(day().alias("load_date"), "event_type").agg(F.count(F.lit(1)).alias("rows"))
    line = F.struct(F.lit("shop").alias("source"), F.col("event_type").alias("entity"), "rows")
    per_table.groupBy("load_date").agg(F.collect_list(line).alias("files")).write.json(root)
    return landing.manifest_lines(t.spark.read.schema(landing.MANIFEST_SCHEMA).json(root))


@query("read_jdbc_incremental", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS changed FROM orders WHERE o_orderdate > TIMESTAMP '2000-06-30 00:00:00' AND o_orderstatus <> 'P'", text="changed")
def read_jdbc_incremental(t: Showcase):
    table = t.orders.withColumn("changed_at", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")))
    return databases.read_jdbc_incremental(t.spark, table, None, "changed_at", "2000-06-30 00:00:00").select("o_orderkey", F.to_date("changed_at").alias("changed"))


RENAMES = {"Enrollment ID": "enrollment_id", "School ID": "school_id", "Participants": "participants", "Title I": "is_title_i"}
SHEET_TYPES = {"enrollment_id": "string", "school_id": "string", "participants": "int"}


@query("combine_sheets", """
    SELECT 'S' || event_id AS enrollment_id, CASE WHEN event_type = 'signup' THEN 'X' || user_id END AS school_id, CAST(floor(value) AS INTEGER) AS participants, event_type = 'signup' AND user_id % 2 = 0 AS is_title_i,
           CASE event_type WHEN 'signup' THEN 'a.csv' ELSE 'B.CSV' END AS source_file FROM events WHERE event_type = 'signup' OR value >= 5""")
def combine_sheets(t: Showcase):
    """Signups in one layout, every other event in another that lacks two columns."""
    a = t.events.where("event_type = 'signup'").select(F.concat(F.lit("S"), "event_id").alias("Enrollment ID"), F.concat(F.lit("X"), "user_id").alias("School ID"), F.floor("value").cast("string").alias("Participants"),
                                                       F.when(F.col("user_id") % 2 == 0, "Yes").otherwise("No").alias("Title I"))
    b = t.events.where("event_type <> 'signup'").select(F.when(F.col("value") < 5, " ").otherwise(F.concat(F.lit("S"), "event_id")).alias("Enrollment ID"), F.floor("value").cast("string").alias("Participants"))
    return sheets.combine_sheets({"a.csv": a, "B.CSV": b, "notes.txt": a}, RENAMES, SHEET_TYPES, "enrollment_id", ["is_title_i"])


@query("read_sheet_folder", "SELECT 'S' || event_id AS enrollment_id, CASE WHEN event_type = 'view' THEN NULL ELSE 'X' || user_id END AS school_id, CAST(floor(value) AS INTEGER) AS participants, user_id % 2 = 0 AS is_title_i FROM events")
def read_sheet_folder(t: Showcase):
    """All events as sheets, one column order for each event type; views come without a school."""
    folder = work_path(t.spark, "sheets")
    cells = {"Enrollment ID": F.concat(F.lit("S"), "event_id"), "School ID": F.concat(F.lit("X"), "user_id"), "Participants": F.floor("value"),
             "Title I": F.when(F.col("user_id") % 2 == 0, "Yes").otherwise("No")}
    headers = list(cells)
    layouts = {"view": [h for h in headers if h != "School ID"], "signup": headers, "click": headers[::-1]}
    known = F.col("event_type").isin("view", "signup")
    for kind, layout in layouts.items():
        rows = t.events.where(F.col("event_type") == kind) if kind != "click" else t.events.where(~known)
        rows.select(*[cells[h].alias(h) for h in layout]).write.mode("append").option("header", True).csv(folder)
    return sheets.read_sheet_folder(t.spark, folder, headers, RENAMES, SHEET_TYPES, "enrollment_id", ["is_title_i"]).drop("source_file")


@query("overwrite_table", "SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(14,2)) * 2 AS price FROM orders", money="price")
def overwrite_table(t: Showcase):
    """Written, then rewritten from itself with a new schema."""
    table = tables.work_table(t.spark, "orders")
    tables.overwrite_table(t.orders.select("o_orderkey", dec("o_totalprice").alias("old_price")), table, NOW)
    doubled = tables.read_table(t.spark, table).select("o_orderkey", (F.col("old_price") * 2).alias("price"))
    tables.overwrite_table(doubled, table, NOW + timedelta(hours=1))
    return tables.read_table(t.spark, table)


@query("clustered_tables", "SELECT o_orderkey, count(*) AS lines, sum(CAST(l_extendedprice AS DECIMAL(14,2))) AS amount FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1", money="amount")
def clustered_tables(t: Showcase):
    """Two tables clustered by their business key meet without an exchange."""
    orders, lines = tables.work_table(t.spark, "orders"), tables.work_table(t.spark, "lines")
    n = tables.cluster_count(t.orders, t.lineitem)
    tables.overwrite_table(t.orders.select("o_orderkey"), orders, NOW, cluster_by=["o_orderkey"], clusters=n)
    tables.overwrite_table(t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), dec("l_extendedprice").alias("amount")), lines, NOW, cluster_by=["o_orderkey"], clusters=n)
    joined = tables.read_table(t.spark, orders).join(tables.read_table(t.spark, lines).hint("merge"), "o_orderkey")
    return joined.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("lines"), F.sum("amount").alias("amount"))


def order_state(t: Showcase):
    """Orders with a fingerprint, the state before a delivery."""
    return with_row_hash(t.orders.select("o_orderkey", "o_orderstatus", dec("o_totalprice").alias("price")), ["o_orderstatus", "price"])


def order_delivery(t: Showcase):
    """A delivery: open orders with a new price, all others of the same customers unchanged, and a new order for every customer."""
    seen = t.orders.where("o_orderstatus <> 'F'").select("o_orderkey", "o_orderstatus", F.when(F.col("o_orderstatus") == "O", dec("o_totalprice") + 1).otherwise(dec("o_totalprice")).alias("price"))
    new = t.customer.select((F.col("c_custkey") + 1000000000).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"), dec("c_acctbal").alias("price"))
    return with_row_hash(seen.union(new), ["o_orderstatus", "price"])


MERGED = """
    SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(14,2)) + CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS price FROM orders
    UNION ALL SELECT c_custkey + 1000000000, 'N', CAST(c_acctbal AS DECIMAL(14,2)) FROM customer"""


@query("merge_upsert", MERGED, money="price")
def merge_upsert(t: Showcase):
    """An upsert that reads and replaces the key buckets of the delivery only."""
    table = tables.work_table(t.spark, "merged")
    tables.create_merged(order_state(t), table, ["o_orderkey"], NOW)
    tables.merge_table(table, order_delivery(t), lambda held, new: upsert(held, new, ["o_orderkey"]), NOW)
    return tables.read_table(t.spark, table).drop("_row_hash")


@query("merge_upsert_null_safe", MERGED, money="price")
def merge_upsert_null_safe(t: Showcase):
    """The same by comparing columns, bucketed by ranges of the order key."""
    table = tables.work_table(t.spark, "merged")
    plain = ["o_orderkey", "o_orderstatus", "price"]
    tables.create_merged(order_state(t).select(*plain), table, ["o_orderkey"], NOW, bucket_expr="least(o_orderkey div 20000, 500)")
    tables.merge_table(table, order_delivery(t).select(*plain), lambda held, new: upsert_null_safe(held, new, ["o_orderkey"], ["o_orderstatus", "price"]).drop("_action"), NOW)
    return tables.read_table(t.spark, table)


@query("merge_delete_insert", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P') "
       "UNION ALL SELECT o_orderkey, 0, -1 FROM orders WHERE o_orderstatus = 'P'")
def merge_delete_insert(t: Showcase):
    """Pending orders arrive again, each as one line that replaces all it had."""
    table = tables.work_table(t.spark, "merged")
    tables.create_merged(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity"), table, ["l_orderkey"], NOW)
    arriving = t.orders.where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"), F.lit(0).cast(t.lineitem.schema["l_linenumber"].dataType).alias("l_linenumber"),
                                                            F.lit(-1).cast(t.lineitem.schema["l_quantity"].dataType).alias("l_quantity"))
    tables.merge_table(table, arriving, lambda held, new: delete_insert(held, new, ["l_orderkey"]), NOW)
    return tables.read_table(t.spark, table)


@query("stage_table", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def stage_table(t: Showcase):
    return tables.stage_table(t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")), tables.work_table(t.spark, "stage"))


@query("truncate_reload", "SELECT (SELECT count(*) FROM orders) AS first_rows, (SELECT count(*) FROM customer) AS second_rows, (SELECT sum(c_custkey) FROM customer) AS checksum", whole="checksum")
def truncate_reload(t: Showcase):
    table = tables.work_table(t.spark, "reload")
    first = tables.truncate_reload(t.orders, table, NOW)
    second = tables.truncate_reload(t.customer, table, NOW + timedelta(hours=1))
    return tables.read_table(t.spark, table).agg(F.lit(first).cast("bigint").alias("first_rows"), F.lit(second).cast("bigint").alias("second_rows"), F.sum("c_custkey").alias("checksum"))


@query("static_lookup", "SELECT cash_flow_line, cash_direction, sum(debit_amount - credit_amount) AS moved FROM gl WHERE account_code = '1010' GROUP BY 1, 2", ["gl"], money="moved")
def static_lookup(t: Showcase):
    labelled = t.journal.where("account_code = '1010'").join(t.modules, "source_module", "left")
    return labelled.groupBy("cash_flow_line", "cash_direction").agg(F.sum(F.col("debit_amount") - F.col("credit_amount")).alias("moved"))


@query("log_run", "SELECT 'shop.orders' AS entity, count(*) AS rows_in, count(*) FILTER (o_orderstatus <> 'P') AS rows_out, count(*) FILTER (o_orderstatus = 'P') AS rows_quarantined, 'Succeeded' AS status FROM orders")
def log_run(t: Showcase):
    path = work_path(t.spark, "run_log")
    counts = t.orders.agg(F.count(F.lit(1)).alias("all"), F.count_if(F.col("o_orderstatus") == "P").alias("bad")).first()
    logs.log_run(t.spark, path, run_id="r1", step="silver", entity="shop.orders", stage="silver", rows_in=counts["all"], rows_out=counts["all"] - counts["bad"], rows_quarantined=counts["bad"], started_at=NOW, ended_at=NOW)
    return t.spark.read.parquet(path).select("entity", "rows_in", "rows_out", "rows_quarantined", "status")


@query("load_log", "SELECT 'fact.gifts' AS target_table, count(*) AS rows_inserted, 0 AS rows_updated, 0 AS rows_deleted, 'Succeeded' AS status FROM orders")
def load_log(t: Showcase):
    path = work_path(t.spark, "load_log")
    logs.load_log(t.spark, path, run_id="r1", step="load_gifts", target="fact.gifts", inserted=t.orders.count(), started_at=NOW, ended_at=NOW)
    return t.spark.read.parquet(path).select("target_table", "rows_inserted", "rows_updated", "rows_deleted", "status")


@query("source_config", "SELECT split_part(entity, '.', 1) AS source_system, count(*) AS runs, CASE split_part(entity, '.', 1) WHEN 'diese' THEN 'weekly' ELSE 'daily' END AS expected_refresh, CASE split_part(entity, '.', 1) WHEN 'diese' THEN 192 ELSE 26 END AS sla_hours FROM run_log GROUP BY 1, 3, 4", ["run_log"])
def source_config(t: Showcase):
    config = logs.source_config(t.spark, [SourceContract(s, s, "weekly" if s == "diese" else "daily") for s in ("tessitura", "mip", "diese", "marketing")])
    runs = t.run_log.groupBy(F.substring_index("entity", ".", 1).alias("source_system")).agg(F.count(F.lit(1)).alias("runs"))
    return runs.join(config.drop("source"), "source_system")


@query("compact_table", "SELECT 'Succeeded' AS status, 1 AS files, (SELECT count(*) FROM orders) AS rows, (SELECT sum(o_orderkey) FROM orders) AS checksum", whole="checksum")
def compact_table(t: Showcase):
    table = tables.work_table(t.spark, "small_files")
    tables.overwrite_table(t.orders.select("o_orderkey").repartition(16), table, NOW)
    log = tables.compact_table(t.spark, {"orders": table}, NOW + timedelta(hours=1))
    folded = tables.read_table(t.spark, table).agg(F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("checksum"))
    return folded.select(log.select("status").scalar().alias("status"), log.select("files").scalar().alias("files"), "rows", "checksum")


@query("expire_snapshots", "SELECT 1 AS removed, 3 AS versions_left, count(*) AS rows FROM customer")
def expire_snapshots(t: Showcase):
    """Four versions over ten days: only those superseded more than seven days ago go."""
    table = tables.work_table(t.spark, "history")
    for days_ago, frame in ((10, t.nation), (9, t.region), (3, t.supplier), (0, t.customer)):
        tables.overwrite_table(frame, table, NOW - timedelta(days=days_ago))
    removed = tables.expire_snapshots(t.spark, table, 168, NOW)
    left = len(tables.written_versions(t.spark, table))
    return tables.read_table(t.spark, table).agg(F.lit(len(removed)).alias("removed"), F.lit(left).alias("versions_left"), F.count(F.lit(1)).alias("rows"))


@query("reset_gold", "SELECT 'fact.gifts' AS table_name, 0 AS n UNION ALL SELECT 'dim.patron', 0 UNION ALL SELECT 'dim_date', (SELECT count(*) FROM calendar)", ["calendar"])
def reset_gold(t: Showcase):
    gold = {name: tables.work_table(t.spark, name) for name in ("fact.gifts", "dim.patron", "dim_date")}
    for name, frame in (("fact.gifts", t.orders), ("dim.patron", t.customer), ("dim_date", t.calendar)):
        tables.overwrite_table(frame, gold[name], NOW)
    return tables.reset_gold(t.spark, gold, NOW + timedelta(hours=1))


@query("stream_landing", "SELECT event_type, count(*) AS n, CAST(count(DISTINCT CAST(ts AS DATE)) AS BIGINT) AS days FROM events GROUP BY 1")
def stream(t: Showcase):
    root = land_events(t, "json")
    target, checkpoint = work_path(t.spark, "stream-bronze"), work_path(t.spark, "stream-checkpoint")
    started = stream_landing(t.spark, f"{root}/events", "event_id string, event_type string, value string, note string", target, checkpoint, "b1", AS_OF, format="json")
    started.awaitTermination()
    return t.spark.read.parquet(target).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("_load_date").alias("days"))


@query("stream_upsert", """
    SELECT event_id, event_type, value + CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS value FROM events
    UNION ALL SELECT event_id + 1000000000, 'late', value FROM events WHERE event_type = 'signup'""")
def upsert_stream(t: Showcase):
    """Two deliveries and a third run: corrected purchases, new rows and older versions that arrive late; then a second stream
    that delivers everything again changes nothing."""
    root, table = work_path(t.spark, "changes"), tables.work_table(t.spark, "streamed")
    schema = "event_id bigint, event_type string, value double, version int"
    first = t.events.select("event_id", "event_type", "value", F.lit(2).alias("version"))
    fixed = t.events.where("event_type = 'purchase'").select("event_id", "event_type", (F.col("value") + 1).alias("value"), F.lit(3).alias("version"))
    late = t.events.where("event_type = 'view'").select("event_id", F.lit("stale").alias("event_type"), F.lit(-1.0).alias("value"), F.lit(1).alias("version"))
    new = t.events.where("event_type = 'signup'").select((F.col("event_id") + 1000000000).alias("event_id"), F.lit("late").alias("event_type"), "value", F.lit(1).alias("version"))
    for stream, deliveries in (("landing", [first, union_all([fixed, late, new])]), ("again", [None])):
        for delivery in deliveries:
            if delivery is not None:
                delivery.write.mode("append").json(root)
            run = stream_upsert(t.spark, root, schema, table, ["event_id"], "version", f"{root}-checkpoint-{stream}", NOW, stream=stream)
            run.awaitTermination()
            if run.exception() is not None:
                raise run.exception()
    return tables.read_table(t.spark, table).select("event_id", "event_type", "value")


# ---------------------------------------------------------------- the daily run

ORDER_CONTRACT = TableContract("orders", {"order_id": "bigint", "customer_id": "bigint", "status": "string", "price": "decimal(12,2)", "ordered": "date"}, ("order_id",), "ordered", "shop")
ORDER_CHECKS = (Rule("accepted_values", "error", "status", values=("F", "O")), Rule("range", "warn", "price", min=1000, max=400000))


def order_text(t: Showcase, shift: int):
    """Orders as a day's delivery in text form; the second day changes prices of finished orders."""
    price = F.when(F.col("o_orderstatus") == "F", dec("o_totalprice") + shift).otherwise(dec("o_totalprice"))
    return t.orders.select(F.concat(F.lit(" "), "o_orderkey").alias("order_id"), F.col("o_custkey").cast("string").alias("customer_id"), F.col("o_orderstatus").alias("status"), price.cast("string").alias("price"),
                           F.to_date("o_orderdate").cast("string").alias("ordered"))


def two_days(t: Showcase) -> "daily.Lake":
    lake = daily.Lake(t.spark, work_path(t.spark, "lake"))
    for shift, day in ((0, "2024-01-30"), (1, "2024-01-31")):
        landed = f"{lake.landing('shop')}/orders/load_date={day}"
        order_text(t, shift).write.option("header", True).csv(landed)
        stamp = datetime.fromisoformat(f"{day} 06:00:00")
        daily.ingest_landing(lake, "shop", ORDER_CONTRACT, "csv", f"run-{day}", stamp)
        daily.process_entity(lake, ORDER_CONTRACT, ORDER_CHECKS, f"run-{day}", stamp)
    return lake


@query("process_entity", "SELECT o_orderkey AS order_id, CAST(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(12,2)) + 1 ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS DOUBLE) AS price, CASE WHEN o_orderstatus = 'F' THEN '2024-01-31' ELSE '2024-01-30' END AS updated FROM orders WHERE o_orderstatus <> 'P'",
       money="price", text="updated")
def process_entity(t: Showcase):
    """Two days through bronze and silver: unchanged rows keep their first time stamp, bad rows are set aside."""
    silver = two_days(t).read("silver", "shop.orders")
    return silver.select("order_id", "price", F.to_date("_silver_updated_at").alias("updated"))


@query("ingest_landing", "SELECT '2024-01-30' AS _load_date, count(*) AS rows FROM orders UNION ALL SELECT '2024-01-31', count(*) FROM orders", text="_load_date")
def ingest_landing(t: Showcase):
    return two_days(t).read("bronze", "shop.orders").groupBy("_load_date").agg(F.count(F.lit(1)).alias("rows"))


@query("process_entity_quarantine", "SELECT day AS run_id, o_orderkey AS order_id FROM orders, (VALUES ('run-2024-01-30'), ('run-2024-01-31')) d(day) WHERE o_orderstatus = 'P'")
def process_entity_quarantine(t: Showcase):
    record = F.from_json("record", "order_id bigint")
    return two_days(t).read("dq", "quarantine").select("run_id", record["order_id"].alias("order_id"))


@query("run_log_lines", "SELECT stage, 'shop.orders' AS entity, run_id, (SELECT count(*) FROM orders) AS rows_in FROM (VALUES ('bronze'), ('silver')) s(stage), (VALUES ('run-2024-01-30'), ('run-2024-01-31')) r(run_id)")
def run_log_lines(t: Showcase):
    return two_days(t).read("audit", "run_log").select("stage", "entity", "run_id", "rows_in")


@query("load_gold", "SELECT 'dim.venue' AS target, count(*) + 1 AS n FROM nation UNION ALL SELECT 'dim.channel', count(DISTINCT o_orderpriority) + 1 FROM orders UNION ALL SELECT 'fact.gifts', count(*) FROM orders")
def load_gold(t: Showcase):
    """Three steps of the ordered load, each logged; counts are read back from the gold tables."""
    from ..operators import dimensions
    lake = daily.Lake(t.spark, work_path(t.spark, "gold-lake"))
    venues = t.nation.select(F.concat(F.lit("V"), "n_nationkey").alias("venue_id"), F.col("n_name").alias("venue_name"), F.lit(10).alias("capacity"))
    gifts = t.orders.select(F.col("o_orderkey").alias("gift_id"), dec("o_totalprice").alias("amount"))
    steps = [
        daily.Step("dim.venue", lambda gold: dimensions.dim_venue(venues, gold("dim.venue", "venue_key int, venue_id string, venue_name string, capacity int"))),
        daily.Step("dim.channel", lambda gold: dimensions.dim_channel(t.orders.withColumnRenamed("o_orderpriority", "channel"), gold("dim.channel", "channel_key int, channel_name string"))),
        daily.Step("fact.gifts", lambda gold: gifts),
    ]
    daily.load_gold(lake, steps, "run-1", NOW)
    return union_all([lake.read("gold", s.target).agg(F.count(F.lit(1)).alias("n")).select(F.lit(s.target).alias("target"), "n") for s in steps])
