from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest

from boxledger.contracts import Contracts, Rule, SourceContract, TableContract
from boxledger.operators import aggregate, dimensions
from boxledger.plans import daily
from boxledger.session import work_path
from boxledger.sources import api_pages, databases, landing, sheets, tables
from conftest import rows, ts

NOW = datetime(2025, 1, 10, 6)


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_csv_is_text_with_quoted_lines_and_empty_files(spark, tmp_path):
    write(tmp_path / "t" / "t.csv", 'id,note\n007,"two\nlines, ""quoted"""\n')
    df = landing.read_landing_csv(spark, str(tmp_path / "t"))
    assert rows(df, "id", "note") == [("007", 'two\nlines, "quoted"')]
    assert df.first()["_source_file"].endswith("t.csv")
    write(tmp_path / "empty" / "t.csv", "")
    assert [c for c in landing.read_landing_csv(spark, str(tmp_path / "empty")).columns if c != "_source_file"] == []


def test_json_nested_values_become_text(spark, tmp_path):
    write(tmp_path / "t" / "t.json", '{"id": 1, "tags": ["a"], "who": {"n": 2}}\n{"id": 2.5, "tags": null}\n')
    assert rows(landing.read_landing_json(spark, str(tmp_path / "t")), "id", "tags", "who") == [("1", '["a"]', '{"n":"2"}'), ("2.5", None, None)]


def test_pending_partitions(frame):
    listed = frame([("s.a", "2025-01-01"), ("s.a", "2025-01-02"), ("s.b", "2025-01-01")], "entity string, load_date string")
    log = frame([("s.a", "2025-01-01"), ("s.a", "2025-01-01")], "entity string, load_date string")
    assert rows(landing.pending_partitions(listed, log)) == [("s.a", "2025-01-02"), ("s.b", "2025-01-01")]
    assert rows(landing.pending_partitions(listed, log, ["s.a"])) == [("s.a", "2025-01-02")]
    assert landing.pending_partitions(listed, log, reprocess=True).count() == 3
    assert rows(landing.pending_partitions(listed, log, load_date="2025-01-01")) == [("s.b", "2025-01-01")]


def pages(tmp_path):
    base = tmp_path / "api" / "gift"
    first = {"count": 3, "value": [{"id": 1}, {"id": 2}], "next_link": "page-2.json"}
    second = {"count": 3, "value": [{"id": 2}, {"id": 3}], "next_link": None}
    write(base / "2025-01-01" / "page-1.json", json.dumps(first, indent=1))
    write(base / "2025-01-01" / "page-2.json", json.dumps(second))
    write(base / "2025-01-02" / "page-1.json", json.dumps({"count": 0, "value": [], "next_link": None}))
    return tmp_path / "api"


def test_saved_pages(spark, tmp_path):
    records, counts = api_pages.read_paged_json(spark, str(pages(tmp_path)), "gift", "id int")
    assert rows(records, "load_date", "id") == [("2025-01-01", 1), ("2025-01-01", 2), ("2025-01-01", 2), ("2025-01-01", 3)]
    manifest = api_pages.build_manifest(records, counts)
    assert rows(manifest, "load_date", "rows", "api_count") == [("2025-01-01", 4, 3), ("2025-01-02", 0, 0)]


def test_live_pages_follow_links(spark, tmp_path):
    spark.dataSource.register(api_pages.PagedJsonSource)
    live = spark.read.format("paged_json").options(base_url=pages(tmp_path).as_uri(), entities="gift", days="2025-01-01,2025-01-02").load()
    assert live.rdd.getNumPartitions() == 2
    assert rows(live, "load_date", "page", "count", "record") == [
        ("2025-01-01", 1, 3, '{"id": 1}'), ("2025-01-01", 1, 3, '{"id": 2}'), ("2025-01-01", 2, 3, '{"id": 2}'), ("2025-01-01", 2, 3, '{"id": 3}'), ("2025-01-02", 1, 0, None)]


def test_manifest_reconciliation(spark, frame, tmp_path):
    write(tmp_path / "m.json", json.dumps({"load_date": "2025-01-01", "files": [{"source": "s", "entity": e, "rows": n} for e, n in (("a", 1), ("b", 2), ("c", 3))]}, indent=1))
    log = frame([("s.a", "2025-01-01", 1), ("s.b", "2025-01-01", 9)], "entity string, load_date string, rows bigint")
    recon = aggregate.rowcount_reconcile(landing.read_manifests(spark, str(tmp_path / "m.json")), log)
    assert rows(recon, "entity", "status") == [("s.a", "OK"), ("s.b", "MISMATCH"), ("s.c", "NOT_LOADED")]
    with pytest.raises(aggregate.MismatchError):
        aggregate.require_no_mismatch(recon)
    aggregate.require_no_mismatch(recon.where("entity <> 's.b'"))


def test_jdbc_increment(spark, frame):
    table = frame([(1, ts("2025-01-01 00:00:00")), (2, ts("2025-01-02 00:00:00")), (3, None)], "k int, u timestamp")
    assert rows(databases.read_jdbc_incremental(spark, table, None, "u"), "k") == [(1,), (2,)]
    assert rows(databases.read_jdbc_incremental(spark, table, None, "u", "2025-01-01 00:00:00"), "k") == [(2,)]


def test_combine_sheets(frame):
    a, b = frame([("1", "Yes", "x"), (" ", "Yes", "3")], "`School ID` string, `Title I` string, n string"), frame([("2", "7")], "`School ID` string, n string")
    got = sheets.combine_sheets({"a.CSV": a, "b.csv": b, "c.pdf": a}, {"School ID": "school_id", "Title I": "is_title_i"}, {"school_id": "string", "n": "int"}, "school_id", ["is_title_i"])
    assert rows(got, "school_id", "is_title_i", "n", "source_file") == [("1", True, None, "a.CSV"), ("2", False, 7, "b.csv")]


def test_versions_and_expiry(spark, frame):
    table = tables.work_table(spark, "test-table")
    for age, value in ((10, 1), (9, 2), (3, 3), (0, 4)):
        tables.overwrite_table(frame([(value,)], "v int"), table, NOW - timedelta(days=age))
    assert tables.read_table(spark, table).first()["v"] == 4
    assert len(tables.expire_snapshots(spark, table, 168, NOW)) == 1
    assert tables.expire_snapshots(spark, table, 168, NOW) == []
    assert tables.read_table(spark, table).first()["v"] == 4
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, tables.work_table(spark, "nothing"))


def test_compaction_reports_failures(spark, frame):
    table = tables.work_table(spark, "test-compact")
    tables.overwrite_table(frame([(i,) for i in range(8)], "v int").repartition(4), table, NOW)
    log = tables.compact_table(spark, {"good": table, "broken": tables.work_table(spark, "missing")}, NOW + timedelta(hours=1))
    assert {r["table_name"]: r["status"] for r in log.collect()} == {"good": "Succeeded", "broken": "Failed"}
    assert tables.read_table(spark, table).count() == 8
    with pytest.raises(RuntimeError, match="broken"):
        tables.require_success(log)


def test_local_table_has_a_known_size(spark):
    df = tables.local_table(spark, [(1, "it's \\ fine", None)], "a int, b string, c date")
    assert df.first()[:] == (1, "it's \\ fine", None)
    assert "LocalTableScan" in df._jdf.queryExecution().executedPlan().toString()
    assert tables.local_table(spark, [], "a int").count() == 0


CONTRACT = TableContract("t", {"id": "int", "v": "string", "u": "int"}, ("id",), "u", "s")


def land(lake, day, text):
    import os
    folder = f"{lake.landing('s')}/t/load_date={day}".removeprefix("file:")
    os.makedirs(folder)
    with open(f"{folder}/t.csv", "w", encoding="utf-8") as out:
        out.write(text)


def test_daily_run(spark, tmp_path):
    lake = daily.Lake(spark, str(tmp_path / "lake"))
    contracts = Contracts((SourceContract("s", "s", tables=(CONTRACT,)),), {"s.t": (Rule("accepted_values", "error", "v", values=("a", "b")),)})
    steps = [daily.Step("dim.channel", lambda gold: dimensions.dim_channel(lake.read("silver", "s.t").withColumnRenamed("v", "channel"), gold("dim.channel", "channel_key int, channel_name string")))]
    land(lake, "2025-01-01", "id,v,u\n1,a,1\n2,a,1\n3,x,1\n")
    daily.run_daily(lake, contracts, steps, "r1", NOW)
    land(lake, "2025-01-02", "id,v,u\n1,a,2\n2,b,2\n2,a,1\n4,b,1\n")
    land(lake, "2025-01-03", "")
    daily.run_daily(lake, contracts, steps, "r2", NOW + timedelta(days=1))
    silver = lake.read("silver", "s.t")
    assert rows(silver, "id", "v", "u") == [(1, "a", 2), (2, "b", 2), (4, "b", 1)]
    assert lake.read("dq", "quarantine").count() == 1
    assert rows(lake.read("audit", "ingest_log"), "load_date", "rows") == [("2025-01-01", 3), ("2025-01-02", 4), ("2025-01-03", 0)]
    assert rows(lake.read("gold", "dim.channel")) == [(-1, "Unknown"), (1, "a"), (2, "b")]
    before = rows(silver)
    daily.run_daily(lake, contracts, steps, "r3", NOW + timedelta(days=2))
    assert rows(lake.read("silver", "s.t")) == before, "a run with nothing new changes nothing"
    assert lake.read("audit", "run_log").where("message like 'checked%'").count() == 1


def test_gold_load_stops_at_the_first_failure(spark, frame, tmp_path):
    lake = daily.Lake(spark, str(tmp_path / "lake"))
    one = frame([(1,)], "v int")
    steps = [daily.Step("a", lambda gold: one), daily.Step("b", lambda gold: gold("missing")), daily.Step("c", lambda gold: one)]
    with pytest.raises(FileNotFoundError):
        daily.load_gold(lake, steps, "r", NOW)
    assert rows(lake.read("audit", "load_log"), "target_table", "status") == [("a", "Succeeded"), ("b", "Failed")]
    assert lake.exists("gold", "a") and not lake.exists("gold", "c")
