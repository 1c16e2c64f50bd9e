"""Versions, parallel writers, malformed values, incremental gold and identities in the daily run."""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from boxledger.contracts import Contracts, Rule, TableContract
from boxledger.operators import aggregate, changes, dimensions
from boxledger.plans import daily, measures
from boxledger.session import work_path
from boxledger.sources import logs, sheets, tables
from conftest import d, rows, ts

NOW = datetime(2025, 6, 1, 12)


def test_the_version_written_last_wins(spark, frame):
    table = tables.work_table(spark, "test-order")
    tables.overwrite_table(frame([(1,)], "v int"), table, NOW)
    tables.overwrite_table(frame([(2,)], "v int"), table, NOW - timedelta(days=3))
    assert rows(tables.read_table(spark, table)) == [(2,)]
    tables.expire_snapshots(spark, table, 1, NOW + timedelta(days=9))
    assert rows(tables.read_table(spark, table)) == [(2,)]
    assert tables.current_version(spark, table).number == 2 and len(tables.written_versions(spark, table)) == 1


def test_a_write_from_an_old_version_fails(spark, frame):
    table = tables.work_table(spark, "test-expected")
    tables.overwrite_table(frame([(1,)], "v int"), table, NOW, expected=0)
    tables.overwrite_table(frame([(2,)], "v int"), table, NOW, expected=1)
    with pytest.raises(tables.ConcurrentWrite):
        tables.overwrite_table(frame([(3,)], "v int"), table, NOW, expected=1)
    assert rows(tables.read_table(spark, table)) == [(2,)] and len(tables.written_versions(spark, table)) == 2


def test_a_table_may_be_made_from_itself_while_it_is_read(spark, frame):
    table = tables.work_table(spark, "test-self")
    tables.overwrite_table(frame([(1,), (2,)], "v int"), table, NOW)
    before = tables.read_table(spark, table)
    tables.overwrite_table(before.select((F.col("v") * 10).alias("w")), table, NOW)
    assert rows(tables.read_table(spark, table)) == [(10,), (20,)] and rows(before) == [(1,), (2,)]


def test_dropping_gives_back_every_version(spark, frame):
    table, staged = tables.work_table(spark, "test-drop"), tables.work_table(spark, "test-stage")
    for v in range(3):
        tables.overwrite_table(frame([(v,)], "v int"), table, NOW)
    assert rows(tables.stage_table(frame([(7,)], "v int"), staged)) == [(7,)]
    tables.drop_table(spark, table)
    tables.drop_table(spark, staged)
    tables.drop_table(spark, staged)
    assert not tables.table_exists(spark, table) and not tables.table_exists(spark, staged) and tables.written_versions(spark, table) == []


def files_of(df):
    return {r[0]: r[1] for r in df.select("_metadata.file_path", "_metadata.file_modification_time").distinct().collect()}


def test_a_merge_leaves_other_buckets_alone(spark, frame):
    table = tables.work_table(spark, "test-merge")
    base = spark.range(5000).selectExpr("id", "id * 2 as v", "cast(null as string) as note")
    tables.create_merged(base, table, ["id"], NOW, n_buckets=16)
    physical = tables.current_version(spark, table).physical
    before = files_of(spark.table(physical))
    source = frame([(3, -1, "late"), (9000, -2, None)], "id long, v long, note string")
    done = tables.merge_table(table, source, lambda held, new: changes.delete_insert(held, new, "id"), NOW, NOW + timedelta(hours=1))
    after = files_of(spark.table(physical))
    kept = {f for f in before if after.get(f) == before[f]}
    assert 1 <= len(done.buckets) <= 2 and len(kept) >= 14 and done.rows_arrived == 2 and done.rows_after == done.rows_before + 1
    got = tables.read_table(spark, table)
    assert got.count() == 5001 and rows(got.where("id in (3, 4, 9000)")) == [(3, -1, "late"), (4, 8, None), (9000, -2, None)]
    assert tables.current_version(spark, table).mark == NOW + timedelta(hours=1)
    again = tables.merge_table(table, source, lambda held, new: changes.delete_insert(held, new, "id"), NOW)
    assert again.rows_after == again.rows_before and got.count() == 5001
    assert tables.current_version(spark, table).mark == NOW + timedelta(hours=1), "a merge without a mark keeps the old one"


def test_a_merge_reads_its_buckets_only(spark, frame):
    table = tables.work_table(spark, "test-pruned")
    tables.create_merged(spark.range(1000).selectExpr("id", "id as v"), table, ["id"], NOW, bucket_expr="id div 100")
    seen = []

    def combine(held, new):
        seen.append(held._jdf.queryExecution().executedPlan().toString())
        return changes.delete_insert(held, new, "id")

    done = tables.merge_table(table, frame([(250, 0), (None, 1)], "id long, v long"), combine, NOW)
    assert done.buckets == (-1, 2) and done.rows_before == 100
    assert "PartitionFilters: [_key_bucket" in seen[0] and "IN (-1,2)" in seen[0].replace(", ", ",").replace("_key_bucket#", "_key_bucket#")
    assert tables.merge_table(table, frame([], "id long, v long"), combine, NOW).buckets == ()


def test_a_hot_key_bucket_is_written_by_many_tasks(spark):
    """Half of the rows share one key; the layout is rebalanced, not one task per bucket."""
    table = tables.work_table(spark, "test-hot")
    base = spark.range(400_000).selectExpr("case when id % 2 = 0 then 7 else id end as k", "uuid() as v")
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        tables.create_merged(base, table, ["k"], NOW, n_buckets=4)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    physical = spark.table(tables.current_version(spark, table).physical)
    hot = physical.where("k = 7").select("_metadata.file_path").distinct().count()
    assert hot > 2 and physical.count() == 400_000


def test_clustered_tables_join_without_exchange(spark):
    names = [tables.work_table(spark, "test-cluster") for _ in range(2)]
    for name in names:
        tables.overwrite_table(spark.range(100).selectExpr("id", "id + 1 as v"), name, NOW, cluster_by=["id"], clusters=4)
    one, two = (tables.read_table(spark, n) for n in names)
    joined = one.join(two.withColumnRenamed("v", "w").hint("merge"), "id").groupBy("id").agg(F.sum("w").alias("w"))
    assert joined.count() == 100
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_buckets_grow_with_the_rows_and_have_one_file_each(spark):
    assert [tables.cluster_count(spark.range(n), rows_each=100) for n in (0, 800, 801, 3200, 3201)] == [8, 8, 16, 32, 64]
    table = tables.work_table(spark, "test-buckets")
    tables.overwrite_table(spark.range(0, 5_000_000, 1, 3), table, NOW, cluster_by=["id"])
    physical = spark.table(tables.current_version(spark, table).physical)
    sizes = [r["count"] for r in physical.groupBy("_metadata.file_path").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 1 << 19 and sum(sizes) == 5_000_000


def test_parallel_log_lines_all_arrive(spark):
    path = work_path(spark, "test-logs")
    line = lambda k: logs.log_run(spark, path, run_id="r", step="s", entity=f"e{k}", stage="x", started_at=NOW, ended_at=NOW)
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(line, range(24)))
    assert tables.read_bronze(spark, path).select("entity").distinct().count() == tables.read_bronze(spark, path).count() == 24


def test_a_batch_that_is_tried_again_replaces_itself(spark, frame):
    path = work_path(spark, "test-batch")
    for _ in range(2):
        tables.append_bronze(frame([(1,), (2,)], "v int"), path, "2025-01-01")
    tables.append_bronze(frame([(3,)], "v int"), path, "2025-01-02")
    assert rows(tables.read_bronze(spark, path)) == [(1,), (2,), (3,)]


def test_bronze_is_laid_out_by_load_day(spark, frame):
    path = work_path(spark, "test-days")
    for day in (1, 2, 3):
        tables.append_bronze(frame([(day, d(f"2025-01-0{day}"))], "v int, _load_date date"), path, f"b{day}")
    tables.append_bronze(frame([(4, d("2025-01-03"), "new")], "v int, _load_date date, extra string"), path, "b4")
    late = tables.read_bronze(spark, path, d("2025-01-03"))
    assert rows(late, "v", "_load_date") == [(3, d("2025-01-03")), (4, d("2025-01-03"))]
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_load_date" in plan
    assert len(late.inputFiles()) == 2 and tables.read_bronze(spark, path).count() == 4
    assert tables.read_bronze(spark, path, d("2026-01-01")).count() == 0


def test_compaction_keeps_layout_and_mark(spark, frame):
    merged, clustered = tables.work_table(spark, "test-layout"), tables.work_table(spark, "test-layout")
    rows_of = frame([(k, k % 3) for k in range(30)], "v int, g int").repartition(6)
    tables.create_merged(rows_of, merged, ["v"], NOW, NOW, bucket_expr="g")
    tables.overwrite_table(rows_of, clustered, NOW, NOW, cluster_by=["v"], clusters=3)
    tables.require_success(tables.compact_table(spark, {"m": merged, "c": clustered}, NOW))
    for table in (merged, clustered):
        version = tables.current_version(spark, table)
        assert version.number == 2 and version.mark == NOW and tables.read_table(spark, table).count() == 30
    done = tables.merge_table(merged, frame([(0, 0)], "v int, g int"), lambda held, new: changes.delete_insert(held, new, "v"), NOW)
    assert done.buckets == (0,) and done.rows_before == 10
    assert tables.current_version(spark, clustered).cluster_by == ("v",)


def test_malformed_change_values_do_not_stop_the_table(spark, frame, tmp_path):
    lake = daily.Lake(spark, str(tmp_path / "lake"))
    raw = frame([("1", "2025-01-01 00:00:00"), ("2", "no time")], "id string, u string").withColumn("_load_date", F.lit("2025-01-01"))
    tables.append_bronze(raw.withColumn("_ingested_at", F.lit(NOW)), lake.path("bronze", "s.t"))
    ticks = iter([NOW + timedelta(minutes=k) for k in range(9)])
    contract = TableContract("t", {"id": "int", "u": "timestamp"}, ("id",), "u", "s", "u")
    assert daily.process_entity(lake, contract, [], "r", NOW, clock=lambda: next(ticks)) == "Succeeded"
    log = lake.read("audit", "run_log").first()
    assert "1 change values" in log["message"] and log["ended_at"] > log["started_at"]
    assert (log["rows_in"], log["rows_out"]) == (2, 2), "a first load takes every row"


def test_a_run_reads_only_days_from_its_mark(spark, frame, tmp_path, monkeypatch):
    """Pruned bronze, no count of its own, lines and results from observed metrics."""
    lake = daily.Lake(spark, str(tmp_path / "lake"))
    contract = TableContract("t", {"id": "int", "v": "string", "u": "timestamp"}, ("id",), "u", "s", "u")
    checks = [Rule("accepted_values", "error", "v", values=("a", "b"))]

    def land(day, *found):
        raw = frame(list(found), "id string, v string, u string").withColumns({"_load_date": F.lit(d(day)), "_ingested_at": F.lit(NOW)})
        tables.append_bronze(raw, lake.path("bronze", "s.t"), day)

    land("2024-11-01", ("9", "a", "2024-11-01 08:00:00"), ("8", "a", "never"))
    land("2025-01-01", ("1", "a", "2025-01-01 08:00:00"), ("2", "x", "2025-01-01 09:00:00"))
    daily.process_entity(lake, contract, checks, "r1", NOW)
    land("2025-03-01", ("1", "b", "2025-03-01 08:00:00"), ("3", "a", "no time"), ("4", "a", "2025-03-01 08:00:00"), ("4", "a", "2024-03-01 08:00:00"))
    df, mark = daily.pending_rows(lake, contract, NOW)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert mark == ts("2025-01-01 09:00:00") and "PartitionFilters: [isnotnull(_load_date" in plan and len(df.inputFiles()) >= 1
    assert {f.split("_load_date=")[1][:10] for f in df.inputFiles()} == {"2025-01-01", "2025-03-01"}
    kind = type(df)
    monkeypatch.setattr(kind, "count", lambda self: pytest.fail("a count of its own"))
    daily.process_entity(lake, contract, checks, "r2", NOW)
    monkeypatch.undo()
    assert rows(lake.read("silver", "s.t"), "id", "v") == [(1, "b"), (4, "a"), (8, "a"), (9, "a")]
    assert rows(lake.read("audit", "run_log").where("run_id = 'r2'"), "rows_in", "rows_out", "rows_quarantined", "message") == [(2, 2, 0, "1 change values are no timestamp")]
    assert rows(lake.read("audit", "run_log").where("run_id = 'r1'"), "rows_in", "rows_out", "rows_quarantined") == [(4, 3, 1)]
    assert rows(lake.read("dq", "results"), "run_id", "failed_rows", "total_rows", "pass_rate") == [("r1", 1, 4, 0.75), ("r2", 0, 2, 1.0)]
    assert lake.read("dq", "quarantine").count() == 1
    assert not [r for r in spark.sql(f"SHOW TABLES IN {lake.database}").collect() if r["tableName"].startswith("stage_")]


def test_silver_takes_a_new_column(spark, frame, tmp_path):
    lake = daily.Lake(spark, str(tmp_path / "lake"))
    one = TableContract("t", {"id": "int", "u": "timestamp"}, ("id",), "u", "s", "u")
    two = TableContract("t", {"id": "int", "u": "timestamp", "w": "string"}, ("id",), "u", "s", "u")
    for day, contract, ddl, row in (("2025-01-01", one, "id string, u string", ("1", "2025-01-01 00:00:00")), ("2025-01-02", two, "id string, u string, w string", ("2", "2025-01-02 00:00:00", "x"))):
        tables.append_bronze(frame([row], ddl).withColumns({"_load_date": F.lit(d(day)), "_ingested_at": F.lit(NOW)}), lake.path("bronze", "s.t"), day)
        daily.process_entity(lake, contract, [], day, NOW)
    assert rows(lake.read("silver", "s.t"), "id", "w") == [(1, None), (2, "x")]


def test_long_messages_stay_whole(spark):
    path = work_path(spark, "test-long")
    logs.log_run(spark, path, run_id="r", step="s", entity="e", stage="x", message="m" * 9000, started_at=NOW, ended_at=NOW)
    assert len(tables.read_bronze(spark, path).first()["message"]) == 9000


def test_repeated_new_ids_get_one_key(spark, frame):
    dim = frame([(-1, "?", None), (1, "a", "x")], "k int, id string, note string")
    got = dimensions.assign_surrogate_keys(dim, frame([("b", "2"), ("b", "1"), ("a", "9"), (None, "0")], "id string, note string"), "id", "k")
    assert rows(got) == [(-1, "?", None), (1, "a", "x"), (2, "b", "1")]


def test_newest_row_with_a_tie(frame):
    df = frame([(2, NOW), (1, NOW), (0, None)], "id int, ts timestamp")
    assert aggregate.top_1(df, "ts", ["id"]).first()["id"] == 1


def test_measures_without_a_fact_that_has_all_keys(frame):
    grid = measures._key_grid([(frame([(1, 10), (2, 20)], "a int, m int"), ["a"]), (frame([(2, 5, 1), (3, 6, 1)], "a int, b int, n int"), ["a", "b"])], ["a", "b"])
    assert rows(grid) == [(2, 5), (3, 6)]
    with pytest.raises(ValueError, match="no fact"):
        measures._key_grid([(frame([(1,)], "m int"), [])], ["fiscal_year"])


def test_incremental_gold(spark, frame, tmp_path):
    lake = daily.Lake(spark, str(tmp_path / "lake"))
    ddl = "id int, v string, u timestamp"
    source = {"rows": [(1, "a", NOW), (2, "b", NOW)]}
    built = []

    def build(gold, mark):
        built.append(mark)
        df = frame(source["rows"], ddl)
        return df if mark is None else df.where(F.col("u") > F.lit(mark))

    step = daily.Step("fact", build, ("id",), lambda gold: max(r[2] for r in source["rows"]))
    daily.load_gold(lake, [step], "r1", NOW)
    daily.load_gold(lake, [step], "r2", NOW)  # nothing new: the target is not read, let alone rewritten
    source["rows"] = [(1, "a", NOW), (2, "late", NOW + timedelta(hours=1)), (3, "c", NOW + timedelta(hours=2))]
    daily.load_gold(lake, [step], "r3", NOW)
    assert built == [None, NOW]
    assert rows(lake.read("gold", "fact"), "id", "v") == [(1, "a"), (2, "late"), (3, "c")]
    log = rows(lake.read("audit", "load_log"), "run_id", "rows_inserted", "rows_updated", "rows_deleted")
    assert log == [("r1", 2, 0, 0), ("r2", 0, 0, 0), ("r3", 1, 1, 0)]
    assert tables.current_version(spark, lake.table("gold", "fact")).mark == NOW + timedelta(hours=2)


def test_identities_between_silver_and_gold(spark, frame, tmp_path):
    from test_model import PEOPLE
    lake = daily.Lake(spark, str(tmp_path / "lake"))
    people = lambda lake: frame([("s", "1", "Ann", "Lee", "1", "a@x.org", "addr", d("2020-01-01"), 1), ("s", "2", "Ann", "Lee", "1", "A@x.org", None, d("2019-01-01"), 2)], PEOPLE)
    step = daily.Step("patron", lambda gold: lake.read("silver", "people"))
    daily.run_daily(lake, Contracts((), {}), [step], "r1", NOW, identities=people)
    daily.run_daily(lake, Contracts((), {}), [step], "r2", NOW, identities=people)
    assert lake.read("silver", "person_xref").count() == 2 and lake.read("gold", "patron").count() == 1
    assert lake.read("audit", "run_log").where("entity = 'people'").count() == 2


def test_sheets_with_mixed_layouts(spark, tmp_path):
    for name, text in (("a.csv", "id,n\n1,5\n"), ("b.CSV", 'n,"id",extra\n7,2,z\n,3,\n'), ("c.txt", "x")):
        (tmp_path / name).write_text(text, encoding="utf-8")
    got = sheets.read_sheet_folder(spark, str(tmp_path), ["id", "n"], {}, {"id": "int", "n": "int"}, "id")
    assert rows(got, "id", "n", "source_file") == [(1, 5, "a.csv"), (2, 7, "b.CSV"), (3, None, "b.CSV")]
    empty = os.path.join(tmp_path, "empty")
    os.makedirs(empty)
    assert sheets.read_sheet_folder(spark, empty, ["id", "n"], {}, {"id": "int"}, "id").count() == 0


def test_a_stream_that_restarts_and_replays_a_batch(spark, frame, tmp_path):
    from boxledger.streaming import batch_upsert, stream_upsert
    folder, table, ddl = str(tmp_path / "in"), tables.work_table(spark, "test-stream"), "id long, v string, version int"

    def deliver(*found):
        frame(list(found), ddl).coalesce(1).write.mode("append").json(folder)
        run = stream_upsert(spark, folder, ddl, table, ["id"], "version", str(tmp_path / "checkpoint"), NOW)
        run.awaitTermination()
        assert run.exception() is None

    deliver((1, "a", 1), (2, "b", 1), (1, "newer", 2))
    deliver((2, "late", 0), (3, "c", 1), (1, "newest", 3))
    want = [(1, "newest", 3), (2, "b", 1), (3, "c", 1)]
    assert rows(tables.read_table(spark, table), "id", "v", "version") == want
    assert tables.table_property(spark, table, "stream.landing") == "1"
    # The commit of the last batch is lost: the restart plans it again with the same number.
    for name in ("1", ".1.crc"):
        (tmp_path / "checkpoint" / "commits" / name).unlink(missing_ok=True)
    before = tables.current_version(spark, table)
    deliver((4, "d", 1))
    assert rows(tables.read_table(spark, table), "id", "v", "version") == [*want, (4, "d", 1)]
    assert tables.current_version(spark, table).number == before.number + 1, "the replayed batch was left out"
    # Died between rows and number: merged again, same rows.
    tables.set_property(spark, table, "stream.landing", "0")
    batch_upsert(table, ["id"], "version", NOW, "landing")(frame([(2, "late", 0), (3, "c", 1), (1, "newest", 3)], ddl), 1)
    assert rows(tables.read_table(spark, table), "id", "v", "version") == [*want, (4, "d", 1)]
