from __future__ import annotations

from decimal import Decimal as D

import pytest

from boxledger.contracts import Rule, TableContract, load_contracts
from boxledger.operators import changes, clean, quality
from conftest import d, rows, ts

NOW = "2025-01-10 00:00:00"


def test_conform(frame):
    raw = frame([(" 7 ", "abc", "1.005", "2026-1-3", " A@B.Org ", "x", "m"), ("", None, "bad", "never", "", "y", None)],
                "id string, n string, amount string, day string, email string, extra string, _meta string")
    typed = clean.conform(raw, {"id": "int", "n": "int", "amount": "decimal(12,2)", "day": "date", "email": "string", "missing": "boolean"})
    assert typed.columns == ["id", "n", "amount", "day", "email", "missing", "_meta"]
    assert rows(typed) == [(7, None, D("1.01"), d("2026-01-03"), "a@b.org", None, "m"), (None,) * 7]


def test_latest_per_key(frame):
    df = frame([(1, "a", 5, 1), (1, "b", None, 9), (1, "c", 5, 2), (2, "d", None, 1), (3, "e", 1, 1), (3, "f", 1, 1)], "k int, v string, o int, _ingested_at int")
    assert rows(changes.latest_per_key(df, ["k"], "o"), "k", "v") == [(1, "c"), (2, "d"), (3, "f")]


def test_latest_per_key_keeps_one_row_per_task_before_the_shuffle(frame):
    plan = changes.latest_per_key(frame([(1, 2)], "k int, o int"), ["k"], "o")._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in before_shuffle


def test_filter_pending_is_strict_and_skips_null(frame):
    df = frame([(1, ts("2025-01-01 00:00:00")), (2, ts("2025-01-02 00:00:00")), (3, None)], "k int, u timestamp")
    assert rows(clean.filter_pending(df, "u", "2025-01-01 00:00:00"), "k") == [(2,)]
    assert clean.filter_pending(df, "u", None).count() == 3


def test_add_missing_meta(frame):
    df = frame([(ts("2025-01-01 05:00:00"),)], "u timestamp")
    row = clean.add_missing_meta(df, "u", NOW).first()
    assert (row["_ingested_at"], row["_load_date"]) == (ts("2025-01-01 05:00:00"), d("2025-01-01"))
    assert clean.add_missing_meta(df, None, NOW).first()["_ingested_at"] == ts(NOW)


RULES = [Rule("not_null", "error", "id"), Rule("regex", "warn", "email", pattern="^[^@]+@[^@]+$", allow_null=True), Rule("regex", "error", "zip", pattern="^[0-9]{5}$"),
         Rule("accepted_values", "error", "kind", values=("A", "B")), Rule("range", "error", "amount", min=0, max=10), Rule("not_future", "error", "day"),
         Rule("expression", "error", None, check="NOT (amount > 5 AND kind = 'A')"), Rule("foreign_key", "error", "ref", ref_entity="s.ref", ref_column="id"),
         Rule("foreign_key", "error", "ref", ref_entity="s.absent", ref_column="id")]
DDL = "id int, email string, zip string, kind string, amount int, day date, ref int"
GOOD = (1, "a@b", "10001", "A", 1, d("2025-01-01"), 7)


def gate(frame, data, rules=RULES):
    refs = {"s.ref": frame([(7,), (7,), (None,)], "id int")}
    return quality.apply_dq(frame(data, DDL), "s.t", rules, restricted=["email"], references=refs, run_id="r", as_of=NOW)


@pytest.mark.parametrize("change, failed", [
    ({}, None), ({"id": None}, "not_null:id"), ({"zip": None}, "regex:zip"), ({"zip": "1"}, "regex:zip"), ({"kind": "C"}, "accepted_values:kind"), ({"amount": 11, "kind": "B"}, "range:amount"),
    ({"amount": 10, "kind": "B"}, None), ({"day": d("2025-02-01")}, "not_future:day"), ({"day": None}, None), ({"amount": 6}, "expression:None"), ({"ref": 8}, "foreign_key:ref"), ({"ref": None}, None),
    ({"email": "bad"}, None), ({"kind": None, "amount": 6}, "expression:None"), ({"id": None, "zip": "1"}, "not_null:id,regex:zip"),
])
def test_each_rule(frame, change, failed):
    names = [c.split()[0] for c in DDL.split(", ")]
    data = tuple(change.get(n, v) for n, v in zip(names, GOOD))
    result = gate(frame, [data])
    assert result.valid.count() == (failed is None)
    assert [r["failed_rules"] for r in result.quarantine.collect()] == ([] if failed is None else [failed])


def test_gate_counts_routes_and_hides(frame):
    bad = (None, "a@b", "10001", "A", 1, d("2025-01-01"), 7)
    warned = (2, "nobody", "10001", "A", 1, d("2025-01-01"), 7)
    result = gate(frame, [GOOD, bad, warned])
    assert result.valid.count() + result.quarantine.count() == 3
    lines = {(r["rule"], r["column_name"]): r for r in result.results.collect()}
    assert len(lines) == len(RULES) - 1, "a rule on a missing reference table leaves no result"
    assert lines["not_null", "id"]["failed_rows"] == 1 and lines["regex", "email"]["failed_rows"] == 1
    assert lines["not_null", "id"]["pass_rate"] == pytest.approx(2 / 3)
    record = result.quarantine.first()["record"]
    assert "a@b" not in record and '"zip":"10001"' in record


def test_gate_without_rules_or_rows(frame):
    assert gate(frame, [GOOD], []).results is None
    assert {r["pass_rate"] for r in gate(frame, []).results.collect()} == {1.0}


def hashed(frame, data):
    return clean.with_row_hash(frame(data, "k int, v string, at int"), ["k", "v"])


def test_upsert(frame):
    old, new = hashed(frame, [(1, "a", 1), (2, "b", 1)]), hashed(frame, [(1, "a", 2), (2, "B", 2), (3, None, 2)])
    once = changes.upsert(old, new, ["k"])
    assert rows(once, "k", "v", "at") == [(1, "a", 1), (2, "B", 2), (3, None, 2)]
    assert rows(changes.upsert(once, new, ["k"]), "k", "v", "at") == rows(once, "k", "v", "at"), "applying twice changes nothing"
    assert rows(changes.upsert(old, new.limit(0), ["k"])) == rows(old)
    assert rows(changes.upsert(None, new, ["k"])) == rows(new)


def test_upsert_older_version_arriving_later(frame):
    held, late = hashed(frame, [(1, "new", 5)]), hashed(frame, [(1, "old", 3)])
    assert rows(changes.upsert(held, late, ["k"]), "v") == [("old",)]
    assert rows(changes.upsert(held, late, ["k"], newest_wins="at"), "v") == [("new",)]


def test_upsert_null_safe(frame):
    old = frame([(1, None), (2, "x"), (3, None)], "k int, v string")
    new = frame([(1, None), (2, None), (3, "y"), (4, None)], "k int, v string")
    tagged = changes.upsert_null_safe(old, new, ["k"], ["v"])
    assert rows(tagged) == [(1, None, "same"), (2, None, "update"), (3, "y", "update"), (4, None, "insert")]
    assert tuple(changes.change_counts(tagged).first()) == (1, 2)


def test_delete_insert(frame):
    old = frame([(1, "a"), (2, "b")], "k int, v string")
    staged = frame([(2, "B"), (3, "c")], "k int, v string")
    assert rows(changes.delete_insert(old, staged, "k")) == [(1, "a"), (2, "B"), (3, "c")]
    assert rows(changes.delete_insert(None, staged, "k")) == rows(staged)


def test_marks(frame):
    a = frame([(ts("2025-01-01 00:00:00"),)], "u timestamp")
    b = frame([(ts("2025-01-05 00:00:00"),), (None,)], "u timestamp")
    marks = changes.set_mark(None, "fact.x", changes.next_mark((a, "u"), (b, "u")), NOW)
    assert changes.get_mark(marks, "fact.x") == ts("2025-01-05 00:00:00")
    assert changes.get_mark(marks, "other") == ts("1900-01-01 00:00:00") == changes.get_mark(None, "fact.x")
    unchanged = changes.set_mark(marks, "fact.x", changes.next_mark((a.limit(0), "u")), NOW)
    assert changes.get_mark(unchanged, "fact.x") == ts("2025-01-05 00:00:00")


def test_contracts(tmp_path):
    with pytest.raises(ValueError):
        TableContract("t", {"a b": "int"}, ("a b",), "a b")
    with pytest.raises(ValueError):
        Rule("wish", "error", "x")
    sources = tmp_path / "s.json"
    sources.write_text('{"sources": [{"source": "box", "refresh": "weekly", "entities": [{"name": "t", "columns": {"id": "int", "u": "timestamp"}, "primary_key": "id", "order_by": "u"}]}]}')
    rules = tmp_path / "r.json"
    rules.write_text('{"rules": {"box.t": [{"rule": "range", "column": "id", "min": 1, "severity": "warn"}]}}')
    loaded = load_contracts(str(sources), str(rules))
    assert loaded.sources[0].sla_hours == 192 and loaded.tables()["box.t"].primary_key == ("id",)
    assert loaded.rules["box.t"][0].min == 1
    assert loaded.tables()["box.t"].schema.fieldNames() == ["id", "u"]
