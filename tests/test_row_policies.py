"""Row rules as SQL table functions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from boxledger.plans import row_policies
from conftest import rows

GIFTS = [(1, False, 5), (2, True, 7), (3, None, 9), (4, False, 1)]
READERS = "user_principal_name string, sees_gifts boolean, by_venue boolean"


@pytest.fixture
def policy(frame):
    readers = frame([("head", True, False), ("clerk", True, False), ("box", False, False), ("hall", True, True), ("head", True, False)], READERS)
    row_policies.gift_policy(frame(GIFTS, "gift_id int, is_anonymous boolean, amount int"), readers, frame([("head",), (None,)], "user_principal_name string"))
    row_policies.venue_policy(frame([("V1", 10), ("V2", 20), (None, 30)], "venue_id string, capacity int"), readers, frame([("hall", "V2")], "user_principal_name string, venue_id string"))
    return lambda name, reader: row_policies.read_as(readers.sparkSession, name, reader)


def test_gifts_by_reader(policy):
    assert rows(policy("gifts_for", "head"), "gift_id") == [(1,), (2,), (3,), (4,)]
    assert rows(policy("gifts_for", "clerk"), "gift_id") == [(1,), (4,)], "anonymous and unknown gifts are hidden"
    assert rows(policy("gifts_for", "box")) == [] and rows(policy("gifts_for", "nobody")) == []
    assert rows(policy("gifts_for", "x' OR 'a' = 'a")) == [], "the name is a value, not SQL"


def test_venues_by_reader(policy):
    assert rows(policy("performances_for", "hall"), "venue_id") == [("V2",)]
    assert rows(policy("performances_for", "head"), "capacity") == [(10,), (20,), (30,)]


def test_the_rule_is_inlined(policy, spark, tmp_path, frame):
    """A caller's filter and columns reach the scan; no join with the list of readers."""
    frame(GIFTS, "gift_id int, is_anonymous boolean, amount int").write.parquet(str(tmp_path / "gifts"))
    row_policies.gift_policy(spark.read.parquet(str(tmp_path / "gifts")), frame([("head", True, False)], READERS), frame([("head",)], "user_principal_name string"))
    seen = policy("gifts_for", "head").where("gift_id > 2").select("gift_id")
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(gift_id,2)" in plan and "amount" not in plan.split("ReadSchema")[1].split("\n")[0] and "Join" not in plan
    assert rows(seen) == [(3,), (4,)]


def test_names_are_checked(frame):
    with pytest.raises(ValueError):
        row_policies.create_row_policy(frame([(1,)], "v int"), "bad name", "true", {})
    row_policies.create_row_policy(frame([(1,)], "v int"), "open_for_all", "true", {})
    assert row_policies.read_as(frame([(1,)], "v int").sparkSession, "open_for_all", "x").agg(F.sum("v")).first()[0] == 1
