"""Every stage against a brute-force version of it, on its own input."""

from __future__ import annotations

import os
from collections import defaultdict

import pytest

import corpus_pipeline
import oracle
from boxledger.llm import QUERIES, ORACLE_SQL
from helpers import frame, prose
from test_near_dup import brute as near_brute

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """The input of each stage and its output, written and read again."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.stored(stage(spark, docs, SF_DIR), f"test-{name}")
        out[name] = (docs, after)
        docs = after
    return out


def test_columns_stay(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_copies", "decontaminate", "packed"]
    assert all(after.columns == COLUMNS for name, (_, after) in stages.items() if name != "packed")


def test_quality_stage(spark, stages):
    before, after = stages["quality"]
    labels = dict(map(tuple, spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", "quality").collect()))
    kept = {r.doc_id for r in after.collect()}
    for r in before.collect():
        if r.doc_id in labels:
            assert (r.doc_id in kept) == bool(labels[r.doc_id])


def test_near_copies_stage(stages):
    before, after = stages["near_copies"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    want = {d for d, (_, c) in near_brute(rows, 80).items() if c == d}
    assert {r.doc_id for r in after.collect()} == want


def test_packed_stage(stages):
    before, after = stages["packed"]
    got = defaultdict(int)
    loads = defaultdict(int)
    for r in after.collect():
        got[r.doc_id] += r.length
        loads[r.sequence_id] += r.length
        assert r.length > 0
    assert set(got) == {r.doc_id for r in before.collect()} and max(loads.values()) <= 1024


def test_run_joins_the_stages(spark, stages):
    pick = lambda df: sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert pick(corpus_pipeline.run(spark, SF_DIR)) == pick(stages["packed"][1])


def test_no_documents(spark):
    docs = frame(spark, [(1, prose(1, 60))]).select(*COLUMNS).filter("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_DIR).collect() == []


def test_ten_queries():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 11))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = oracle.connect(SF_DIR)
    assert oracle.differences(QUERIES[name](spark, SF_DIR), con, ORACLE_SQL[name]) is None
