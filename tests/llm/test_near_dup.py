from __future__ import annotations

import random
from collections import Counter
from unittest.mock import Mock

import pyarrow as pa
import pytest

from boxledger.llm import near_dup, workers
from boxledger.llm.graph import components
from helpers import ODD, frame, lowered, prose


def shingles(text):
    w = lowered(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows, percent):
    sets = {}
    for d, t in rows:
        sets[d] = shingles(t)
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = list(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            same = len(sets[a] & sets[b])
            if same and 100 * same >= percent * (len(sets[a]) + len(sets[b]) - same):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def edited(text, changes, seed):
    rng = random.Random(seed)
    w = text.split(" ")
    for _ in range(changes):
        w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
    return " ".join(w)


def corpus():
    base, passage = prose(5, 150), prose(9, 40)
    rows = [(k, edited(base, k % 5, k)) for k in range(100, 140)]  # a family longer than a short list, with outliers
    rows += [(k, passage + " " + prose(k, 30)) for k in range(200, 230)]  # a shared passage, no links
    rows += [(k, prose(k // 2, 80)) for k in range(300, 320)]  # exact pairs
    rows += [(400, prose(77, 90).upper()), (401, prose(77, 90)), (402, "two words"), (403, "Two Words"), (404, "a b c d e f"), (405, "a b c d e")]
    chain = prose(50, 200).split(" ")
    rows += [(500 + k, " ".join(chain[3 * k:3 * k + 120])) for k in range(8)]  # each like the next, the ends unlike
    return rows


def test_components_match_brute_force(spark):
    for percent in (80, 85):
        want = brute(corpus(), percent)
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(frame(spark, corpus()), percent=percent).collect()}
        assert got == {d: (n, c, c == d) for d, (n, c) in want.items()}
        assert max(Counter(c for _, c in want.values()).values()) > near_dup.SHORT_LIST


def family(n, words, changes, copies=1):
    """Copies of one text with edits, as far from each other as from the threshold, and copies of those copies."""
    base = prose(31, words)
    out = []
    for k in range(n):
        text = edited(base, changes[k % len(changes)], 1000 + k)
        out += [text] + [edited(text, 1, 5000 + 10 * k + c) for c in range(copies - 1)]
    return out


def check(spark, texts, percent=85):
    rows = list(enumerate(texts))
    want = brute(rows, percent)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(frame(spark, rows), percent=percent).collect()}
    assert got == want
    return want


def test_a_family_whose_members_are_mostly_outside(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "FEW_OUTSIDE", 8)
    want = check(spark, family(90, 150, [2, 3, 4, 5, 6]))
    assert len({c for _, c in want.values()}) > 30, "many are linked with nobody"


def test_families_within_a_family(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "FEW_OUTSIDE", 8)
    want = check(spark, family(12, 150, [6], copies=22))  # lists of shingles that the centre lacks are long themselves
    assert max(Counter(c for _, c in want.values()).values()) >= 20 and len({c for _, c in want.values()}) >= 8


def test_members_that_only_lack_shingles(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "FEW_OUTSIDE", 8)
    """Shorter copies of one text: what they share lies in the centre, so sizes find them."""
    base = prose(41, 160).split(" ")
    texts = [" ".join(base)] + [" ".join(base[k:k + 120 + k % 11]) for k in range(0, 40)] * 2
    check(spark, texts)


def test_the_last_round_compares_with_everyone(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "ROUNDS", 0)
    check(spark, family(40, 150, [3, 5], copies=2))


def test_pairs_of_a_family_grow_with_its_members(spark, monkeypatch):
    """Candidate pairs of a family without inner links: a few per member, not all of them."""
    monkeypatch.setattr(near_dup, "FEW_OUTSIDE", 8)
    made = []
    links = near_dup._Linker.links

    def counted(self, pairs):
        made.append(pairs.count())
        return links(self, pairs)

    monkeypatch.setattr(near_dup._Linker, "links", counted)
    n = {}
    for size in (60, 240):
        made.clear()
        rows = list(enumerate(family(size, 150, [5, 6])))
        near_dup.near_duplicates(frame(spark, rows), percent=85).count()
        n[size] = sum(made)
    assert n[240] < 8 * n[60] and n[240] < 240 * 239 / 8


def test_members_of_many_long_lists_are_listed_once(spark):
    """Nodes in three long lists of three centres: each gives the rarest two of its nine common shingles, once."""
    sets = spark.createDataFrame([(1, list(range(10))), (2, [*range(9), 20]), (3, list(range(30, 40)))], "node long, values array<long>")
    member = spark.createDataFrame([(v, v + 100, n, 10, n, n > 1) for v in range(3) for n in (1, 2, 3)],
                                   "value long, centre long, node long, n_shingles long, label long, outside boolean")
    got = sorted((r.node, r.value) for r in near_dup._rarest(member, sets, 80).collect())
    assert got == [(1, 0), (1, 1), (2, 0), (2, 1)]


def test_pairs_at_exactly_the_threshold(spark):
    """One text extends the other: 5 shingles against 4, 10 against 8 and so on are 0.8 alike."""
    rows = []
    for n in range(5, 40, 5):
        w = [f"t{n}x{k}" for k in range(n + 4)]
        rows += [(10 * n, " ".join(w)), (10 * n + 1, " ".join(w[:4 * n // 5 + 4]))]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(frame(spark, rows), percent=80).collect()}
    assert got == brute(rows, 80) == {d: (n, 10 * n) if d == 10 * n else (4 * n // 5, 10 * n) for n in range(5, 40, 5) for d in (10 * n, 10 * n + 1)}


def test_odd_rows(spark):
    got = near_dup.near_duplicates(frame(spark, ODD)).collect()
    assert len(got) == len(ODD)
    by = {r.doc_id: r for r in got}
    assert [by[k].n_shingles for k in (1, 2, 3, 4, 5)] == [0, 0, 0, 1, 1]
    assert all(by[k].component_id == k and by[k].kept for k in (1, 2, 3, 4, 5, 7, 8, 9, 10))
    assert by[None].component_id is None and not by[None].kept


def test_empty_table(spark):
    assert near_dup.near_duplicates(frame(spark, []).filter("false")).collect() == []


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101)], "a long, b long")
    got = {r.node: r.label for r in components(edges).collect()}
    assert got == {**{k: 0 for k in range(61)}, 100: 100, 101: 100}


def test_long_text(spark):
    rows = [(1, prose(1, 30_000, 5000)), (2, prose(1, 30_000, 5000) + " tail"), (3, "x y z")]
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(frame(spark, rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_only_marked_keeps_every_key_and_little_else(spark):
    from boxledger.llm.workers import only_marked

    df = spark.range(-5000, 5000).selectExpr("id AS doc_id", "id AS text").union(spark.createDataFrame([(None, 0)], "doc_id long, text long"))
    keys = df.filter("doc_id % 97 = 0 or doc_id = 4999").select("doc_id")
    got = {r.doc_id for r in only_marked(df, keys, "doc_id").collect()}
    want = {r.doc_id for r in keys.collect()}
    assert want <= got and len(got) <= len(want) + 5
    assert only_marked(df, keys.filter("false"), "doc_id").collect() == []


@pytest.mark.parametrize("columns", [["doc_id", "text"], ["node", "text"]])
def test_shingles_are_sent_by_slices_of_text(spark, columns, monkeypatch):
    """A batch of texts goes out in several, so that a task never holds the sets of all its rows."""
    docs, runs = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, 4]), pa.array([prose(k, 40) for k in range(3)] + [None])], columns), []
    monkeypatch.setattr(near_dup, "map_arrow", lambda df, run, schema: runs.append(run))
    monkeypatch.setattr(near_dup, "SLICE_BYTES", 200)
    if columns[0] == "node":
        near_dup.full_sets(Mock(), size=5)
    else:
        near_dup.sketches(frame(spark, [(1, "a")]), k=8, size=5, id_col="doc_id", text_col="text")
    sent = list(runs[0]([docs]))
    assert len(sent) >= 3 and [x for b in sent for x in b.column(0).to_pylist()] == [1, 2, 3, 4]


def test_tasks_give_memory_back(monkeypatch):
    times = []
    monkeypatch.setattr(workers.pa, "default_memory_pool", lambda: Mock(release_unused=lambda: times.append(1)))
    assert list(workers.released(lambda batches: iter(batches))(["a", "b"])) == ["a", "b"] and len(times) == 3
