from __future__ import annotations

import hashlib
from collections import Counter

import pytest

from boxledger.llm import substring_dedup
from helpers import ODD, frame, prose, words


def brute(rows, length):
    texts = [words(t) for _, t, *_ in rows]
    seen = Counter(tuple(w[i:i + length]) for w in texts for i in range(len(w) - length + 1))
    out = []
    for (d, *_), w in zip(rows, texts):
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i:i + length])] > 1:
                gone[i:i + length] = [True] * length
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


def key(r):
    return tuple(str(x) for x in r)


@pytest.mark.parametrize(("length", "minimiser"), [(35, 4), (8, 3), (4, 4)])
def test_matches_brute_force(spark, length, minimiser):
    passage = prose(3, 60)
    rows = ODD + [(20 + k, f"{prose(100 + k, 50)} {passage if k % 2 else ''} {prose(200 + k, 30)}") for k in range(12)]
    rows += [(50, "go " * 120), (51, passage), (52, passage[:200] + " " + passage), (53, "x " + prose(3, 60)), (54, prose(8, 34)), (55, prose(8, 35)), (56, prose(8, 35))]
    got = substring_dedup.dedup_substrings(frame(spark, rows), length=length, minimiser=minimiser, with_text=True).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows, length), key=key)


def test_many_flushes_and_an_empty_table(spark, monkeypatch):
    rows = [(k, prose(k // 2, 90)) for k in range(30)]
    monkeypatch.setattr(substring_dedup, "FLUSH_BYTES", 500)
    got = substring_dedup.dedup_substrings(frame(spark, rows)).collect()
    assert sorted(tuple(r) for r in got) == sorted(r[:4] for r in brute(rows, 35))
    assert substring_dedup.dedup_substrings(frame(spark, []).filter("false")).collect() == []


def phrase_rows(n):
    """A third of the rows hold one short phrase among other words; some of them share longer passages too."""
    import pyarrow as pa
    from boxledger.llm.textbytes import split_words, windows
    part = next(iter(split_words(pa.array([f"p{k} q{k} r{k} s{k}" for k in range(4000)]))))
    phrase = f"p{(k := int(windows(part.hashes(), part.bounds, 4)[0].argmin()))} q{k} r{k} s{k}"  # its hash is small, so it is a minimiser
    rows = [(k, f"{prose(1000 + k, 40)} {phrase if k % 3 == 0 else ''} {prose(5000 + k, 40)}") for k in range(n)]
    return rows + [(n + k, f"{prose(9000 + k, 10)} {rows[k][1]} {prose(9500 + k, 10)}") for k in range(0, n, 7)]


def test_a_phrase_in_a_third_of_the_rows_is_dealt_by_windows(spark, monkeypatch):
    rows = phrase_rows(300) + ODD
    monkeypatch.setattr(substring_dedup, "HOT_BYTES", 6000)
    monkeypatch.setattr(substring_dedup, "HOT_WINDOWS", 200)
    docs = frame(spark, rows).select("text")
    hot = substring_dedup.hot_buckets(docs, length=35, minimiser=4, buckets=64)
    assert hot and all(n >= 2 for n in hot.values())
    got = substring_dedup.dedup_substrings(frame(spark, rows), with_text=True).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows, 35), key=key)


def test_no_part_holds_more_than_its_share(spark, monkeypatch):
    """Strings of the hot buckets leave them; the parts of their windows stay near the wanted size."""
    monkeypatch.setattr(substring_dedup, "HOT_BYTES", 40_000)
    monkeypatch.setattr(substring_dedup, "HOT_WINDOWS", 500)
    docs = frame(spark, phrase_rows(600)).selectExpr("doc_id as key", "text")
    hot = substring_dedup.hot_buckets(docs, length=35, minimiser=4, buckets=64)
    assert hot
    windows_of = sum(hot.values())
    import pyarrow as pa
    monkeypatch.setattr(substring_dedup, "_window_ranges", lambda rows, length: pa.RecordBatch.from_arrays(
        [pa.array([-sum(r[1] for r in rows)]), pa.array([0]), pa.array([0])], ["key", "begin", "end"]))
    found = substring_dedup.ranges(docs, length=35, minimiser=4, buckets=64).filter("key < 0").collect()
    sizes = [-r.key for r in found]
    assert len(sizes) <= windows_of and max(sizes) < 3 * 500


def test_a_very_long_text(spark):
    text = prose(5, 60_000) + " " + prose(6, 200) + " " + prose(7, 100) + " " + prose(6, 200)
    rows = [(1, text), (2, prose(8, 50))]
    got = substring_dedup.dedup_substrings(frame(spark, rows)).collect()
    assert sorted(tuple(r) for r in got) == sorted(r[:4] for r in brute(rows, 35))
