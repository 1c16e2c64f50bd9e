"""Classifier, resampler and language model: held-out accuracy, brute-force bases, exact selection, awkward rows."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxledger.llm import gru, lm_scoring, quality, toxicity
from helpers import ODD, frame, lowered, prose


def labelled(spark, rows, name):
    return spark.createDataFrame([(d, v, "x") for d, v in rows], f"doc_id long, {name} int, text string")


def toxic_rows():
    rng = random.Random(4)
    rows, labels = [], []
    for k in range(600):
        w = prose(k, 40 + k % 60).split(" ")
        bad = k % 3 == 0
        if bad:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["grumph", "blarg"]) + rng.choice(["", "en", "os", "ity"]))
        rows.append((1000 + k, " ".join(w), "en" if k % 2 else "de", "s"))
        labels.append((1000 + k, int(bad)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = toxic_rows()
    docs = frame(spark, rows + [r if len(r) > 2 else (*r, "fr", "s") for r in ODD])
    labels = dict(labels)
    model = toxicity.fit(docs, labelled(spark, [x for x in labels.items() if x[0] % 5] + [(1001, None), (99, 1)], "toxic"))
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows) + len(ODD)
    held = [(r.score >= 0.5) == labels[r.doc_id] for r in got if r.doc_id in labels and r.doc_id % 5 == 0]
    assert sum(held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got)
    empty = {r.score for r in got if r.doc_id in (1, 2, 3)}
    assert len(empty) == 1 and empty.pop() < 0.5
    assert toxicity.score(docs.filter("false"), model).collect() == []


def test_toxicity_without_labels(spark):
    docs = frame(spark, ODD)
    model = toxicity.fit(docs, labelled(spark, [], "toxic"))
    assert all(0 <= r.score <= 1 for r in toxicity.score(docs, model).collect())


def test_toxicity_learns_from_every_labelled_row(spark):
    """More labels than any bounded sample took: the words of rows late in the order of the ids' hashes count too."""
    ids = spark.range(1, 9001).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"), F.xxhash64("id", F.lit("toxicity")).alias("key"))
    late = {r.doc_id for r in ids.filter("toxic = 1").orderBy("key", "doc_id").collect()[4000:]}
    text = lambda k: f"{prose(k, 6)} {'zorgle' if k in late else 'grumph' if k % 2 else 'kindly'} {prose(k + 1, 3)}"
    docs = frame(spark, [(k, text(k)) for k in range(1, 9001)])
    model = toxicity.fit(docs, ids.select("doc_id", "toxic"))
    new = frame(spark, [(1, f"{prose(7, 6)} zorgle {prose(8, 3)}"), (2, f"{prose(7, 6)} kindly {prose(8, 3)}")])
    found = {r.doc_id: r.score for r in toxicity.score(new, model).collect()}
    assert found[1] >= 0.5 > found[2]


def test_toxicity_in_several_shards(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 64)
    rows, labels = toxic_rows()
    labels = dict(labels)
    docs = frame(spark, rows)
    known = labelled(spark, [x for x in labels.items() if x[0] % 5], "toxic")
    models = [toxicity.fit(docs, known) for _ in range(2)]
    assert models[0] == models[1], "the same in every run"
    held = [(r.score >= 0.5) == labels[r.doc_id] for r in toxicity.score(docs, models[0]).collect() if r.doc_id % 5 == 0]
    assert sum(held) >= 0.95 * len(held)


def test_toxicity_shards_are_not_dealt_anew(spark, monkeypatch):
    """As many partitions train as there are shards, whatever the session's number of shuffle partitions."""
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 20)
    rows, labels = toxic_rows()
    known = labelled(spark, labels, "toxic").select("doc_id", F.col("toxic").alias("label"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "23")
        found = toxicity._labelled(frame(spark, rows), known, 3, 1 << 10, 1 << 10, 5, "doc_id", "text", "lang")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    parts = [r.asDict() for r in found.select(F.spark_partition_id().alias("part"), "shard").distinct().collect()]
    assert found.rdd.getNumPartitions() == 3
    assert sorted(r["shard"] for r in parts) == [0, 1, 2] and len({r["part"] for r in parts}) == 3


def test_pooling_sees_whole_windows_of_a_row_only():
    rng = np.random.default_rng(0)
    net = toxicity.Net(rng.normal(size=(50, 4)).astype(np.float32), np.zeros((50, 4), np.float32), rng.normal(size=(4, 12)).astype(np.float32),
                       np.zeros(6, np.float32), np.ones(6, np.float32), 0.0, 2, {})
    word = rng.integers(0, 50, 9)
    bounds = np.array([0, 4, 4, 5, 9])
    got = net.pooled(word, word, bounds)
    for k in range(4):
        own = net.words[word[bounds[k]:bounds[k + 1]]]
        want, block = [], 0
        for width in (1, 2, 3):
            each = [sum(own[t + j] @ net.filters[:, (block + j) * 2:(block + j + 1) * 2] for j in range(width) if t + j < len(own)) for t in range(len(own))]
            want += list(np.maximum(np.max(each, axis=0), 0)) if each else [0, 0]
            block += width
        assert np.allclose(got[k], want, atol=1e-5)


def quality_rows():
    rows, labels = [], []
    for k in range(300):
        junk = k % 5 == 0
        text = " ".join(f"{w.upper()}!!" for w in prose(k, 50).split(" ")) if junk else prose(k, 30 + k)
        rows.append((k + 100, text))
        labels.append((k + 100, 0 if junk else 1))
    return rows, labels


def test_quality_keeps_clean_rows(spark):
    rows, labels = quality_rows()
    docs = frame(spark, rows + [(d, t) for d, t, *_ in ODD])
    known = labelled(spark, labels[:150] + [(101, None), (5000, 1)], "quality")
    kept = quality.resample(docs, known)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert {d for d, v in labels if v} == {d for d, _ in labels if d in ids}
    weighed, least = quality.importance(docs, known, quality.fit(docs, known))
    out = weighed.collect()
    assert len(out) == len(rows) + len(ODD)
    assert {r.log_weight for r in out if r.doc_id in (1, 2, 3)} == {0.0}
    assert sorted(str(r.doc_id) for r in out if r.kept) == sorted(str(d) for d in ids.elements())


@pytest.mark.parametrize("k", [0, 1, 7, 10_000])
def test_gumbel_top_k_keeps_the_largest_keys(spark, k):
    rows, labels = quality_rows()
    docs, known = frame(spark, rows[:60]), labelled(spark, labels, "quality")
    out = quality.importance(docs, known, quality.fit(docs, known), k=k)[0].collect()
    want = sorted((r.key for r in out), reverse=True)[:k]
    assert sorted((r.key for r in out if r.kept), reverse=True) == want


def test_kth_largest_is_exact(spark):
    values = [-(1 << 63), -5, -5, -1, 0, 3, 3, 1 << 40, (1 << 63) - 1]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    assert [quality.kth_largest(df, "v", k) for k in range(1, 10)] == sorted(values, reverse=True)
    assert quality.kth_largest(df, "v", 10) is None and quality.kth_largest(df, "v", 0) is None


def test_words_count_beside_shapes(spark):
    """Two texts of the same shape and other words: the words of good rows weigh more."""
    good, bad = "quiet river boats along banks.", "cheap pills make happy money."
    rows = [(k, " ".join([good if k % 2 else bad] * 3)) for k in range(40)]
    docs, known = frame(spark, rows), labelled(spark, [(k, k % 2) for k in range(30)], "quality")
    model = quality.fit(docs, known)
    weight = {r.doc_id: r.log_weight for r in quality.importance(docs, known, model)[0].collect()}
    assert min(weight[k] for k in range(1, 40, 2)) > max(weight[k] for k in range(0, 40, 2))
    assert abs(weight[1]) > 1 and len({round(w, 6) for w in weight.values()}) == 2


def test_weights_by_hand(spark):
    """Counts and log ratios of both models recomputed in plain Python, from each row's own buckets."""
    import pyarrow as pa
    from boxledger.llm.textbytes import split_words
    buckets = 64
    rows = [(k, prose(k, 10 + k)) for k in range(12)] + [(20, None), (21, ""), (22, "one"), (23, prose(9, 5000))]
    labels = {k: k % 2 for k in range(10)}
    own = {}
    for d, text in rows:
        found = Counter()
        for part in split_words(pa.array([text], pa.string())):
            for bucket, _ in quality.grams(part, 3, buckets):
                found.update(bucket.tolist())
        own[d] = found
    raw, target = Counter(), Counter()
    for d, found in own.items():
        raw.update(found)
        if labels.get(d) == 1:
            target.update(found)
    weight = {}
    for first in (0, buckets):
        span = range(first, first + buckets)
        n_raw, n_target = sum(raw[b] for b in span), sum(target[b] for b in span)
        for b in span:
            weight[b] = math.log((target[b] + 1) / (n_target + buckets)) - math.log((raw[b] + 1) / (n_raw + buckets))
    docs, known = frame(spark, rows), labelled(spark, labels.items(), "quality")
    model = quality.fit(docs, known, buckets=buckets)
    for r in quality.importance(docs, known, model)[0].collect():
        assert math.isclose(r.log_weight, sum(n * weight[b] for b, n in own[r.doc_id].items()), abs_tol=1e-4)
        words = len((dict(rows)[r.doc_id] or "").split())
        assert sum(own[r.doc_id].values()) == sum(max(words - n, 0) for n in (0, 1, 2, 0, 1))


def test_quality_without_labels_or_rows(spark):
    docs = frame(spark, ODD)
    assert quality.resample(docs, labelled(spark, [], "quality")).count() == len(ODD)
    assert quality.resample(docs.filter("false"), labelled(spark, [(1, 1)], "quality")).collect() == []


def lm_rows():
    rng = random.Random(2)
    half = lambda k: " ".join(rng.choice([f"{'ab'[k % 2]}{n}" for n in range(30)] + [f"R{'ab'[k % 2]}{rng.randrange(400)}"]) for _ in range(60))
    return [(100 + k, half(k)) for k in range(400)]


def test_lm_bases_and_gain(spark):
    rows = lm_rows() + [(d, t) for d, t, *_ in ODD]
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    is_held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    got = lm_scoring.score(frame(spark, rows), held, head=200, short=64, share=0.3).collect()
    counts = Counter(x for d, t in rows if not is_held(d) for x in [*lowered(t), None])
    n, v = sum(counts.values()), len(counts)
    want = []
    for d, t in rows:
        w = [*lowered(t), None]
        want.append((d, is_held(d), len(w), sum(counts[x] > 0 for x in w), n, round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), 6)))
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=str) == sorted(want, key=str)
    tested = [r for r in got if r.held_out and r.doc_id >= 100]
    assert sum(r.score for r in tested) > sum(r.base_score for r in tested)
    assert all(r.score < 0 for r in got)


def test_lm_trains_on_every_training_row_once(spark, monkeypatch):
    """With the registered query's settings, and with a gain on held-out rows."""
    rows = lm_rows() + [(d, t) for d, t, *_ in ODD]
    seen, plain = Counter(), lm_scoring.map_arrow

    def spy(df, run, schema, *more, **named):
        if df.columns == ["text"] and "packed" in schema:
            seen.update(r.text for r in df.collect())
        return plain(df, run, schema, *more, **named)

    monkeypatch.setattr(lm_scoring, "map_arrow", spy)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    got = lm_scoring.score(frame(spark, rows), held).collect()
    assert seen == Counter(t or "" for d, t in rows if d is None or zlib.crc32(str(d).encode()) % 7 != 2)
    tested = [r for r in got if r.held_out and r.doc_id >= 100]
    assert sum(r.score for r in tested) > sum(r.base_score for r in tested)


def test_lm_without_rows_or_training_rows(spark):
    docs = frame(spark, ODD)
    assert lm_scoring.score(docs.filter("false"), F.lit(False), head=10, short=4).collect() == []
    assert {r.train_tokens for r in lm_scoring.score(docs, F.lit(True), head=10, short=4).collect()} == {0}


def tiny(seed=0):
    rng = np.random.default_rng(seed)
    net = gru.start(np.arange(8.0), np.arange(3.0), per_class=4, hidden=5)
    net.class_w[:] = rng.normal(size=net.class_w.shape)
    net.word_w[:] = rng.normal(size=net.word_w.shape)
    lengths = np.array([7, 1, 30, 3, 12, 1])
    n = lengths.sum()
    target = rng.integers(0, 11, n)
    return net, rng.integers(0, 12, n), np.where(target < 8, target // 4, 2 + target - 8), np.where(target < 8, target % 4, 0), lengths


def test_lanes_and_windows_do_not_change_scores():
    net, x, cls, word, lengths = tiny()
    want = gru.score(net, x, cls, word, lengths, n_lanes=1, window=1000)
    for n_lanes, window in ((1, 3), (3, 4), (6, 1), (10, 50)):
        assert np.allclose(gru.score(net, x, cls, word, lengths, n_lanes=n_lanes, window=window), want, atol=1e-4)
    one = np.concatenate([gru.score(net, x[a:b], cls[a:b], word[a:b], np.array([b - a])) for a, b in zip(np.cumsum(lengths) - lengths, np.cumsum(lengths))])
    assert np.allclose(one, want, atol=1e-4)


def test_probabilities_sum_to_one():
    net, *_ = tiny()
    h = np.random.default_rng(1).normal(size=(11, 5)).astype(np.float32)[:1].repeat(11, 0)
    target = np.arange(11)
    log_p, _, _ = gru._outputs(net, h, np.where(target < 8, target // 4, 2 + target - 8), np.where(target < 8, target % 4, 0), False)
    assert math.isclose(np.exp(log_p).sum(), 1, rel_tol=1e-5)


def test_first_step_of_a_window_learns_from_the_state_before_it():
    """Without learning in between, the slopes of two windows are those of each by itself, from the state that was carried."""
    net, x, cls, word, _ = tiny(5)
    x, cls, word = x[:6], cls[:6], word[:6]
    states = []
    plain = gru._forward

    def spy(net, x, first, state, keep):
        out, saved = plain(net, x, first, state, keep)
        states.append((state.copy(), saved))
        return out, saved

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(gru, "_forward", spy)
        gru.train(net, x, cls, word, np.array([6]), n_lanes=1, window=3)
    assert len(states) == 2 and states[1][0].any()
    for before, saved in states:
        assert np.allclose(saved.before[0], before)


def test_gradients_match_differences():
    """A tiny AdaGrad step moves every weight against the numeric slope of the loss."""
    net, x, cls, word, lengths = tiny(3)
    lengths = np.array([int(lengths.sum())])
    loss = lambda w: -gru.score(net.filled(w), x, cls, word, lengths).sum()
    flat = net.flat().astype(np.float64)
    big = np.full(flat.size, 1e12, np.float32)
    moved, _ = gru.train(net, x, cls, word, lengths, sums=big, n_lanes=1, window=1000, rate=1e6 * 8 * 1e-3)
    step = (flat - moved.flat()) / 1e-3
    rng = np.random.default_rng(0)
    checked = 0
    for k in rng.choice(flat.size, 60, replace=False):
        up, down = flat.copy(), flat.copy()
        up[k] += 1e-2
        down[k] -= 1e-2
        slope = (loss(up) - loss(down)) / 2e-2
        assert abs(slope - step[k]) <= 0.05 * max(1, abs(slope)) + 0.02
        checked += abs(slope) > 0.1
    assert checked > 10


def test_sums_that_would_overflow():
    """Beyond the bound the largest sum is taken off first, within it the result is the same without."""
    net, x, cls, word, lengths = tiny(2)
    want = gru.score(net, x, cls, word, lengths)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(gru, "SAFE", 0)
        assert np.allclose(gru.score(net, x, cls, word, lengths), want, atol=1e-5)
    net.class_w *= 500
    net.word_w *= 500
    assert np.isfinite(gru.score(net, x, cls, word, lengths)).all()


def test_words_are_found_by_their_first_bits(monkeypatch):
    """Every hash finds its place or -1, also among hashes that share their first bits, without one search for each."""
    rng = np.random.default_rng(6)
    near = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    for known in (np.unique(near), np.unique(near >> np.uint64(40)), np.unique(near)[:1], np.array([0, 2**64 - 1], np.uint64)):
        vocab = lm_scoring.Vocabulary(known, known, known, 0, 0, 0, known, known)
        asked = np.concatenate((known, near, near >> np.uint64(40), np.array([0, 1, 2**64 - 1], np.uint64)))
        place = {int(h): k for k, h in enumerate(known)}
        sizes, plain = [], np.searchsorted
        monkeypatch.setattr(np, "searchsorted", lambda a, v, *more: sizes.append(np.size(v)) or plain(a, v, *more))
        assert vocab.find(asked).tolist() == [place.get(int(h), -1) for h in asked]
        assert vocab.find(asked[:5]).tolist() == [place.get(int(h), -1) for h in asked[:5]]
        monkeypatch.undo()
        assert len(asked) not in sizes and len(sizes) <= 1
