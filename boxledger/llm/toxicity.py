"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word's vector is the sum of two hashed embeddings, of the whole word and of its first bytes, so inflected forms of
a seen stem share strength.  Filters of several widths slide over a text, the maximum over all positions is kept, and a
logistic layer scores it.  The first dimension of the embeddings starts at the shrunk log odds of the bucket in the
training texts, the rest at small random numbers; all are then trained.

All labelled rows are learned from.  They are dealt to two halves (copies of a text to the same one), and each half trains a
net of its own; every labelled row is then scored by the net that has not seen it, and these logits place the score 0.5 and
calibrate a threshold for every language.  A score is that of both nets' mean logit; language is never an input of it.

A half is dealt to shards by a hash of the id, as many as its rows ask for.  In each round every shard goes over its rows once
from the same weights and sends what it changed; the changes of a word's vector are averaged over the shards that touched it.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from boxledger.session import cut_lineage

from .registry import register, table
from .textbytes import mix, ragged, span_hashes, split_words
from .workers import map_arrow

WIDTHS = (1, 2, 3)
#: Rows of a shard, about; words whose changes travel in one row; bins of a logit when thresholds are placed.
SHARD_ROWS = 8192
BLOCK = 8192
BINS = 64
#: Hashes of ids that are marked as labelled.
PLACES = 1 << 26
#: Packed words that are learned from at once.
SLICE_WORDS = 1 << 18


@dataclass
class Net:
    """Weights; ``filters`` has one block of columns per width and offset in the window."""

    words: np.ndarray
    stems: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    n_filters: int
    thresholds: dict

    def pooled(self, word: np.ndarray, stem: np.ndarray, bounds: np.ndarray, keep: bool = False):
        """Maximum activation of each filter over each row, zero at least; with ``keep`` also vectors and places."""
        n, f = len(bounds) - 1, self.n_filters
        best = np.zeros((n, f * len(WIDTHS)), np.float32)
        places = np.zeros(best.shape, np.int64)
        vectors = self.words[word] + self.stems[stem]
        some = np.flatnonzero(np.diff(bounds))
        if len(some):
            ends = bounds[1:][some]
            parts = vectors @ self.filters
            block = 0
            for k, width in enumerate(WIDTHS):
                total = parts[:, block * f:(block + 1) * f].copy()
                for j in range(1, width):
                    shifted = parts[j:, (block + j) * f:(block + j + 1) * f].copy()
                    # Places less than j before the end of a row see nothing beyond it.
                    cut = ragged(np.maximum(ends - j, 0), np.minimum(j, ends))
                    shifted[cut[cut < len(shifted)]] = 0
                    total[:len(shifted)] += shifted
                block += width
                top = np.maximum.reduceat(total, bounds[:-1][some], axis=0)
                best[some, k * f:(k + 1) * f] = np.maximum(top + self.bias[k * f:(k + 1) * f], 0)
                if keep:
                    rows = np.repeat(np.arange(len(some)), np.diff(bounds)[some])
                    hit_at, hit_f = np.nonzero(total == top[rows])
                    places[some[rows[hit_at[::-1]]], k * f + hit_f[::-1]] = hit_at[::-1]
        return (best, places, vectors) if keep else best

    def logits(self, word, stem, bounds) -> np.ndarray:
        return self.pooled(word, stem, bounds) @ self.out + self.out_bias


def features(words, n_words: int, n_stems: int, stem_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word and of its first ``stem_bytes`` bytes."""
    stems = span_hashes(words.data, words.starts, np.minimum(words.ends, words.starts + stem_bytes))
    return (words.hashes() % np.uint64(n_words)).astype(np.int64), (mix(stems) % np.uint64(n_stems)).astype(np.int64)


def _log_odds(hits: np.ndarray, seen: np.ndarray, share: float, shrink: float = 10.0) -> np.ndarray:
    """Log of the share of positive rows among those with a bucket, over the share overall, shrunk towards it."""
    share = max(share, 1e-3)
    return np.log((hits + shrink * share) / ((seen + shrink) * share)).astype(np.float32)


#: Weights that every row changes; the vectors of words and stems are changed by the rows that have them.
DENSE = ("filters", "bias", "out")


def start(hits: np.ndarray, seen: np.ndarray, n: int, positive: int, *, n_words: int, dim: int = 12, n_filters: int = 8, seed: int = 7) -> tuple[Net, dict]:
    """A net that begins with the log odds of ``n`` rows, ``positive`` of them toxic, and AdaGrad's squared sums."""
    rng = np.random.default_rng(seed)
    blocks = sum(WIDTHS)
    net = Net(rng.normal(0, 0.05, (n_words, dim)).astype(np.float32), rng.normal(0, 0.05, (len(seen) - n_words, dim)).astype(np.float32),
              rng.normal(0, 0.1, (dim, blocks * n_filters)).astype(np.float32), np.zeros(len(WIDTHS) * n_filters, np.float32),
              np.full(len(WIDTHS) * n_filters, 0.1, np.float32), 0.0, n_filters, {})
    if n:
        odds = _log_odds(hits, seen, positive / n)
        net.words[:, 0], net.stems[:, 0] = odds[:n_words], odds[n_words:]
        net.filters[0] = np.abs(net.filters[0]) + 0.5
        share = min(max(positive / n, 0.01), 0.99)
        net.out_bias = float(np.log(share / (1 - share))) - 1.0
    sums = {k: np.full_like(getattr(net, k), 1e-2) for k in ("words", "stems", *DENSE)}
    return net, sums | {"out_bias": 1e-2}


def learn(net: Net, sums: dict, word, stem, bounds, labels, rng, *, rate: float = 0.05, batch: int = 64) -> None:
    """One pass over the rows in random order, in place: minimise the log loss by AdaGrad over mini-batches."""
    f, dim = net.n_filters, net.words.shape[1]
    order = rng.permutation(len(labels))
    for low in range(0, len(order), batch):
        pick = order[low:low + batch]
        sizes = np.diff(bounds)[pick]
        at = ragged(bounds[:-1][pick], sizes)
        own = np.concatenate(([0], np.cumsum(sizes)))
        w, s = word[at], stem[at]
        best, places, vectors = net.pooled(w, s, own, keep=True)
        logit = best @ net.out + net.out_bias
        slope = ((1 / (1 + np.exp(-np.clip(logit, -80, 80))) - labels[pick]) / len(pick)).astype(np.float32)
        grad_out = best.T @ slope
        flow = np.outer(slope, net.out) * (best > 0)
        grad_filters = np.zeros_like(net.filters)
        word_rows, word_grads = [], []
        block = 0
        for k, width in enumerate(WIDTHS):
            f0 = k * f
            for j in range(width):
                column = slice((block + j) * f, (block + j + 1) * f)
                place = places[:, f0:f0 + f] + j
                inside = (place < own[1:, None]) & (best[:, f0:f0 + f] > 0)
                doc, which = np.nonzero(inside)
                spot, g = place[doc, which], flow[doc, f0 + which]
                np.add.at(grad_filters.T, (block + j) * f + which, vectors[spot] * g[:, None])
                word_rows.append(spot)
                word_grads.append(net.filters[:, column].T[which] * g[:, None])
            block += width
        spot, grads = np.concatenate(word_rows), np.concatenate(word_grads)
        for name, buckets in (("words", w), ("stems", s)):
            touched, place = np.unique(buckets[spot], return_inverse=True)
            total = np.zeros((len(touched), dim), np.float32)
            np.add.at(total, place, grads)
            sums[name][touched] += total ** 2
            getattr(net, name)[touched] -= rate * total / np.sqrt(sums[name][touched])
        for name, grad in (("filters", grad_filters), ("bias", flow.sum(0)), ("out", grad_out)):
            sums[name] += grad ** 2
            setattr(net, name, getattr(net, name) - rate * grad / np.sqrt(sums[name]))
        sums["out_bias"] += float(slope.sum()) ** 2
        net.out_bias -= rate * float(slope.sum()) / np.sqrt(sums["out_bias"])


def _copy(net: Net, sums: dict) -> tuple[Net, dict]:
    own = Net(**{k: v.copy() if isinstance(v, np.ndarray) else v for k, v in net.__dict__.items()})
    return own, {k: v.copy() if isinstance(v, np.ndarray) else v for k, v in sums.items()}


def _dense(net: Net, sums: dict) -> np.ndarray:
    """All dense weights, then their squared sums, as one row."""
    flat = [[x[n].ravel() for n in DENSE] + [np.array([x["out_bias"]])] for x in (net.__dict__, sums)]
    return np.concatenate(flat[0] + flat[1]).astype(np.float64)[None]


def _pack(index: np.ndarray, values: np.ndarray) -> bytes:
    return np.array([len(index)], np.int32).tobytes() + index.astype(np.int32).tobytes() + values.astype(np.float32).tobytes()


def _unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(packed, np.int32, 1)[0])
    return np.frombuffer(packed, np.int32, n, 4), np.frombuffer(packed, np.float32, offset=4 + 4 * n).reshape(n, -1)


def changes(before: tuple[Net, dict], after: tuple[Net, dict]) -> Iterator[tuple[int, bytes]]:
    """What training changed: block -1 with the dense weights, then the touched vectors in blocks of ``BLOCK`` words or stems."""
    yield -1, _pack(np.zeros(1), _dense(*after) - _dense(*before))
    first = 0
    for name in ("words", "stems"):
        old, new = before[1][name], after[1][name]
        touched = np.flatnonzero((old != new).any(1))
        values = np.concatenate((getattr(after[0], name)[touched] - getattr(before[0], name)[touched], new[touched] - old[touched]), 1)
        edges = np.searchsorted(touched, np.arange(0, len(old) + BLOCK, BLOCK))
        for k in np.flatnonzero(np.diff(edges)):
            part = slice(edges[k], edges[k + 1])
            yield first + int(k), _pack(touched[part] - k * BLOCK, values[part])
        first += -(-len(old) // BLOCK)


def apply(net: Net, sums: dict, block: int, packed: bytes) -> None:
    """Adds changes of one block, in place."""
    index, values = _unpack(packed)
    if block < 0:
        flat, at = _dense(net, sums)[0] + values[0], 0
        for x in (net.__dict__, sums):
            for name in DENSE:
                x[name] = flat[at:at + x[name].size].reshape(x[name].shape).astype(np.float32)
                at += x[name].size
            x["out_bias"] = float(flat[at])
            at += 1
        return
    of_words = -(-len(net.words) // BLOCK)
    name, first = ("words", block) if block < of_words else ("stems", block - of_words)
    half = values.shape[1] // 2
    getattr(net, name)[index + first * BLOCK] += values[:, :half]
    sums[name][index + first * BLOCK] += values[:, half:]


def best_cut(logits: np.ndarray, labels: np.ndarray) -> float | None:
    """The logit midway between the two neighbours where the F1 of positives is highest; None with one class only."""
    if not 0 < labels.sum() < len(labels):
        return None
    by = np.argsort(-logits, kind="stable")
    hits = np.cumsum(labels[by])
    f1 = 2 * hits / (np.arange(1, len(by) + 1) + labels.sum())
    ranked = logits[by]
    f1[:-1][ranked[:-1] == ranked[1:]] = -1
    k = int(np.argmax(f1))
    return float((ranked[k] + ranked[k + 1]) / 2) if k + 1 < len(by) else float(ranked[k] - 1)


def binned_cut(bins: np.ndarray, hits: np.ndarray, seen: np.ndarray) -> float | None:
    """The logit midway between the two neighbouring bins where the F1 of positives is highest; None with one class only.

    ``hits`` of the ``seen`` rows of a bin are positive; every bin has a row.
    """
    if not 0 < hits.sum() < seen.sum():
        return None
    by = np.argsort(-bins)
    f1 = 2 * np.cumsum(hits[by]) / (np.cumsum(seen[by]) + hits.sum())
    k = int(np.argmax(f1))
    middle = (bins[by] + 0.5) / BINS
    return float((middle[k] + middle[k + 1]) / 2) if k + 1 < len(by) else float(middle[k] - 1)


def _marked(label: DataFrame) -> np.ndarray:
    """A bit for each of ``PLACES`` hashes of ids, set where a label has it."""
    by_block = label.select(_place("doc_id").alias("place")).groupBy(F.bitmap_bucket_number("place").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")).toArrow()  # at most 2,048 rows of 4 KB
    marked = np.zeros(PLACES // 8, np.uint8)
    for block, bits in zip(by_block.column(0).to_pylist(), by_block.column(1).to_pylist()):
        marked[(block - 1) * 4096:block * 4096] = np.frombuffer(bits, np.uint8)
    return marked


def _place(column: str):
    return F.pmod(F.xxhash64(column, F.lit("place")), F.lit(PLACES)) + 1


def _labelled(docs: DataFrame, label: DataFrame, n_shards: int, n_words: int, n_stems: int, stem_bytes: int, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """``shard, half, label, lang, packed`` of all labelled rows in a fixed order, kept in the shared folder.

    ``packed`` holds the buckets of words and stems by turns, two bytes each.  Rows whose id has the hash of no label stay
    behind before the join, so texts without a label are not shuffled; the join itself is exact.
    """
    half = F.pmod(F.xxhash64(F.col(text_col).cast("string"), F.lit("half")), F.lit(2)).cast("int")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), half.alias("half"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    texts = texts.filter("doc_id is not null").withColumn("place", _place("doc_id"))
    marked = docs.sparkSession.sparkContext.broadcast(_marked(label))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(4).to_numpy() - 1
            batch = batch.filter(pa.array((marked.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1))
            for part in split_words(batch.column(3), lower=True):
                pairs = np.stack(features(part, n_words, n_stems, stem_bytes), 1).astype(np.uint16)
                offsets = pa.py_buffer((part.bounds * 4).astype(np.int32).tobytes())
                packed = pa.Array.from_buffers(pa.binary(), part.n_rows, [None, offsets, pa.py_buffer(pairs.tobytes())])
                yield pa.RecordBatch.from_arrays([c.slice(part.first_row, part.n_rows) for c in batch.columns[:3]] + [packed], ["doc_id", "half", "lang", "packed"])

    packed = map_arrow(texts, run, "doc_id long, half int, lang string, packed binary").repartition(n_shards, "doc_id")
    # A shard is a partition of the join.  Grouped labels keep theirs; of two bare exchanges Spark would deal both anew, to
    # `spark.sql.shuffle.partitions`, and each of those would train, and send what it changed, by itself.
    own = label.repartition(n_shards, "doc_id").groupBy("doc_id").agg(F.max("label").alias("label"))
    rows = packed.join(own, "doc_id")
    rows = rows.select(F.pmod(F.hash("doc_id"), F.lit(n_shards)).alias("shard"), "half", "label", "lang", "packed", F.xxhash64("doc_id", F.lit("toxicity")).alias("key"))
    return cut_lineage(rows.sortWithinPartitions("shard", "half", "key", "packed").drop("key"))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``shard, half, labels, langs, words, stems, bounds`` of runs of rows of one half of a shard, about ``SLICE_WORDS`` words at once."""
    for batch in batches:
        shard, half, label = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
        packed = batch.column(4)
        offsets = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset:packed.offset + len(packed) + 1].astype(np.int64) // 4
        data = packed.buffers()[2]
        pairs = np.frombuffer(data, np.uint16)[:offsets[-1] * 2].reshape(-1, 2).astype(np.int64) if data is not None else np.zeros((0, 2), np.int64)
        ends = np.append(np.flatnonzero((np.diff(shard) != 0) | (np.diff(half) != 0)) + 1, len(label))
        low = 0
        while low < len(label):
            high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + SLICE_WORDS, "right")) - 1)
            high = min(high, int(ends[np.searchsorted(ends, low, "right")]))
            own = pairs[offsets[low]:offsets[high]]
            yield int(shard[low]), int(half[low]), label[low:high].astype(np.float64), batch.column(3).slice(low, high - low), own[:, 0], own[:, 1], offsets[low:high + 1] - offsets[low]
            low = high


def _counted(rows: DataFrame, n_words: int, n_stems: int) -> list[tuple[np.ndarray, np.ndarray, int, int]]:
    """For each half: toxic rows and all rows by bucket of words, then of stems, and toxic rows and rows in all."""
    size = n_words + n_stems

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {}
        for _, half, label, _, word, stem, bounds in _slices(batches):
            hits, seen = found.setdefault(half, (np.zeros(size + 1, np.int64), np.zeros(size + 1, np.int64)))
            row_of = np.repeat(np.arange(len(label)), np.diff(bounds))
            pairs = np.unique(np.concatenate((word, stem + n_words)) * len(label) + np.concatenate((row_of, row_of)))
            bucket, row = np.append(pairs // len(label), np.full(len(label), size)), np.append(pairs % len(label), np.arange(len(label)))
            hits += np.bincount(bucket, weights=label[row], minlength=size + 1).astype(np.int64)
            seen += np.bincount(bucket, minlength=size + 1)
        for half, (hits, seen) in found.items():
            at = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), half, np.int32)), pa.array(at), pa.array(hits[at]), pa.array(seen[at])], ["half", "bucket", "hits", "seen"])

    sent = map_arrow(rows, run, "half int, bucket long, hits long, seen long").groupBy("half", "bucket").agg(F.sum("hits").alias("hits"), F.sum("seen").alias("seen"))
    half, bucket, hits, seen = (c.to_numpy() for c in sent.toArrow().columns)  # at most two rows for each bucket
    out = []
    for k in range(2):
        totals = np.zeros((2, size + 1), np.int64)
        totals[:, bucket[half == k]] = hits[half == k], seen[half == k]
        out.append((totals[0, :size], totals[1, :size], int(totals[0, size]), int(totals[1, size])))
    return out


def train(rows: DataFrame, nets: list[tuple[Net, dict]], *, rounds: int) -> list[tuple[Net, dict]]:
    """The nets after ``rounds`` passes over all rows; each net learns from its own half, a single one from both."""
    context = rows.sparkSession.sparkContext
    n_nets = len(nets)
    for k in range(rounds):
        weights = context.broadcast(nets)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for (shard, which), own in groupby(_slices(batches), key=lambda x: (x[0], x[1] % n_nets)):
                before = weights.value[which]
                after, rng = _copy(*before), np.random.default_rng([k, shard, which])
                for _, _, label, _, word, stem, bounds in own:
                    learn(*after, word, stem, bounds, label, rng)
                for block, packed in changes(before, after):
                    yield pa.RecordBatch.from_arrays([pa.array([which], pa.int32()), pa.array([block], pa.int32()), pa.array([packed], pa.binary())], ["net", "block", "packed"])

        def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = {}
            for batch in batches:
                for which, block, packed in zip(*[c.to_pylist() for c in batch.columns]):
                    index, values = _unpack(packed)
                    sums, times = total.setdefault((which, block), (np.zeros((BLOCK if block >= 0 else 1, values.shape[1])), np.zeros(BLOCK if block >= 0 else 1)))
                    sums[index] += values
                    times[index] += 1
            for (which, block), (sums, times) in total.items():
                at = np.flatnonzero(times)
                yield pa.RecordBatch.from_arrays([pa.array([which], pa.int32()), pa.array([block], pa.int32()), pa.array([_pack(at, sums[at] / times[at, None])], pa.binary())],
                                                 ["net", "block", "packed"])

        n_blocks = n_nets * (1 + sum(-(-len(x) // BLOCK) for x in (nets[0][0].words, nets[0][0].stems)))
        schema = "net int, block int, packed binary"
        got = map_arrow(map_arrow(rows, run, schema).repartition(n_blocks, "net", "block"), mean, schema).collect()  # `n_blocks` rows of one size
        nets = [_copy(*x) for x in nets]
        for r in sorted(got, key=lambda r: (r.net, r.block)):
            apply(*nets[r.net], r.block, r.packed)
        weights.unpersist()
    return nets


def calibrate(rows: DataFrame, nets: list[Net]) -> None:
    """Shift the score so that 0.5 is the best cut over all rows, and set each language's own threshold.

    A row is scored by the net that did not learn from its half; a single net scores all.
    """
    shared = rows.sparkSession.sparkContext.broadcast(nets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, half, label, lang, word, stem, bounds in _slices(batches):
            logit = shared.value[(1 - half) % len(shared.value)].logits(word, stem, bounds)
            bins = np.floor(np.clip(logit, -64, 64) * BINS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([lang, pa.array(bins), pa.array(label.astype(np.int64))], ["lang", "bin", "label"])

    # At most 8,193 bins for each language.
    found = map_arrow(rows, run, "lang string, bin int, label long").groupBy("lang", "bin").agg(F.sum("label").alias("hits"), F.count("*").alias("seen")).toArrow()
    langs = np.array(found.column(0).to_pylist(), object)
    bins, hits, seen = (found.column(k).to_numpy() for k in range(1, 4))
    every, place = np.unique(bins, return_inverse=True)
    cut = binned_cut(every, np.bincount(place, weights=hits), np.bincount(place, weights=seen)) if len(bins) else None
    shift = cut or 0.0
    thresholds = {}
    for lang in sorted({x for x in langs if x is not None}):
        own = langs == lang
        if seen[own].sum() >= 150 and (cut := binned_cut(bins[own], hits[own], seen[own])) is not None:
            thresholds[lang] = float(1 / (1 + np.exp(shift - cut)))
    for net in nets:
        net.out_bias -= shift
        net.thresholds = thresholds


def fit(docs: DataFrame, labels: DataFrame, *, n_words: int = 1 << 16, n_stems: int = 1 << 15, stem_bytes: int = 5, rounds: int = 5,
        id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", label_col: str = "toxic") -> bytes:
    """Train on all labelled rows, in ``rounds`` passes over them; returns the pickled nets.

    Null labels and ids without a text are left out, an id labelled twice counts as toxic if either label says so.  Fewer than
    50 rows, or a half with one class only, train a single net.  With no labelled row, or one class only, it scores nearly
    all texts alike.  ``n_words`` and ``n_stems`` are at most 65,536.
    """
    label = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).dropna()
    n_shards = max(1, -(-label.select("doc_id").distinct().count() // (2 * SHARD_ROWS)))
    rows = _labelled(docs, label, n_shards, n_words, n_stems, stem_bytes, id_col, text_col, lang_col)
    halves = _counted(rows, n_words, n_stems)
    if sum(x[3] for x in halves) < 50 or any(x[2] in (0, x[3]) for x in halves):
        halves = [tuple(a + b for a, b in zip(*halves))]
    nets = [start(hits, seen, n, positive, n_words=n_words, seed=7 + k) for k, (hits, seen, positive, n) in enumerate(halves)]
    nets = [net for net, _ in train(rows, nets, rounds=rounds)]
    calibrate(rows, nets)
    return pickle.dumps([net.__dict__ for net in nets])


def score(docs: DataFrame, model: bytes, *, stem_bytes: int = 5, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> DataFrame:
    """Score every row: ``doc_id, lang, score, lang_threshold, flagged``; ``flagged`` compares with the language's threshold.

    Null and empty texts get the score of a text without words.  Languages that were not calibrated, null among them, use
    0.5.  Repeated rows are scored alike.  Other columns are ignored.
    """
    weights = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nets = [Net(**x) for x in pickle.loads(weights.value)]
        n_words, n_stems, thresholds = len(nets[0].words), len(nets[0].stems), nets[0].thresholds
        for batch in batches:
            scores = [np.zeros(0)]
            for part in split_words(batch.column(1), lower=True, limit=1 << 20):
                w, s = features(part, n_words, n_stems, stem_bytes)
                logits = sum(net.logits(w, s, part.bounds).astype(np.float64) for net in nets) / len(nets)
                scores.append(1 / (1 + np.exp(-np.clip(logits, -500, 500))))
            value = np.concatenate(scores)
            limits = np.array([thresholds.get(x, 0.5) for x in batch.column(2).to_pylist()], np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(value), pa.array(limits), pa.array(value >= limits)],
                                             ["doc_id", "lang", "score", "lang_threshold", "flagged"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                         F.col(lang_col).cast("string").alias("lang"))
    return map_arrow(picked, run, "doc_id long, lang string, score double, lang_threshold double, flagged boolean")


@register("op8_toxicity")
def op8_toxicity(spark, sf_dir):
    """All documents scored by a net that learns from the labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = fit(docs, table(spark, sf_dir, "labels").filter(~held))
    scored = score(docs, model)
    return scored.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                         "lang_threshold", "flagged")
