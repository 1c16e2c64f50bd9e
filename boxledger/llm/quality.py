"""Quality classifier by importance resampling.

Two bag-of-n-grams models over hashed buckets, one of target text (labelled good) and one of all raw text, give every
document a log importance weight: the sum over its n-grams of the log ratio of their probabilities.  Gumbel noise is
added and the ``k`` largest sums are kept, which samples ``k`` documents without replacement in proportion to weight.

N-grams run over words (1 and 2) and over word shapes (letter case, digits, last sign, repeat of the word before; 1 to 3),
so a text's words tell as well as its form, and unseen words count too.  Words and shapes have buckets of their own and are
two models each, whose log ratios add up.
The raw model covers every row; labels come from a bounded sample, which also sets ``k``: the number of documents whose
weight reaches the cut that parts the sample's two classes best.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from boxledger.session import cut_lineage

from .registry import register, table
from .textbytes import mix, span_hashes, split_words, unit, windows
from .toxicity import best_cut
from .workers import map_arrow

_KIND = np.zeros(256, np.uint8)
_KIND[ord("a"):ord("z") + 1] = 1
_KIND[ord("A"):ord("Z") + 1] = 2
_KIND[ord("0"):ord("9") + 1] = 3
_KIND[128:] = 4


@dataclass(frozen=True)
class Weights:
    """Log ratios by bucket, the cut between the labelled classes, and the noise seed."""

    log_ratio: np.ndarray
    n_grams: int
    seed: int


def shapes(words) -> np.ndarray:
    """A hash of the shape of each word: counts of lower case, upper case and digits up to 3, last sign, repetition."""
    kinds = _KIND[words.data]
    counts = []
    for kind in range(4):
        before = np.concatenate(([0], np.cumsum(kinds == kind)))
        counts.append(before[words.ends] - before[words.starts])
    signs, lower, upper, digits = counts
    last = words.data[words.ends - 1].astype(np.int64)
    sign = np.where(_KIND[last] == 0, last, 0)
    value = words.hashes()
    again = np.zeros(len(value), bool)
    again[1:] = value[1:] == value[:-1]
    again[words.bounds[:-1][words.bounds[:-1] < len(value)]] = False
    bare = signs == words.ends - words.starts
    packed = np.minimum(lower, 3) + 4 * np.minimum(upper, 3) + 16 * np.minimum(digits, 2) + 48 * again + 96 * bare
    return mix((packed * 256 + sign).astype(np.uint64) + np.uint64(0x51ED27))


#: Longest n-gram of words.
WORD_GRAMS = 2


def grams(words, n_grams: int, buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets of the 1- to ``n_grams``-grams of shapes (the first ``buckets``) and of the words (those after), each with its
    bounds by row."""
    out = []
    for first, values, longest in ((0, shapes(words), n_grams), (buckets, words.hashes(), WORD_GRAMS)):
        for n in range(1, longest + 1):
            h, bounds = (values, words.bounds) if n == 1 else windows(values, words.bounds, n, n)
            out.append(((h % np.uint64(buckets)).astype(np.int64) + first, bounds))
    return out


def log_ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log of target over raw probability per bucket, counts plus one, for each of the two models by itself."""
    parts = []
    for r, t in zip(np.split(raw, 2), np.split(target, 2)):
        parts.append(np.log((t + 1) / (t.sum() + len(t))) - np.log((r + 1) / (r.sum() + len(r))))
    return np.concatenate(parts)


def _sample(labels: DataFrame, id_col: str, label_col: str, max_rows: int) -> DataFrame:
    """At most ``max_rows`` labelled ids, half from each class at most, chosen by a hash; an id labelled twice is good
    only if both labels say so."""
    label = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("_label")).dropna()
    label = label.groupBy("_id").agg(F.min("_label").alias("_label")).withColumn("_key", F.xxhash64("_id", F.lit("quality")))
    picked = [label.filter(F.col("_label") == v).orderBy("_key", "_id").limit(max_rows // 2) for v in (0, 1)]
    return picked[0].unionByName(picked[1]).select("_id", "_label")


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_rows: int) -> DataFrame:
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return texts.join(F.broadcast(_sample(labels, id_col, label_col, max_rows)), "_id", "left")  # two numbers a labelled row


def fit(docs: DataFrame, labels: DataFrame, *, n_grams: int = 3, buckets: int = 1 << 15, max_rows: int = 20_000, seed: int = 11,
        id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Weights:
    """The two models: raw counts from every row of ``docs``, target counts from good rows among at most ``max_rows`` labels.

    Without a good labelled row the target is all text, so every weight is zero.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(2 * buckets, np.int64), np.zeros(2 * buckets, np.int64)
        for batch in batches:
            good = batch.column(2).fill_null(0).to_numpy(zero_copy_only=False) == 1
            for part in split_words(batch.column(1), limit=1 << 20):
                own = good[part.first_row:part.first_row + part.n_rows]
                for bucket, bounds in grams(part, n_grams, buckets):
                    raw += np.bincount(bucket, minlength=2 * buckets)
                    target += np.bincount(bucket[np.repeat(own, np.diff(bounds))], minlength=2 * buckets)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(target[some])], ["bucket", "raw", "target"])

    rows = _labelled(docs, labels, id_col, text_col, label_col, max_rows).select("_id", "_text", "_label")
    counted = map_arrow(rows, run, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw"), F.sum("target"))
    raw, target = np.zeros(2 * buckets), np.zeros(2 * buckets)
    for bucket, n, good in counted.collect():  # at most one row per bucket
        raw[bucket], target[bucket] = n, good
    if not target.sum():
        target = raw
    return Weights(log_ratios(raw, target), n_grams, seed)


def weigh(batch_ids, batch_texts, model: Weights) -> tuple[np.ndarray, np.ndarray]:
    """Log weight and noisy key of each row; the noise depends on id and text only."""
    ids = batch_ids.cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.uint64)
    weights, keys = [np.zeros(0)], [np.zeros(0)]
    for part in split_words(batch_texts, limit=1 << 20):
        total = np.zeros(part.n_rows)
        for bucket, bounds in grams(part, model.n_grams, len(model.log_ratio) // 2):
            sums = np.concatenate(([0.0], np.cumsum(model.log_ratio[bucket])))
            total += sums[bounds[1:]] - sums[bounds[:-1]]
        own = span_hashes(part.data, part.text_bounds[:-1], part.text_bounds[1:])
        total = np.round(total, 6)
        noise = -np.log(-np.log(unit(mix(own ^ mix(ids[part.first_row:part.first_row + part.n_rows] + np.uint64(model.seed))))))
        weights.append(total)
        keys.append(total + noise)
    return np.concatenate(weights), np.concatenate(keys)


def ordered(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the doubles."""
    bits = values.astype(np.float64).view(np.int64)
    return np.where(bits < 0, np.int64(-1) ^ (bits & np.int64(0x7FFFFFFFFFFFFFFF)), bits)


def kth_largest(df: DataFrame, column: str, k: int) -> int | None:
    """The exact ``k``-th largest value of a bigint column, found digit by digit from counts; None beyond the last row."""
    if k < 1:
        return None
    value = F.col(column).bitwiseXOR(F.lit(-(1 << 63)))
    prefix, rest = 0, df
    for shift in (48, 32, 16, 0):
        counts = dict(rest.groupBy(F.shiftrightunsigned(value, shift).bitwiseAND(0xFFFF).alias("digit")).count().collect())
        for digit in sorted(counts, reverse=True):
            if k <= counts[digit]:
                break
            k -= counts[digit]
        else:
            return None
        prefix = (prefix << 16) | digit
        signed = prefix - (1 << (64 - shift)) if prefix >> (63 - shift) else prefix
        rest = df.filter(F.shiftright(value, shift) == signed)
    return (prefix ^ (1 << 63)) - (1 << 64) if (prefix ^ (1 << 63)) >> 63 else prefix ^ (1 << 63)


def importance(docs: DataFrame, labels: DataFrame, model: Weights, *, k: int | None = None, max_rows: int = 20_000,
               id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> tuple[DataFrame, int | None]:
    """Weights of all rows (``doc_id, log_weight, key, kept``) and the smallest kept key as an ordered whole number.

    ``k`` rows with the largest keys are kept; without ``k`` it is the number of weights at or above the cut that parts
    the labelled sample best (all rows if the sample has one class only).  Rows that tie with the last one, repeated rows
    among them, are kept as well.  Null and empty texts have weight 0.  Rows with a null id are weighed like others.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight, key = weigh(batch.column(0), batch.column(1), model)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(weight), pa.array(key), pa.array(ordered(key))],
                                             ["doc_id", "label", "log_weight", "key", "place"])

    rows = _labelled(docs, labels, id_col, text_col, label_col, max_rows).select("_id", "_text", "_label")
    weighed = cut_lineage(map_arrow(rows, run, "doc_id long, label int, log_weight double, key double, place long"))
    if k is None:
        sample = weighed.dropna(subset=["label"]).select("log_weight", "label").collect()  # at most max_rows labels
        cut = best_cut(np.array([r[0] for r in sample]), np.array([r[1] for r in sample], np.float64)) if sample else None
        k = weighed.filter(F.col("log_weight") >= cut).count() if cut is not None else weighed.count()
    least = kth_largest(weighed, "place", k)
    kept = F.lit(True) if least is None and k > 0 else F.lit(False) if least is None else F.col("place") >= least
    return weighed.select("doc_id", "log_weight", "key", kept.alias("kept")), (least if least is not None else -(1 << 63) if k > 0 else (1 << 63) - 1)


def resample(docs: DataFrame, labels: DataFrame, *, k: int | None = None, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that importance resampling keeps, with all their columns.

    The smallest kept key is found first; documents are then weighed where they are read, so no text is shuffled.
    """
    model = fit(docs, labels, id_col=id_col, text_col=text_col, **options)
    _, least = importance(docs, labels, model, k=k, id_col=id_col, text_col=text_col)
    at_id, at_text = docs.columns.index(id_col), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, key = weigh(batch.column(at_id), batch.column(at_text), model)
            yield batch.filter(pa.array(ordered(key) >= least))

    return map_arrow(docs, run, docs.schema)


@register("op1_quality_classifier")
def op1_quality_classifier(spark, sf_dir):
    """Importance weight, noisy key and decision of every document."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    return importance(docs, labels, fit(docs, labels))[0]
