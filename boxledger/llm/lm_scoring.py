"""Language-model scoring: the log probability of whole documents under a gated recurrent network.

All training documents are counted: words by bucketless aggregation, classes by form.  The most frequent words are the
network's short list; every other word's probability is its class's (predicted by the network) times its share of the
class by counts, add-one smoothed with one place for unseen words, so the model is a distribution over the same events
as the unigram base.

The network learns in rounds.  In each, every task trains on its share of another part of the training documents from the
same weights, and the weights are averaged by tokens.  The rounds together use each training document once.

Counts of the ``head`` most frequent words (a fixed number) travel to the tasks; the counts of all others are joined to
the documents by a shuffle of each document's rarer words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import gru
from .registry import register, table
from .textbytes import mix, split_words, span_hashes
from .workers import map_arrow, stored

#: The hash that stands for the end of a text; words hash to it with probability 2^-64.
END = np.uint64(0x5E1D_0F7E_A1B2_C3D4)
N_FORMS = 32
LN10 = float(np.log(10))


def forms(words) -> np.ndarray:
    """A class from 0 to ``N_FORMS - 1`` for each word by its first two bytes and whether it ends in a sign."""
    first = span_hashes(words.data, words.starts, np.minimum(words.starts + 2, words.ends))
    last = words.data[words.ends - 1]
    return (mix(first) % np.uint64(N_FORMS // 2)).astype(np.int64) * 2 + ((last < 48) | ((last > 57) & (last < 97)))


@dataclass
class Vocabulary:
    """Known words: hashes in order, their counts and short-list ids (-1: none), and totals of the other words by form."""

    hashes: np.ndarray
    counts: np.ndarray
    short: np.ndarray
    n_short: int
    n_tokens: int
    n_types: int
    form_tokens: np.ndarray
    form_types: np.ndarray
    bounds: np.ndarray | None = None

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash among the known ones, -1 if it is not one of them."""
        if not len(self.hashes):
            return np.full(len(hashes), -1, np.int64)
        # Hashes are spread evenly, so their first bits lead to the place but for a few steps.
        bits = max(1, len(self.hashes).bit_length())
        shift = np.uint64(64 - bits)
        if self.bounds is None:
            self.bounds = np.searchsorted(self.hashes >> shift, np.arange((1 << bits) + 1).astype(np.uint64)).astype(np.int32)
        block = (hashes >> shift).astype(np.int64)
        at, end = self.bounds[block], self.bounds[block + 1]
        out = np.full(len(hashes), -1, np.int64)
        left = np.flatnonzero(at < end)
        at, end, wanted = at[left], end[left], hashes[left]
        while len(left):
            same = self.hashes[at] == wanted
            out[left[same]] = at[same]
            at += 1
            more = np.flatnonzero(~same & (at < end))
            left, at, end, wanted = left[more], at[more], end[more], wanted[more]
        return out


def _texts(docs: DataFrame, held_out: Column, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                       F.coalesce(held_out, F.lit(False)).alias("held_out"))


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def count_words(texts: DataFrame) -> DataFrame:
    """``word, form, n`` over all training texts; each task sends a word once per million distinct words it meets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def merged() -> tuple[np.ndarray, ...]:
            word, form, n = (np.concatenate(x) for x in zip(*held)) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
            unique, first, back = np.unique(word, return_index=True, return_inverse=True)
            return unique, form[first], np.bincount(back, weights=n, minlength=len(unique)).astype(np.int64)

        def send(x) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(_signed(x[0])), pa.array(x[1].astype(np.int32)), pa.array(x[2])], ["word", "form", "n"])

        ends = 0
        for batch in batches:
            train = ~batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for part in split_words(batch.column(0), lower=True):
                own = train[part.first_row:part.first_row + part.n_rows]
                ends += int(own.sum())
                pick = own[part.rows]
                unique, first, n = np.unique(part.hashes()[pick], return_index=True, return_counts=True)
                held.append((unique, forms(part)[pick][first], n))
                if len(held) >= 8:
                    held = [merged()]
                    if len(held[0][0]) > 1_000_000:
                        yield send(held.pop())
        held.append((np.array([END]), np.array([-1]), np.array([ends])))
        yield send(merged())

    sent = map_arrow(texts.select("text", "held_out"), run, "word long, form int, n long")
    return sent.groupBy("word").agg(F.min("form").alias("form"), F.sum("n").alias("n")).filter("n > 0")


def vocabulary(counts: DataFrame, *, head: int, short: int, per_class: int) -> Vocabulary:
    """The ``head`` most frequent words and the totals of the others; ``short`` words fill whole classes of the network."""
    top = counts.orderBy(F.desc("n"), "word").limit(head).toArrow()  # at most `head` rows of three numbers
    word = top.column(0).to_numpy().view(np.uint64)
    form, n = top.column(1).to_numpy().astype(np.int64), top.column(2).to_numpy()
    is_end = word == END
    order = np.argsort(~is_end, kind="stable")  # the end first, then by frequency
    ids = np.full(len(word), -1, np.int64)
    ids[order[:short]] = np.arange(min(short, len(word)))
    n_short = max(per_class, -(-min(short, len(word)) // per_class) * per_class)
    tokens, types = np.zeros(N_FORMS, np.int64), np.zeros(N_FORMS, np.int64)
    for f, total, kinds in counts.filter("form >= 0").groupBy("form").agg(F.sum("n"), F.count("*")).collect():  # one row per form
        tokens[f], types[f] = total, kinds
    listed = (ids >= 0) & (form >= 0)
    np.subtract.at(tokens, form[listed], n[listed])
    np.subtract.at(types, form[listed], 1)
    ends = int(n[is_end].sum())
    by = np.argsort(word)
    return Vocabulary(word[by], n[by], ids[by], n_short, int(tokens.sum() + n[listed].sum() + ends), int(types.sum() + listed.sum() + (ends > 0)), tokens, types)


def _encode(part, vocab: Vocabulary, per_class: int, pick: np.ndarray | None = None):
    """Inputs, classes, words in class and lengths of the rows of a slice, each with its end token; also places in the vocabulary."""
    value, form, counts = part.hashes(), forms(part), part.counts
    if pick is not None:
        keep = pick[part.rows]
        value, form, counts = value[keep], form[keep], counts[pick]
    lengths = counts + 1
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    inner = np.ones(total, bool)
    inner[ends - 1] = False
    hashes = np.full(total, END, np.uint64)
    hashes[inner] = value
    known = vocab.find(hashes)
    target = np.where(known >= 0, vocab.short[np.maximum(known, 0)], -1) if len(vocab.short) else np.full(total, -1)
    other = np.zeros(total, np.int64)
    other[inner] = form
    n_classes = vocab.n_short // per_class
    target[~inner & (target < 0)] = 0
    cls = np.where(target >= 0, target // per_class, n_classes + other)
    fed = np.where(target >= 0, target, vocab.n_short + other)
    x = np.empty(total, np.int64)
    x[1:] = fed[:-1]
    x[ends - lengths] = vocab.n_short + N_FORMS
    return x, cls, np.where(target >= 0, target % per_class, 0), lengths, hashes, known, target, other


def train(texts: DataFrame, vocab: Vocabulary, *, per_class: int, hidden: int, rounds: int, share: float | None = None, merge: int = 24) -> gru.Gru:
    """A network after ``rounds`` rounds, each over another ``share`` of the training documents (by a hash of id and text).

    Without ``share`` the rounds split all training documents: each is used once.
    A task sends its weights and token count; ``merge`` tasks add them up, so the driver gets at most that many rows.
    """
    counts = np.zeros(vocab.n_short)
    listed = vocab.short >= 0
    counts[vocab.short[listed]] = vocab.counts[listed]
    net = gru.start(counts, vocab.form_tokens.astype(float), per_class=per_class, hidden=hidden)
    context = texts.sparkSession.sparkContext
    known = context.broadcast(vocab)
    sums = None
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit("round")), F.lit(1_000_000))
    share = 1 / rounds if share is None else share
    for k in range(rounds):
        weights = context.broadcast((net, sums))
        low, high = round(1e6 * share * k), round(1e6 * share * (k + 1))
        rows = texts.filter(~F.col("held_out") & (draw >= low) & (draw < high))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, own_sums = weights.value
            tokens = 0
            for batch in batches:
                for part in split_words(batch.column(0), lower=True):
                    x, cls, word, lengths, *_ = _encode(part, known.value, per_class)
                    own, own_sums = gru.train(own, x, cls, word, lengths, sums=own_sums)
                    tokens += len(x)
            if tokens:
                packed = np.concatenate((own.flat(), own_sums)).astype(np.float64) * tokens
                yield pa.RecordBatch.from_arrays([pa.array([tokens]), pa.array([packed.tobytes()], pa.binary())], ["tokens", "packed"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tokens, total = 0, None
            for batch in batches:
                for n, packed in zip(*[c.to_pylist() for c in batch.columns]):
                    tokens += n
                    value = np.frombuffer(packed)
                    total = value.copy() if total is None else total + value
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array([tokens]), pa.array([total.tobytes()], pa.binary())], ["tokens", "packed"])

        sent = map_arrow(rows.select("text"), run, "tokens long, packed binary")
        got = map_arrow(sent.repartition(merge, F.col("tokens")), add, "tokens long, packed binary").collect()  # `merge` rows at most
        if got:
            mean = sum(np.frombuffer(r.packed) for r in got) / sum(r.tokens for r in got)
            half = len(mean) // 2
            net, sums = net.filled(mean[:half]), mean[half:].astype(np.float32)
    return net


def score(docs: DataFrame, held_out: Column, *, head: int = 1 << 18, short: int = 1024, per_class: int = 32, hidden: int = 16, rounds: int = 3,
          share: float | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of every row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Tokens are the words of the text (A-Z lower-cased) and an end.  ``base_score`` is the add-one unigram score from the
    rows that are not held out, ``score`` the network's; both are base-10 logarithms.  A null ``held_out`` is false.
    Null texts are empty: one end token.  Repeated rows are counted and scored each.  Rows with a null id take part.
    Other columns are ignored.  Without training rows both scores use empty counts.
    """
    texts = _texts(docs, held_out, id_col, text_col)
    counts = stored(count_words(texts), "word-counts")
    vocab = vocabulary(counts, head=head, short=short, per_class=per_class)
    net = train(texts, vocab, per_class=per_class, hidden=hidden, rounds=rounds, share=share)
    shared = texts.sparkSession.sparkContext.broadcast((vocab, net))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        vocab, net = shared.value
        row = TaskContext.get().partitionId() << 34
        log_form = np.log10(np.maximum(vocab.form_tokens + vocab.form_types + 1, 1))
        log_count = np.log10(vocab.counts + 1.0)
        for batch in batches:
            ids, held = batch.column(0), batch.column(2)
            for part in split_words(batch.column(1), lower=True, limit=4 << 20):
                x, cls, word, lengths, hashes, known, target, other = _encode(part, vocab, per_class)
                log_p = gru.score(net, x, cls, word, lengths) / LN10
                log_p -= np.where(target < 0, log_form[other], 0)
                owner = np.repeat(np.arange(part.n_rows), lengths)
                base = np.where(known >= 0, log_count[np.maximum(known, 0)] if len(log_count) else 0.0, 0.0)
                log_p += np.where(target < 0, base, 0)
                rare = np.flatnonzero(known < 0)
                pairs = np.stack((owner[rare].astype(np.uint64), hashes[rare]))
                by = np.lexsort((pairs[1], pairs[0]))
                pairs = pairs[:, by]
                new = np.ones(pairs.shape[1], bool)
                new[1:] = (pairs[:, 1:] != pairs[:, :-1]).any(0)
                at = np.flatnonzero(new)
                times = np.diff(np.append(at, pairs.shape[1]))
                bounds = np.searchsorted(pairs[0][at], np.arange(part.n_rows + 1).astype(np.uint64)).astype(np.int32)
                total = lambda v: pa.array(np.bincount(owner, weights=v, minlength=part.n_rows))  # noqa: E731, B023
                rows = pa.array(row + np.arange(part.n_rows))
                row += part.n_rows
                offsets = pa.array(bounds)
                yield pa.RecordBatch.from_arrays([
                    rows, ids.slice(part.first_row, part.n_rows), held.slice(part.first_row, part.n_rows), pa.array(lengths.astype(np.int64)),
                    pa.array(np.bincount(owner, weights=known >= 0, minlength=part.n_rows).astype(np.int64)), total(base), total(log_p),
                    pa.ListArray.from_arrays(offsets, pa.array(_signed(pairs[1][at]))), pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int64)))],
                    ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "model", "rare", "times"])

    schema = ("row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, model double, rare array<long>, times array<long>")
    scored = stored(map_arrow(texts, run, schema), "scored")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("word"), F.col("x.times").alias("times"))
    known = rare.join(counts.select("word", "n"), "word").groupBy("row").agg(
        F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more"))
    zero = F.lit(0.0)
    joined = scored.drop("rare", "times").join(known, "row", "left")
    total = float(np.log10(vocab.n_tokens + vocab.n_types + 1))
    return joined.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(vocab.n_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", zero) - F.col("n_tokens") * F.lit(total)).alias("base_score"),
        (F.col("model") + F.coalesce("more", zero)).alias("score"))


@register("op2_lm_scoring")
def op2_lm_scoring(spark, sf_dir):
    """All documents scored by a network and counts from those outside the held-out fold."""
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return score(table(spark, sf_dir, "documents"), held)
