"""Substring deduplication by super-k-mer partitioning.

A window is ``length`` consecutive words.  Its minimiser is the smallest hash among the runs of ``minimiser`` words in it,
so equal windows have equal minimisers.  Consecutive windows with the same minimiser travel as one packed string (a
super-k-mer) to the minimiser's bucket; there the windows of all strings are sorted and counted exactly.  Windows that
start twice or more are sent back as word ranges, and each document drops the words they cover.

Equal strings of a task travel once with the list of their places, so a passage that a third of all rows share costs a
bucket one string per task.  A phrase shorter than a window, in a third of all rows with other words around it, does not:
all its strings differ and have one minimiser.  A first pass therefore counts what each bucket would get.  In a bucket
beyond ``HOT_BYTES`` the windows travel one by one, as their two hashes, dealt by the hash of the window itself, which equal
windows share and others do not; so a task holds at most ``HOT_BYTES`` of strings or about ``HOT_WINDOWS`` windows.

Windows are compared by two 64-bit hashes with bases of their own, words and windows alike.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .registry import register, table
from .textbytes import joined, mix, ragged, span_hashes, split_words, windows
from .workers import map_arrow

#: Bytes of strings a task gathers before it sends them.
FLUSH_BYTES = 48 << 20
#: Bytes of strings from which a bucket is dealt by windows, and windows a part of it gets.
HOT_BYTES, HOT_WINDOWS = 96 << 20, 1 << 20


def super_kmers(words, length: int, minimiser: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of words, row and minimiser of each super-k-mer of a slice."""
    small, bounds = windows(words.hashes(), words.bounds, minimiser)
    span = length - minimiser + 1
    value, place = small.copy(), np.arange(len(small))
    have = 1
    while have < span:  # leftmost minimum over `have` runs from each place, widened up to `span`
        step = min(have, span - have)
        later = value[step:] < value[:-step]
        value[:-step] = np.where(later, value[step:], value[:-step])
        place[:-step] = np.where(later, place[step:], place[:-step])
        have += step
    counts = np.maximum(np.diff(bounds) - span + 1, 0)
    row = np.repeat(np.arange(len(counts)), counts)
    at = ragged(bounds[:-1], counts)
    if not len(at):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, np.zeros(0, np.uint64)
    new = np.ones(len(at), bool)
    new[1:] = (place[at[1:]] != place[at[:-1]]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    n_windows = np.diff(np.append(first, len(at)))
    own = row[first]
    return at[first] - bounds[own] + words.bounds[own], n_windows + length - 1, own, value[at[first]]


def _send(strings: dict[tuple[int, bytes], list], schema_names: list[str]) -> pa.RecordBatch:
    """One row per bucket: its strings, how often each occurs, and the row keys and first words of the places."""
    by: dict[int, list] = {}
    for (bucket, text), places in strings.items():
        by.setdefault(bucket, []).append((text, places))
    buckets, texts, places = [], [], []
    for bucket, found in by.items():
        counts = np.array([len(p) // 2 for _, p in found], np.int64)
        flat = np.array([x for _, p in found for x in p], np.int64)
        buckets.append(bucket)
        texts.append(pa.compress(b"\n".join(t for t, _ in found), codec="zstd", asbytes=True))
        raw = np.concatenate(([len(counts)], counts, flat[0::2], flat[1::2])).astype("<i8").tobytes()
        places.append(np.int64(len(raw)).tobytes() + pa.compress(raw, codec="zstd", asbytes=True))
    sizes = [sum(len(t) + 1 for t, _ in found) for found in by.values()]
    return pa.RecordBatch.from_arrays([pa.array(buckets, pa.int64()), pa.array(sizes, pa.int64()), pa.array(texts, pa.binary()),
                                       pa.array(places, pa.binary())], schema_names)


def window_hashes(part, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Both hashes of each window of a slice, and the bounds of each row's windows."""
    one, bounds = windows(part.hashes(), part.bounds, length)
    two, _ = windows(part.hashes(second=True), part.bounds, length, seed=2)
    return one, two, bounds


def repeated(one: np.ndarray, two: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Which pairs of hashes occur twice or more, each counted by its weight."""
    twice = np.zeros(len(one), bool)
    if not len(one):
        return twice
    by = np.argsort(one, kind="stable")
    same = one[by][1:] == one[by][:-1]
    if np.any(same & (two[by][1:] != two[by][:-1])):
        by = np.lexsort((two, one))
        same = (one[by][1:] == one[by][:-1]) & (two[by][1:] == two[by][:-1])
    heads = np.flatnonzero(np.concatenate(([True], ~same)))
    total = np.add.reduceat(weights[by], heads)
    twice[by] = np.repeat(total >= 2, np.diff(np.append(heads, len(by))))
    return twice


def _send_windows(bucket: np.ndarray, columns: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    """One row per part of a hot bucket: the hashes, and the row keys and first words, of its windows."""
    by = np.argsort(bucket, kind="stable")
    heads = np.flatnonzero(np.concatenate(([True], bucket[by][1:] != bucket[by][:-1])))
    ends = np.append(heads[1:], len(by))
    pack = lambda which, at: pa.compress(b"".join(columns[k][by[at]].astype("<u8" if k < 2 else "<i8").tobytes() for k in which), codec="zstd", asbytes=True)
    pieces = [slice(a, b) for a, b in zip(heads, ends)]
    return pa.RecordBatch.from_arrays([pa.array(bucket[by][heads], pa.int64()), pa.array(ends - heads, pa.int64()),
                                       pa.array([pack((0, 1), at) for at in pieces], pa.binary()), pa.array([pack((2, 3), at) for at in pieces], pa.binary())], names)


def _window_ranges(rows: list[tuple], length: int) -> pa.RecordBatch:
    """Word ranges that the repeated windows of one part of a hot bucket cover."""
    read = lambda packed, n: np.frombuffer(pa.decompress(packed, 16 * n, codec="zstd", asbytes=True), "<u8")
    hashes = [read(packed, n) for _, n, packed, _ in rows]
    places = [read(packed, n).view("<i8") for _, n, _, packed in rows]
    half = lambda arrays, k: np.concatenate([a[k * (len(a) // 2):(k + 1) * (len(a) // 2)] for a in arrays])
    key, at = half(places, 0), half(places, 1)
    hit = np.flatnonzero(repeated(half(hashes, 0), half(hashes, 1), np.ones(len(key), np.int64)))
    hit = hit[np.lexsort((at[hit], key[hit]))]
    key, at = key[hit], at[hit]
    apart = np.ones(len(key), bool)
    apart[1:] = (key[1:] != key[:-1]) | (at[1:] > at[:-1] + 1)
    start = np.flatnonzero(apart)
    stop = np.append(start[1:], len(key)) - 1 if len(key) else start
    return pa.RecordBatch.from_arrays([pa.array(key[start]), pa.array(at[start]), pa.array(at[stop] + length)], ["key", "begin", "end"])


def bucket_of(value: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(value + np.uint64(1)) % np.uint64(buckets)).astype(np.int64)


def hot_buckets(docs: DataFrame, *, length: int, minimiser: int, buckets: int) -> dict[int, int]:
    """Parts of each bucket that would get more than ``HOT_BYTES``; at most one entry a bucket comes to the driver."""
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, n_windows = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        kept: list[tuple] = []
        held = 0

        def settle():
            if kept:
                _, first = np.unique(np.concatenate([k[1] for k in kept]), return_index=True)  # equal strings travel once
                np.add.at(size, np.concatenate([k[0] for k in kept])[first], np.concatenate([k[2] for k in kept])[first])
                kept.clear()

        for batch in batches:
            for part in split_words(batch.column(0)):
                word, n, _, value = super_kmers(part, length, minimiser)
                if not len(word):
                    continue
                text, starts = joined(part)
                bucket, begin, end = bucket_of(value, buckets), starts[word], starts[word + n] - 1
                np.add.at(n_windows, bucket, n - length + 1)
                kept.append((bucket, span_hashes(text, begin, end), end - begin))
                held += int((end - begin).sum())
                if held > FLUSH_BYTES:
                    settle()
                    held = 0
        settle()
        some = np.flatnonzero(n_windows)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(size[some]), pa.array(n_windows[some])], ["bucket", "size", "n_windows"])

    weighed = map_arrow(docs.select("text"), weigh, "bucket long, size long, n_windows long")
    heavy = weighed.groupBy("bucket").agg(F.sum("size").alias("size"), F.sum("n_windows").alias("n_windows")).filter(F.col("size") > HOT_BYTES)
    return {r["bucket"]: max(2, -(-r["n_windows"] // HOT_WINDOWS)) for r in heavy.collect()}


def repeated_ranges(texts: list[bytes], counts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """String, first word and end word of the runs of windows that occur twice or more; ``counts`` weighs each string."""
    weights, first_hash, second_hash, owner, offset = [], [], [], [], []
    base = 0
    for part in split_words(pa.array(texts, pa.large_binary()).view(pa.large_string())):
        one, two, bounds = window_hashes(part, length)
        n = np.diff(bounds)
        rows = np.repeat(np.arange(part.n_rows), n)
        owner.append(rows + base)
        offset.append(np.arange(len(rows)) - bounds[:-1][rows])
        weights.append(counts[rows + base])
        first_hash.append(one)
        second_hash.append(two)
        base += part.n_rows
    owner, offset, weights = np.concatenate(owner), np.concatenate(offset), np.concatenate(weights)
    one, two = np.concatenate(first_hash), np.concatenate(second_hash)
    hit = np.flatnonzero(repeated(one, two, weights))
    if not len(hit):
        return hit, hit, hit
    apart = np.ones(len(hit), bool)
    apart[1:] = (np.diff(hit) > 1) | (owner[hit[1:]] != owner[hit[:-1]])
    start = np.flatnonzero(apart)
    stop = np.append(start[1:], len(hit)) - 1
    return owner[hit[start]], offset[hit[start]], offset[hit[stop]] + length


def ranges(docs: DataFrame, *, length: int, minimiser: int, buckets: int) -> DataFrame:
    """``key, begin, end``: word ranges of each row (columns ``key``, ``text``) that repeated windows cover."""
    names = ["bucket", "size", "texts", "places"]
    hot = hot_buckets(docs, length=length, minimiser=minimiser, buckets=buckets)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings: dict[tuple[int, bytes], list] = {}
        loose: list[tuple] = []
        held = 0
        parts = np.zeros(buckets, np.int64)
        parts[list(hot)] = list(hot.values())
        first_part = buckets + np.cumsum(parts) - parts
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            for part in split_words(batch.column(1)):
                word, n, row, value = super_kmers(part, length, minimiser)
                of = bucket_of(value, buckets)
                apart = parts[of] > 0
                if apart.any():
                    one, two, bounds = window_hashes(part, length)
                    count = n[apart] - length + 1
                    own, home = np.repeat(row[apart], count), np.repeat(of[apart], count)
                    at = ragged(word[apart] - part.bounds[row[apart]], count)
                    window = bounds[own] + at
                    to = first_part[home] + (one[window] % parts[home].astype(np.uint64)).astype(np.int64)
                    loose.append((to, one[window], two[window], keys[part.first_row + own], at))
                    held += 40 * len(at)
                    word, n, row, of = word[~apart], n[~apart], row[~apart], of[~apart]
                text, starts = joined(part)
                raw = text.tobytes()
                local = (word - part.bounds[row]).tolist()
                own = keys[part.first_row + row].tolist()
                for b, low, high, key, at in zip(of.tolist(), starts[word].tolist(), (starts[word + n] - 1).tolist(), own, local):
                    packed = (b, raw[low:high])
                    places = strings.get(packed)
                    if places is None:
                        strings[packed] = [key, at]
                        held += high - low + 120
                    else:
                        places += (key, at)
                        held += 16
                if held > FLUSH_BYTES:
                    yield _send(strings, names)
                    if loose:
                        to, *columns = (np.concatenate(c) for c in zip(*loose))
                        yield _send_windows(to, columns, names)
                    strings, loose, held = {}, [], 0
        yield _send(strings, names)
        if loose:
            to, *columns = (np.concatenate(c) for c in zip(*loose))
            yield _send_windows(to, columns, names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(*[batch.column(k).to_pylist() for k in range(4)])

        for bucket, group in groupby(rows(), key=lambda r: r[0]):
            if bucket >= buckets:
                yield _window_ranges(list(group), length)
                continue
            texts, n, keys, firsts = [], [], [], []
            for _, size, packed, places in group:
                texts += pa.decompress(packed, size - 1, codec="zstd", asbytes=True).split(b"\n")
                raw = np.frombuffer(pa.decompress(places[8:], int(np.frombuffer(places[:8], "<i8")[0]), codec="zstd", asbytes=True), "<i8")
                some = int(raw[0])
                n.append(raw[1:1 + some])
                half = (len(raw) - 1 - some) // 2
                keys.append(raw[1 + some:1 + some + half])
                firsts.append(raw[1 + some + half:])
            n, keys, firsts = np.concatenate(n), np.concatenate(keys), np.concatenate(firsts)
            bounds = np.concatenate(([0], np.cumsum(n)))
            which, begin, end = repeated_ranges(texts, n, length)
            place = ragged(bounds[which], n[which])
            repeat = np.repeat(np.arange(len(which)), n[which])
            yield pa.RecordBatch.from_arrays([pa.array(keys[place]), pa.array(firsts[place] + begin[repeat]), pa.array(firsts[place] + end[repeat])],
                                             ["key", "begin", "end"])

    sent = map_arrow(docs.select("key", "text"), split, "bucket long, size long, texts binary, places binary")
    return map_arrow(sent.repartition("bucket").sortWithinPartitions("bucket"), count, "key long, begin long, end long")


def dedup_substrings(docs: DataFrame, *, length: int = 35, minimiser: int = 4, id_col: str = "doc_id", text_col: str = "text",
                     with_text: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row, and ``text`` (kept words joined by a space) if asked for.

    A word goes if a window over it occurs elsewhere in the input, in the same row too.  Null and empty texts have no
    words.  Repeated rows are each other's copies, so they lose all words of their windows.  Texts with fewer words than
    ``length`` have no window.  Rows with a null id take part like others.  Other columns are ignored.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    source = source.withColumn("key", F.xxhash64("doc_id", "text"))
    buckets = 16 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = ranges(source, length=length, minimiser=minimiser, buckets=buckets)
    by_row = found.groupBy("key").agg(F.collect_list(F.struct("begin", "end")).alias("cut"))  # at most one range per word of a row

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = batch.column(2)
            n_words, n_removed, digest, kept_text = [], [], [], []
            for part in split_words(batch.column(1)):
                text, starts = joined(part)
                raw = text.tobytes()
                for k in range(part.n_rows):
                    low, high = int(part.bounds[k]), int(part.bounds[k + 1])
                    cut = cuts[part.first_row + k].as_py()
                    n = high - low
                    if not cut:
                        kept, gone = raw[starts[low]:max(starts[low], starts[high] - 1)], 0
                    else:
                        edge = np.zeros(n + 1, np.int64)
                        np.add.at(edge, [c["begin"] for c in cut], 1)
                        np.add.at(edge, [c["end"] for c in cut], -1)
                        stay = np.concatenate(([False], np.cumsum(edge[:-1]) == 0, [False]))
                        turn = np.flatnonzero(stay[1:] != stay[:-1])
                        runs = list(zip(turn[0::2].tolist(), turn[1::2].tolist()))
                        kept = b" ".join(raw[starts[low + a]:starts[low + b] - 1] for a, b in runs)
                        gone = n - sum(b - a for a, b in runs)
                    n_words.append(n)
                    n_removed.append(gone)
                    digest.append(hashlib.sha256(kept).hexdigest())
                    if with_text:
                        kept_text.append(kept.decode())
            arrays = [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digest, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays + ([pa.array(kept_text, pa.string())] if with_text else []),
                                             ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["text"] * with_text)

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", text string" if with_text else "")
    return map_arrow(source.join(by_row, "key", "left").select("doc_id", "text", "cut"), remove, schema)


@register("op7_substring_dedup")
def op7_substring_dedup(spark, sf_dir):
    """All documents without the words of windows of 35 words that occur elsewhere."""
    return dedup_substrings(table(spark, sf_dir, "documents"))
