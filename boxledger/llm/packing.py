"""Sequence packing by Karmarkar-Karp multiway differencing.

Texts become token ids and an end id.  Full windows are cut off each document; what is left is cut to grains, and
batches of grains are spread over as few windows as their sum allows: the two partial partitions with the largest
spreads are merged again and again, the fullest windows of one on the emptiest of the other, until one is left.  If a
window exceeds the capacity, the batch is spread over more windows.

Each task packs the rows it reads, so nothing is shuffled, memory is bounded by one batch of grains, and a task that is
run again after the loss of an executor gives the same rows.  Only the last batch of a task is small.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .registry import register, table
from .tokens import encoder
from .workers import map_arrow

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def difference(sizes: np.ndarray, n: int) -> np.ndarray:
    """The window of each item when ``sizes`` are spread over ``n`` windows by multiway differencing.

    A partial partition keeps its non-empty windows in falling order of load and, for each, a linked list of items.
    Ties go to the partition that was made first, so the result depends on ``sizes`` only.
    """
    follows = np.full(len(sizes), -1, np.int64)
    heap = [(-int(s), k, np.array([s]), np.array([k]), np.array([k])) for k, s in enumerate(sizes)]
    heapq.heapify(heap)
    made = len(sizes)
    while len(heap) > 1:
        _, _, a, a_head, a_tail = heapq.heappop(heap)
        _, _, b, b_head, b_tail = heapq.heappop(heap)
        over = max(0, len(a) + len(b) - n)
        # The `over` smallest of b meet the smallest of a in opposite order: falling loads of a on rising loads of b.
        low_a, low_b = slice(len(a) - over, None), slice(len(b) - over, None)
        follows[a_tail[low_a]] = b_head[low_b][::-1]
        loads = np.concatenate((a[:len(a) - over], b[:len(b) - over], a[low_a] + b[low_b][::-1]))
        heads = np.concatenate((a_head[:len(a) - over], b_head[:len(b) - over], a_head[low_a]))
        tails = np.concatenate((a_tail[:len(a) - over], b_tail[:len(b) - over], b_tail[low_b][::-1]))
        by = np.argsort(-loads, kind="stable")
        loads, heads, tails = loads[by], heads[by], tails[by]
        heapq.heappush(heap, (-int(loads[0] - (loads[-1] if len(loads) == n else 0)), made, loads, heads, tails))
        made += 1
    window = np.zeros(len(sizes), np.int64)
    for k, item in enumerate(heap[0][3] if heap else ()):
        while item >= 0:
            window[item] = k
            item = follows[item]
    return window


def spread(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The window of each item, over as few windows as hold them within ``capacity``."""
    if not len(sizes):
        return np.zeros(0, np.int64)
    n = -(-int(sizes.sum()) // capacity)
    while True:
        window = difference(sizes, n)
        if np.bincount(window, weights=sizes).max() <= capacity:
            return window
        n += max(1, n // 256)


def pack(docs: DataFrame, tokenizer_path: str, *, capacity: int = 1024, grain: int = 128, batch: int = 2048, end_id: int = 0,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of all rows of ``docs`` in windows of at most ``capacity`` tokens.

    One row per piece: ``doc_id``, ``start`` (its document's ids before it), ``length``, ``ids_crc32`` (of its ids as
    little-endian 32-bit numbers), ``doc_tokens``, ``sequence_id``, ``offset`` in the sequence; with ``with_ids`` also
    ``ids``, the real tokens.  ``grain`` bounds the pieces that share windows and ``batch`` how many are spread at once.

    Null and empty texts are one piece with the end id.  Repeated rows and null ids are packed row by row.  Very long
    texts are cut like others.  Other columns are ignored, whatever their names.  An empty table gives no rows.
    """
    schema = PIECES + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, base = encoder(tokenizer_path), TaskContext.get().partitionId() << 34
        state = {"sequence": base}
        full: list[tuple] = []
        loose: list[tuple] = []

        def out(rows: list[tuple]) -> pa.RecordBatch:
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            columns = list(zip(*[r[:7] for r in rows])) if rows else [()] * 7
            arrays = [pa.array(c, pa.int64()) for c in columns]
            if with_ids:
                arrays.append(pa.array([r[7] for r in rows], pa.list_(pa.int32())))
                names = [*names, "ids"]
            return pa.RecordBatch.from_arrays(arrays, names)

        def settle(items: list[tuple]) -> list[tuple]:
            window = spread(np.array([x[2] for x in items], np.int64), capacity)
            rows, used = [], {}
            for at, item in zip(window.tolist(), items):
                offset = used.get(at, 0)
                used[at] = offset + item[2]
                rows.append((*item[:5], state["sequence"] + at, offset, *item[5:]))
            state["sequence"] += len(used)
            return rows

        for block in batches:
            for doc_id, ids in zip(block.column(0).to_pylist(), encode.rows(block.column(1))):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                n = len(ids)
                cut = n - n % capacity
                for start in range(0, cut, capacity):
                    piece = ids[start:start + capacity]
                    extra = (piece.tolist(),) if with_ids else ()
                    full.append((doc_id, start, capacity, zlib.crc32(piece.tobytes()), n, state["sequence"], 0, *extra))
                    state["sequence"] += 1
                for start in range(cut, n, grain):
                    piece = ids[start:start + grain]
                    extra = (piece.tolist(),) if with_ids else ()
                    loose.append((doc_id, start, len(piece), zlib.crc32(piece.tobytes()), n, *extra))
                if len(full) > 4096:
                    yield out(full)
                    full.clear()
                while len(loose) >= batch:
                    yield out(settle(loose[:batch]))
                    del loose[:batch]
        yield out(full)
        if loose:
            yield out(settle(loose))

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(picked, run, schema)


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@register("op10_packing")
def op10_packing(spark, sf_dir):
    """All documents packed into sequences of at most 1024 tokens."""
    return pack(table(spark, sf_dir, "documents"), vocabulary())
