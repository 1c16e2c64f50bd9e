"""Interaction of quality filters: what each removes in every order they could run in.

A document's failures are a row of the mask matrix (0 where it fails a filter, infinite where it does not), and an order's
inverse permutation is a row of the position matrix (at which step each filter runs).  Their min-plus product gives the
step at which the document is removed, or infinity.  Documents with equal failures share that step in every order, so
Spark counts them per part and mask (at most 32 rows a part, whatever the size of the corpus), and the product drives
weighted scatter counts: the removed at their step, the redundant ones at the later steps of the filters they fail.

Text comes to one row of flags in DataFrame functions; Python sees the counts only.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .registry import register, table
from .workers import map_arrow

FILTERS = "ABCDE"
BLANK = "[ \\t-\\r]+"
NEVER = len(FILTERS) + 1
SCHEMA = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, "
          "toxic_lost long, shapley long")


def failures(docs: DataFrame, *, min_words: int = 200, min_distinct_percent: int = 50, max_upper_percent: int = 3, symbols: str = "#$%&*|",
             id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, part, mask`` of every row: bit 0 to 4 of ``mask`` is set where the row fails filter A to E.

    A: fewer than ``min_words`` words.  B: distinct words below ``min_distinct_percent`` of the words.  C: A-Z above
    ``max_upper_percent`` of the code points.  D: holds any of ``symbols``.  E: the text of a smaller id.  Null texts are
    empty, and equal to other empty ones; null languages are the part ``''``.  Repeated rows with one id are not copies of
    each other.  A row with a null id is nobody's original and never fails E.  Other columns are ignored.

    Texts are compared by SHA-256.  The smallest id per text combines on the map side, and rows meet it by digest and id
    together, so a text that a third of all rows share is spread by id.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    rows = rows.withColumn("words", F.array_remove(F.split("text", BLANK), ""))
    n_words, n_distinct = F.size("words"), F.size(F.array_distinct("words"))
    n_upper = F.char_length("text") - F.char_length(F.regexp_replace("text", "[A-Z]+", ""))
    fails = [n_words < min_words, 100 * n_distinct < min_distinct_percent * n_words, 100 * n_upper > max_upper_percent * F.char_length("text"),
             F.char_length(F.translate("text", symbols, "")) < F.char_length("text")]
    own = sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))
    rows = rows.select("doc_id", "part", own.alias("own"), F.unhex(F.sha2("text", 256)).alias("digest"))
    first = (docs.select(F.col(id_col).cast("long").alias("first"), F.unhex(F.sha2(text, 256)).alias("of")).filter("first is not null")
             .groupBy("of").agg(F.min("first").alias("first")))
    joined = rows.join(first, (F.col("digest") == F.col("of")) & (F.col("doc_id") == F.col("first")), "left")
    copy = F.col("first").isNull() & F.col("doc_id").isNotNull()
    return joined.select("doc_id", "part", (F.col("own") + F.when(copy, 1 << 4).otherwise(0)).alias("mask"))


def orders(n: int = len(FILTERS)) -> np.ndarray:
    """All orders of ``n`` filters, one per row."""
    return np.array(list(permutations(range(n))))


def removal_steps(masks: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Step (from 1) at which each mask (rows) is removed in each order (columns); ``NEVER`` where it is not.

    The min-plus product of the mask matrix with the orders' inverse permutations.
    """
    n = order.shape[1]
    position = np.empty_like(order)
    np.put_along_axis(position, order, np.broadcast_to(np.arange(1, n + 1), order.shape), axis=1)
    fails = (masks[:, None] >> np.arange(n)) & 1
    weight = np.where(fails == 1, 0, NEVER)
    return np.minimum((weight[:, None, :] + position[None, :, :]).min(axis=2), NEVER)


def interactions(masks: np.ndarray, n: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> dict[str, np.ndarray]:
    """Counts of all orders (rows) and steps (columns) from how many rows, good and toxic ones have each mask."""
    order = orders()
    n_orders, n_steps = order.shape
    step = removal_steps(masks, order)
    line = np.arange(n_orders)

    def scatter(weights: np.ndarray) -> np.ndarray:
        out = np.zeros((n_orders, NEVER), np.int64)
        np.add.at(out, (np.broadcast_to(line, step.shape), step - 1), np.broadcast_to(weights[:, None], step.shape))
        return out[:, :n_steps]

    removed = scatter(n)
    fails = (masks[:, None] >> np.arange(n_steps)) & 1
    failing = (fails * n[:, None]).sum(axis=0)[order]  # rows that fail the filter of each step, removed at it, earlier or never later
    alone = np.array([n[masks == 1 << k].sum() for k in range(n_steps)])[order]
    total = np.zeros(n_steps, np.int64)
    np.add.at(total, order, removed)
    return {"kept": n.sum() - np.cumsum(removed, axis=1), "removed": removed, "redundant": failing - removed, "unique_fails": alone,
            "good_lost": scatter(good), "toxic_lost": scatter(toxic), "shapley": total[order]}


def audit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", quality_col: str = "quality", toxic_col: str = "toxic", **columns) -> DataFrame:
    """One row per part (language), order of the five filters and step, with the counts of ``interactions``.

    A row counts as good or toxic if any label row of its id says so; ids without labels, and null ids, are neither.
    Repeated rows count each.  No documents give no rows.
    """
    marks = labels.select(F.col(id_col).cast("long").alias("marked"), (F.col(quality_col) == 1).alias("good"), (F.col(toxic_col) == 1).alias("toxic"))
    marks = marks.groupBy("marked").agg(F.max("good").cast("long").alias("good"), F.max("toxic").cast("long").alias("toxic"))
    rows = failures(docs, id_col=id_col, **columns).join(marks, F.col("doc_id") == F.col("marked"), "left")
    counts = rows.groupBy("part", "mask").agg(F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
                                              F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))
    by_part = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # 32 at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = orders()
        names = ["".join(FILTERS[f] for f in o) for o in order]
        n_steps = len(FILTERS)
        for batch in batches:
            for part, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = interactions(*[np.array([c[k] for c in cells], np.int64) for k in ("mask", "n", "good", "toxic")])
                arrays = [pa.array([part] * order.size, pa.string()), pa.array(np.repeat(names, n_steps), pa.string()),
                          pa.array(np.tile(np.arange(1, n_steps + 1), len(names)), pa.int32()), *[pa.array(v.ravel(), pa.int64()) for v in found.values()]]
                yield pa.RecordBatch.from_arrays(arrays, ["part", "filter_order", "step", *found])

    return map_arrow(by_part, run, SCHEMA)


#: The same counts, from each mask's removal step in each order.
SQL = r"""
WITH words AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda w: w <> '') AS w
    FROM documents),
flags AS (
    SELECT part, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
           100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 3 * length(text) AS c,
           regexp_matches(text, '[#$%&*|]') AS d, coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e,
           doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good, doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic
    FROM words),
cells AS (
    SELECT part, CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END
               || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END AS fails,
           count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic
    FROM flags GROUP BY ALL),
letter AS (SELECT UNNEST(['A', 'B', 'C', 'D', 'E']) AS x),
chain AS (
    SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM letter p, letter q, letter r, letter s, letter t
    WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
ranked AS (
    SELECT part, fails, n, n_good, n_toxic, filter_order,
           CASE WHEN fails = '' THEN 6 ELSE list_min(list_transform(string_split(fails, ''), lambda f: strpos(filter_order, f))) END AS gone
    FROM cells, chain),
steps AS (SELECT filter_order, s AS step, filter_order[s] AS own FROM chain, range(1, 6) r(s)),
counted AS (
    SELECT part, s.filter_order, own, step, sum(n) FILTER (gone > step) AS kept, sum(n) FILTER (gone = step) AS removed,
           sum(n) FILTER (contains(fails, own) AND gone < step) AS redundant, sum(n) FILTER (fails = own) AS unique_fails,
           sum(n_good) FILTER (gone = step) AS good_lost, sum(n_toxic) FILTER (gone = step) AS toxic_lost
    FROM ranked r JOIN steps s USING (filter_order) GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM counted
"""


@register("op13_filter_audit", SQL)
def op13_filter_audit(spark, sf_dir):
    """Every order of five filters over all documents, per language."""
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
