"""Benchmark decontamination, in DataFrame functions only.

A document leaks a benchmark item if a window as long as the item is at least ``similarity`` alike, by weighted shingles.
Such a window shares a shingle with the item, so windows are laid where they do: at every start between neighbouring
alignments of shared shingles.  Each window's SimHash is looked up in a multi-index of the items' fingerprints: with
``radius + 1`` blocks of bits, two fingerprints within the radius agree on a block, so all of them are found.  What is
found is verified exactly: sum of the smaller weighted counts over the sum of the larger.

A shingle's weight grows with the number of items per item that has it, as a whole number, so sums are exact.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from .registry import register, table
from .workers import stored

SHINGLE = 5
BITS = 64
#: Item shingles up to this number (about 20 MB) are broadcast to the document scan; more are joined by a shuffle.
BROADCAST_SHINGLES = 400_000


def _hashed(docs: DataFrame) -> DataFrame:
    """``words`` as hashes of the lower-cased words of ``text``."""
    words = F.array_remove(F.split(F.lower(F.coalesce("text", F.lit(""))), "[ \\t-\\r]+"), "")
    return docs.withColumn("words", F.transform(words, lambda w: F.xxhash64(w))).drop("text")


def _shingles(size: int):
    """The hashes of ``size`` consecutive words, by place."""
    places = F.sequence(F.lit(0), F.size("words") - size)
    return F.when(F.size("words") >= size, F.transform(places, lambda i: F.xxhash64(*[F.get("words", i + j) for j in range(size)])))


def item_shingles(benchmark: DataFrame, *, item_col: str, text_col: str) -> DataFrame:
    """``item_id, n_words, size, place, shingle`` of every shingle of every item; items below five words are one shingle."""
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    items = _hashed(items).withColumn("n_words", F.size("words")).filter("n_words > 0").dropDuplicates(["item_id", "words"])
    parts = [items.filter((F.col("n_words") == n) if n < SHINGLE else (F.col("n_words") >= n))
             .select("item_id", "n_words", F.lit(n).alias("size"), F.posexplode(_shingles(n)).alias("place", "shingle")) for n in range(1, SHINGLE + 1)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, *, similarity: float = 0.8, radius: int = 23, id_col: str = "doc_id",
          text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, start, similarity``: the best window of every document and item that are alike.

    ``start`` is the window's first word; of equal windows the first is reported.  A window is cut at the document's ends.
    Null and empty texts, of documents or items, match nothing.  Repeated documents give one row; a document id with
    several texts gets the best window of any.  Rows with a null id are compared under the id null.  Items of the same
    id and different texts are alternatives: the best counts.  Other columns are ignored.  Empty tables give no rows.
    """
    pieces = stored(item_shingles(benchmark, item_col=item_col, text_col=item_text_col), "items")
    facts = pieces.agg(F.count_distinct("item_id", "n_words"), F.count("*"), F.collect_set("size")).first()
    n_items, n_pieces, sizes = facts[0], facts[1], sorted(facts[2])
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    source = source.withColumn("row", F.xxhash64("doc_id", "text"))
    weights = pieces.groupBy("shingle").agg(F.count_distinct("item_id").alias("df"))
    weights = stored(weights.select("shingle", F.round(1000 * F.log(1 + n_items / F.col("df"))).cast("long").alias("weight")), "weights")
    default = round(1000 * math.log(1 + max(n_items, 1)))

    small = F.broadcast if n_pieces <= BROADCAST_SHINGLES else (lambda df: df)
    words = _hashed(source)
    hits = None
    for size in sizes or [SHINGLE]:
        spots = words.select("row", F.posexplode(_shingles(size)).alias("at", "shingle"))
        known = pieces.filter(F.col("size") == size).select("shingle", "item_id", "n_words", "size", "place")
        part = spots.join(small(known), "shingle").select("row", "item_id", "n_words", "size", (F.col("at") - F.col("place")).alias("start"))
        hits = part if hits is None else hits.unionByName(part)
    hits = stored(hits.distinct(), "hits")

    order = Window.partitionBy("row", "item_id", "n_words").orderBy("start")
    following = F.lead("start").over(order)
    last = F.when(following - F.col("start") <= F.ceil(F.col("n_words") * (1 - similarity)) + 1, following - 1).otherwise(F.col("start"))
    windows = hits.withColumn("last", last).select("row", "item_id", "n_words", "size", F.explode(F.sequence("start", "last")).alias("start"))
    leaking = source.join(hits.select("row").distinct(), "row").dropDuplicates(["row"])
    # Each window's shingles with their counts.  A row is cut to its windows before anything is shuffled.
    held = _hashed(leaking.select("row", "text"))
    placed = None
    for size in sizes or [SHINGLE]:
        own = held.withColumn("all", _shingles(size)).withColumn("n", F.size("words")).drop("words")
        part = windows.filter(F.col("size") == size).join(own, "row")
        low = F.greatest(F.col("start"), F.lit(0))
        high = F.least(F.col("start") + F.col("n_words"), F.col("n"))
        part = part.withColumn("parts", F.slice("all", low + 1, F.greatest(high - low - size + 1, F.lit(0))))
        part = part.select("row", "item_id", "n_words", "start", F.explode("parts").alias("shingle"))
        placed = part if placed is None else placed.unionByName(part)
    key = ["row", "item_id", "n_words", "start"]
    counted = placed.groupBy(*key, "shingle").agg(F.count("*").alias("n"))
    counted = stored(counted.join(small(weights), "shingle", "left").withColumn("weight", F.coalesce("weight", F.lit(default)) * F.col("n")), "windows")
    item_counts = pieces.groupBy("item_id", "n_words", "shingle").agg(F.count("*").alias("n_item")).join(small(weights), "shingle")
    item_counts = stored(item_counts.withColumn("weight_item", F.col("weight") * F.col("n_item")).drop("weight"), "item-counts")

    prints = _fingerprints(counted, key, "weight").withColumnRenamed("print", "window_print")
    index = _blocks(_fingerprints(item_counts, ["item_id", "n_words"], "weight_item"), "print", radius)
    probe = _blocks(prints, "window_print", radius)
    near = probe.join(small(index), ["item_id", "n_words", "block", "bits"])
    near = near.filter(F.bit_count(F.col("print").bitwiseXOR(F.col("window_print"))) <= radius).select(*key).distinct()

    totals = item_counts.groupBy("item_id", "n_words").agg(F.sum("weight_item").alias("total_item"))
    shared = counted.join(near, key).join(small(item_counts), ["item_id", "n_words", "shingle"], "left")
    both = F.least(F.col("n"), F.coalesce(F.col("n_item"), F.lit(0)))
    scored = shared.groupBy(*key).agg(F.sum(F.col("weight") / F.col("n") * both).alias("same"), F.sum("weight").alias("total"))
    scored = scored.join(small(totals), ["item_id", "n_words"])
    scored = scored.withColumn("similarity", F.round(F.col("same") / (F.col("total") + F.col("total_item") - F.col("same")), 6))
    named = scored.filter(F.col("similarity") >= similarity).join(leaking.select("row", "doc_id"), "row")
    best = F.max_by(F.struct(F.greatest("start", F.lit(0)).cast("long").alias("start"), "similarity"), F.struct(F.col("similarity"), -F.col("start")))
    return named.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.start", "best.similarity")


def _fingerprints(counts: DataFrame, key: list[str], weight: str) -> DataFrame:
    """``print``: the SimHash of the weighted shingles of each key."""
    bit = lambda b: F.shiftright("shingle", b).bitwiseAND(F.lit(1))
    sums = counts.groupBy(*key).agg(*[F.sum(F.when(bit(b) == 1, F.col(weight)).otherwise(-F.col(weight))).alias(f"b{b}") for b in range(BITS)])
    value = F.lit(0).cast("long")
    for b in range(BITS):
        value = value.bitwiseOR(F.when(F.col(f"b{b}") > 0, F.lit(1 << b if b < 63 else -(1 << 63)).cast("long")).otherwise(F.lit(0).cast("long")))
    return sums.select(*key, value.alias("print"))


def _blocks(prints: DataFrame, column: str, radius: int) -> DataFrame:
    """One row per block of bits: ``radius + 1`` blocks, so that prints within the radius share one."""
    n = radius + 1
    edges = [BITS * k // n for k in range(n + 1)]
    parts = [F.struct(F.lit(k).alias("block"), F.shiftrightunsigned(column, edges[k]).bitwiseAND(F.lit((1 << (edges[k + 1] - edges[k])) - 1)).alias("bits")) for k in range(n)]
    return prints.withColumn("part", F.explode(F.array(*parts))).select("*", "part.block", "part.bits").drop("part")


def remove_leaking(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that leak no item, with all their columns; rows with a null id stay."""
    found = leaks(docs, benchmark, id_col=id_col, **options).select(F.col("doc_id").alias(id_col)).dropna().distinct()
    return docs.join(stored(found, "leaking"), id_col, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


SQL = """
WITH words AS (
    SELECT 'd' AS kind, doc_id AS id, list_filter(regexp_split_to_array(lower(text), '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '') AS w FROM documents
    UNION ALL
    SELECT 'i', item_id, list_filter(regexp_split_to_array(lower(text), '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '') FROM benchmark),
places AS (
    SELECT kind, id, len(w) AS n_words, UNNEST(range(0, len(w) - 4)) AS pos, w FROM words WHERE len(w) >= 5),
shingles AS (
    SELECT kind, id, n_words, pos, array_to_string(w[pos + 1:pos + 5], ' ') AS s FROM places),
item_shingles AS (SELECT id AS item_id, n_words, pos AS place, s FROM shingles WHERE kind = 'i'),
n_items AS (SELECT count(DISTINCT item_id) AS n FROM item_shingles),
weights AS (
    SELECT s, CAST(round(1000 * ln(1 + any_value(n) / count(DISTINCT item_id))) AS BIGINT) AS weight
    FROM item_shingles, n_items GROUP BY s),
alignments AS (
    SELECT DISTINCT d.id AS doc_id, i.item_id, i.n_words, d.pos - i.place AS start
    FROM shingles d JOIN item_shingles i USING (s) WHERE d.kind = 'd'),
followed AS (
    SELECT *, lead(start) OVER (PARTITION BY doc_id, item_id ORDER BY start) AS following FROM alignments),
starts AS (
    SELECT DISTINCT doc_id, item_id, n_words, UNNEST(range(start,
        CASE WHEN following - start <= ceil(n_words * 0.2) + 1 THEN following ELSE start + 1 END)) AS start
    FROM followed),
window_counts AS (
    SELECT doc_id, item_id, t.n_words, start, d.s, count(*) AS n
    FROM starts t JOIN shingles d ON d.kind = 'd' AND d.id = t.doc_id AND d.pos >= start AND d.pos + 5 <= start + t.n_words
    GROUP BY ALL),
item_counts AS (SELECT item_id, s, count(*) AS n FROM item_shingles GROUP BY ALL),
item_totals AS (SELECT item_id, sum(n * weight) AS total FROM item_counts JOIN weights USING (s) GROUP BY ALL),
scored AS (
    SELECT doc_id, c.item_id, start, sum(least(c.n, coalesce(i.n, 0)) * coalesce(w.weight, f.weight)) AS same,
           sum(c.n * coalesce(w.weight, f.weight)) AS total
    FROM window_counts c LEFT JOIN weights w USING (s) LEFT JOIN item_counts i ON i.item_id = c.item_id AND i.s = c.s,
         (SELECT CAST(round(1000 * ln(1 + n)) AS BIGINT) AS weight FROM n_items) f
    GROUP BY ALL),
ratios AS (
    SELECT doc_id, item_id, start, round(same / (s.total + t.total - same), 6) AS similarity FROM scored s JOIN item_totals t USING (item_id))
SELECT doc_id, item_id, greatest(0, arg_max(start, similarity * 1e9 - start)) AS start, max(similarity) AS similarity
FROM ratios WHERE similarity >= 0.8 GROUP BY doc_id, item_id
"""


@register("op4_benchmark_decontamination", SQL)
def op4_benchmark_decontamination(spark, sf_dir):
    """Documents with a window that is at least 80 % a benchmark item."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
