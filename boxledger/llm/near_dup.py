"""Near-duplicate documents by bottom-k sketches.

One hash function orders all word shingles; a document's sketch is its ``k`` smallest values.  Documents with equal
shingle sets are one node.  Inverted lists of retained values generate the overlaps, the sketch of a pair's union
estimates its similarity and filters, and links are confirmed on full sets.

Which lists: two similar nodes share many retained values, so they share one even among the rarest of each (the prefix
that remains when the smallest possible overlap is taken off).  Only those prefixes are listed, which keeps passages
shared by unlike documents out of the lists.  A short list gives all its pairs.  A long one is a family of near copies:
its members are compared with its centre, the member with the fewest shingles of its own.

Members outside the family's largest component have been found unlike the centre, and that bounds whom they can be like.
What two nodes share lies in the centre or not.  Either what each shares with the centre is already enough for the two (then
the other node is no larger than a size that follows from that share, and a join by size finds it), or they share a shingle
that the centre does not have.  So such members go into new lists, and these are treated the same way: all pairs if short, a
centre of their own if long.  In the first round the lists are those of the rarest shingles of the members' full sets, once for
each member, which is far closer than a sketch; after it, one for each shingle that the centre lacks (the rarest of a member's,
as many as the share that the centre cannot give asks for).  Where no more than ``FEW_OUTSIDE`` members of a list are outside, they are compared
with all others of it, which is linear in the list; after ``ROUNDS`` rounds, so are all that are left.  No link between
components is missed, and no family gives all its pairs.

The chance that a pair's overlap falls below the bound is that of ``SIGMAS`` standard deviations, about one in 10^7.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .graph import components
from .registry import register, table
from .textbytes import mix, split_words, windows
from .workers import map_arrow, only_marked, stored

SIGMAS = 5.5
#: Bytes of text that a task cuts into shingles and sends at once; a longer text goes alone.
SLICE_BYTES = 1 << 19
#: Lists up to this length give all their pairs.
SHORT_LIST = 16
#: Members outside the main component up to which they meet the whole list at once.
FEW_OUTSIDE = 40
#: Rounds of ever closer lists before the members that are still outside are compared with everyone in their list.
ROUNDS = 4


def shingle_sets(words, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row; fewer words than ``size`` are one shingle, no words none."""
    value = words.hashes()
    hashed, bounds = windows(value, words.bounds, size)
    for k in range(words.n_rows):
        low, high = words.bounds[k], words.bounds[k + 1]
        if high - low >= size:
            yield np.unique(hashed[bounds[k]:bounds[k + 1]])
        elif high > low:
            short, _ = windows(value[low:high], np.array([0, high - low]), int(high - low), int(high - low) + 100)
            yield short
        else:
            yield np.zeros(0, np.uint64)


def node_of(values: np.ndarray) -> int:
    """A 64-bit fingerprint of a set, equal for equal sets whatever their order."""
    with np.errstate(over="ignore"):
        return int(mix(np.array([values.sum(dtype=np.uint64) * np.uint64(3) + np.bitwise_xor.reduce(mix(values)) + np.uint64(len(values))]))[0].astype(np.int64))


def sketches(docs: DataFrame, *, k: int, size: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, node, n_shingles, sketch`` of every row; ``node`` is null and the sketch empty without words."""
    def run(batches):
        for batch in batches:
            for part in split_words(batch.column(1), lower=True, limit=SLICE_BYTES):
                node, n, sketch = [], [], []
                for values in shingle_sets(part, size):
                    node.append(node_of(values) if len(values) else None)
                    n.append(len(values))
                    sketch.append(np.sort(values[:k]).view(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.first_row, part.n_rows), pa.array(node, pa.int64()), pa.array(n, pa.int64()),
                                                  pa.array(sketch, pa.list_(pa.int64()))], ["doc_id", "node", "n_shingles", "sketch"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(picked, run, "doc_id long, node long, n_shingles long, sketch array<long>")


def full_sets(docs: DataFrame, *, size: int) -> DataFrame:
    """``node, own, values`` of the rows of ``docs`` (columns ``node`` and ``text``); ``own`` is the text's real node."""
    def run(batches):
        for batch in batches:
            for part in split_words(batch.column(1), lower=True, limit=SLICE_BYTES):
                values = list(shingle_sets(part, size))
                own = [node_of(v) if len(v) else None for v in values]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.first_row, part.n_rows), pa.array(own, pa.int64()),
                                                  pa.array([v.view(np.int64) for v in values], pa.list_(pa.int64()))], ["node", "own", "values"])

    return map_arrow(docs.select("node", "text"), run, "node long, own long, values array<long>")


class _Linker:
    """Confirms candidate pairs of nodes: sketch estimate first, then full sets of the nodes that are left."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, *, k: int, size: int, percent: int):
        self.docs, self.nodes, self.k, self.size, self.percent = docs, nodes, k, size, percent
        t = percent / 100
        self.least = t - SIGMAS * math.sqrt(t * (1 - t) / k)

    def sets_of(self, wanted: DataFrame) -> DataFrame:
        """``node, values``: the full sets of the wanted nodes, each from one document that has it."""
        chosen = stored(wanted.join(self.nodes.select("node", F.col("doc").alias("doc_id")), "node"), "chosen")
        texts = only_marked(self.docs, chosen, "doc_id").join(chosen, "doc_id").select("node", "text")
        sets = full_sets(texts, size=self.size)
        return stored(sets.filter("node = own").select("node", "values").dropDuplicates(["node"]), "sets")

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs ``a, b`` whose similarity reaches the threshold, written once."""
        side = lambda x: self.nodes.select(F.col("node").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))
        both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
        both = both.filter((F.col("n_a") * 100 >= F.col("n_b") * self.percent) & (F.col("n_b") * 100 >= F.col("n_a") * self.percent))
        union = F.slice(F.array_sort(F.array_union("s_a", "s_b")), 1, self.k)
        both = both.withColumn("union", union)
        shared = F.size(F.array_intersect(F.array_intersect("union", "s_a"), F.col("s_b")))
        likely = stored(both.filter(shared >= F.size("union") * self.least).select("a", "b", "n_a", "n_b"), "likely")
        sets = self.sets_of(likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct())
        side = lambda x: sets.select(F.col("node").alias(x), F.col("values").alias(f"v_{x}"))
        exact = likely.join(side("a"), "a").join(side("b"), "b").withColumn("same", F.size(F.array_intersect("v_a", "v_b")))
        return stored(exact.filter(F.col("same") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("same")) * self.percent).select("a", "b").distinct(), "links")


def near_duplicates(docs: DataFrame, *, percent: int = 80, k: int = 48, size: int = 5, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Rows are linked when ``100 * |intersection| >= percent * |union|`` of their sets of ``size``-word shingles (A-Z
    lower-cased).  ``component_id`` is the smallest id that can be reached over links, the row's own included; ``kept``
    says that it is the row's own.  Rows without words, null texts among them, are linked with nothing.  Repeated rows
    are exact copies.  A row with a null id links nothing itself: it gets the component of the rows with its set, null if
    there is none, and is not kept.  Other columns are ignored.  No rows give no rows.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    drawn = stored(sketches(source, k=k, size=size, id_col="doc_id", text_col="text"), "sketches")
    nodes = stored(drawn.filter("node is not null and doc_id is not null").groupBy("node").agg(
        F.min("doc_id").alias("doc"), F.max("n_shingles").alias("n_shingles"), F.max("sketch").alias("sketch")), "nodes")

    t = percent / 100
    weak = max(1, math.floor(k * t - SIGMAS * math.sqrt(k * t * (1 - t))))
    spare = F.expr(f"n_shingles * {100 - percent} div 100")  # in whole numbers: 5 * (1 - 0.8) is less than 1
    prefix = F.when(F.col("n_shingles") * 100 <= percent * k, spare).otherwise(F.least("n_shingles", F.lit(k)) - weak) + 1
    values = nodes.select("node", "n_shingles", F.explode("sketch").alias("value"))
    shared = values.groupBy("value").agg(F.count("*").alias("n_nodes")).filter("n_nodes > 1")
    ranked = (values.join(shared, "value").groupBy("node", "n_shingles").agg(F.array_sort(F.collect_list(F.struct("n_nodes", "value"))).alias("common"))
              .select("node", "n_shingles", F.slice("common", 1, F.greatest(F.lit(0), (F.size("common") - F.least("n_shingles", F.lit(k)) + prefix).cast("int"))).alias("common")))
    ranked = ranked.withColumn("common", F.col("common.value"))
    listed = stored(ranked.select("node", "n_shingles", F.explode("common").alias("value"), F.col("node").alias("label")), "lists")
    labels = _families(listed, _Linker(source, nodes, k=k, size=size, percent=percent), percent)

    named = nodes.select("node", "doc").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = named.groupBy("label").agg(F.min("doc").alias("component_id"))
    named = named.join(least, "label").select("node", "component_id")
    out = drawn.select("doc_id", "n_shingles", "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def _alike(percent: int, x: str = "a", y: str = "b"):
    """Sizes allow the two nodes to be alike."""
    return (F.col(f"n_{x}") * 100 >= F.col(f"n_{y}") * percent) & (F.col(f"n_{y}") * 100 >= F.col(f"n_{x}") * percent)


def _side(df: DataFrame, x: str, keys: list[str], *more: str) -> DataFrame:
    return df.select(*keys, F.col("node").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("label").alias(f"l_{x}"), *[F.col(c).alias(f"{c}_{x}") for c in more])


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _families(lists: DataFrame, linker: _Linker, percent: int) -> DataFrame:
    """``node, label`` of all links among nodes that share a list (``value, node, n_shingles, label``)."""
    found, sets, labels = None, None, None
    for depth in range(ROUNDS + 1):
        lengths = lists.groupBy("value").agg(F.count("*").alias("length")).filter("length > 1")
        placed = stored(lists.join(lengths, "value"), "placed")
        short, long = placed.filter(F.col("length") <= SHORT_LIST), placed.filter(F.col("length") > SHORT_LIST)
        pairs = _side(short, "a", ["value"]).join(_side(short, "b", ["value"]), "value")
        pairs = pairs.filter((F.col("a") < F.col("b")) & (F.col("l_a") != F.col("l_b")) & _alike(percent)).select("a", "b")
        if sets is None:
            sets = linker.sets_of(long.select("node").distinct())
        long, stars = _stars(long, sets, percent)
        links = linker.links(_ordered(pairs.union(stars)))
        if found is None or not links.isEmpty():
            found = links if found is None else stored(found.union(links).distinct(), "found")
            labels = components(found)
        member = _outside(long, labels, percent)
        if member.filter("outside").isEmpty():
            return labels
        # A few outside members meet the whole list at once: that is linear in its length.
        few = member.groupBy("value").agg(F.count_if("outside").alias("n")).filter(F.lit(depth == ROUNDS) | (F.col("n") <= FEW_OUTSIDE)).select("value")
        direct = member.join(few, "value", "left_semi")
        pairs = _side(direct.filter("outside"), "a", ["value"], "shared").join(_side(direct, "b", ["value"], "shared"), "value")
        enough = F.least("shared_a", "shared_b") * (100 + percent) >= percent * (F.col("n_a") + F.col("n_b"))
        pairs = pairs.filter((F.col("l_a") != F.col("l_b")) & _alike(percent) & enough).select("a", "b")
        member, lists = stored(member.join(few, "value", "left_anti"), "many"), None
        if not member.isEmpty():
            if depth == 0:
                lists = _rarest(member, sets, percent)
            else:
                more, lists = _apart(member, sets, percent)
                pairs = pairs.union(more)
        late = linker.links(_ordered(pairs))
        if not late.isEmpty():
            found = stored(found.union(late).distinct(), "found")
            labels = components(found)
        if lists is None or lists.isEmpty():
            return labels
        lists = lists.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    return labels


def _stars(long: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The members of long lists with their centre, and the pairs of centres with members.

    ``shared`` is how many of a node's shingles any other member of a long list has.
    """
    sets = sets.join(long.select("node").distinct(), "node", "left_semi")
    each = sets.select("node", F.explode("values").alias("shingle"))
    often = each.groupBy("shingle").agg(F.count("*").alias("n")).filter("n > 1").select("shingle")
    shared = each.join(often, "shingle").groupBy("node").agg(F.count("*").alias("shared"))
    long = stored(long.join(shared, "node", "left").withColumn("shared", F.coalesce("shared", F.lit(0))), "long")
    centre = F.max_by(F.struct(F.col("node").alias("centre"), F.col("shared").alias("s_centre"), F.col("n_shingles").alias("n_centre"), F.col("label").alias("l_centre")),
                      F.struct(F.col("shared") / F.col("n_shingles"), -F.col("node")))
    long = long.join(long.groupBy("value").agg(centre.alias("c")).select("value", "c.*"), "value")
    enough = F.least("shared", "s_centre") * (100 + percent) >= percent * (F.col("n_shingles") + F.col("n_centre"))
    return long, long.filter((F.col("label") != F.col("l_centre")) & enough).select(F.col("centre").alias("a"), F.col("node").alias("b"))


def _outside(long: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Members of long lists, with ``outside`` where they are not in the list's largest component but share enough shingles
    with others to be like one; only lists that have such members."""
    member = stored(long.drop("label").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "members")
    families = member.groupBy("value", "label").agg(F.count("*").alias("n"), F.min("n_shingles").alias("least"))
    main = families.groupBy("value").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.count("*").alias("n_labels"), F.min("least").alias("least"))
    member = member.join(main.filter("n_labels > 1"), "value")
    # The other node has no fewer shingles than the least of the list, or than `percent` of this one's.
    other = F.greatest(F.col("least") * 100, F.col("n_shingles") * percent)
    hopeful = F.col("shared") * (100 + percent) * 100 >= percent * (F.col("n_shingles") * 100 + other)
    member = member.filter(hopeful).withColumn("outside", F.col("label") != F.col("main"))
    some = member.groupBy("value").agg(F.bool_or("outside").alias("some")).filter("some").select("value")
    return stored(member.join(some, "value"), "outside")


def _rarest(member: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """New lists of the members of long lists, one for each of the rarest shingles of a node's full set.

    Only shingles that nodes of different components hold can be common to a pair, and a pair has `percent` of each node's
    shingles in common at least.  So it shares one of the rarest that remain when all but one of these are taken off.  Every
    node is counted and listed once, in however many long lists it is.
    """
    nodes = member.groupBy("node").agg(F.max("n_shingles").alias("n_shingles"), F.max("label").alias("label"), F.bool_or("outside").alias("outside"))
    each = sets.join(nodes, "node").select("node", "n_shingles", "label", "outside", F.explode("values").alias("shingle"))
    often = each.groupBy("shingle").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"), F.bool_or("outside").alias("some"))
    often = often.filter("some and low <> high").select("shingle", "n")
    rare = each.join(often, "shingle").groupBy("node", "n_shingles").agg(F.array_sort(F.collect_list(F.struct("n", "shingle"))).alias("common"))
    need = F.ceil(F.col("n_shingles") * percent / 100)
    prefix = F.greatest(F.lit(0), F.size("common") - need + 1).cast("int")
    return stored(rare.select("node", "n_shingles", F.explode(F.slice("common.shingle", 1, prefix)).alias("value")), "lists")


def _apart(member: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Whom an outside member can be like: pairs that the centre's shingles alone can link, and new lists by the others.

    Shingles that one member alone has are counted as taken off first: they come before all others in the order of rarity.
    """
    by_centre = member.groupBy("centre", "node").agg(F.max("n_shingles").alias("n_shingles"), F.max("label").alias("label"), F.bool_or("outside").alias("outside"))
    own = by_centre.join(sets, "node").join(sets.select(F.col("node").alias("centre"), F.col("values").alias("core")), "centre")
    own = stored(own.select("centre", "node", "n_shingles", "label", "outside", F.size(F.array_intersect("values", "core")).alias("kept"),
                            F.array_except("values", "core").alias("extra")), "apart")
    one = _side(own.filter("outside"), "a", ["centre"], "kept")
    low, high = F.ceil(F.col("n_a") * percent / 100), F.floor(F.col("kept_a") * (100 + percent) / percent - F.col("n_a"))
    one = one.filter(low <= high).withColumn("n_b", F.explode(F.sequence(low.cast("int"), high.cast("int"))))
    two = _side(own, "b", ["centre"], "kept").withColumn("n_b", F.col("n_b").cast("int"))
    pairs = one.join(two, ["centre", "n_b"]).filter((F.col("l_a") != F.col("l_b")) & (F.least("kept_a", "kept_b") * (100 + percent) >= percent * (F.col("n_a") + F.col("n_b"))))
    # A pair must share `need` extra shingles at least: all that the centre cannot give.  So an outside member is listed by the
    # rarest of its own that remain when all but one of these are taken off, others by whatever of theirs is listed.
    each = own.select("centre", "node", "outside", F.explode("extra").alias("shingle"))
    often = each.groupBy("centre", "shingle").agg(F.count("*").alias("n")).filter("n > 1")
    least = own.groupBy("centre").agg(F.min("n_shingles").alias("least"))
    rare = each.filter("outside").join(often, ["centre", "shingle"]).groupBy("centre", "node").agg(F.array_sort(F.collect_list(F.struct("n", "shingle"))).alias("common"))
    outer = own.filter("outside").join(least, "centre").join(rare, ["centre", "node"])
    other = F.greatest(F.ceil(F.col("n_shingles") * percent / 100), F.col("least"))
    need = F.greatest(F.lit(1), F.ceil(percent * (F.col("n_shingles") + other) / (100 + percent)) - F.col("kept"))
    prefix = F.greatest(F.lit(0), F.size("common") - need + 1).cast("int")
    outer = stored(outer.select("centre", "node", "n_shingles", F.explode(F.slice("common.shingle", 1, prefix)).alias("shingle")), "outer")
    asked = outer.select("centre", "shingle").distinct()
    inner = own.filter(~F.col("outside")).select("centre", "node", "n_shingles", F.explode("extra").alias("shingle")).join(asked, ["centre", "shingle"], "left_semi")
    lists = outer.unionByName(inner.select(*outer.columns)).select("node", "n_shingles", F.xxhash64("centre", "shingle").alias("value"))
    return pairs.select("a", "b"), stored(lists, "lists")


@register("op3_minhash_near_dedup")
def op3_minhash_near_dedup(spark, sf_dir):
    """Components of documents whose word shingles are at least 85 % alike."""
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)
