"""Connected components of large graphs by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .workers import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, label`` for every node of ``edges``; the label is the smallest node that can be reached.

    Every round each node takes the smallest label among its neighbours, or that label's own if it is smaller still, so
    labels jump ahead along chains.  Labels are written each round; nothing is collected.
    """
    both = stored(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).union(edges.select(b, a)).filter("u <> v").distinct(), "edges")
    labels = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("least"))
    labels = stored(labels.select("node", F.least("node", "least").alias("label"), F.lit(True).alias("moved")), "labels")
    while not labels.filter("moved").isEmpty():
        near = (both.join(labels.select(F.col("node").alias("v"), "label"), "v").groupBy(F.col("u").alias("node"))
                .agg(F.min("label").alias("near")))
        hooked = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("next"))
        ahead = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        far = F.least("next", "far")
        labels = stored(hooked.join(ahead, "next").select("node", far.alias("label"), (far != F.col("label")).alias("moved")), "labels")
    return labels.select("node", "label")
