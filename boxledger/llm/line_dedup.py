"""Line deduplication by distinct-site spread.

Each line's sites go into a HyperLogLog sketch; sketches of equal lines merge by aggregation, map side first, so a line
that a third of all rows share costs a few sketches.  Lines clearly above the threshold are boilerplate, lines clearly
below are not, and lines whose estimate is within the sketch's error of it get an exact count of their sites.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .registry import register, table
from .workers import stored

#: Half width of the band with exact counts: five standard errors of the sketch, one site at least.
ERRORS = 5


def boilerplate(docs: DataFrame, *, min_sites: int, lg_k: int = 12, site_col: str = "source", text_col: str = "text") -> DataFrame:
    """``line``: hashes of the lines that occur on ``min_sites`` distinct sites or more."""
    lines = docs.select(F.col(site_col).alias("site"), F.explode(F.split(F.col(text_col), "\n")).alias("line")).filter(F.col("line").rlike(r"\S"))
    lines = lines.select(F.xxhash64("line").alias("line"), F.col("site").cast("string").alias("site"))
    band = max(1.0, ERRORS * 1.04 / (1 << (lg_k // 2)) * min_sites)
    spread = lines.groupBy("line").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", lg_k)).alias("sites"))
    spread = stored(spread.filter(F.col("sites") >= min_sites - band), "spread")
    near = spread.filter(F.col("sites") <= min_sites + band).select("line")
    exact = lines.join(near, "line").groupBy("line").agg(F.count_distinct("site").alias("sites"))
    sure = spread.filter(F.col("sites") > min_sites + band).select("line")
    return stored(sure.union(exact.filter(F.col("sites") >= min_sites).select("line")), "boilerplate")


def drop_boilerplate(docs: DataFrame, *, min_sites: int = 10, lg_k: int = 12, id_col: str = "doc_id", site_col: str = "source",
                     text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with their columns and boilerplate lines taken out of the text; ``n_lines`` and ``n_removed`` are added.

    Lines are the stretches between line feeds, compared by 64-bit hashes of their bytes.  A line goes if it occurs on ``min_sites`` distinct
    values of the site column or more; lines of white space are never counted and never go.  A text that consists of
    boilerplate and white space alone is a copy of a whole document, not a page with furniture, and stays as it is.  Null
    sites count as no site, null texts stay null and have no lines, an empty text has one.  Repeated rows are treated
    alike.  Columns ``n_lines`` and ``n_removed`` of the input are replaced; others may have any name.
    """
    kept = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    found = boilerplate(docs, min_sites=min_sites, lg_k=lg_k, site_col=site_col, text_col=text_col)
    key = F.xxhash64(F.col(id_col), F.col(text_col))
    lines = docs.select(key.alias("row"), F.explode(F.transform(F.split(F.col(text_col), "\n"), lambda x: F.xxhash64(x))).alias("line"))
    by_row = lines.join(found, "line").groupBy(F.col("row").alias("_row_key")).agg(F.collect_set("line").alias("_row_lines"))
    joined = docs.select(*[F.col(f"`{c}`") for c in kept], key.alias("_row_key")).join(by_row, "_row_key", "left")
    all_lines = F.split(F.col(text_col), "\n")
    rest = F.filter(all_lines, lambda x: ~F.array_contains(F.col("_row_lines"), F.xxhash64(x)))
    joined = joined.withColumn("_row_rest", F.when(F.col("_row_lines").isNotNull(), rest))
    something = F.exists("_row_rest", lambda x: x.rlike(r"\S"))
    joined = joined.withColumn("_row_rest", F.when(something, F.col("_row_rest")))
    n_lines = F.coalesce(F.size(all_lines).cast("long"), F.lit(0).cast("long"))
    n_lines = F.when(F.col(text_col).isNull(), F.lit(0).cast("long")).otherwise(n_lines)
    removed = F.when(F.col("_row_rest").isNull(), F.lit(0).cast("long")).otherwise(F.size(all_lines).cast("long") - F.size("_row_rest"))
    text = F.coalesce(F.array_join("_row_rest", "\n"), F.col(text_col))
    return joined.select(*[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in kept], n_lines.alias("n_lines"), removed.alias("n_removed"))


SQL = """
WITH lines AS (
    SELECT doc_id, source, text, UNNEST(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
    FROM documents),
boiler AS (
    SELECT line FROM lines WHERE regexp_matches(line, '[^ \\t\\n\\r\\f\\v]')
    GROUP BY line HAVING count(DISTINCT source) >= 10),
parted AS (
    SELECT l.*, b.line IS NOT NULL AS gone, regexp_matches(l.line, '[^ \\t\\n\\r\\f\\v]') AS solid
    FROM lines l LEFT JOIN boiler b USING (line)),
by_doc AS (
    SELECT doc_id, any_value(text) AS text, count(*) AS n_lines, count(*) FILTER (gone) AS n_gone,
           bool_or(solid AND NOT gone) AS something, string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone) AS rest
    FROM parted GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, CASE WHEN something THEN n_gone ELSE 0 END AS n_removed,
       CAST(length(CASE WHEN something AND n_gone > 0 THEN rest ELSE d.text END) AS BIGINT) AS n_chars,
       md5(CASE WHEN something AND n_gone > 0 THEN rest ELSE d.text END) AS text_md5
FROM documents d LEFT JOIN by_doc USING (doc_id)
"""


@register("op5_line_dedup", SQL)
def op5_line_dedup(spark, sf_dir):
    """All documents without lines that ten sites or more share."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return drop_boilerplate(docs).select("doc_id", "n_lines", "n_removed", F.char_length("text").cast("long").alias("n_chars"),
                                         F.md5("text").alias("text_md5"))
