"""Quality rules with adaptive thresholds, in DataFrame functions only.

Ratios of each document are summarised by mergeable quantile sketches (KLL) per language and source.  A group's limits
follow from its own quartiles, ``upper quartile + reach * (upper quartile - lower quartile)``, and nothing else: no ratio
has a fixed cutoff.  Groups with few documents use the merged sketches of their language, and languages with few those of all.  The limits are
joined to the documents, which fail if they break any.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .registry import register, table
from .workers import stored

#: Fixed value: the symbols that count.
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WHITE = " \t\n\x0b\f\r"
BLANK = "[ \\t-\\r]+"
#: Ratio, the least distance of its quartiles that counts as spread, and whether it has a lower limit too.  The least
#: spread keeps a group whose rows agree (no symbols at all, say) from rejecting the first that differs.
RULES = {"symbol_ratio": (0.002, False), "upper_ratio": (0.001, False), "dup_line_ratio": (0.06, False), "repeat_ratio": (0.06, False),
         "word_length": (0.05, True)}
#: Ratios are compared after rounding, so that equal fractions of other numbers stay equal.
PLACES = 9
#: How many spreads beyond its quartiles a ratio may lie.
REACH = 6.0


def _without(text: Column, signs: str) -> Column:
    return F.char_length(F.translate(text, signs, ""))


def measures(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``doc_id, lang, source, n_words, word_chars, n_symbols, n_upper, n_lines, n_dup_lines, n_repeat_words`` of every row.

    Repeated windows are found inside each row: the hashes of its three-word windows are sorted with their places,
    neighbours with equal hashes are repeats, and the words they cover are counted by gaps.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
                       F.col(source_col).cast("string").alias("source"), text.alias("text"))
    rows = rows.withColumn("chars", F.char_length("text")).withColumn("words", F.array_remove(F.split("text", BLANK), ""))
    rows = rows.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike("[^ \\t-\\r]")))
    rows = rows.select(
        "doc_id", "lang", "source", F.size("words").cast("long").alias("n_words"), _without(F.col("text"), WHITE).cast("long").alias("word_chars"),
        (F.col("chars") - _without(F.col("text"), SYMBOLS)).cast("long").alias("n_symbols"),
        (F.col("chars") - _without(F.col("text"), UPPER)).cast("long").alias("n_upper"), F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    window = F.transform(F.sequence(F.lit(0), (F.col("n_words") - 3).cast("int")),
                         lambda i: F.xxhash64(F.get("hashes", i), F.get("hashes", i + 1), F.get("hashes", i + 2)))
    rows = rows.withColumn("windows", F.when(F.col("n_words") >= 3, window)).drop("hashes")
    placed = F.sort_array(F.transform("windows", lambda x, i: F.struct(x.alias("hash"), i.alias("place"))))
    rows = rows.withColumn("sorted", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), placed))

    def hash_at(k: Column) -> Column:
        return F.get("sorted", k)["hash"]

    def equal(j: Column, k: Column) -> Column:
        return F.coalesce(hash_at(j) == hash_at(k), F.lit(False))

    indexed = F.transform("sorted", lambda x, k: F.when(equal(k, k - 1) | equal(k, k + 1), x["place"]))
    rows = rows.withColumn("repeats", F.sort_array(F.filter(indexed, lambda x: x.isNotNull())))
    gaps = F.transform("repeats", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("repeats", k + 1) - p, F.lit(3))))
    covered = F.aggregate(gaps, F.lit(0).cast("long"), lambda total, x: total + x)
    return rows.select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_upper", "n_lines", "n_dup_lines",
                       F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"))


def _ratios(measured: DataFrame) -> DataFrame:
    per = lambda a, b: F.round(F.try_divide(a, b), PLACES)  # noqa: E731; null without words
    return measured.select("*", per("n_symbols", "word_chars").alias("symbol_ratio"), per("n_upper", "word_chars").alias("upper_ratio"),
                           per("n_dup_lines", "n_lines").alias("dup_line_ratio"), per("n_repeat_words", "n_words").alias("repeat_ratio"),
                           per("word_chars", "n_words").alias("word_length"))


def thresholds(measured: DataFrame, *, min_words: int, min_docs: int, reach: float, k: int) -> DataFrame:
    """``lang, source`` and the limits of each rule, from sketches of the rows with ``min_words`` words or more."""
    rows = _ratios(measured.filter(F.col("n_words") >= min_words))
    own = stored(rows.groupBy("lang", "source").agg(F.count("*").alias("n"), *[F.kll_sketch_agg_double(c, F.lit(k)).alias(c) for c in RULES]), "sketches")
    merged = [F.sum("n").alias("n")] + [F.kll_merge_agg_double(c, F.lit(k)).alias(c) for c in RULES]
    by_lang = own.groupBy("lang").agg(*merged)
    of_all = own.agg(*merged)
    two = by_lang.select(F.col("lang").alias("lang_of"), F.col("n").alias("n_lang"), *[F.col(c).alias(f"{c}_lang") for c in RULES])
    three = of_all.select(*[F.col(c).alias(f"{c}_all") for c in RULES])  # one row
    joined = own.join(two, F.col("lang").eqNullSafe(F.col("lang_of"))).join(F.broadcast(three))
    out = []
    for c, (least, both) in RULES.items():
        sketch = F.when(F.col("n") >= min_docs, F.col(c)).when(F.col("n_lang") >= min_docs, F.col(f"{c}_lang")).otherwise(F.col(f"{c}_all"))
        q1, q3 = F.kll_sketch_get_quantile_double(sketch, F.lit(0.25)), F.kll_sketch_get_quantile_double(sketch, F.lit(0.75))
        spread = F.greatest(F.lit(least), q3 - q1)
        out.append((q3 + reach * spread).alias(f"{c}_max"))
        if both:
            out.append((q1 - reach * spread).alias(f"{c}_min"))
    return joined.select("lang", "source", *out)


def apply_rules(docs: DataFrame, *, min_words: int = 50, min_docs: int = 40, reach: float = REACH, k: int = 2048, **columns) -> DataFrame:
    """The measures of every row with ``base_failed`` and ``kept``.

    ``base_failed``: fewer than ``min_words`` words, or more than half of them in repeated three-word windows.  ``kept``: not
    that, and within the limits of the row's language and source; null languages and sources are groups like others.
    Null, empty and blank texts have no words and no ratios, and fail.  Repeated rows get the same verdict.  Other columns are ignored.
    """
    measured = stored(measures(docs, **columns), "measures")
    limit = thresholds(measured, min_words=min_words, min_docs=min_docs, reach=reach, k=k)
    limit = limit.select(F.col("lang").alias("lang_of"), F.col("source").alias("source_of"), *[c for c in limit.columns if c not in ("lang", "source")])
    rows = _ratios(measured).join(limit, F.col("lang").eqNullSafe(F.col("lang_of")) & F.col("source").eqNullSafe(F.col("source_of")), "left")
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    good = F.lit(True)
    for c, (_, both) in RULES.items():
        good = good & (F.col(c) <= F.col(f"{c}_max"))
        if both:
            good = good & (F.col(c) >= F.col(f"{c}_min"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"),
                       F.coalesce(~base & good, F.lit(False)).alias("kept"))


#: The same in SQL with exact quantiles; a sketch is exact up to its ``k`` rows, which covers each group of the smaller tables.
SQL = f"""
WITH parsed AS (
    SELECT doc_id, lang, source, coalesce(text, '') AS text,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \\t\\n\\x0B\\f\\r]')) AS lines
    FROM documents),
places AS (SELECT doc_id, w, UNNEST(range(0, len(w) - 2)) AS i FROM parsed WHERE len(w) >= 3),
repeated AS (SELECT doc_id, i FROM places QUALIFY count(*) OVER (PARTITION BY doc_id, w[i + 1], w[i + 2], w[i + 3]) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + d) AS n FROM repeated, (VALUES (0), (1), (2)) t(d) GROUP BY doc_id),
measured AS (
    SELECT p.doc_id, lang, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
           length(text) - length(translate(text, '{SYMBOLS}', '')) AS n_symbols, length(text) - length(translate(text, '{UPPER}', '')) AS n_upper,
           len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
    FROM parsed p LEFT JOIN covered c USING (doc_id)),
ratios AS (
    SELECT *, round(n_symbols / nullif(word_chars, 0), {PLACES}) AS symbol_ratio, round(n_upper / word_chars, {PLACES}) AS upper_ratio,
           round(n_dup_lines / n_lines, {PLACES}) AS dup_line_ratio, round(n_repeat_words / n_words, {PLACES}) AS repeat_ratio,
           round(word_chars / n_words, {PLACES}) AS word_length FROM measured),
long AS (UNPIVOT (SELECT * FROM ratios WHERE n_words >= 50) ON symbol_ratio, upper_ratio, dup_line_ratio, repeat_ratio, word_length INTO NAME rule VALUE x),
own AS (SELECT lang, source, rule, count(*) AS n, quantile_disc(x, 0.25) AS q1, quantile_disc(x, 0.75) AS q3 FROM long GROUP BY ALL),
by_lang AS (SELECT lang, rule, count(*) AS n, quantile_disc(x, 0.25) AS q1, quantile_disc(x, 0.75) AS q3 FROM long GROUP BY ALL),
of_all AS (SELECT rule, quantile_disc(x, 0.25) AS q1, quantile_disc(x, 0.75) AS q3 FROM long GROUP BY ALL),
chosen AS (
    SELECT o.lang, o.source, o.rule, CASE WHEN o.n >= 40 THEN o.q1 WHEN l.n >= 40 THEN l.q1 ELSE a.q1 END AS q1,
           CASE WHEN o.n >= 40 THEN o.q3 WHEN l.n >= 40 THEN l.q3 ELSE a.q3 END AS q3
    FROM own o JOIN by_lang l ON l.lang IS NOT DISTINCT FROM o.lang AND l.rule = o.rule JOIN of_all a ON a.rule = o.rule),
least_spread(rule, least) AS (VALUES {", ".join(f"('{c}', CAST({least} AS DOUBLE))" for c, (least, _) in RULES.items())}),
limits AS (
    SELECT lang, source, rule, q3 + CAST({REACH} AS DOUBLE) * greatest(least, q3 - q1) AS top,
           CASE WHEN rule = 'word_length' THEN q1 - CAST({REACH} AS DOUBLE) * greatest(least, q3 - q1) END AS bottom
    FROM chosen JOIN least_spread USING (rule)),
broken AS (
    SELECT DISTINCT doc_id FROM long x JOIN limits t ON t.lang IS NOT DISTINCT FROM x.lang AND t.source IS NOT DISTINCT FROM x.source AND t.rule = x.rule
    WHERE x.x > t.top OR x.x < t.bottom)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND doc_id NOT IN (SELECT doc_id FROM broken) AS kept
FROM measured
"""


@register("op6_quality_rules", SQL)
def op6_quality_rules(spark, sf_dir):
    """Measures and verdict of every document."""
    return apply_rules(table(spark, sf_dir, "documents"))
