from __future__ import annotations

import math
from collections import Counter

from boxledger.llm import decontamination
from helpers import ODD, frame, prose

ITEM_DDL = "item_id long, text string, place int, weight double, doc_id string"


def items(spark, rows):
    return spark.createDataFrame([(*r, 1, 0.5, "d") for r in rows], ITEM_DDL)


def grams(w, n):
    return [tuple(w[i:i + n]) for i in range(len(w) - n + 1)]


def brute(docs, bench, least=0.8):
    """The best similarity over all windows of each length, wherever they start."""
    split = lambda t: [x for x in __import__("re").split(r"[ \t-\r]+", (t or "").lower()) if x]
    parsed = {i: split(t) for i, t in bench if split(t)}
    df = Counter(g for w in parsed.values() for g in set(grams(w, min(5, len(w)))))
    weight = lambda g: math.floor(1000 * math.log(1 + len(parsed) / df.get(g, 1)) + 0.5)
    out = {}
    for d, t in docs:
        w = split(t)
        for i, item in parsed.items():
            n = min(5, len(item))
            a = Counter(grams(item, n))
            best = 0
            for start in range(-len(item), len(w)):
                b = Counter(grams(w[max(start, 0):max(start + len(item), 0)], n))
                same = sum(weight(g) * min(c, b[g]) for g, c in a.items())
                total = sum(weight(g) * c for g, c in a.items()) + sum(weight(g) * c for g, c in b.items()) - same
                best = max(best, round(same / total, 6) if total else 0)
            if best >= least:
                out[d, i] = max(best, out.get((d, i), 0))
    return out


BENCH = [(1, prose(900, 30)), (2, prose(901, 55) + " end."), (3, "only four words here"), (4, "single"), (5, None), (6, ""), (7, prose(902, 12) + " " + prose(902, 12)),
         (8, prose(903, 40))]


def documents():
    one, two, eight = BENCH[0][1], BENCH[1][1], BENCH[7][1]
    rows = [(d, t) for d, t, *_ in ODD]
    rows += [(20, prose(1, 40) + " " + one + " " + prose(2, 40)), (21, one.upper()), (22, " ".join(one.split(" ")[2:])), (23, " ".join(one.split(" ")[15:])),
             (24, two.replace(" ", "\n")), (25, "x " + " ".join(two.split(" ")[:20]) + " inserted " + " ".join(two.split(" ")[20:])), (26, "only FOUR words here"),
             (27, "we say only four words here today"), (28, "a single word"), (29, BENCH[6][1]), (30, one + " " + one), (31, " ".join(eight.split(" ")[::-1])),
             (32, prose(3, 3000) + " " + eight)]
    return rows + [(40 + k, prose(300 + k, 60)) for k in range(20)]


def test_matches_brute_force(spark):
    got = {(r.doc_id, r.item_id): r.similarity for r in decontamination.leaks(frame(spark, documents()), items(spark, BENCH)).collect()}
    want = brute(documents(), BENCH)
    assert got == want
    assert {(20, 1), (21, 1), (24, 2), (26, 3), (27, 3), (28, 4), (30, 1), (32, 8)} <= set(got) and (23, 1) not in got


def test_leaking_rows_go_and_columns_stay(spark):
    docs = frame(spark, documents())
    left = decontamination.remove_leaking(docs, items(spark, BENCH))
    assert left.columns == docs.columns
    leaking = {d for d, _ in brute(documents(), BENCH)} - {None}
    assert sorted((r.doc_id or 0) for r in left.collect()) == sorted((d or 0) for d, _ in documents() if d not in leaking)


def test_empty_tables(spark):
    docs, bench = frame(spark, documents()), items(spark, BENCH)
    assert decontamination.leaks(docs.filter("false"), bench).collect() == []
    assert decontamination.leaks(docs, bench.filter("false")).collect() == []


def test_fingerprints_within_the_radius_share_a_block(spark):
    base = 0x0123456789ABCDEF
    prints = spark.createDataFrame([(base,), (base ^ 0b111,), (-base,)], "print long")
    for radius in (3, 23):
        blocks = decontamination._blocks(prints, "print", radius).collect()
        assert len(blocks) == 3 * (radius + 1)
        by = {}
        for r in blocks:
            by.setdefault(r.print, set()).add((r.block, r.bits))
        assert by[base] & by[base ^ 0b111]


def test_no_python_on_the_way(spark):
    plan = decontamination.leaks(frame(spark, documents()[:5]), items(spark, BENCH))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
