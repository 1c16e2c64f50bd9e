from __future__ import annotations

from collections import Counter
from itertools import permutations

from boxledger.llm import filter_audit
from helpers import ODD, frame, prose, words

LABELS = [(4, 1, 0), (4, 0, 1), (7, 1, None), (20, 1, 1), (21, None, 1), (31, 1, 0), (None, 1, 1), (99, 1, 1)]
COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def fails(doc_id, text, rows):
    w = words(text)
    out = "A" if len(w) < 200 else ""
    out += "B" if 100 * len(set(w)) < 50 * len(w) else ""
    out += "C" if 100 * sum("A" <= x <= "Z" for x in text) > 3 * len(text) else ""
    out += "D" if any(x in "#$%&*|" for x in text) else ""
    smaller = doc_id is not None and any(r[0] is not None and r[0] < doc_id and (r[1] or "") == text for r in rows)
    return out + ("E" if smaller else "")


def brute(rows, labels):
    """Every order applied to every row, one after the other."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    full = [(r[0], fails(r[0], r[1] or "", rows), (r[2] if len(r) > 2 else "en") or "") for r in rows]
    out, shapley = {}, Counter()
    for part in {p for _, _, p in full}:
        for order in permutations("ABCDE"):
            left = [(d, f) for d, f, p in full if p == part]
            gone = []
            for k, f in enumerate(order):
                here = [(d, x) for d, x in left if f in x]
                left = [(d, x) for d, x in left if f not in x]
                out[part, "".join(order), k + 1] = [len(left), len(here), sum(f in x for _, x in gone), sum(x == f for _, x, p in full if p == part),
                                                    sum(d in good for d, _ in here), sum(d in toxic for d, _ in here)]
                shapley[part, f] += len(here)
                gone += here
    return {(p, o, k): (*v, shapley[p, o[k - 1]]) for (p, o, k), v in out.items()}


ROWS = ODD + [(20, prose(1, 60)), (21, "BIG " * 250), (22, "# " + prose(2, 300)), (23, prose(4, 20_000)), (24, "BIG " * 250), (25, prose(2, 260), "de", "s"),
              (26, prose(2, 260), "fr", "s"), (27, prose(2, 260), "de", "t"), (27, prose(2, 260), "de", "t"), (30, "A|B " * 300), (31, "A|B " * 300, None, None),
              (None, "A|B " * 300), (None, "A|B " * 300), (40, " ".join(f"w{k}" for k in range(200))), (41, " ".join(f"W{k}" for k in range(199)))]


def test_matches_brute_force(spark):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(frame(spark, ROWS), labels).collect()
    assert {(r.part, r.filter_order, r.step): tuple(r[c] for c in COLUMNS) for r in got} == brute(ROWS, LABELS)
    assert len(got) == 600 * len({(r[2] if len(r) > 2 else "en") or "" for r in ROWS})


def test_steps_are_the_min_plus_product():
    order = filter_audit.orders()
    steps = filter_audit.removal_steps(filter_audit.np.arange(32), order)
    for mask in range(32):
        for k, o in enumerate(order):
            hit = [s + 1 for s, f in enumerate(o) if mask >> f & 1]
            assert steps[mask, k] == (hit[0] if hit else filter_audit.NEVER)


def test_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(frame(spark, []).filter("false"), labels).collect() == []
    got = filter_audit.audit(frame(spark, [(1, "x")]), labels).filter("filter_order = 'BACDE'").orderBy("step").collect()
    assert [r.removed for r in got] == [0, 1, 0, 0, 0] and [r.kept for r in got] == [1, 0, 0, 0, 0]


def test_a_text_that_many_rows_share_is_spread_by_id(spark):
    rows = spark.range(4000).selectExpr("id as doc_id", "'same text' as text", "'en' as lang")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    row = filter_audit.audit(rows, labels).filter("filter_order = 'EABCD' and step = 1").first()
    assert (row.kept, row.removed, row.unique_fails) == (1, 3999, 0)
    plan = filter_audit.failures(rows)._jdf.queryExecution().toString()
    assert "digest" in plan and "Python" not in plan
