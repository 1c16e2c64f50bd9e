from __future__ import annotations

from collections import defaultdict

from boxledger.llm import line_dedup
from helpers import ODD, frame, prose


def brute(rows, min_sites):
    sites = defaultdict(set)
    for _, text, _, source in rows:
        for line in (text or "").split("\n"):
            if line.strip(" \t\n\r\x0b\x0c") and source is not None:
                sites[line].add(source)
    out = []
    for d, text, _, _ in rows:
        if text is None:
            out.append((d, None, 0, 0))
            continue
        lines = text.split("\n")
        rest = [x for x in lines if len(sites[x]) < min_sites]
        if not any(x.strip(" \t\n\r\x0b\x0c") for x in rest):
            rest = lines
        out.append((d, "\n".join(rest), len(lines), len(lines) - len(rest)))
    return sorted(out, key=str)


def rows():
    out = [(r[0], r[1], "en", r[3] if len(r) > 2 else "s0") for r in ODD]
    for k in range(40):
        spread = [f"shared by {n}" for n in (3, 4, 5, 6, 30) if k < n]
        out.append((100 + k, "\n".join([prose(k, 9), *spread, "", prose(k + 500, 9)]), "en", f"site{k}" if k % 7 else None))
    out += [(200, "shared by 30\n \nshared by 6", "en", "site1"), (201, "shared by 30\nshared by 30\nown", "en", "site1"), (202, "x\r\nshared by 30", "de", "site2")]
    return out


def test_matches_brute_force(spark):
    for min_sites in (2, 4, 5):
        got = line_dedup.drop_boilerplate(frame(spark, rows()), min_sites=min_sites).collect()
        assert sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got), key=str) == brute(rows(), min_sites)


def test_columns_and_empty_table(spark):
    docs = frame(spark, rows())
    out = line_dedup.drop_boilerplate(docs, min_sites=5)
    assert out.columns == [*docs.columns, "n_lines", "n_removed"]
    assert line_dedup.drop_boilerplate(docs.filter("false")).collect() == []
