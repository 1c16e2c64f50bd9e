from __future__ import annotations

import random
import re

import pytest

from boxledger.llm import license_scan
from boxledger.llm.license_rules import Rule, rules, whole_words
from helpers import LOWER, ODD, frame, prose

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base(text):
    w = WORD.findall((text or "").translate(LOWER))
    found = [(k, label) for phrase, label in license_scan.BASE.items() for k in range(len(w)) if w[k:k + len(phrase.split())] == phrase.split()]
    places = [k for k, _ in found]
    return len(w), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in found}))


def beats(x, y):
    """Whether detection ``x`` comes before ``y``."""
    return (-x[2].priority, x[0] - x[1], x[2].number, x[0]) < (-y[2].priority, y[0] - y[1], y[2].number, y[0])


def resolve_by_pairs(found):
    kept = []
    for d in sorted(found, key=lambda d: (-d[2].priority, d[0] - d[1], d[2].number, d[0])):
        if not any((k[0] <= d[0] and d[1] <= k[1]) or (d[0] <= k[0] and k[1] <= d[1]) for k in kept):
            kept.append(d)
    return sorted(kept, key=lambda d: d[:2])


def brute(text):
    """All rules on every text, without the gate."""
    joined = " ".join(WORD.findall((text or "").translate(LOWER)))
    found = [(m.start(), m.end(), r) for r in rules() for m in whole_words(r.pattern).finditer(joined)]
    return {r.label for _, _, r in resolve_by_pairs(found)}


NOTES = ["Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "(c) 2020 Someone. ALL RIGHTS-RESERVED!", "GNU General Public License, version 2",
         "GNU Lesser General Public License v2.1 or later", "SPDX-License-Identifier: GPL-3.0-or-later", "cc by cc_by CC-BY, cc by", "Apache License, Version 2.0",
         "see creativecommons.org/licenses/by-sa/4.0/", "general  public\nlicense general public", "dominio público", "mit freundlichen Grüßen", "ccby é cc by"]
ROWS = ODD + [(20 + k, f"{prose(k, 40)} {n} {prose(k + 9, 20)}") for k, n in enumerate(NOTES)] + [(40 + k, n) for k, n in enumerate(NOTES)] + [
    (70, " ".join(NOTES) * 300), (71, prose(2, 30_000) + " all rights reserved"), (72, "license " * 20_000), (73, " ".join(NOTES)), (73, " ".join(NOTES))]


def test_matches_brute_force(spark):
    got = license_scan.summary(license_scan.scan_licenses(frame(spark, ROWS))).collect()
    texts = {}
    for r in ROWS:
        texts.setdefault(r[0], r[1])
    assert len(got) == len(ROWS)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(texts[r.doc_id])
        assert set(filter(None, r.labels.split(","))) == brute(texts[r.doc_id]) | set(filter(None, r.base_labels.split(",")))
        assert r.labels == ",".join(sorted(filter(None, r.labels.split(",")))) and 0 <= r.score <= 1


@pytest.mark.parametrize(("text", "labels"), [
    ("GNU Lesser General Public License v2.1", {"lgpl-2.1"}), ("CC BY-NC-SA 4.0", {"cc-by-nc-sa-4.0"}), ("Licensed under the Apache License, Version 2.0", {"licensed-under", "apache-2.0"}),
    ("SPDX-License-Identifier: MIT", {"mit"}), ("SPDX-License-Identifier: Foo", {"other-spdx"}), ("mit freundlichen Grüßen", set()), ("admit license", {"license-mention"}),
    ("MIT License and BSD 3-Clause License", {"mit", "bsd-3-clause"}), ("© 2021 X", {"copyright"}), ("the mit licensed", {"license-mention"})])
def test_labels(text, labels):
    scanner = license_scan.Scanner(license_scan.TABLE, {})
    assert {d[0] for d in scanner.scan(license_scan.normal_words(text.encode()))[1]} == labels


def test_resolution_matches_pairs():
    rng = random.Random(3)
    for _ in range(200):
        found = []
        for n in range(rng.randrange(40)):
            a = rng.randrange(60)
            found.append((a, a + rng.randrange(1, 20), Rule(rng.randrange(9), "x", rng.randrange(3), (), "")))
        assert license_scan.resolve(found) == resolve_by_pairs(found)


def test_rules_are_many_and_reachable():
    table = rules()
    assert len(table) >= 300 and len({(r.label, r.pattern) for r in table}) == len(table)
    for rule in table:  # each keyword is a word, and every rule has its sureness
        assert all(WORD.fullmatch(k) for k in rule.keywords) and rule.priority in license_scan.SURENESS


def test_the_gate_hides_no_rule():
    """Every text a rule can match holds one of its keywords: taken from the pattern's own alternatives."""
    scanner = license_scan.Scanner(license_scan.TABLE, {})
    for text in [n for _, n, *_ in ROWS if n]:
        assert {d[0] for d in scanner.scan(license_scan.normal_words(text.encode()))[1]} == brute(text)


def test_spans_point_at_words(spark):
    text = "one two MIT license three general public license"
    row = license_scan.scan_licenses(frame(spark, [(1, text)])).first()
    w = license_scan.normal_words(text.encode())
    spans = {(d.label, b" ".join(w[d.first_word:d.first_word + d.n_words]).decode()) for d in row.detections}
    assert spans == {("mit", "mit license"), ("license-mention", "license")} and [(d.label, d.first_word) for d in row.base] == [("gpl", 5)]


def test_no_rows(spark):
    assert license_scan.summary(license_scan.scan_licenses(frame(spark, []).filter("false"))).collect() == []
