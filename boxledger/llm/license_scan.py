"""License scan by ordered signature rules.

Each text is brought to its words in lower case, joined by single spaces.  The words it has in common with the rules'
keywords pick the rules to try; the others never run.  Where a detection lies within another one, the lower priority gives
way; at equal priority the longer stays, and at equal place the rule that stands first.  A detection that gave way
suppresses nothing.  Detections that only overlap both stay.  Phrases of the caller's own (``base``) are reported besides
and are never suppressed.

Rules run per text in Arrow batches; nothing is shuffled.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .license_rules import SURENESS, TABLE, Rule, rules, whole_words
from .registry import register, table
from .textbytes import text_slices
from .workers import map_arrow

#: The phrases that are always reported, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

_TO_WORDS = bytearray(range(256))
for _c in range(0x80):
    if not chr(_c).isalnum():
        _TO_WORDS[_c] = 0x20
for _c in range(ord("A"), ord("Z") + 1):
    _TO_WORDS[_c] = _c + 32
_TO_WORDS = bytes(_TO_WORDS)


def normal_words(raw: bytes) -> list[bytes]:
    """The words of a text in UTF-8: runs of digits, letters and characters beyond ASCII, A-Z in lower case."""
    return raw.translate(_TO_WORDS).split()


def resolve(found: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """Detections ``(begin, end, rule)`` that are left once containment is resolved, by place.

    Taken by priority, length, rule and place; what is accepted never contains one another, so the accepted are ordered
    by begin and by end alike and each new one meets two neighbours.
    """
    begins: list[int] = []
    ends: list[int] = []
    kept = []
    for begin, end, rule in sorted(found, key=lambda d: (-d[2].priority, d[0] - d[1], d[2].number, d[0])):
        k = bisect_right(begins, begin) - 1
        inside = k >= 0 and ends[k] >= end
        k = bisect_left(begins, begin)
        around = k < len(begins) and ends[k] <= end
        if not inside and not around:
            insort(begins, begin)
            insort(ends, end)
            kept.append((begin, end, rule))
    return sorted(kept, key=lambda d: d[:2])


class Scanner:
    """Compiled rules with their keyword gate."""

    def __init__(self, rule_table: str, base: Mapping[str, str]):
        self.patterns = {r.number: (r, whole_words(r.pattern)) for r in rules(rule_table)}
        self.by_keyword: dict[bytes, list[int]] = {}
        for rule, _ in self.patterns.values():
            for word in rule.keywords:
                self.by_keyword.setdefault(word.encode(), []).append(rule.number)
        self.keywords = frozenset(self.by_keyword)
        self.base = [(phrase.split()[0].encode(), label, phrase.count(" ") + 1, whole_words(phrase)) for phrase, label in base.items()]
        self.gate = self.keywords | {word for word, *_ in self.base}

    def scan(self, words: list[bytes]) -> tuple[list[tuple], list[tuple]]:
        """Base detections and resolved detections: ``(label, rule, priority, first word, number of words)`` by place."""
        present = self.gate.intersection(words)
        if not present:
            return [], []
        text = b" ".join(words).decode()
        base = [(m.start(), m.end(), label) for word, label, _, p in self.base if word in present for m in p.finditer(text)]
        numbers = sorted({n for word in present & self.keywords for n in self.by_keyword[word]})
        found = resolve([(m.start(), m.end(), rule) for rule, p in map(self.patterns.__getitem__, numbers) for m in p.finditer(text)])
        at = _Places(text)
        mine = [(rule.label, rule.number, rule.priority, at.word(a), text.count(" ", a, b) + 1) for a, b, rule in found]
        at = _Places(text)
        return [(label, -1, 0, at.word(a), text.count(" ", a, b) + 1) for a, b, label in sorted(base)], mine


class _Places:
    """Word numbers of places that come in ascending order."""

    def __init__(self, text: str):
        self.text, self.at, self.seen = text, 0, 0

    def word(self, place: int) -> int:
        self.seen += self.text.count(" ", self.at, place)
        self.at = place
        return self.seen


_DETECTION = pa.struct([("label", pa.string()), ("rule", pa.int32()), ("priority", pa.int32()), ("first_word", pa.int64()), ("n_words", pa.int64())])
_DDL = "array<struct<label:string,rule:int,priority:int,first_word:long,n_words:long>>"


def scan_licenses(docs: DataFrame, *, rule_table: str = TABLE, base: Mapping[str, str] = BASE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, base, detections`` of every row.

    ``base`` holds every place of the given phrases (rule -1), ``detections`` those of the rules that containment left;
    both are ordered by place and count words from 0.  Null and empty texts have no words and no detections.  Texts have
    any length.  Repeated rows are scanned alike, null ids too.  Other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rule_table, base)
        keys = [f.name for f in _DETECTION]
        for batch in batches:
            for first, data, offsets in text_slices(batch.column(1)):
                raw = data.tobytes()
                counts, fixed, mine = [], [], []
                for low, high in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                    words = normal_words(raw[low:high])
                    one, two = scanner.scan(words)
                    counts.append(len(words))
                    fixed.append([dict(zip(keys, d)) for d in one])
                    mine.append([dict(zip(keys, d)) for d in two])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(counts)), pa.array(counts, pa.int64()), pa.array(fixed, pa.list_(_DETECTION)),
                     pa.array(mine, pa.list_(_DETECTION))], ["doc_id", "n_words", "base", "detections"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(picked, run, f"doc_id long, n_words long, base {_DDL}, detections {_DDL}")


def summary(scanned: DataFrame) -> DataFrame:
    """One line per row: base places, first and last of them, base labels, all labels, and a score from 0 to 1.

    The score is the chance that at least one label is right, each with the sureness of its best detection.
    """
    labels = lambda *columns: F.array_join(F.array_sort(F.array_distinct(F.concat(*[F.col(f"{c}.label") for c in columns]))), ",")
    sure = F.create_map(*[F.lit(x) for pair in SURENESS.items() for x in pair])
    best = F.transform(F.array_distinct("detections.label"), lambda x: F.array_max(F.transform(
        F.filter("detections", lambda d: d["label"] == x), lambda d: sure[d["priority"]])))
    doubt = F.aggregate(best, F.lit(1.0), lambda left, p: left * (1.0 - p))
    return scanned.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min("base.first_word").alias("first_word"),
        F.array_max("base.first_word").alias("last_word"), labels("base").alias("base_labels"), labels("base", "detections").alias("labels"),
        (1.0 - doubt).alias("score"))


@register("op12_license_scan")
def op12_license_scan(spark, sf_dir):
    """License phrases and detections of every document."""
    return summary(scan_licenses(table(spark, sf_dir, "documents")))
