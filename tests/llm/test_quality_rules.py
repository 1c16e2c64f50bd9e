from __future__ import annotations

from collections import Counter

from boxledger.llm import quality_rules
from helpers import ODD, frame, prose, words


def brute(text):
    text = text or ""
    w, seen, dup = words(text), set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    c = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = {i + j for i in range(len(w) - 2) if c[tuple(w[i:i + 3])] > 1 for j in range(3)}
    return len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in text), dup, len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w)


ROWS = ODD + [(20 + k, "\n".join([prose(k, 40), "again line", "again line", prose(k + 500, 25)])) for k in range(50)] + [
    (90, "a%%% b### " * 60), (91, "same three words " * 40), (92, "x | y | " * 50), (93, prose(3, 20_000)), (94, "\n\n" + prose(4, 60) + " \n")]


def test_measures_match_brute_force(spark):
    got = quality_rules.apply_rules(frame(spark, ROWS)).collect()
    plain = lambda r: (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
    assert sorted(map(plain, got), key=str) == sorted(((d, *brute(t)) for d, t, *_ in ROWS), key=str)


def test_verdicts(spark):
    kept = {r.doc_id: r.kept for r in quality_rules.apply_rules(frame(spark, ROWS)).collect()}
    assert all(kept[20 + k] for k in range(50)) and kept[93] and kept[94] and kept[7]
    assert not any(kept[k] for k in (1, 2, 3, 4, 5, 90, 91, 92))


def test_limits_follow_their_group(spark):
    """A group whose clean rows carry symbols gets a higher limit than one whose rows do not."""
    some = lambda k: prose(k, 80) + " #a #b #c #d #e #f" * (1 + k % 4)
    rows = [(k, some(k), "en", "tags") for k in range(60)] + [(100 + k, prose(k, 90), "en", "plain") for k in range(60)]
    rows += [(200, some(203), "en", "plain"), (201, some(203), "en", "tags")]
    kept = {r.doc_id: r.kept for r in quality_rules.apply_rules(frame(spark, rows)).collect()}
    assert kept[201] and not kept[200] and all(kept[k] for k in range(60))


def test_limits_come_from_the_sketches(spark):
    """On the given tables the limits of most groups are their own, not the least spread's."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    limit = quality_rules.thresholds(quality_rules.measures(docs), min_words=50, min_docs=40, reach=quality_rules.REACH, k=2048).collect()
    for rule in ("upper_ratio", "word_length"):
        own = {round(r[f"{rule}_max"], 6) for r in limit}
        assert len(limit) >= 70 and len(own) > 0.9 * len(limit), rule
    by_lang = {}
    for r in limit:
        by_lang.setdefault(r.lang, []).append(r.word_length_max)
    assert min(by_lang["de"]) > sorted(by_lang["en"])[len(by_lang["en"]) // 2]


def test_repeats_in_a_text_of_many_words(spark):
    text = " ".join(f"w{k}" for k in range(120_000)) + " w5 w6 w7 w90000 w90001 w90002"
    got = quality_rules.measures(frame(spark, [(1, text)])).first()
    assert (got.n_words, got.n_repeat_words) == (120_006, 12)


def test_null_groups_and_empty_table(spark):
    rows = [(k, prose(k, 70), None, None) for k in range(5)]
    assert all(r.kept for r in quality_rules.apply_rules(frame(spark, rows)).collect())
    assert quality_rules.apply_rules(frame(spark, []).filter("false")).collect() == []


def test_no_python_on_the_way(spark):
    plan = quality_rules.apply_rules(frame(spark, ROWS[:12]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
