"""Small documents with every awkward case, and plain-Python references."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
DDL = ("doc_id long, text string, lang string, source string, n_chars long, key string, `row` int, node double, value string, words string, "
       "label string, line string, shingle string, bucket string, n int, `odd name` string")


def words(text) -> list[str]:
    return WORD.findall(text or "")


def lowered(text) -> list[str]:
    return words((text or "").translate(LOWER))


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    parts = [f"w{rng.randrange(vocabulary)}" for _ in range(n)]
    for k in range(11, n, 23):
        parts[k] += "."
    return " ".join(parts)


def frame(spark, rows):
    """Rows ``(doc_id, text)`` or ``(doc_id, text, lang, source)`` with extra columns whose names clash with inner ones."""
    full = []
    for k, r in enumerate(rows):
        doc_id, text = r[0], r[1]
        lang, source = (r[2], r[3]) if len(r) > 2 else ("en", f"s{k % 3}")
        full.append((doc_id, text, lang, source, len(text or ""), "k", k, 0.5, "v", "w", "l", "x", "s", "b", 7, "o"))
    return spark.createDataFrame(full, DDL).repartition(3)


#: Null and empty texts, white space, one word, few words, a null id, repeated rows, null groups.
ODD = [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "three little words"), (None, "an id is missing here today"), (7, prose(1, 60)),
       (7, prose(1, 60)), (8, "a b c d e", None, None), (9, "É über ñandú \x0b tab\r\nnext  line "), (10, "same same same same same same same same")]
