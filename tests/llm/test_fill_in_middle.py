from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from boxledger.llm import fill_in_middle as fim
from boxledger.llm.textbytes import text_slices
from helpers import ODD, frame, prose

TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def brute(doc_id, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    n = len(tokens)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < 20:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def mess(seed, n):
    """Letters, signs, characters of two to four bytes and pieces of markers."""
    rng = random.Random(seed)
    return "".join(rng.choice("abcXYZ  \n<>PSMé漢😀1.") for _ in range(n))


ROWS = ODD + [(20 + k, prose(k, 300)) for k in range(40)] + [(80 + k, mess(k, 900)) for k in range(40)] + [
    (150, "a" * 60_000), (151, "é" * 30_000), (152, prose(5, 60_000)), (153, "<P"), (154, "x<S>y"), (155, "<" * 5000), (156, "S><M"), (157, "ab1" * 9000)]


def test_matches_brute_force_and_reads_back(spark):
    got = fim.transform(frame(spark, ROWS)).withColumn("back", fim.restored()).collect()
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted((brute(r[0], r[1]) for r in ROWS), key=str)
    want = {r[0]: r[1] or "" for r in ROWS}
    assert all(r.back == want[r.doc_id] for r in got)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("mean", [4, 16, 1024])
def test_every_cut_of_combined_chunks(monkeypatch, mean):
    monkeypatch.setattr(fim, "MEAN_CHUNK", mean)
    monkeypatch.setattr(fim, "MAX_CHUNK", 64)
    texts = [mess(k, 400) for k in range(6)] + ["", prose(1, 80), "a" * 300, "漢" * 200, "x"]
    cache = fim.Summaries()
    for _, data, offsets in text_slices(pa.array(texts)):
        starts = fim.chunk_starts(data, offsets)
        found = cache.of(data, starts)
        bounds = np.searchsorted(starts, offsets)
        for k, text in enumerate(texts):
            own = slice(bounds[k], bounds[k + 1])
            one = fim.Text(data[offsets[k]:offsets[k + 1]], starts[own] - offsets[k], found[own])
            tokens = TOKEN.findall(text)
            assert one.n_tokens == len(tokens)
            for n in range(len(tokens) + 1):
                assert one.cut(n) == len("".join(tokens[:n]).encode())


def test_equal_passages_are_counted_once_and_compared():
    passage = prose(3, 3000)
    texts = [prose(10 + k, 50) + " " + passage for k in range(4)]
    cache = fim.Summaries()
    for text in texts:
        for _, data, offsets in text_slices(pa.array([text])):
            cache.of(data, fim.chunk_starts(data, offsets))
    assert cache.hits >= 3 * (len(passage) // fim.MAX_CHUNK)
    # A fingerprint with other content is not taken for the known chunk.
    data, starts = np.frombuffer(b"one two", np.uint8), np.array([0])
    mark = fim.span_hashes(data, starts, np.array([len(data)])).tolist()[0]
    cache.known[mark] = (b"other", (99, 0, 0))
    assert cache.of(data, starts).tolist() == [[3, 1, 1]]


def test_a_full_cache_starts_anew():
    cache = fim.Summaries(limit=2000)
    for k in range(20):
        text = prose(k, 200).encode()
        data = np.frombuffer(text, np.uint8)
        assert cache.of(data, np.array([0]))[0, 0] == len(TOKEN.findall(text.decode()))
        assert cache.held <= 2000 + len(text) + 100


def test_no_rows(spark):
    assert fim.transform(frame(spark, []).filter("false")).collect() == []
