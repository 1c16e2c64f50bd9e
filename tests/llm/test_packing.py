from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from boxledger.llm import packing
from boxledger.llm.tokens import encoder
from helpers import ODD, frame, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")
WHOLE = Tokenizer.from_file(PATH)


def ids_of(text):
    return [*WHOLE.encode(text or "", add_special_tokens=False).ids, 0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab1'.s \n\t é　日<|>")), max_size=30), max_size=6))
def test_ids_are_the_tokenizers(texts):
    import pyarrow as pa
    texts = texts + ["x <|endoftext|> y"]
    got = [x.tolist() for x in encoder(PATH).rows(pa.array(texts))]
    assert got == [WHOLE.encode(t, add_special_tokens=False).ids for t in texts]


def test_pieces_cover_every_id_once(spark):
    rows = [(k, t) for k, (_, t, *_) in enumerate(ODD)] + [(100 + k, prose(k, 37 * k)) for k in range(40)] + [(200, prose(1, 9000))]
    got = packing.pack(frame(spark, rows), PATH, with_ids=True).collect()
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.length == len(r.ids)
    for d, text in rows:
        pieces = sorted(docs[d], key=lambda r: r.start)
        want = ids_of(text)
        assert [x for p in pieces for x in p.ids] == want and all(p.doc_tokens == len(want) for p in pieces)
        assert [p.start for p in pieces] == [sum(q.length for q in pieces[:k]) for k in range(len(pieces))]
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r.offset)
        assert [p.offset for p in pieces] == [sum(q.length for q in pieces[:k]) for k in range(len(pieces))]
        assert sum(p.length for p in pieces) <= 1024


def test_repeated_rows_null_ids_and_empty_table(spark):
    got = packing.pack(frame(spark, [(1, "a b"), (1, "a b"), (None, "c")]), PATH).collect()
    assert sorted((r.doc_id, r.length) for r in got if r.doc_id) == [(1, 3), (1, 3)] and sum(r.doc_id is None for r in got) == 1
    assert packing.pack(frame(spark, []).filter("false"), PATH).collect() == []


def test_differencing_balances_and_rises():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 129, 2048)
    window = packing.spread(sizes, 1024)
    loads = np.bincount(window, weights=sizes)
    assert loads.max() <= 1024 and len(loads) <= -(-sizes.sum() // 1024) + 3
    assert loads.max() - loads.min() <= 64
    assert len(set(packing.spread(np.array([700, 700, 700]), 1024))) == 3  # two windows would hold the sum, not the items
    assert packing.spread(np.zeros(0, int), 1024).size == 0
    loads = np.bincount(packing.difference(np.array([8, 7, 6, 5, 4]), 2), weights=[8, 7, 6, 5, 4])
    assert sorted(loads) == [14, 16]  # the known result of largest differencing
