"""Token ids of whole texts, with each distinct word-sized unit of a task tokenised once.

The byte-level pattern never joins characters across the step from a non-space to a space, so a text splits there
into units that are tokenised independently.  Texts with white space outside ASCII or with a special token's string
go to the tokenizer whole.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator

import numpy as np

from .textbytes import _SPACE, ragged, span_hashes, text_slices

_WHOLE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80|[\x1c-\x1f]|<\|endoftext\|>")
#: Bytes with which a match of _WHOLE can start; rows without any need no search.
_LEADS = np.zeros(256, bool)
_LEADS[[0xC2, 0xE1, 0xE2, 0xE3, 0x1C, 0x1D, 0x1E, 0x1F, ord("<")]] = True
#: Units a worker remembers before it starts afresh; bounds memory, never changes ids.
CACHE_UNITS = 400_000


class Encoder:
    """Ids of the byte-level vocabulary named by ``path`` (a ``tokenizers`` file with its rank file beside it)."""

    def __init__(self, path: str):
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(os.path.splitext(path)[0] + ".tiktoken", "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.ranked = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.first = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _learn(self, hashes: np.ndarray, units: list[bytes]) -> None:
        """Tokenise new units: those that start with a space and end with a word in one call, others one by one."""
        if len(self.known) > CACHE_UNITS:
            self._forget()
        alone = np.array([u[0] not in b" \t\n\v\f\r" or u[-1] in b" \t\n\v\f\r" for u in units], bool)
        sizes, parts = np.zeros(len(units), np.int64), []
        joined = [u for u, a in zip(units, alone) if not a]
        if joined:
            ids = np.array(self.ranked.encode_ordinary(b"".join(joined).decode()), np.uint32)
            ends = np.searchsorted(np.cumsum(self.lengths[ids]), np.cumsum([len(u) for u in joined])) + 1
            sizes[~alone] = np.diff(ends, prepend=0)
            parts.append(ids)
        order = np.concatenate((np.flatnonzero(~alone), np.flatnonzero(alone)))
        for k in np.flatnonzero(alone):
            ids = np.array(self.ranked.encode_ordinary(units[k].decode()), np.uint32)
            sizes[k] = len(ids)
            parts.append(ids)
        first = np.zeros(len(units), np.int64)
        first[order] = len(self.flat) + np.concatenate(([0], np.cumsum(sizes[order])[:-1]))
        self.flat = np.concatenate([self.flat, *parts])
        known = np.concatenate((self.known, hashes))
        by = np.argsort(known, kind="stable")
        self.known = known[by]
        self.first = np.concatenate((self.first, first))[by]
        self.size = np.concatenate((self.size, sizes))[by]

    def _units(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a slice and their bounds by row."""
        space = _SPACE[data]
        step = space.copy()
        step[1:] &= ~space[:-1]
        step[offsets[offsets < len(data)]] = True
        starts = np.flatnonzero(step)
        ends = np.append(starts[1:], len(data))
        hashes = span_hashes(data, starts, ends)
        unique, at, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        new = ~np.isin(unique, self.known, assume_unique=True)
        if new.any():
            if len(self.known) > CACHE_UNITS:
                self._forget()
                new[:] = True
            raw = data.tobytes()
            self._learn(unique[new], [raw[starts[k]:ends[k]] for k in at[new]])
        place = np.searchsorted(self.known, unique)[inverse]
        sizes = self.size[place]
        return self.flat[ragged(self.first[place], sizes)], np.concatenate(([0], np.cumsum(sizes)))[np.searchsorted(starts, offsets)]

    def rows(self, column) -> Iterator[np.ndarray]:
        """The ids of each text of an Arrow column, in order; a null text has none."""
        for _, data, offsets in text_slices(column):
            raw = data.tobytes()
            whole = np.zeros(len(offsets) - 1, bool)
            for k in np.unique(np.searchsorted(offsets, np.flatnonzero(_LEADS[data]), "right") - 1):
                whole[k] = _WHOLE.search(raw, offsets[k], offsets[k + 1]) is not None
            ids, bounds = self._units(data, offsets) if len(data) else (np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64))
            for k in range(len(whole)):
                if whole[k]:
                    text = raw[offsets[k]:offsets[k + 1]].decode()
                    yield np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
                else:
                    yield ids[bounds[k]:bounds[k + 1]]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
