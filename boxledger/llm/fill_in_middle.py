"""Fill-in-the-middle transformation with content-defined chunks.

Texts are cut into prefix, middle and suffix at token counts (tokens are runs of letters and single other characters), and
the pieces are put back in another order behind markers.  To find the cuts without tokenising whole texts, a rolling hash
over the last bytes cuts each text into chunks where the content says so, so equal passages give equal chunks in whatever
text and place they occur.  A chunk's boundary summary (tokens, whether it begins and ends with a letter) is kept in a
cache; a chunk with a known rolling fingerprint is compared byte by byte with the kept content before its summary is used.
Summaries of a text's chunks combine from left to right: a run of letters across a boundary is one token, of the earlier
chunk.  The running count tells in which chunk a cut falls, and that chunk alone is tokenised.

Each task has a cache of its own with a bound in bytes; nothing is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .registry import register, table
from .textbytes import span_hashes, text_slices, windows
from .workers import map_arrow

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes of the rolling window, average and greatest bytes of a chunk.
ROLL, MEAN_CHUNK, MAX_CHUNK = 12, 1 << 10, 1 << 13
#: Bytes of chunk contents that a task keeps; a full cache starts anew.
CACHE_BYTES = 48 << 20

_LETTER = np.zeros(256, bool)
_LETTER[ord("A"):ord("Z") + 1] = _LETTER[ord("a"):ord("z") + 1] = True
#: Bytes that continue a code point.
_INNER = np.zeros(256, bool)
_INNER[0x80:0xC0] = True


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where chunks start in the bytes of consecutive texts: at each text, and before code points after a rolling hash of
    the wanted form; stretches without one are cut at the greatest size."""
    cut = np.zeros(len(data) + 1, bool)
    if len(data) >= ROLL:
        value, _ = windows(data.astype(np.uint64) + np.uint64(1), np.array([0, len(data)]), ROLL, seed=11)
        cut[np.flatnonzero((value & np.uint64(MEAN_CHUNK - 1)) == 0) + ROLL] = True
    # A window that reaches into the text before says nothing about this one.
    near = (offsets[:-1, None] + np.arange(ROLL)).ravel()
    cut[near[near < len(data)]] = False
    cut[:-1] &= ~_INNER[data]
    cut[offsets] = True
    starts = np.flatnonzero(cut[:-1])
    sizes = np.diff(np.append(starts, len(data)))
    long = np.flatnonzero(sizes > MAX_CHUNK)
    if not len(long):
        return starts
    more = []
    for low, size in zip(starts[long].tolist(), sizes[long].tolist()):
        for at in range(low + MAX_CHUNK, low + size, MAX_CHUNK):
            while at < low + size and _INNER[data[at]]:
                at += 1
            more.append(at)
    return np.union1d(starts, [m for m in more if m < len(data)])


def token_starts(data: np.ndarray, after_letter: bool = False) -> np.ndarray:
    """Offsets at which tokens start; a first letter after a letter starts none."""
    letter = _LETTER[data]
    before = np.empty(len(data), bool)
    before[0] = after_letter
    before[1:] = letter[:-1]
    return np.flatnonzero(np.where(letter, ~before, ~_INNER[data]))


class Summaries:
    """Boundary summaries of chunks by content: ``(tokens, begins with a letter, ends with a letter)``."""

    def __init__(self, limit: int = CACHE_BYTES):
        self.limit, self.held, self.known, self.hits = limit, 0, {}, 0

    def of(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """One row per chunk of ``data``; unknown chunks are counted once and kept."""
        ends = np.append(starts[1:], len(data))
        prints = span_hashes(data, starts, ends).tolist()
        raw = data.tobytes()
        out = np.zeros((len(starts), 3), np.int64)
        fresh = []
        for k, (mark, low, high) in enumerate(zip(prints, starts.tolist(), ends.tolist())):
            content = raw[low:high]
            kept = self.known.get(mark)
            if kept is not None and kept[0] == content:
                out[k] = kept[1]
                self.hits += 1
            else:
                fresh.append((k, mark, content))
        if fresh:
            # Tokens of all new chunks at once: starts within a chunk, a chunk's first byte as if nothing stood before it.
            letter = _LETTER[data]
            begins = np.where(letter, True, ~_INNER[data])
            begins[1:] &= ~(letter[1:] & letter[:-1])
            begins[starts] = True
            count = np.add.reduceat(begins.astype(np.int64), starts)
            for k, mark, content in fresh:
                out[k] = summary = (int(count[k]), int(letter[starts[k]]), int(letter[ends[k] - 1]))
                if self.held + len(content) > self.limit:
                    self.known, self.held = {}, 0
                self.known[mark] = (content, summary)
                self.held += len(content) + 100
        return out


class Text:
    """The chunks of one text and their combined counts."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, summaries: np.ndarray):
        self.data, self.starts = data, starts
        self.joined = np.zeros(len(starts), bool)  # the chunk's first letters belong to the token before
        self.joined[1:] = (summaries[1:, 1] & summaries[:-1, 2]).astype(bool)
        self.upto = np.concatenate(([0], np.cumsum(summaries[:, 0] - self.joined)))

    @property
    def n_tokens(self) -> int:
        return int(self.upto[-1])

    def cut(self, k: int) -> int:
        """The byte after the first ``k`` tokens."""
        if k >= self.n_tokens:
            return len(self.data)
        chunk = int(np.searchsorted(self.upto, k, "right")) - 1
        low = int(self.starts[chunk])
        high = int(self.starts[chunk + 1]) if chunk + 1 < len(self.starts) else len(self.data)
        return low + int(token_starts(self.data[low:high], bool(self.joined[chunk]))[k - self.upto[chunk]])


def draws(doc_id, seed: int) -> list[int]:
    """Four numbers from the row's id: the first 32 hex digits of ``sha256('seed:id')`` in groups of eight."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k:k + 8], 16) for k in range(0, 32, 8)]


def transform(docs: DataFrame, *, seed: int = 1, plain_percent: int = 10, spm_percent: int = 20, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every row.

    ``n`` counts tokens.  ``form`` is ``plain`` for ``plain_percent`` of the rows, for empty texts and for texts that hold a
    marker; of the others ``spm_percent`` are ``spm`` (suffix first), the rest ``psm``.  The characters of prefix and middle
    are null for plain rows.  The cuts follow from seed and id, so a row gives the same output in every run, and repeated
    rows give equal ones.  Null texts are empty, a null id draws like an empty one.  Texts have any length; a chunk is at
    most ``MAX_CHUNK`` bytes.  Other columns are ignored.
    """
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Summaries()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, data, offsets in text_slices(batch.column(1)):
                starts = chunk_starts(data, offsets)
                summaries = cache.of(data, starts) if len(starts) else np.zeros((0, 3), np.int64)
                bounds = np.searchsorted(starts, offsets)
                solid = np.concatenate(([0], np.cumsum(~_INNER[data])))  # code points before each byte
                raw = data.tobytes()
                rows = []
                for k in range(len(offsets) - 1):
                    low, high = int(offsets[k]), int(offsets[k + 1])
                    own = slice(int(bounds[k]), int(bounds[k + 1]))
                    doc_id, content = ids[first + k], raw[low:high]
                    text = Text(data[low:high], starts[own] - low, summaries[own])
                    n = text.n_tokens
                    h1, h2, h3, h4 = draws(doc_id, seed)
                    if not content or h3 % 100 >= 100 - plain_percent or any(m.encode() in content for m in (PREFIX, SUFFIX, MIDDLE)):
                        rows.append((doc_id, n, "plain", None, None, content.decode()))
                        continue
                    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
                    one, two = text.cut(a), text.cut(b)
                    prefix, middle, suffix = content[:one].decode(), content[one:two].decode(), content[two:].decode()
                    spm = h4 % 100 < spm_percent
                    output = f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}" if spm else f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
                    rows.append((doc_id, n, "spm" if spm else "psm", int(solid[low + one] - solid[low]), int(solid[low + two] - solid[low + one]), output))
                columns = list(zip(*rows))
                types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(picked, run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(form: str | Column = "form", output: str | Column = "output") -> Column:
    """The text that an output came from, read back by its markers alone."""
    form, output = (F.col(c) if isinstance(c, str) else c for c in (form, output))
    after = lambda mark: F.substring_index(output, mark, -1)
    before = lambda text, mark: F.substring_index(text, mark, 1)
    psm = F.concat(before(after(PREFIX), SUFFIX), after(MIDDLE), before(after(SUFFIX), MIDDLE))
    spm = F.concat(before(after(PREFIX), MIDDLE), after(MIDDLE), before(after(SUFFIX), PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


SQL = r"""
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || doc_id) AS h,
           regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS t FROM documents),
numbers AS (
    SELECT doc_id, text, t, len(t) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(t) + 1) AS c1, CAST('0x' || h[9:16] AS BIGINT) % (len(t) + 1) AS c2,
           CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 THEN 'plain'
                WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn),
parts AS (
    SELECT *, array_to_string(t[:least(c1, c2)], '') AS p, array_to_string(t[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
           array_to_string(t[greatest(c1, c2) + 1:], '') AS s FROM numbers)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""


@register("op11_fill_in_middle", SQL)
def op11_fill_in_middle(spark, sf_dir):
    """All documents transformed, with digests of the outputs and of the texts read back from them."""
    done = transform(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(), 256).alias("restored_sha256"))
