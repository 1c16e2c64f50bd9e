"""Chat formatting: conversations rendered by compiled templates, with the spans that training may learn from.

Turns are shuffled by conversation and sorted inside partitions; a task then streams them through the template, so a
conversation of any length costs bounded memory.  Output is cut into numbered parts for the same reason.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .registry import register, table
from .templates import Mark, compile_template, unescape
from .workers import map_arrow

CHATML = """{%- for message in messages -%}
<|im_start|>{{ message.role | escape_line }}{{ '\\n' }}
{%- if message.role == 'assistant' -%}
{% generation %}{{ message.content | escape_text }}{% endgeneration %}
{%- else -%}
{{ message.content | escape_text }}
{%- endif -%}
<|im_end|>{{ '\\n' }}
{%- endfor -%}"""
PART_CHARS = 1 << 18
PARTS = "conv_id long, part long, text string, spans array<struct<begin: long, end: long>>"
_SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))


def format_chat(turns: DataFrame, template: str = CHATML, *, conv_col: str = "conv_id", turn_col: str = "turn",
                role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Formatted conversations in parts: ``conv_id``, ``part`` (from 0), ``text``, ``spans``.

    The texts of a conversation's parts in order are its formatted text.  ``spans`` are the stretches of it inside
    generation markers, as code point offsets in the whole conversation; a stretch over two parts is two spans.

    Turns are rendered by ``turn``, then role and text, nulls first.  Null roles and texts are empty.  Rows with a null
    ``conv_id`` are one conversation.  Repeated rows are repeated turns.  Other columns are ignored.  No rows, no parts.
    """
    compile_template(template)
    picked = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
                          F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                          F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    ordered = picked.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)

        def rows():
            for batch in batches:
                columns = [batch.column(k).to_pylist() for k in (0, 2, 3)]
                yield from zip(*columns)

        ready: list[tuple] = []
        waiting = 0
        for conv, group in groupby(rows(), key=lambda r: r[0]):
            part = length = 0
            begin = None
            texts, held, spans = [], 0, []
            for piece in render({"messages": ({"role": r, "content": t} for _, r, t in group)}):
                if isinstance(piece, Mark) and piece.name == "begin":
                    begin = length
                elif isinstance(piece, Mark):
                    spans.append({"begin": begin, "end": length})
                    begin = None
                else:
                    texts.append(piece)
                    held += len(piece)
                    length += len(piece)
                    if held >= PART_CHARS:
                        if begin is not None and begin < length:
                            spans.append({"begin": begin, "end": length})
                            begin = length
                        ready.append((conv, part, "".join(texts), spans))
                        waiting += held
                        part, texts, held, spans = part + 1, [], 0, []
                        if waiting >= 8 * PART_CHARS:
                            yield _parts(ready)
                            ready, waiting = [], 0
            if held or spans or not part:
                ready.append((conv, part, "".join(texts), spans))
                waiting += held
            if waiting >= 8 * PART_CHARS or len(ready) >= 10_000:
                yield _parts(ready)
                ready, waiting = [], 0
        yield _parts(ready)

    return map_arrow(ordered, run, PARTS)


def _parts(rows: list[tuple]) -> pa.RecordBatch:
    conv, part, text, spans = zip(*rows) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays([pa.array(conv, pa.int64()), pa.array(part, pa.int64()), pa.array(text, pa.string()),
                                       pa.array(spans, _SPANS)], ["conv_id", "part", "text", "spans"])


_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


class _Reader:
    """Reads one formatted conversation back, part by part; keeps at most one unfinished turn."""

    def __init__(self):
        self.rest, self.turns, self.chars, self.loss_chars, self.held = "", 0, 0, 0, ""
        self.digest, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, spans: list[dict]) -> None:
        for span in spans:
            self.held += text[span["begin"] - self.chars:span["end"] - self.chars]
            loose = len(self.held) - len(self.held.rstrip("\\"))
            cut = len(self.held) - loose % 2
            plain = unescape(self.held[:cut])
            self.held = self.held[cut:]
            self.loss_chars += len(plain)
            self.loss.update(plain.encode())
        self.chars += len(text)
        self.rest += text
        at = 0
        while found := _TURN.match(self.rest, at):
            self.digest.update(f"{unescape(found[1])}\n{unescape(found[2])}\n".encode())
            self.turns += 1
            at = found.end()
        self.rest = self.rest[at:]

    def row(self, conv) -> tuple:
        if self.rest or self.held:
            raise ValueError(f"conversation {conv} cannot be read back")
        return conv, self.turns, self.digest.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(parts: DataFrame) -> DataFrame:
    """Digests of formatted conversations (``CHATML``), read from their parts alone: one row per ``conv_id``.

    Parts may arrive in any order; they are shuffled by conversation, sorted and streamed.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for k in range(batch.num_rows):
                    yield tuple(batch.column(c)[k].as_py() for c in (0, 2, 3))

        ready = []
        for conv, group in groupby(rows(), key=lambda r: r[0]):
            reader = _Reader()
            for _, text, spans in group:
                reader.add(text, spans)
            ready.append(reader.row(conv))
            if len(ready) >= 10_000:
                yield _digests(ready)
                ready = []
        yield _digests(ready)

    return map_arrow(parts.repartition("conv_id").sortWithinPartitions("conv_id", "part"), run, DIGESTS)


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 6
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                      ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


#: A conversation whose texts are control strings; the query formats it beside the table's.
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


@register("op9_chat_formatting")
def op9_chat_formatting(spark, sf_dir):
    """All conversations formatted and read back, with one made of control strings."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                    F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                    F.lit(CONTROL_TEXT).alias("text"))
    return read_back(format_chat(turns.unionByName(control)))
