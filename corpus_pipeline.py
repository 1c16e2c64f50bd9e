"""The training corpus from raw documents: five stages, each over all rows that the one before kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a frame; between stages it is written as Parquet in the shared
folder and read again, so a lost executor never repeats more than a stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from boxledger.llm.decontamination import remove_leaking
from boxledger.llm.line_dedup import drop_boilerplate
from boxledger.llm.near_dup import near_duplicates
from boxledger.llm.packing import pack, vocabulary
from boxledger.llm.quality import resample
from boxledger.llm.registry import table
from boxledger.llm.workers import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps."""
    return resample(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without boilerplate lines; ``n_chars`` follows the text."""
    cleaned = drop_boilerplate(docs)
    return cleaned.select(*[F.char_length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (80 % alike), the one with the smallest id."""
    gone = near_duplicates(docs, percent=80).filter(~F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id")
    return docs.join(stored(gone, "copies"), "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return remove_leaking(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 tokens."""
    return pack(docs, vocabulary())


STAGES = [("quality", quality), ("lines", lines), ("near_copies", near_copies), ("decontaminate", decontaminate), ("packed", packed)]

#: Resampling and tokenizing have no SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
