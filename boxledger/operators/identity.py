"""Identity resolution: one person behind several source records.

Matching is one pass of equality joins: address first, then name and postal code.  Ids, once given, never change.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from .changes import tie_break
from .joins import left_anti, multi_key_fallback_match

__all__ = ["match_keys", "match_known", "cluster_new", "append_xref", "golden_record", "golden_rollup", "golden_people",
           "dedupe_rate", "resolve_identities", "XREF_SCHEMA"]

XREF_SCHEMA = ("source_system string, source_id string, patron_id string, email_key string, name_zip_key string, "
               "match_rule string, matched_at timestamp")
SOURCE_KEY = ["source_system", "source_id"]
# Shape of a person id; the number of digits is a default.
ID_PREFIX, ID_HEX_DIGITS = "PAT-", 12


def match_keys(records: DataFrame, email: str = "email",
               name_zip: Sequence[str] = ("first_name", "last_name", "postal_code")) -> DataFrame:
    """Add ``email_key`` and ``name_zip_key``.

    The second is never NULL: missing parts are skipped, so records without any name share the key ''.
    """
    return records.withColumns({
        "email_key": F.lower(F.nullif(F.trim(F.col(email)), F.lit(""))),
        "name_zip_key": F.lower(F.concat_ws("|", *name_zip)),
    })


def match_known(candidates: DataFrame, xref: DataFrame) -> DataFrame:
    """Records not yet in the cross-reference with the known person they match, if any.

    ``match_rule`` is ``email`` or ``name_zip``; the smallest id wins where several people share a key.
    """
    new = left_anti(candidates, xref, SOURCE_KEY)
    return multi_key_fallback_match(new, xref, ["email_key", "name_zip_key"], "patron_id",
                                    labels=["email", "name_zip"])


def cluster_new(unmatched: DataFrame, xref: DataFrame | None = None, *, digits: int = ID_HEX_DIGITS) -> DataFrame:
    """Give the rest an id derived from their key: equal keys give equal ids of ``digits`` hex digits (1 to 64).

    The frame fails when read if two keys give one id, among these records or with those that got theirs in ``xref``.
    The check is one grouping by id; the records themselves are not shuffled.  It reads ``unmatched`` besides the result,
    so pass records that are staged, not a query.
    """
    if not 1 <= digits <= 64:
        raise ValueError(f"digits must be from 1 to 64, not {digits}")
    basis = F.coalesce("email_key", "name_zip_key")
    patron_id = F.concat(F.lit(ID_PREFIX), F.left(F.sha2(basis, 256), F.lit(digits)))
    keys = unmatched.select(patron_id.alias("patron_id"), basis.alias("basis"))
    if xref is not None:
        given = F.when(F.col("match_rule") == "new:email", F.col("email_key")).when(F.col("match_rule") == "new:name_zip", F.col("name_zip_key"))
        keys = keys.union(xref.select("patron_id", given.alias("basis")).where("basis IS NOT NULL").join(keys.select("patron_id"), "patron_id", "left_semi"))
    clash = keys.groupBy("patron_id").agg(F.min("basis").alias("one"), F.max("basis").alias("other")).where("one <> other")
    n = clash.agg(F.count(F.lit(1)).alias("n")).scalar()
    failed = F.raise_error(F.concat(n.cast("string"), F.lit(f" person ids of {digits} hex digits come from two keys or more")))
    return unmatched.withColumns({
        "patron_id": F.when(n > 0, failed.cast("string")).otherwise(patron_id),
        "match_rule": F.when(F.col("email_key").isNotNull(), "new:email").otherwise("new:name_zip"),
    })


def append_xref(xref: DataFrame, matched: DataFrame, as_of, *, digits: int = ID_HEX_DIGITS) -> DataFrame:
    """The cross-reference with this batch appended.  ``matched`` comes from :func:`match_known` and is read several times, so
    stage it first."""
    known = matched.where(F.col("patron_id").isNotNull())
    fresh = cluster_new(matched.where(F.col("patron_id").isNull()), xref, digits=digits)
    batch = known.unionByName(fresh).withColumn("matched_at", F.lit(as_of).cast("timestamp"))
    return xref.unionByName(batch.select(*xref.columns))


def golden_record(candidates: DataFrame, xref: DataFrame) -> DataFrame:
    """One record per person: a row with an address first, then the newest; ties by the other columns.

    One row per person leaves each map task (WindowGroupLimit), however many records a person has.
    """
    linked = candidates.join(xref.select(*SOURCE_KEY, "patron_id"), SOURCE_KEY)
    ordering = [F.col("address_line1").isNull(), F.col("updated_at").desc_nulls_last(),
                *tie_break(candidates, ["updated_at"])]
    place = F.row_number().over(Window.partitionBy("patron_id").orderBy(*ordering))
    return linked.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def golden_rollup(candidates: DataFrame, xref: DataFrame) -> DataFrame:
    """First day seen and the sorted source systems, per person."""
    linked = candidates.join(xref.select(*SOURCE_KEY, "patron_id"), SOURCE_KEY)
    return linked.groupBy("patron_id").agg(
        F.min("first_seen_date").alias("first_seen_date"),
        F.array_join(F.sort_array(F.collect_set("source_system")), ",").alias("source_systems"))


def golden_people(candidates: DataFrame, xref: DataFrame, as_of) -> DataFrame:
    """Golden record and roll-up in one grouping.

    The record is the largest struct of (has an address, update time, all other columns), which is the order of
    :func:`golden_record`; being an aggregate it combines on the map side, however many records a person has.
    """
    linked = candidates.join(xref.select(*SOURCE_KEY, "patron_id"), SOURCE_KEY)
    rest = [c for c in candidates.columns if c != "updated_at"]
    best = F.max(F.struct(F.col("address_line1").isNotNull().alias("_has_address"), "updated_at", *rest))
    folded = linked.groupBy("patron_id").agg(
        best.alias("_best"), F.min("first_seen_date").alias("_first_seen"),
        F.array_join(F.sort_array(F.collect_set("source_system")), ",").alias("source_systems"))
    shown = [c for c in candidates.columns if c not in ("first_seen_date", "email_key", "name_zip_key", *SOURCE_KEY)]
    return folded.select("patron_id", *[F.col(f"_best.{c}").alias(c) for c in shown],
                         F.col("_first_seen").alias("first_seen_date"), "source_systems",
                         F.lit(as_of).cast("timestamp").alias("_silver_updated_at"))


def dedupe_rate(candidates: DataFrame, people: DataFrame) -> DataFrame:
    """Source records, people, and the share of records that were duplicates."""
    records = candidates.agg(F.count(F.lit(1)).alias("source_records"))
    persons = people.agg(F.count(F.lit(1)).alias("people"))
    n = persons.scalar()
    share = 1 - n.cast("double") / F.greatest(F.col("source_records"), F.lit(1))
    return records.select("source_records", n.alias("people"), share.alias("deduplicated_share"))


def resolve_identities(candidates: DataFrame, xref: DataFrame, as_of) -> tuple[DataFrame, DataFrame]:
    """(cross-reference, people) after matching one batch of candidates."""
    keyed = match_keys(candidates)
    linked = append_xref(xref, match_known(keyed, xref), as_of)
    return linked, golden_people(keyed, linked, as_of)
