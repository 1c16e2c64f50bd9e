"""Landed changes to a merged table as Structured Streaming with ``foreachBatch``."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from ..operators.changes import latest_per_key, upsert
from ..operators.clean import with_row_hash
from ..sources.tables import create_merged, merge_table, set_property, table_exists, table_property


def batch_upsert(table: str, keys: Sequence[str], order_by: str, as_of, stream: str, n_buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """What to do with each micro-batch: keep the newest row per key and merge it, the newer of old and new row winning.

    The number of the last batch of ``stream`` is a property of the table.  A batch with that number or an earlier one is
    left out, and one that died between its rows and that property is merged again to the same end, because a merge of the
    same rows changes nothing.  A row that is delivered again, or late with an older version, changes nothing either.
    """
    name = f"stream.{stream}"

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        exists = table_exists(spark, table)
        last = table_property(spark, table, name) if exists else None
        if last is not None and int(last) >= batch_id:
            return
        columns = [c for c in batch.columns if not c.startswith("_")]
        newest = with_row_hash(latest_per_key(batch, keys, order_by), columns)
        if exists:
            merge_table(table, newest, lambda held, new: upsert(held, new, keys, newest_wins=order_by), as_of)
        else:
            create_merged(newest, table, keys, as_of, n_buckets=n_buckets, expected=0)
        set_property(spark, table, name, str(batch_id))

    return merge


def stream_upsert(spark: SparkSession, folder: str, schema: str, table: str, keys: Sequence[str], order_by: str, checkpoint: str, as_of,
                  format: str = "json", max_files: int = 1000, stream: str = "landing") -> StreamingQuery:
    """Merge every landed file not seen before into ``table`` by key, then stop.  Files are taken in the order they landed.

    Only the key buckets of a micro-batch are read and rewritten.  The checkpoint remembers files, the table remembers
    batches, so a restart at any point ends with the rows of an uninterrupted run.
    """
    changes = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).option("recursiveFileLookup", "true")
               .format(format).load(folder))
    return (changes.writeStream.foreachBatch(batch_upsert(table, keys, order_by, as_of, stream)).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
