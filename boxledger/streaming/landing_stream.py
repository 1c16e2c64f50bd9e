"""Landing folder to bronze as Structured Streaming with ``availableNow``.

The checkpoint plays the part of the ingest log.  Reprocessing, single-day runs and logging of empty days are not
expressible here, so the batch form is the primary one.
"""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..functions import clean_text


def stream_landing(spark: SparkSession, folder: str, schema: str, target: str, checkpoint: str, batch_id: str,
                   as_of, format: str = "csv", max_files: int = 1000) -> StreamingQuery:
    """Append every landed file not seen before, as text with lineage, then stop.

    ``schema`` lists the text columns; the load date is read from the folder name.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    reader = reader.option("recursiveFileLookup", "true")
    if format == "csv":
        reader = reader.option("header", True).option("multiLine", True).option("escape", '"')
    raw = reader.format(format).load(folder)
    file_path = F.col("_metadata.file_path")
    stamped = raw.select(*[F.col(c).cast("string") for c in raw.columns], file_path.alias("_source_file")).withColumns({
        "_load_date": clean_text(F.regexp_extract("_source_file", r"load_date=([0-9-]{10})", 1)).try_cast("date"),
        "_ingested_at": F.lit(as_of).cast("timestamp"),
        "_batch_id": F.lit(batch_id)})
    return (stamped.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", target)
            .outputMode("append").trigger(availableNow=True).start())
