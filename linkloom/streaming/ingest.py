"""Incremental ingest: new WAT files become link rows, each file once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.extract import extract
from ..sources.readers import RECORD_SEPARATOR, wat_records


def start_ingest(spark: SparkSession, source: str, links_path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Watches a folder of WAT files; each micro-batch replaces its own folder, so a repeated batch adds nothing twice."""
    raw = spark.readStream.format("text").option("lineSep", RECORD_SEPARATOR).load(source).select(F.col("_metadata.file_name").alias("wat_file"), "value")

    def land(batch: DataFrame, number: int) -> None:
        _, links = extract(wat_records(batch.withColumn("pos", F.monotonically_increasing_id())))
        links.write.mode("overwrite").parquet(f"{links_path}/batch={number}")

    writer = raw.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
