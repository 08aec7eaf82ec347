"""An extension: the ingest of platform records as a stream of files that are added once each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lookout.sources import append_table, committed


def ingest(spark: SparkSession, landing: str, schema: str, table: str, checkpoint: str) -> StreamingQuery:
    """Appends the JSON files of a landing folder to a table without repeating rows; runs until all that has arrived is in."""
    rows = spark.readStream.schema(schema).json(landing)

    def add(batch: DataFrame, _: int) -> None:
        append_table(batch, table)

    return rows.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingest_once(spark: SparkSession, landing: str, schema: str, table: str, checkpoint: str, key: list[str] | None = None, buckets: int = 256) -> StreamingQuery:
    """As ingest(), into a committed table: a batch reads the hashes of the buckets that its rows fall in, and one that is run again adds nothing."""
    rows = spark.readStream.schema(schema).json(landing)

    def add(batch: DataFrame, number: int) -> None:
        committed.append_new(batch, table, key, buckets, (checkpoint, number))

    return rows.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
