"""Exact dedup of a growing folder of line tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def first_texts(spark: SparkSession, path: str, schema: str, within: str | None = None, clock: str = "seen_at") -> DataFrame:
    """A stream of each text's first row.

    Without ``within`` the state keeps every text for good; with it (such as
    ``"1 day"``) texts are forgotten after that time by the column ``clock``, which
    bounds the state.
    """
    rows = spark.readStream.schema(schema).parquet(path)
    return rows.dropDuplicates(["t"]) if within is None else rows.withWatermark(clock, within).dropDuplicatesWithinWatermark(["t"])


def drain(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Runs the stream over what has arrived, and ends; a rerun goes on from there."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
