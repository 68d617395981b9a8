"""Structured Streaming forms of the incremental parts (an extension: the batch
operators define the results).

Sessions close by watermark; the ledger of finished units and the store of
candidates are kept by foreachBatch, which may run twice for one batch and gives
the same table both times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.store import write_scoped


def sessions(events: DataFrame, by: list[str], gap: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Sessions of events (ts, value) per key: start, end, n, total."""
    grouped = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), *by)
    return grouped.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(*by, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "total")


def windowed(events: DataFrame, by: list[str], length: str, hop: str, late: str) -> DataFrame:
    grouped = events.withWatermark("ts", late).groupBy(F.window("ts", length, hop).alias("w"), *by)
    return grouped.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(*by, F.col("w.start").alias("start"), "n", "total")


def new_units(units: DataFrame, late: str = "7 days") -> DataFrame:
    """Each (speaker, unit) once, as long as the watermark remembers it."""
    return units.withWatermark("processed_at", late).dropDuplicatesWithinWatermark(["speaker_id", "processing_unit_id"])


def keep_store(stream: DataFrame, path: str, checkpoint: str, keys: list[str]) -> StreamingQuery:
    """Rows replace those of their (speaker, unit) in a Parquet table."""

    def upsert(batch: DataFrame, epoch: int) -> None:
        rows = batch.withColumn("scope", F.concat_ws("|", "speaker_id", "processing_unit_id"))
        write_scoped(batch.sparkSession, path, rows, rows, keys, "scope")

    return stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
