"""Streams into the vault: exactly once by the vault's keys, positions kept by the stream's checkpoint."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from threadloom.plans.corpus import Vault
from threadloom.sources.connectors import transcript_rows
from threadloom.sources.tables import register


def vault_sink(vault: Vault):
    """For ``foreachBatch``: the anti-join against the vault makes a repeated batch harmless, without unbounded state."""

    def write(batch: DataFrame, _epoch: int) -> None:
        vault.write(batch)

    return write


def stream_transcripts(spark: SparkSession, path: str, vault: Vault, checkpoint: str, subject_id: str, now: datetime, forever: bool = False) -> StreamingQuery:
    """Follow growing transcript files into the vault; by default all that is there now, then stop."""
    register(spark)
    lines = spark.readStream.format("threadloom_tail").option("path", path).load()
    t = transcript_rows(lines)
    e = t.select(
        F.lit(subject_id).alias("subject_id"), F.lit("claude_code").alias("source"), "source_id", "ts", F.lit(now).alias("ingested_at"),
        F.to_json(F.struct("text", F.col("path").alias("file"), "raw_chars", "prose_chars", "looks_pasted")).alias("payload"),
    )
    w = e.writeStream.foreachBatch(vault_sink(vault)).option("checkpointLocation", checkpoint)
    return (w.trigger(processingTime="10 seconds") if forever else w).start()


def stream_envelopes(spark: SparkSession, path: str, schema, vault: Vault, checkpoint: str) -> StreamingQuery:
    """Envelope files that arrive in a folder, each once."""
    e = spark.readStream.schema(schema).parquet(path)
    return e.writeStream.foreachBatch(vault_sink(vault)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(turns: DataFrame, late: str = "21 days", width: str = "1 day") -> DataFrame:
    """Turns per source and time window of a stream; rows later than ``late`` behind the newest are dropped with their window."""
    return turns.withWatermark("ts", late).groupBy(F.window("ts", width), F.lower(F.trim("source")).alias("source")).agg(F.count("*").alias("n"))
