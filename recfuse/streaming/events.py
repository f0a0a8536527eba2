"""Structured Streaming variants: windowed counts with a watermark, and an incremental key index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recfuse.operators.identity import hard_keys
from recfuse.session import _ensure_checkpoint_dir


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder that all executors share, for state and output of a stream."""
    _ensure_checkpoint_dir(spark)
    from uuid import uuid4

    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid4().hex}"


def windowed_counts(events: DataFrame, length: str = "1 day", late: str = "2 days", time: str = "ts", by: str = "event_type") -> DataFrame:
    """Counts and sums per tumbling window and type; works on a stream and on a table."""
    return (
        events.withWatermark(time, late)
        .groupBy(F.window(time, length).alias("w"), by)
        .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
        .select(F.col("w.start").alias("window_start"), by, "n", "total")
    )


def drain(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a stream over all that is there and return its output table."""
    spark = stream.sparkSession
    out, state = shared_folder(spark, f"{name}-out"), shared_folder(spark, f"{name}-state")
    q = stream.writeStream.outputMode(mode).option("checkpointLocation", state).trigger(availableNow=True).format("parquet").start(out)
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def key_index(stream: DataFrame, to_records, name: str = "keys") -> DataFrame:
    """Hard keys of streamed rows: each micro-batch is mapped and appended; one batch may be replayed without harm.

    ``to_records`` maps source rows to canonical records. Batches write to folders named by their
    number, so a replayed batch replaces its own output.
    """
    spark = stream.sparkSession
    out, state = shared_folder(spark, f"{name}-out"), shared_folder(spark, f"{name}-state")

    def write(batch: DataFrame, number: int) -> None:
        hard_keys(to_records(batch)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    q = stream.writeStream.foreachBatch(write).option("checkpointLocation", state).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(out).select("ord", "kind", "key")
