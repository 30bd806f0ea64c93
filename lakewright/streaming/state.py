"""Streaming forms of the batch operators: idempotent ingestion, latest state with a change log, windowed counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions.values import row_hash
from ..operators.dedup import keep_latest, upsert
from ..operators.kpi import changes


def read_events(spark, path: str, schema, files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def replay_safe(events: DataFrame, at: str, late: str = "60 days") -> DataFrame:
    """Each content once within the time that late data may take; state older than that is dropped."""
    # watermarks need instants
    hashed = events.withColumn("hash", row_hash(events.columns)).withColumn(at, F.col(at).cast("timestamp"))
    return hashed.withWatermark(at, late).dropDuplicatesWithinWatermark(["hash"])


def windowed_counts(events: DataFrame, at: str, by: list[str], width: str, slide: str | None = None, late: str = "1 day") -> DataFrame:
    """Counts per tumbling (or sliding) window; a window closes when the watermark passes it."""
    window = F.window(at, width, slide) if slide else F.window(at, width)
    return events.withWatermark(at, late).groupBy(window, *by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("window_start"), *by, "n")


def sessions(events: DataFrame, at: str, key: str, gap: str = "30 minutes", late: str = "1 day") -> DataFrame:
    """Sessions per key: a gap of that length ends one."""
    return events.withWatermark(at, late).groupBy(F.session_window(at, gap), key).agg(F.count("*").alias("n")).select(key, F.col("session_window.start").alias("started"), F.col("session_window.end").alias("ended"), "n")


def latest_state(events: DataFrame, key: str, at: str, code: str, state_path: str, log_path: str) -> DataStreamWriter:
    """foreachBatch: the change log (computed from the state before the upsert), then the new state.

    State is versioned by batch (state_path/v=<id>); a batch that is run again
    starts from the version before it and overwrites its own output, so results
    are exactly once.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = keep_latest(batch, [key], at)
        if batch_id == 0:
            old = newest.limit(0)
        else:
            old = spark.read.schema(newest.schema).parquet(f"{state_path}/v={batch_id - 1}")
        # late rows don't replace newer state
        known = old.select(key, F.col(at).alias("__known"))
        fresh = newest.join(known, key, "left").where(F.col("__known").isNull() | (F.col(at) >= F.col("__known"))).drop("__known")
        changes(old, fresh, key, code).write.mode("overwrite").parquet(f"{log_path}/batch={batch_id}")
        upsert(old, fresh, [key]).write.mode("overwrite").parquet(f"{state_path}/v={batch_id}")

    return events.writeStream.foreachBatch(apply)


def drain(writer: DataStreamWriter, checkpoint: str) -> None:
    """Run a stream over all that is there, then stop."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
