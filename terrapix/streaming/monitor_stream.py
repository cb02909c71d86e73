"""Streaming monitor over the result topic.

State = one row of counters per worker (bounded by the number of workers,
so no watermark is needed for it). Each micro-batch emits the complete
per-worker table; ``foreachBatch`` turns it into the global totals (a sum
over at most #workers rows) and appends one progress snapshot per batch,
written under the batch id so a replayed batch overwrites itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from terrapix.session import require_checkpoint

from terrapix.functions.status import percent, rate
from terrapix.operators.monitor import _counter_aggs, _flags, normalize_results


def worker_counters(results_stream: DataFrame) -> DataFrame:
    """Stateful per-worker counters (streaming aggregation)."""
    f = _flags(normalize_results(results_stream))
    return f.groupBy("worker_id").agg(*_counter_aggs(), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def totals_from_workers(per_worker: DataFrame) -> DataFrame:
    """Global totals and rate = column sums over the per-worker rows (F9 from
    F10, L4)."""
    cols = ["tasks", "success", "skipped", "failed", "patches", "crop_pixels", "noncrop_pixels"]
    t = per_worker.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in cols],
                       F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"),
                       F.timestamp_diff("MICROSECOND", F.min("first_ts"), F.max("last_ts")).alias("_us"))
    tot = F.col("crop_pixels") + F.col("noncrop_pixels")
    return t.withColumns({"total_pixels": tot, "crop_ratio": F.round(percent("crop_pixels", tot), 6),
                          "tasks_per_sec": F.round(rate("tasks", F.col("_us") / F.lit(1e6)), 6)}).drop("_us")


def run_monitor_stream(results_stream: DataFrame, out_dir: str, checkpoint: str | None,
                       available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Start the monitor: per-worker table overwritten and one totals
    snapshot per micro-batch (replay-safe by batch id)."""
    require_checkpoint(checkpoint)
    out = out_dir.rstrip("/")

    def batch(per_worker: DataFrame, epoch: int) -> None:
        per_worker = per_worker.persist()
        # a folder for each batch: the last complete one survives a crash
        per_worker.orderBy("worker_id").write.mode("overwrite").parquet(f"{out}/by_worker/batch={epoch}")
        totals_from_workers(per_worker).withColumn("batch", F.lit(epoch)).write.mode("overwrite") \
            .parquet(f"{out}/snapshots/batch={epoch}")
        per_worker.unpersist()

    w = (worker_counters(results_stream).writeStream.outputMode("complete")
         .foreachBatch(batch).option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def dedupe_stream(results_stream: DataFrame, delay: str = "1 hour") -> DataFrame:
    """First result per task within the watermark delay (G4, streaming form)."""
    return results_stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["task_id"])
