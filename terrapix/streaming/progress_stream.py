"""Every-N-th-result progress snapshots over a result stream (L3 with G3).

Messages are numbered in arrival order: batch by batch, and by (ts, task_id)
inside a batch. Each micro-batch reads the running state left by the
previous batch (one row: messages seen and cumulative counters), numbers and
accumulates its own rows with the distributed running-totals helper, writes
the snapshots that fall on a multiple of N and its new state row - both under
its batch id, so a replayed batch reproduces exactly the same files. When the
stream ends or is stopped, ``run_to_end`` leaves a last summary with the rate.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from terrapix.operators.monitor import _flags, normalize_results
from terrapix.operators.ordering import running_totals
from terrapix.session import require_checkpoint

_SUMS = ["_succ", "_skip", "_fail", "_crop", "_noncrop"]
_NAMES = {"_succ": "success", "_skip": "skipped", "_fail": "failed", "_crop": "crop_pixels",
          "_noncrop": "noncrop_pixels"}


def _previous_state(spark, out: str, epoch: int) -> dict:
    """The state that batch ``epoch - 1`` left; zero before the first batch.
    Lost state is an error: counting again from zero would look right."""
    if epoch == 0:
        return {"message": 0, **{v: 0 for v in _NAMES.values()}}
    path = f"{out}/state/batch={epoch - 1}"
    try:
        r = spark.read.parquet(path).first()
    except AnalysisException as ex:
        raise RuntimeError(f"progress state of batch {epoch - 1} is missing: {path}") from ex
    if r is None:
        raise RuntimeError(f"progress state of batch {epoch - 1} is empty: {path}")
    return r.asDict()


def run_progress_stream(results_stream: DataFrame, out_dir: str, checkpoint: str | None = None,
                        every: int = 20, available_now: bool = True) -> StreamingQuery:
    require_checkpoint(checkpoint)
    out = out_dir.rstrip("/")

    def batch(df: DataFrame, epoch: int) -> None:
        spark = df.sparkSession
        prev = _previous_state(spark, out, epoch)
        f = _flags(normalize_results(df)).select("ts", "task_id", *_SUMS)
        cum = running_totals(f, ["ts", "task_id"], _SUMS, row_number="_rn")
        cum = cum.withColumn("message", F.col("_rn") + F.lit(int(prev["message"])))
        snap = cum.select(
            F.col("message").cast("bigint").alias("message"), "ts",
            *[(F.col(f"cum_{k}") + F.lit(int(prev[v]))).cast("bigint").alias(v) for k, v in _NAMES.items()])
        snap = snap.persist()
        snap.where(F.col("message") % every == 0).write.mode("overwrite").parquet(f"{out}/snapshots/batch={epoch}")
        last = snap.orderBy(F.col("message").desc()).limit(1).drop("ts")
        if last.isEmpty():
            last = spark.createDataFrame([prev], "message long, success long, skipped long, failed long, "
                                                 "crop_pixels long, noncrop_pixels long")
        last.write.mode("overwrite").parquet(f"{out}/state/batch={epoch}")
        snap.unpersist()

    w = results_stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def final_summary(spark, out_dir: str) -> DataFrame:
    """The counters after the last message seen, whether or not its number is a
    multiple of N: one row, none before the first batch."""
    try:
        states = spark.read.parquet(f"{out_dir.rstrip('/')}/state")
    except AnalysisException:
        return spark.createDataFrame([], "message long, " + ", ".join(f"{c} long" for c in _NAMES.values()))
    return states.where(F.col("batch") == states.agg(F.max("batch")).first()[0]).select("message", *_NAMES.values())


def run_to_end(query: StreamingQuery, out_dir: str, timeout: float | None = None) -> DataFrame:
    """Wait for the stream to end, or stop it (after ``timeout`` seconds, or when
    interrupted), and leave the final summary with the stream's own rate in
    ``final``: messages of the batches that this run remembers, and per second of
    their run time."""
    spark = query.sparkSession if hasattr(query, "sparkSession") else SparkSession.active()
    out = out_dir.rstrip("/")
    try:
        query.awaitTermination(timeout) if timeout is not None else query.awaitTermination()
    finally:
        recent = list(query.recentProgress)
        query.stop()
        # (a batch is scanned several times, so the progress' own row counts are too high)
        before = min((p["batchId"] for p in recent), default=0) - 1
        rows = spark.read.parquet(f"{out}/state").agg(F.max("message") - F.coalesce(F.max(F.when(F.col("batch") == before, F.col("message"))), F.lit(0))).first()[0] if recent else 0
        seconds = sum(p["durationMs"].get("triggerExecution", 0) for p in recent) / 1000.0
        done = final_summary(spark, out).withColumns({
            "messages_read": F.lit(rows or 0).cast("bigint"), "messages_per_sec": F.lit((rows or 0) / seconds if seconds > 0 else 0.0)})
        done.coalesce(1).write.mode("overwrite").parquet(f"{out}/final")
    return spark.read.parquet(f"{out}/final")
