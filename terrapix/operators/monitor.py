"""Result-stream statistics in batch form (F9, F10, F19, G3, G4, B11, B16,
B17, D10). The streaming versions reuse these functions per micro-batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrapix.functions.status import percent, rate, status_group
from terrapix.operators.ordering import running_totals


def normalize_results(df: DataFrame) -> DataFrame:
    """Defaults for missing fields: worker/status 'unknown', pixels 0,
    task_id -1 (B11)."""
    cols = set(df.columns)

    def get(c, default, typ):
        return F.coalesce(F.col(c).cast(typ), F.lit(default).cast(typ)) if c in cols else F.lit(default).cast(typ)
    return df.withColumns({
        "task_id": get("task_id", -1, "bigint"),
        "worker_id": get("worker_id", "unknown", "string"),
        "status": get("status", "unknown", "string"),
        "crop_pixels": get("crop_pixels", 0, "bigint"),
        "noncrop_pixels": get("noncrop_pixels", 0, "bigint"),
    })


def _flags(df: DataFrame) -> DataFrame:
    g = status_group("status")
    ok = F.col("status") == "success"
    return df.withColumns({
        "_succ": ok.cast("bigint"),
        "_skip": (g == "skipped").cast("bigint"),
        "_fail": (g == "failed").cast("bigint"),
        "_crop": F.when(ok, F.col("crop_pixels")).otherwise(F.lit(0)).cast("bigint"),
        "_noncrop": F.when(ok, F.col("noncrop_pixels")).otherwise(F.lit(0)).cast("bigint"),
    })


def _counter_aggs() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("tasks"),
        F.sum("_succ").alias("success"),
        F.sum("_skip").alias("skipped"),
        F.sum("_fail").alias("failed"),
        F.sum("_succ").alias("patches"),
        F.sum("_crop").alias("crop_pixels"),
        F.sum("_noncrop").alias("noncrop_pixels"),
    ]


def _elapsed_us(ts: str) -> Column:
    """Microseconds between the first and last message; computed on the
    values as stored, so a session time zone (and its DST) cannot shift it."""
    return F.timestamp_diff("MICROSECOND", F.min(ts), F.max(ts))


def monitor_totals(results: DataFrame, ts: str | None = "ts") -> DataFrame:
    """Global counters, pixel totals (success only), crop ratio %, and - when a
    timestamp is present - elapsed time split into minutes/seconds and
    tasks per second (F9, B15, B17, L4). One aggregation."""
    f = _flags(normalize_results(results))
    aggs = _counter_aggs()
    if ts:
        aggs.append(_elapsed_us(ts).alias("_us"))
    a = f.agg(*aggs)
    tot = F.col("crop_pixels") + F.col("noncrop_pixels")
    out = a.withColumns({"total_pixels": tot, "crop_ratio": F.round(percent("crop_pixels", tot), 6)})
    if ts:
        el = F.col("_us") / F.lit(1e6)
        out = out.withColumns({
            "elapsed_s": F.round(el, 6),
            "elapsed_min": F.floor(el / 60).cast("bigint"),
            "elapsed_sec": F.floor(el % 60).cast("bigint"),
            "tasks_per_sec": F.round(rate("tasks", el), 6),
        }).drop("_us")
    return out


def monitor_by_worker(results: DataFrame) -> DataFrame:
    """Per-worker counters, sorted by worker id as strings."""
    f = _flags(normalize_results(results))
    return f.groupBy("worker_id").agg(*_counter_aggs()).orderBy("worker_id")


def worker_runtime(results: DataFrame, ts: str = "ts") -> DataFrame:
    """First/last message, run time and rate per worker."""
    f = normalize_results(results)
    a = f.groupBy("worker_id").agg(F.count(F.lit(1)).alias("tasks"), _elapsed_us(ts).alias("_us"),
                                   F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))
    secs = F.col("_us") / F.lit(1e6)
    return a.select("worker_id", "tasks", "first_ts", "last_ts", F.round(secs, 6).alias("seconds"),
                    F.round(rate("tasks", secs), 6).alias("tasks_per_sec"))


def progress(results: DataFrame, every: int = 20, ts: str = "ts", key: str = "task_id",
             n: int | None = None) -> DataFrame:
    """Running totals after every ``every``-th message in (ts, key) order.

    Distributed: range partitioning on the order key + per-partition offsets
    (terrapix.operators.ordering), never one task holding all messages."""
    f = _flags(normalize_results(results)).select(ts, key, "_succ", "_skip", "_fail", "_crop", "_noncrop")
    cum = running_totals(f, [ts, key], ["_succ", "_skip", "_fail", "_crop", "_noncrop"], n=n, row_number="message")
    snap = cum.where(F.col("message") % every == 0)
    return snap.select(
        F.col("message").cast("bigint").alias("message"), F.col(ts).alias("ts"),
        F.col("cum__succ").alias("success"), F.col("cum__skip").alias("skipped"),
        F.col("cum__fail").alias("failed"), F.col("cum__crop").alias("crop_pixels"),
        F.col("cum__noncrop").alias("noncrop_pixels"))


def dedupe_results(results: DataFrame, key: str = "task_id", ts: str = "ts") -> DataFrame:
    """Keep one result per task: the latest (ties: larger worker id).

    ``max(struct(ts, worker_id, ...))`` is a partial aggregation, so a task
    repeated many times never gathers its copies in one place."""
    rest = [c for c in results.columns if c not in (key, ts, "worker_id")]
    best = F.max(F.struct(F.col(ts).alias(ts), F.col("worker_id").alias("worker_id"), *rest)).alias("_b")
    return results.groupBy(key).agg(best).select(key, "_b.*")


def every_nth(results: DataFrame, n: int = 5, key: str = "task_id") -> DataFrame:
    """The log sampling rule: messages whose task id is a multiple of n."""
    return results.where(F.col(key) % n == 0)


def patch_name() -> Column:
    """The id of a result's patch in the pixel table."""
    return F.concat(F.lit("task_"), F.col("task_id").cast("string"), F.lit("_worker_"), F.col("worker_id"))


def dedupe_pixels(pixels: DataFrame, results: DataFrame) -> DataFrame:
    """Pixels of the winning result of each task (G4): a task done twice leaves
    two patches, and only one may be trained on.

    Two workers leave them under different names. The same worker leaves both
    under one name, in different batches of the pixel table (column ``batch``):
    the batch of the winning result decides when results know their batch, else
    the latest batch that holds the patch."""
    by_batch = "batch" in pixels.columns and "batch" in results.columns
    own = [F.col("batch").cast("bigint").alias("batch")] if by_batch else []
    won = dedupe_results(results.where(F.col("status") == "success").select("task_id", "worker_id", "ts", *own))
    names = won.select(patch_name().alias("patch_id"), *(["batch"] if by_batch else []))
    if by_batch:
        wide = pixels.withColumn("_batch", F.col("batch").cast("bigint"))
        return wide.join(names.withColumnRenamed("batch", "_batch"), ["patch_id", "_batch"], "left_semi").select(*pixels.columns)
    if "batch" in pixels.columns:
        last = pixels.groupBy("patch_id").agg(F.max("batch").alias("batch")).join(names, "patch_id", "left_semi")
        return pixels.join(last, ["patch_id", "batch"], "left_semi").select(*pixels.columns)
    return pixels.join(names, "patch_id", "left_semi")
