"""Streaming patch production.

readStream(tasks) -> foreachBatch: the batch ``produce_all`` on the micro-batch
-> results and image-ready events written per batch id.

The stream's offsets live in the checkpoint, and each micro-batch overwrites
its own ``batch=<id>`` folders, so a batch replayed after a failure replaces,
never duplicates, its files: rejects, pixels, ready events, and results last, so
a result row exists only if the pixels it names were written. Topics are
written after the files, at least once: a replayed batch publishes its records
again, keyed ``task_<id>``, and readers keep one per key.

A task is done once over all micro-batches: the ids of finished tasks stand in a
ledger of levelled runs, and a task that the bus delivers again later is only
listed in ``repeats``. A task that failed is not finished; delivered again, it is
tried again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from terrapix.functions.status import status_group
from terrapix.plans.patch_production import produce_all, write_pixels
from terrapix.schema import REQUESTED_BANDS, SearchWindow
from terrapix.session import require_checkpoint
from terrapix.sources import messages
from terrapix.streaming.levels import ledger, unseen


def run_patch_stream(tasks_stream: DataFrame, parcels: DataFrame, scenes: DataFrame,
                     windows: list[SearchWindow], out_dir: str, checkpoint: str | None,
                     res: float, parcel_cell: float, scene_cell: float, worker_id: str = "spark",
                     available_now: bool = True, processing_time: str | None = None,
                     kafka_bootstrap: str | None = None, rasters: DataFrame | None = None,
                     n_bands: int = len(REQUESTED_BANDS), utm_zone: int | None = None) -> StreamingQuery:
    """Start the loop. ``tasks_stream`` is a decoded task stream (``_ok`` flag
    present); bad messages go to ``rejects``. With ``rasters`` (task_id, h, w,
    bands) the pixels of successful tasks are written and named in results and
    ready events; without, neither is announced. With ``kafka_bootstrap`` the
    ready events and results are also published to their topics."""
    require_checkpoint(checkpoint)
    out = out_dir.rstrip("/")
    done = ledger(f"{out}/done", "task_id", "bigint")

    def batch(df: DataFrame, epoch: int) -> None:
        accepted = f"{out}/accepted/batch={epoch}"  # read many times below
        unseen(df.where("_ok"), done, "task_id", epoch).write.mode("overwrite").parquet(accepted)
        good = df.sparkSession.read.schema(df.schema).parquet(accepted)
        repeats = df.where("_ok").select("task_id").join(good.select("task_id"), "task_id", "left_anti").where("task_id IS NOT NULL")
        repeats.distinct().write.mode("overwrite").parquet(f"{out}/repeats/batch={epoch}")
        df.where("not _ok").select("_raw").write.mode("overwrite").text(f"{out}/rejects/batch={epoch}")
        made = produce_all(good, parcels, scenes, windows, res, parcel_cell, scene_cell, worker_id,
                           pixel_path=f"{out}/pixels/batch={epoch}" if rasters is not None else None,
                           rasters=rasters, n_bands=n_bands, utm_zone=utm_zone)
        res_df = made.results.persist()
        if rasters is not None:
            made.results = res_df
            write_pixels(made.pixels(rasters, n_bands), f"{out}/pixels", batch=epoch)
        ready = messages.ready_events(res_df if rasters is not None else res_df.limit(0))
        ready.write.mode("overwrite").parquet(f"{out}/ready/batch={epoch}")
        res_df.write.mode("overwrite").parquet(f"{out}/results/batch={epoch}")
        done.put(res_df.where((status_group("status") != "failed") & F.col("task_id").isNotNull()), epoch)
        if kafka_bootstrap:
            messages.write_topic(messages.encode(ready, messages.task_key()), messages.READY_TOPIC, kafka_bootstrap)
            messages.write_results(res_df, kafka_bootstrap)
        res_df.unpersist()

    w = tasks_stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
