"""Structured Streaming: file source + availableNow, restart from checkpoint,
stream result == batch result."""

import glob
import os

from pyspark.sql import functions as F

from terrapix.operators import monitor as mon
from terrapix.schema import RESULT_SCHEMA, TASK_SCHEMA
from terrapix.sources import derived, messages
from terrapix.streaming.monitor_stream import run_monitor_stream
from terrapix.streaming.patch_stream import run_patch_stream
from tests.conftest import SF_SMALL


def _write_results_json(spark, df, path):
    frames = messages.encode(df.withColumn("ts", F.col("ts").cast("timestamp")))
    messages.write_json_lines(frames, path)


def test_monitor_stream_equals_batch_and_restarts(spark, tmp_dir):
    res = derived.task_results(spark, SF_SMALL)
    src = os.path.join(tmp_dir, "in")
    ck = os.path.join(tmp_dir, "ck")
    out = os.path.join(tmp_dir, "out")
    first = res.where(F.col("task_id") < 400)
    second = res.where(F.col("task_id") >= 400)
    _write_results_json(spark, first, os.path.join(src, "part1"))
    stream = messages.read_json_stream(spark, os.path.join(src, "*"), RESULT_SCHEMA)
    q = run_monitor_stream(messages.valid(stream), out, ck)
    q.awaitTermination(120)
    tot1 = spark.read.parquet(os.path.join(out, "snapshots")).orderBy(F.col("batch").desc()).first()
    assert tot1.tasks == first.count()
    # new data + restart from the same checkpoint: state carries over
    _write_results_json(spark, second, os.path.join(src, "part2"))
    stream = messages.read_json_stream(spark, os.path.join(src, "*"), RESULT_SCHEMA)
    q = run_monitor_stream(messages.valid(stream), out, ck)
    q.awaitTermination(120)
    tot = spark.read.parquet(os.path.join(out, "snapshots")).orderBy(F.col("batch").desc()).first()
    batch = mon.monitor_totals(res, ts=None).first()
    for c in ("tasks", "success", "skipped", "failed", "patches", "crop_pixels", "noncrop_pixels"):
        assert tot[c] == batch[c], c
    per_worker = spark.read.parquet(os.path.join(out, "by_worker"))
    per_worker = per_worker.where(F.col("batch") == per_worker.agg(F.max("batch")).first()[0])
    seconds = (tot.last_ts - tot.first_ts).total_seconds()
    assert abs(tot.tasks_per_sec - tot.tasks / seconds) < 1e-3
    assert per_worker.agg(F.sum("tasks")).first()[0] == batch.tasks   # workers sum to totals


def test_patch_stream_results_idempotent(spark, tmp_dir):
    from terrapix.operators import grid
    from terrapix.plans import queries as Q
    tasks, _, spec = Q.task_pairs(spark, SF_SMALL, with_rings=False)
    msgs = grid.task_messages(tasks, spec, derived.FIXTURE_CLASS_MAP)
    src = os.path.join(tmp_dir, "tasks")
    messages.write_json_lines(messages.encode(msgs, messages.task_key()), src)
    with open(os.path.join(src, "bad.txt"), "w") as fh:
        fh.write("{not json\n")
    parcels = grid.class_lookup(derived.parcels(spark, SF_SMALL), derived.class_map(spark))
    stream = messages.read_json_stream(spark, src, TASK_SCHEMA)
    out = os.path.join(tmp_dir, "out")
    q = run_patch_stream(stream, parcels, derived.scenes(spark, SF_SMALL), derived.FIXTURE_WINDOWS, out,
                         os.path.join(tmp_dir, "ck"), res=1.0, parcel_cell=20.0, scene_cell=50.0, worker_id="7")
    q.awaitTermination(300)
    got = spark.read.parquet(os.path.join(out, "results"))
    assert got.count() == tasks.count()
    assert spark.read.text(os.path.join(out, "rejects")).count() == 1
    # same statuses and pixel counts as the batch plan
    batch = Q.q_patch_results(spark, SF_SMALL).select("task_id", "status", "crop_pixels", "noncrop_pixels")
    diff = got.select("task_id", "status", "crop_pixels", "noncrop_pixels").exceptAll(batch)
    assert diff.count() == 0
    ready = spark.read.parquet(os.path.join(out, "ready"))
    assert ready.count() == got.where("status = 'success'").count()
    assert set(glob.glob(os.path.join(out, "results", "batch=*")))


def test_progress_stream_equals_batch(spark, tmp_dir):
    from terrapix.streaming.progress_stream import run_progress_stream
    res = derived.task_results(spark, SF_SMALL)
    cut = res.orderBy("ts", "task_id").select("ts").collect()[400][0]
    src = os.path.join(tmp_dir, "in")
    _write_results_json(spark, res.where(F.col("ts") < cut), os.path.join(src, "p1"))
    stream = messages.read_json_stream(spark, os.path.join(src, "*"), RESULT_SCHEMA)
    out, ck = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck")
    run_progress_stream(messages.valid(stream), out, ck, every=20).awaitTermination(120)
    _write_results_json(spark, res.where(F.col("ts") >= cut), os.path.join(src, "p2"))
    stream = messages.read_json_stream(spark, os.path.join(src, "*"), RESULT_SCHEMA)
    run_progress_stream(messages.valid(stream), out, ck, every=20).awaitTermination(120)
    got = spark.read.parquet(os.path.join(out, "snapshots")).drop("batch", "ts")
    want = mon.progress(res, every=20).drop("ts")
    assert got.count() == want.count() == res.count() // 20
    assert got.exceptAll(want).count() == 0
