"""Streams whose inputs grow while they run: scoring, repeated tasks, levelled state."""

import io
import os
import time
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from terrapix.operators import features as feat
from terrapix.operators import metrics, ml
from terrapix.operators import monitor as mon
from terrapix.plans import patch_production as pp
from terrapix.plans import queries as Q
from terrapix.schema import READY_SCHEMA, TASK_SCHEMA
from terrapix.sources import derived, messages
from terrapix.streaming import score_stream as sc
from terrapix.streaming.levels import Levels, ledger, unseen
from terrapix.streaming.patch_stream import run_patch_stream
from tests.conftest import SF_SMALL


def task_pixels(spark):
    return derived.pixels(spark, SF_SMALL).withColumn("task_id", F.regexp_extract("patch_id", r"task_(\d+)_", 1).cast("bigint"))


def last_of(spark, path):
    df = spark.read.parquet(path)
    return df.where(F.col("batch") == df.agg(F.max("batch")).first()[0])


def announce(px, table, batch, src):
    messages.write_json_lines(messages.encode(Q.ready_of(px, table, batch)), src)


# ---- levelled runs

@pytest.mark.parametrize("fan", [2, 3, 8])
def test_runs_cover_every_batch_once(fan):
    lv = Levels("p", "k long", lambda df: df, fan)
    for before in range(0, 200):
        covered = [b for level, n in lv.runs(before) for b in range(n * fan ** level, (n + 1) * fan ** level)]
        assert covered == list(range(before))
        assert all(sum(1 for level, _ in lv.runs(before) if level == k) < fan for k in range(9))


def test_levels_add_up_and_replay(spark, tmp_dir):
    lv = sc.score_counts(os.path.join(tmp_dir, "s"), fan=2)
    want = {}
    for epoch in range(5):
        rows = [(float(k % (epoch + 2)), 1, epoch) for k in range(4)]
        df = spark.createDataFrame(rows, "s double, pos long, neg long").groupBy("s").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        for _ in range(2):  # every batch is replayed
            lv.put(df, epoch)
        for s, p, n in rows:
            a = want.setdefault(s, [0, 0])
            a[0], a[1] = a[0] + p, a[1] + n
        got = {r["s"]: [r["pos"], r["neg"]] for r in lv.merge(lv.read(spark, epoch + 1)).collect()}
        assert got == want
    with pytest.raises(RuntimeError):
        lv.read(spark, 9).count()


def test_unseen(spark, tmp_dir):
    done = ledger(os.path.join(tmp_dir, "d"), "k", "bigint", fan=2)
    for epoch in range(3):
        done.put(spark.createDataFrame([(epoch,), (10 + epoch,)], "k long"), epoch)
    df = spark.createDataFrame([(0, "a"), (12, "b"), (7, "c"), (None, "d")], "k long, v string")
    assert sorted(r["v"] for r in unseen(df, done, "k", 3).collect()) == ["c", "d"]
    assert sorted(r["v"] for r in unseen(df, done, "k", 2).collect()) == ["b", "c", "d"]
    assert unseen(df, done, "k", 0).count() == 4


# ---- scoring

def test_scoring_while_both_sides_grow(spark, tmp_dir):
    px = task_pixels(spark)
    f = feat.pixel_features(px, keep=("patch_id", "pixel_idx"))
    model = ml.logistic_pipeline(feat.FEATURES_V1, weight=None, max_iter=5).fit(f)
    table, src, out, ck = (os.path.join(tmp_dir, x) for x in ("pixels", "ready", "out", "ck"))
    part = [px.where(F.col("task_id") % 4 == k) for k in range(4)]
    announce(part[1], table, 1, src)  # before its pixels
    stream = messages.valid(messages.read_json_stream(spark, src, READY_SCHEMA))
    q = sc.run_score_stream(stream, table, model, ck, out, available_now=False, processing_time="200 milliseconds", fan=2)
    try:
        def settled(n):
            end = time.time() + 120
            while time.time() < end:
                q.processAllAvailable()
                if spark.read.parquet(os.path.join(out, "report")).agg(F.sum("n_scored")).first()[0] == n:
                    return
                time.sleep(0.3)
            raise AssertionError("patches not scored in time")
        ids = [p.select("patch_id").distinct().count() for p in part]
        q.processAllAvailable()
        assert last_of(spark, os.path.join(out, "report")).first()["n_waiting"] == ids[1]
        pp.write_pixels(part[0], table, batch=0, buckets=16)
        pp.write_pixels(part[1], table, batch=1, buckets=5)  # another number of buckets
        settled(ids[1])
        announce(part[0], table, 0, src)
        announce(part[0], table, 0, src)  # twice
        settled(ids[0] + ids[1])
        announce(part[2], table, 2, src)
        lost = part[2].select("patch_id").first()[0]
        pp.write_pixels(part[2].where(F.col("patch_id") != lost), table, batch=2, buckets=16)
        settled(sum(ids[:3]) - 1)
    finally:
        q.stop()
    want = f.where(F.regexp_extract("patch_id", r"task_(\d+)_", 1).cast("bigint") % 4 < 3).where(F.col("patch_id") != lost)
    pred = sc.scored_pixels(px.where(F.col("task_id") % 4 < 3).where(F.col("patch_id") != lost), model)
    conf = metrics.confusion_long(model.transform(want))
    got = last_of(spark, os.path.join(out, "confusion")).select("label", "prediction", "count")
    assert got.exceptAll(conf).count() == 0 and got.count() == conf.count() > 0
    report = last_of(spark, os.path.join(out, "report")).first()
    auc = metrics.auc_rank(pred, "label", "s").first()
    assert (report["auc"], report["n_pos"], report["n_neg"]) == pytest.approx((auc["auc"], auc["n_pos"], auc["n_neg"]))
    waiting = last_of(spark, os.path.join(out, "waiting")).collect()
    assert [(r["patch_id"], r["reason"]) for r in waiting] == [(lost, "pixels not written")]


def test_short_patches_wait_and_are_given_up(spark, tmp_dir):
    px = task_pixels(spark).where("task_id IN (3, 7, 9)")
    table, src, out, ck = (os.path.join(tmp_dir, x) for x in ("pixels", "ready", "out", "ck"))
    announce(px, table, 0, src)
    extra = spark.createDataFrame([(77, "1", None, None, None, 0.0)], READY_SCHEMA)
    messages.write_json_lines(messages.encode(extra), src)
    short = px.where("patch_id LIKE 'task_3_%'").select("patch_id").first()[0]
    one = px.where(F.col("patch_id") == short).limit(1).select("pixel_idx").first()[0]
    pp.write_pixels(px.where(~((F.col("patch_id") == short) & (F.col("pixel_idx") == one))), table, batch=0)

    def run():
        stream = messages.valid(messages.read_json_stream(spark, src, READY_SCHEMA))
        sc.run_score_stream(stream, table, Q.NdviThreshold(), ck, out, patience=1).awaitTermination()
    run()
    waiting = {r["patch_id"]: r["reason"] for r in last_of(spark, os.path.join(out, "waiting")).collect()}
    assert waiting == {short: "fewer pixels than the shape", "task_77_worker_1": "the event names no path"}
    pp.write_pixels(px.limit(0), table, batch=1)  # wakes the stream
    run()
    assert last_of(spark, os.path.join(out, "report")).first()["n_missing"] == 2
    announce(px, table, 0, src)  # given up for good, and nothing is counted twice
    run()
    report = last_of(spark, os.path.join(out, "report")).first()
    assert (report["n_scored"], report["n_waiting"], report["n_missing"]) == (0, 0, 0)
    want = Q.NdviThreshold().transform(feat.pixel_features(px.where(F.col("patch_id") != short), keep=("patch_id", "pixel_idx"))).count()
    assert last_of(spark, os.path.join(out, "confusion")).agg(F.sum("count")).first()[0] == want


def test_lost_state_is_an_error(spark, tmp_dir):
    with pytest.raises(RuntimeError):
        sc._state(spark, os.path.join(tmp_dir, "none"), "waiting", "k long", 3)


def test_announced_pixels_prune_folders(spark, tmp_dir):
    """A scoring batch reads the folder and the buckets that its events need."""
    table = os.path.join(tmp_dir, "p")
    for b, buckets in ((0, 64), (1, 4)):
        pp.write_pixels(task_pixels(spark).where(F.col("task_id") % 2 == b), table, batch=b, buckets=buckets)
    ids = spark.createDataFrame([(3, "task_3_worker_0", f"{table}/batch=1")], "task_id long, patch_id string, folder string")
    px = sc.announced_pixels(ids, table)
    buf = io.StringIO()
    with redirect_stdout(buf):
        px.explain("formatted")
    assert "PartitionFilters: [isnotnull(task_bucket" in buf.getvalue()
    assert all("batch=1/" in f for f in px.inputFiles() if f.endswith(".parquet"))
    assert px.count() == task_pixels(spark).where("patch_id = 'task_3_worker_0'").count() > 0
    assert sc.announced_pixels(ids.withColumn("folder", F.lit(f"{table}/batch=9")), table) is None


# ---- repeated tasks

def test_a_task_is_done_once_over_batches(spark, tmp_dir):
    """A first batch, another one, then repeats of the first with a new task."""
    boxes = {t: [20.0 * t, 0.0, 20.0 * t + 20, 20.0] for t in range(4)}
    parcels = spark.createDataFrame([(10 * t + k, 1, 20.0 * t + 1 + k, 1.0, 20.0 * t + 2 + k, 8.0) for t in range(4) for k in range(5 if t != 1 else 2)],
                                    "parcel_id long, binary_id int, xmin double, ymin double, xmax double, ymax double")
    scenes = spark.createDataFrame([(1, "2024-01-10 12:00:00", 1.0, -10.0, -10.0, 100.0, 50.0)],
                                   "scene_id long, t string, cloud_cover double, xmin double, ymin double, xmax double, ymax double").withColumn("scene_ts", F.to_timestamp("t"))
    # task 2 has no raster at first: a failed task is tried again
    rasters = spark.createDataFrame([(t, 20, 20, [[float(t)] * 400]) for t in range(4)], "task_id long, h int, w int, bands array<array<double>>")
    src, out = os.path.join(tmp_dir, "tasks"), os.path.join(tmp_dir, "out")
    for ids, have in (((0, 1), rasters), ((2,), rasters.where("task_id < 2")), ((0, 1, 2, 3), rasters)):
        msgs = spark.createDataFrame([(t, boxes[t]) for t in ids], "task_id long, bbox array<double>")
        messages.write_json_lines(messages.encode(msgs), src)
        run_patch_stream(messages.read_json_stream(spark, src, TASK_SCHEMA), parcels, scenes, derived.FIXTURE_WINDOWS, out, os.path.join(tmp_dir, "ck"),
                         res=1.0, parcel_cell=20.0, scene_cell=50.0, worker_id="7", rasters=have, n_bands=1).awaitTermination()
    got = sorted((r["task_id"], r["batch"], r["status"]) for r in spark.read.parquet(os.path.join(out, "results")).collect())
    assert got == [(0, 0, "success"), (1, 0, "skipped_few_polygons"), (2, 1, "failed_download"), (2, 2, "success"), (3, 2, "success")]
    px = spark.read.parquet(os.path.join(out, "pixels"))
    assert px.count() == px.select("patch_id", "pixel_idx").distinct().count() == 3 * 400
    assert sorted((r["task_id"], r["batch"]) for r in spark.read.parquet(os.path.join(out, "repeats")).collect()) == [(0, 2), (1, 2)]


def test_dedupe_pixels_by_batch(spark):
    px = spark.createDataFrame([("task_1_worker_7", k, b) for b in (0, 2) for k in range(10)] + [("task_2_worker_7", 0, 0)], "patch_id string, pixel_idx long, batch int")
    res = spark.createDataFrame([(1, "7", 5, "success", 0), (1, "7", 9, "success", 2), (2, "7", 1, "success", 0)], "task_id long, worker_id string, ts long, status string, batch long")
    for results in (res, res.drop("batch")):
        got = mon.dedupe_pixels(px, results)
        assert got.columns == px.columns and sorted((r["patch_id"], r["batch"]) for r in got.collect()) == [("task_1_worker_7", 2)] * 10 + [("task_2_worker_7", 0)]
    earlier = res.withColumn("ts", F.when(F.col("batch") == 2, 0).otherwise(F.col("ts")))
    assert {r["batch"] for r in mon.dedupe_pixels(px, earlier).collect()} == {0}


# ---- the summary on stop

def test_final_summary_when_the_stream_ends(spark, tmp_dir):
    from terrapix.schema import RESULT_SCHEMA
    from terrapix.streaming.progress_stream import final_summary, run_progress_stream, run_to_end
    res = derived.task_results(spark, SF_SMALL).orderBy("ts", "task_id").limit(47)
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("in", "out", "ck"))
    messages.write_json_lines(messages.encode(res.withColumn("ts", F.col("ts").cast("timestamp"))), src)
    assert final_summary(spark, out).count() == 0
    stream = messages.valid(messages.read_json_stream(spark, src, RESULT_SCHEMA))
    last = run_to_end(run_progress_stream(stream, out, ck, every=20), out).first()
    assert sorted(r["message"] for r in spark.read.parquet(os.path.join(out, "snapshots")).collect()) == [20, 40]
    want = mon.monitor_totals(res, ts=None).first()
    assert last["message"] == 47 and last["messages_read"] == 47 and last["messages_per_sec"] > 0
    assert all(last[c] == want[c] for c in ("success", "skipped", "failed", "crop_pixels", "noncrop_pixels"))
    # one that goes on is stopped
    stream = messages.valid(messages.read_json_stream(spark, src, RESULT_SCHEMA))
    q = run_progress_stream(stream, out, ck, every=20, available_now=False)
    assert run_to_end(q, out, timeout=3).first()["message"] == 47 and not q.isActive
