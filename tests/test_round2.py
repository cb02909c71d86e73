"""Worker, packing, ordering and join cases that bad or unlucky input brings."""

import itertools
import os
import random
import sqlite3
from collections import Counter

import pytest
from pyspark.sql import functions as F

from terrapix.operators import grid, ml, ordering, patches, profile
from terrapix.operators.spatial import box_join, prefixed
from terrapix.plans import patch_production as pp
from terrapix.plans import queries as Q
from terrapix.sources import derived, files, messages
from tests.conftest import SF_SMALL

BOXES = "id long, xmin double, ymin double, xmax double, ymax double"


# ---- worker

def production(spark, tasks, **kw):
    parcels = grid.class_lookup(derived.parcels(spark, SF_SMALL), derived.class_map(spark))
    return pp.produce_all(tasks, parcels, derived.scenes(spark, SF_SMALL), derived.FIXTURE_WINDOWS, res=1.0, parcel_cell=20.0, scene_cell=50.0, worker_id="1", **kw)


def messages_of(spark):
    tasks, _, spec = Q.task_pairs(spark, SF_SMALL, with_rings=False)
    return grid.task_messages(tasks, spec, derived.FIXTURE_CLASS_MAP), tasks


def test_repeated_task_messages_change_nothing(spark):
    msgs, tasks = messages_of(spark)
    cols = ["task_id", "status", "polygon_count", "crop_pixels", "noncrop_pixels"]
    once = production(spark, msgs).results.select(*cols)
    thrice = production(spark, msgs.unionByName(msgs).unionByName(msgs)).results.select(*cols)
    assert once.count() == tasks.count() == thrice.count()
    assert once.exceptAll(thrice).count() == 0


def test_latest_message_of_a_task_wins(spark):
    rows = [(1, [0.0, 0.0, 1.0, 1.0], 5, 0), (1, [2.0, 2.0, 3.0, 3.0], 6, 0), (1, [9.0, 9.0, 10.0, 10.0], 6, -1)]
    df = spark.createDataFrame(rows, "task_id long, bbox array<double>, _partition int, _offset long")
    got = pp.one_per_task(df).collect()
    assert len(got) == 1 and got[0]["xmin"] == 2.0


def test_unusable_boxes_fail_with_a_reason(spark):
    rows = [(1, None), (2, [0.0, 1.0]), (3, [0.0, None, 1.0, 1.0]), (4, [5.0, 0.0, 1.0, 1.0]), (5, [float("nan"), 0.0, 1.0, 1.0]), (6, [0.0, 0.0, 20.0, 20.0])]
    got = {r["task_id"]: r for r in production(spark, spark.createDataFrame(rows, "task_id long, bbox array<double>")).results.collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6}
    assert all(got[k]["status"] == "failed" and got[k]["error"] for k in range(1, 6))
    assert got[6]["status"] != "failed" and got[6]["error"] is None


def test_raster_of_another_size_is_an_invalid_shape(spark):
    msgs, tasks = messages_of(spark)
    whole = derived.task_rasters(spark, SF_SMALL, tasks)
    ok = production(spark, msgs, rasters=whole, n_bands=4, min_polygons=1).results.where("status = 'success'").select("task_id").collect()
    assert ok
    bad = ok[0]["task_id"]
    missing = ok[1]["task_id"]
    cut = whole.withColumn("bands", F.when(F.col("task_id") == bad, F.slice("bands", 1, 3)).otherwise(F.col("bands"))).where(F.col("task_id") != missing)
    got = {r["task_id"]: r["status"] for r in production(spark, msgs, rasters=cut, n_bands=4, min_polygons=1).results.collect()}
    assert got[bad] == "invalid_image_shape" and got[missing] == "failed_download"
    assert sum(s == "success" for s in got.values()) == len(ok) - 2


def test_projected_worker_burns_metres(spark):
    """A 0.002 degree square parcel at 42 N in a task around it: its area in
    10 m pixels is what the projection says."""
    ring = [(-3.001, 41.999), (-2.999, 41.999), (-2.999, 42.001), (-3.001, 42.001)]  # left open: it is closed
    parcels = spark.createDataFrame([(i, 1, -3.001, 41.999, -2.999, 42.001, [ring]) for i in range(5)],
                                    "parcel_id long, binary_id int, xmin double, ymin double, xmax double, ymax double, rings array<array<struct<x:double,y:double>>>")
    tasks = spark.createDataFrame([(0, [-3.005, 41.995, -2.995, 42.005])], "task_id long, bbox array<double>")
    scenes = spark.createDataFrame([(1, "2024-01-10 12:00:00", 1.0, -10.0, 30.0, 10.0, 50.0)],
                                   "scene_id long, t string, cloud_cover double, xmin double, ymin double, xmax double, ymax double").withColumn("scene_ts", F.to_timestamp("t"))
    made = pp.produce_all(tasks, parcels, scenes, derived.FIXTURE_WINDOWS, res=10.0, parcel_cell=0.05, scene_cell=5.0, utm_zone=30)
    r = made.results.first()
    # 0.002 degrees are 222.2 m north and 165.6 m east here
    assert r["status"] == "success" and abs(r["crop_pixels"] - 222.2 * 165.6 / 100) < 30
    assert r["shape"][1] == pytest.approx(111, abs=2) and r["shape"][2] == pytest.approx(83, abs=2)


def test_topic_records_keep_their_time_and_key(spark):
    frames = spark.createDataFrame([("task_1", '{"task_id": 1, "status": "success"}', "2024-01-01 00:00:05", 0, 7)], "key string, value string, t string, partition int, offset long")
    from terrapix.schema import RESULT_SCHEMA
    r = messages.decode_topic(frames.withColumn("timestamp", F.to_timestamp("t")).withColumn("value", F.encode("value", "UTF-8")), RESULT_SCHEMA).first()
    assert r["_ok"] and r["_key"] == "task_1" and r["_offset"] == 7 and str(r["ts"]) == "2024-01-01 00:00:05"


def test_lost_progress_state_is_an_error(spark, tmp_dir):
    from terrapix.streaming.progress_stream import _previous_state
    assert _previous_state(spark, tmp_dir, 0)["message"] == 0
    with pytest.raises(RuntimeError, match="missing"):
        _previous_state(spark, tmp_dir, 3)


def test_streams_demand_a_checkpoint(spark):
    from terrapix.session import require_checkpoint
    with pytest.raises(ValueError):
        require_checkpoint(None)


# ---- patches

PIXELS = "patch_id string, pixel_idx long, label long, band_0 double, band_1 double"


def test_pack_places_by_index_and_counts_what_does_not_fit(spark):
    rows = [("a", 0, 1, 0.0, 10.0), ("a", 2, 1, 2.0, 12.0), ("a", 3, 0, 3.0, 13.0), ("a", 4, 1, 9.0, 9.0), ("a", -1, 1, 9.0, 9.0),
            ("b", 0, 0, 5.0, 50.0), ("b", 0, 1, 6.0, 60.0), ("b", 1, 1, 7.0, 70.0)]
    sizes = spark.createDataFrame([("a", 2, 2), ("b", 1, 2), ("c", 1, 1)], "patch_id string, h int, w int")
    got = {r["patch_id"]: r for r in patches.pack_patches(spark.createDataFrame(rows, PIXELS), 2, sizes=sizes).collect()}
    a, b, c = got["a"], got["b"], got["c"]
    assert a["bands"] == [[0.0, 0.0, 2.0, 3.0], [10.0, 0.0, 12.0, 13.0]] and a["mask"] == [1, 0, 1, 0]
    assert (a["n_missing"], a["n_extra"], a["n_conflicts"]) == (1, 2, 0)
    assert (b["n_missing"], b["n_extra"], b["n_conflicts"]) == (0, 0, 1) and b["bands"] == [[6.0, 7.0], [60.0, 70.0]]
    assert (c["n_missing"], c["bands"]) == (1, [[0.0], [0.0]])


def test_explode_rejects_other_band_counts_and_skips_empty(spark):
    schema = "patch_id string, n_bands int, h int, w int, bands array<array<double>>, mask array<int>"
    empty = spark.createDataFrame([("e", 2, 0, 0, [[], []], [])], schema)
    assert patches.explode_patches(empty, 2).count() == 0
    wide = spark.createDataFrame([("x", 3, 1, 1, [[1.0], [2.0], [3.0]], [1])], schema)
    with pytest.raises(Exception, match="expected 2"):
        patches.explode_patches(wide, 2).collect()


# ---- joins, order, quantiles, models

def test_box_join_mixes_sizes(spark):
    rng = random.Random(8)

    def boxes(n, seed):
        out = [(seed * 1000, -500.0, -500.0, 500.0, 500.0), (seed * 1000 + 1, 3.0, 3.0, 3.0, 3.0), (seed * 1000 + 2, 5.0, 5.0, 4.0, 6.0), (seed * 1000 + 3, None, 0.0, 1.0, 1.0)]
        for i in range(n):
            x, y, s = rng.uniform(-100, 100), rng.uniform(-100, 100), rng.choice([0.0, 0.5, 2.0, 16.0, 64.0])
            out.append((seed * 1000 + 10 + i, round(x), round(y), round(x) + s, round(y) + s * rng.choice([0.1, 1.0, 2.0])))
        return [tuple(float(v) if v is not None and k else v for k, v in enumerate(b)) for b in out]
    a, b = boxes(60, 1), boxes(60, 2)

    def ok(p):
        return None not in p and p[1] <= p[3] and p[2] <= p[4]
    want = sorted((p[0], q[0]) for p, q in itertools.product(a, b) if ok(p) and ok(q) and q[1] <= p[3] and q[3] >= p[1] and q[2] <= p[4] and q[4] >= p[2])
    left = prefixed(spark.createDataFrame(a, BOXES).withColumnRenamed("id", "l"), "l_")
    right = prefixed(spark.createDataFrame(b, BOXES).withColumnRenamed("id", "r"), "r_")
    assert sorted((r["l"], r["r"]) for r in box_join(left, right, 2.0).select("l", "r").collect()) == want


def test_running_totals_with_a_hot_value_and_nulls(spark):
    rows = [(5 if i % 3 else i, i, 1 + i % 7) for i in range(600)] + [(None, 1000 + i, 2) for i in range(20)]
    df = spark.createDataFrame(rows, "t int, k int, v int").repartition(5)
    out = {r["k"]: (r["rn"], r["cum_v"]) for r in ordering.running_totals(df, ["t", "k"], ["v"], n=16, row_number="rn").collect()}
    total = 0
    for n, (t, k, v) in enumerate(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])), 1):
        total += v
        assert out[k] == (n, total)
    buckets = df.groupBy(ordering.range_bucket(df, ["t", "k"], 16).alias("b")).count().collect()
    assert max(r["count"] for r in buckets) < 200  # the hot value's 400 rows are spread


def test_exact_quantiles(spark):
    import numpy as np
    x = np.random.default_rng(1).normal(size=777)
    r = profile.exact_quantiles(spark.createDataFrame([(float(v),) for v in x], "x double"), "x").first()
    assert [r["q25"], r["q50"], r["q75"]] == pytest.approx(np.quantile(x, [0.25, 0.5, 0.75]).tolist())


def test_training_rows_do_not_follow_the_machine(spark):
    df = derived.pixels(spark, SF_SMALL).select("patch_id", "pixel_idx", "label")

    def parts(d):
        return d.withColumn("p", F.spark_partition_id()).groupBy("p").agg(F.sort_array(F.collect_list("pixel_idx")).alias("x")).orderBy("p").collect()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    a = parts(ml.stable_input(df))
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        b = parts(ml.stable_input(df.repartition(11)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert a == b and len(a) == ml.FIT_PARTITIONS


# ---- sources

def test_readers_check_their_columns(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    spark.createDataFrame([(1, "x")], "scene_id long, cloud_cover string").write.parquet(path)
    with pytest.raises(ValueError, match="cloud_cover"):
        files.read_scenes(spark, path)
    with pytest.raises(ValueError, match="bands"):
        files.read_patches(spark, path)


def test_geopackage_layers_must_be_named(tmp_dir):
    from terrapix.sources.gpkg import _meta
    path = os.path.join(tmp_dir, "two.gpkg")
    con = sqlite3.connect(path)
    con.execute("CREATE TABLE gpkg_contents (table_name TEXT, data_type TEXT)")
    con.executemany("INSERT INTO gpkg_contents VALUES (?, 'features')", [("a",), ("b",)])
    con.commit()
    con.close()
    with pytest.raises(ValueError, match="option table"):
        _meta(path, None)


def test_exact_box_filter_on_polygons(spark, tmp_dir):
    """Rhombi around a box: their envelopes meet it, some polygons do not; a
    polygon around the whole box and one inside it do."""
    path = os.path.join(tmp_dir, "parcels")
    derived.parcels(spark, SF_SMALL, shape="diamond").write.parquet(path)
    from terrapix.functions.geo import rings_meet_box
    rng = random.Random(4)
    boxes = [(x, y, x + w, y + h) for x, y, w, h in ((rng.randrange(2000) * 1.0, rng.randrange(1500) * 1.0, rng.choice([0.0, 3.0, 40.0]), rng.choice([0.0, 5.0, 60.0])) for _ in range(60))]
    rows = spark.read.parquet(path)
    meets = F.array(*[rings_meet_box("rings", tuple(F.lit(v) for v in box)) for box in boxes])
    seen = Counter()
    for r in rows.withColumn("meets", meets).collect():
        cx, cy, a, b = (r.xmin + r.xmax) / 2, (r.ymin + r.ymax) / 2, (r.xmax - r.xmin) / 2, (r.ymax - r.ymin) / 2
        for box, got in zip(boxes, r.meets):
            dx, dy = max(box[0] - cx, 0, cx - box[2]), max(box[1] - cy, 0, cy - box[3])
            want = dx / a + dy / b <= 1 + 1e-12  # the nearest point of the box, in the rhombus norm
            assert got == want, (r.parcel_id, box)
            seen[want, dx <= a and dy <= b] += 1
    assert seen[True, True] and seen[False, True]  # envelopes that meet: some polygons do, some do not
    ring = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]
    rows = [(1, 0.0, 0.0, 10.0, 10.0, [ring])]
    df = spark.createDataFrame(rows, "parcel_id long, xmin double, ymin double, xmax double, ymax double, rings array<array<struct<x:double,y:double>>>")
    df.write.parquet(os.path.join(tmp_dir, "one"))
    for b in ((4.0, 4.0, 5.0, 5.0), (-5.0, -5.0, 15.0, 15.0), (10.0, 10.0, 11.0, 11.0)):
        assert files.read_parcels(spark, os.path.join(tmp_dir, "one"), bbox=b, exact=True).count() == 1
