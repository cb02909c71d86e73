"""Operator unit tests on hand-made rows (edges, nulls, NaN, empty input)."""

import math
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from terrapix.functions.geo import box_ring, point_in_rings, to_utm
from terrapix.functions.spectral import norm_diff, norm_diff_eps
from terrapix.functions.status import label_name, status_group
from terrapix.operators import grid, metrics, ordering, patches, sampling, scenes
from terrapix.operators.spatial import box_join, prefixed
from terrapix.schema import BandSpec, GridSpec, SearchWindow, windows_from_intervals


def test_norm_diff_guard_null_nan(spark):
    df = spark.createDataFrame(
        [(0.3, 0.1), (None, 0.1), (0.0, 0.0), (float("nan"), 0.1), (0.0005, 0.0004)], "a double, b double")
    out = [r[0] for r in df.select(norm_diff("a", "b")).collect()]
    assert out[0] == pytest.approx(0.5)
    assert out[1] == 0.0            # null guard -> otherwise branch
    assert out[2] == 0.0            # zero sum
    assert math.isnan(out[3])       # NaN passes the guard
    assert out[4] == 0.0            # sum below eps
    eps = df.select(norm_diff_eps("a", "b")).collect()
    assert eps[1][0] is None


def test_band_spec_orders():
    assert BandSpec().red == "band_4" and BandSpec().nir == "band_2"
    assert BandSpec().swir == "band_8" and BandSpec().green == "band_1"
    from terrapix.schema import REQUEST_ORDER_BANDS
    assert REQUEST_ORDER_BANDS.red == "band_2" and REQUEST_ORDER_BANDS.nir == "band_3"


def test_windows_from_intervals_inclusive_end():
    w = windows_from_intervals()
    assert w[0] == SearchWindow(1, "peak_spring", "2023-04-15", "2023-06-16", 10.0)
    assert [x.priority for x in w] == [1, 2, 3, 4]


def test_status_group_and_label_name(spark):
    df = spark.createDataFrame([("success",), ("skipped_few_polygons",), ("failed_download",), ("unknown",)],
                               "s string")
    assert [r[0] for r in df.select(status_group("s")).collect()] == ["success", "skipped", "failed", "failed"]
    lab = spark.createDataFrame([(0,), (1,), (2,)], "l int").select(label_name("l")).collect()
    assert [r[0] for r in lab] == ["Non-Crop", "Crop", None]


def test_utm_reference_point(spark):
    df = spark.createDataFrame([(-3.0, 40.0), (-3.7038, 40.4168)], "lon double, lat double")
    x, y = to_utm("lon", "lat", 30)
    r = df.select(x.alias("e"), y.alias("n")).collect()
    assert r[0]["e"] == pytest.approx(500000.0, abs=1e-6)
    assert r[0]["n"] == pytest.approx(4427757.22, abs=0.05)
    # Madrid (Puerta del Sol) ~ (440291, 4474254) in EPSG:32630
    assert r[1]["e"] == pytest.approx(440291, abs=5)
    assert r[1]["n"] == pytest.approx(4474254, abs=5)


def _ring(pts):
    return [Row(x=float(x), y=float(y)) for x, y in pts + [pts[0]]]


def test_point_in_polygon_hole_and_multipart(spark):
    outer = _ring([(0, 0), (10, 0), (10, 10), (0, 10)])
    hole = _ring([(3, 3), (7, 3), (7, 7), (3, 7)])
    part2 = _ring([(20, 0), (22, 0), (22, 2), (20, 2)])
    rings = [outer, hole, part2]
    pts = [(1, 1, True), (5, 5, False), (21, 1, True), (15, 5, False), (9.5, 9.5, True)]
    df = spark.createDataFrame([(x * 1.0, y * 1.0, rings, e) for x, y, e in pts],
                               "x double, y double, rings array<array<struct<x:double,y:double>>>, e boolean")
    got = df.select(point_in_rings("x", "y", "rings").alias("g"), "e").collect()
    assert all(r["g"] == r["e"] for r in got)


def test_scanline_rasterize_equals_point_test(spark):
    """Scanline spans == per-pixel even-odd test on a concave polygon with a hole."""
    tri = _ring([(0.0, 0.0), (16, 2), (9, 7), (15, 15), (1, 12)])
    hole = _ring([(4, 4), (7, 4), (7, 8), (4, 8)])
    rows = [(1, 1, 1, [tri, hole], 0.0, 0.0, 16.0, 15.0)]
    schema = ("task_id long, parcel_id long, binary_id int, rings array<array<struct<x:double,y:double>>>, "
              "xmin double, ymin double, xmax double, ymax double")
    pairs = spark.createDataFrame(rows, schema)
    tasks = spark.createDataFrame([(1, 0.0, 0.0, 16.0, 16.0)], "task_id long, xmin double, ymin double, "
                                  "xmax double, ymax double")
    g = patches.pixel_grid(tasks, 1.0)
    burned = {r["pixel_idx"] for r in patches.rasterize(pairs.join(g, "task_id")).collect()}
    allpx = (g.select("task_id", "gx0", "gy1", "w", F.explode(F.sequence(F.lit(0), F.lit(255))).alias("p"))
             .withColumn("cx", F.col("gx0") + (F.col("p") % 16) + 0.5)
             .withColumn("cy", F.col("gy1") - F.floor(F.col("p") / 16) - 0.5)
             .join(pairs.select("task_id", "rings"), "task_id")
             .where(point_in_rings("cx", "cy", "rings")))
    brute = {r["p"] for r in allpx.collect()}
    assert burned == brute and len(brute) > 50


def test_rasterize_later_polygon_wins(spark):
    schema = "task_id long, parcel_id long, binary_id int, xmin double, ymin double, xmax double, ymax double"
    pairs = spark.createDataFrame([(1, 1, 1, 0.0, 0.0, 4.0, 4.0), (1, 2, 0, 2.0, 0.0, 4.0, 4.0)], schema)
    pairs = pairs.withColumn("rings", F.array(box_ring("xmin", "ymin", "xmax", "ymax")))
    tasks = spark.createDataFrame([(1, 0.0, 0.0, 4.0, 4.0)], "task_id long, xmin double, ymin double, "
                                  "xmax double, ymax double")
    g = patches.pixel_grid(tasks, 1.0)
    b = patches.rasterize(pairs.join(g, "task_id"))
    m = {r["pixel_idx"]: r["mask_class"] for r in b.collect()}
    assert len(m) == 16 and sum(m.values()) == 8
    c = patches.mask_counts(b, g).first()
    assert (c["crop_pixels"], c["noncrop_pixels"], c["background_pixels"], c["empty_mask"]) == (8, 8, 0, False)


def test_cell_join_equals_brute_force(spark):
    rnd = random.Random(7)
    rows = []
    for k in range(300):
        x, y = rnd.randint(0, 95), rnd.randint(0, 95)
        rows.append((k, "c", float(x), float(y), float(x + rnd.choice([0, 1, 5, 10, 30])),
                     float(y + rnd.choice([0, 2, 10, 25]))))
    # some exactly on cell borders (closed edges)
    rows += [(1000, "c", 10.0, 10.0, 20.0, 20.0), (1001, "c", 0.0, 0.0, 0.0, 0.0)]
    p = spark.createDataFrame(rows, "parcel_id long, ec_hcat_n string, xmin double, ymin double, "
                              "xmax double, ymax double").withColumn("binary_id", F.lit(1))
    spec = grid.grid_spec(p, 10.0)
    got = {(r.i, r.j, r.parcel_id) for r in grid.cell_parcels(p, spec).collect()}
    brute = set()
    for (k, _, x0, y0, x1, y1) in rows:
        for i in range(spec.nx):
            for j in range(spec.ny):
                cx, cy = spec.x0 + i * spec.step, spec.y0 + j * spec.step
                if x0 <= cx + spec.step and x1 >= cx and y0 <= cy + spec.step and y1 >= cy:
                    brute.add((i, j, k))
    assert got == brute
    assert (1, 1, 1000) in got and (2, 2, 1000) in got and (1, 2, 1000) in got


def test_number_tasks_dense_order(spark):
    cells = spark.createDataFrame([(3, 1), (0, 5), (3, 0), (1, 1), (0, 2)], "i long, j long")
    got = sorted((r.task_id, r.i, r.j) for r in grid.number_tasks(cells).collect())
    assert got == [(0, 0, 2), (1, 0, 5), (2, 1, 1), (3, 3, 0), (4, 3, 1)]


def test_empty_grid(spark):
    p = spark.createDataFrame([], "parcel_id long, ec_hcat_n string, xmin double, ymin double, xmax double, "
                              "ymax double, binary_id int")
    spec = grid.grid_spec(p, 1.0)
    assert (spec.nx, spec.ny) == (0, 0)
    assert grid.cell_parcels(p, spec).count() == 0


def test_box_join_no_duplicates(spark):
    a = spark.createDataFrame([(1, 0.0, 0.0, 120.0, 120.0), (2, 49.0, 49.0, 51.0, 51.0)],
                              "id long, xmin double, ymin double, xmax double, ymax double")
    b = spark.createDataFrame([(10, 50.0, 50.0, 200.0, 60.0), (11, 121.0, 0.0, 130.0, 1.0)],
                              "sid long, xmin double, ymin double, xmax double, ymax double")
    pairs = box_join(prefixed(a, "l_"), prefixed(b, "r_"), 25.0).select("id", "sid").collect()
    assert sorted((r.id, r.sid) for r in pairs) == [(1, 10), (2, 10)]


def test_match_scenes_tiers(spark):
    w = [SearchWindow(1, "peak", "2024-01-10", "2024-01-12", 10.0),
         SearchWindow(2, "full", "2024-01-01", "2024-02-01", 30.0)]
    t = spark.createDataFrame([(1, 0.0, 0.0, 1.0, 1.0), (2, 50.0, 50.0, 51.0, 51.0), (3, 90.0, 90.0, 91.0, 91.0)],
                              "task_id long, xmin double, ymin double, xmax double, ymax double")
    import datetime as dt
    s = spark.createDataFrame([
        (1, dt.datetime(2024, 1, 20), 1.0, 0.0, 0.0, 5.0, 5.0),    # full tier, lowest cloud
        (2, dt.datetime(2024, 1, 11), 9.0, 0.0, 0.0, 5.0, 5.0),    # peak tier wins for task 1
        (3, dt.datetime(2024, 1, 11), 12.0, 49.0, 49.0, 55.0, 55.0),  # too cloudy for peak -> full
        (4, dt.datetime(2024, 1, 3), 5.0, 49.0, 49.0, 55.0, 55.0),
        (5, dt.datetime(2024, 1, 11), None, 90.0, 90.0, 95.0, 95.0),  # null cloud never matches
    ], "scene_id long, scene_ts timestamp, cloud_cover double, xmin double, ymin double, xmax double, ymax double")
    got = {r.task_id: (r.scene_id, r.season, r.status) for r in scenes.match_scenes(t, s, w, 10.0).collect()}
    assert got[1] == (2, "peak", None)
    assert got[2] == (4, "full", None)
    assert got[3] == (None, None, "failed_download")


def test_explode_pack_roundtrip_and_layouts(spark):
    bands = [[float(c * 100 + p) for p in range(6)] for c in range(3)]
    df = spark.createDataFrame([("a", 3, 2, 3, bands, [0, 1, 1, 0, 0, 1])],
                               "patch_id string, n_bands int, h int, w int, bands array<array<double>>, "
                               "mask array<int>")
    px = patches.explode_patches(df, 3).orderBy("pixel_idx").collect()
    assert [px[4][f"band_{k}"] for k in range(3)] == [4.0, 104.0, 204.0]
    buf = patches.explode_patches(df, 3, layout="buffer").orderBy("pixel_idx").collect()
    assert [buf[1][f"band_{k}"] for k in range(3)] == [3.0, 4.0, 5.0]   # flat[3..5]
    packed = patches.pack_patches(patches.explode_patches(df, 3), 3, 2, 3).first()
    assert packed["bands"] == bands and packed["mask"] == [0, 1, 1, 0, 0, 1]
    st = patches.mask_stats(df).first()
    assert (st["crop_pixels"], st["noncrop_pixels"], st["empty_mask"], st["shape_ok"]) == (3, 3, False, True)


def test_resample_identity_and_corners(spark):
    bands = [[1.0, 2.0, 3.0, 4.0]]
    df = spark.createDataFrame([("a", 1, 2, 2, bands, [0, 1, 1, 0])],
                               "patch_id string, n_bands int, h int, w int, bands array<array<double>>, "
                               "mask array<int>")
    same = patches.resample_bilinear(df, 2, 2).first()["bands"][0]
    assert same == bands[0]
    up = patches.resample_bilinear(df, 3, 3).first()["bands"][0]
    assert up == [1.0, 1.5, 2.0, 2.0, 2.5, 3.0, 3.0, 3.5, 4.0]
    nn = patches.resample_nearest(df, 4, 4).first()["mask"]
    assert nn[0] == 0 and nn[3] == 1 and nn[12] == 1 and nn[15] == 0


def test_hash_split_disjoint_complete_and_partition_invariant(spark):
    df = spark.range(5000).select(F.concat(F.lit("p"), (F.col("id") % 7).cast("string")).alias("patch_id"),
                                  F.col("id").alias("pixel_idx"))
    a, b = sampling.hash_split(df, [0.8, 0.2], 42)
    ka = {(r[0], r[1]) for r in a.collect()}
    kb = {(r[0], r[1]) for r in b.collect()}
    assert not (ka & kb) and len(ka) + len(kb) == 5000
    s1 = {r[1] for r in sampling.sample_fraction(df, 0.1).collect()}
    s2 = {r[1] for r in sampling.sample_fraction(df.repartition(13), 0.1).collect()}
    assert s1 == s2 and 350 < len(s1) < 650


def test_balance_split_fraction_capped(spark):
    rows = [("p", i, 1 if i < 100 else 0) for i in range(1000)]
    df = spark.createDataFrame(rows, "patch_id string, pixel_idx long, label int")
    fr = sampling.balance_fractions(df)
    assert fr[1] == 1.0 and fr[0] == pytest.approx(100 / 900)
    tr, te = sampling.balance_split(df)
    assert tr.join(te, ["patch_id", "pixel_idx"]).count() == 0


def test_running_totals_match_python(spark):
    rnd = random.Random(3)
    vals = [(rnd.randint(0, 50), k, rnd.randint(0, 9)) for k in range(2000)]
    df = spark.createDataFrame(vals, "t long, k long, v long")
    out = ordering.running_totals(df, ["t", "k"], ["v"], n=7, row_number="rn").collect()
    exp, acc = {}, 0
    for i, (t, k, v) in enumerate(sorted(vals)):
        acc += v
        exp[k] = (i + 1, acc)
    assert all(exp[r.k] == (r.rn, r.cum_v) for r in out)


def test_auc_rank_with_ties(spark):
    rows = [(1, 0.9), (1, 0.5), (0, 0.5), (0, 0.1), (1, 0.1), (0, 0.05)]
    df = spark.createDataFrame(rows, "label int, score double")
    auc = metrics.auc_rank(df, n=3).first()["auc"]
    # pairs: pos {0.9,0.5,0.1} x neg {0.5,0.1,0.05}: 3 + (0.5+1+1) + (0+0.5+1) = 7 of 9
    assert auc == pytest.approx(7 / 9)


@pytest.mark.parametrize("cm,f1", [
    ({(1, 0): 788204, (1, 1): 998191, (0, 0): 1031227, (0, 1): 745819}, 0.569463),
    ({(1, 0): 794511, (1, 1): 991884, (0, 0): 1038411, (0, 1): 738635}, 0.569669),
    ({(1, 0): 786519, (1, 1): 999876, (0, 0): 1030739, (0, 1): 746307}, 0.569805),
])
def test_golden_f1_from_saved_confusions(spark, cm, f1):
    df = spark.createDataFrame([(float(k[0]), float(k[1]), n) for k, n in cm.items()],
                               "label double, prediction double, n long")
    ex = df.select("label", "prediction", F.explode(F.array_repeat(F.lit(1), F.col("n").cast("int"))).alias("_"))
    rep = metrics.classification_report(ex).first()
    assert rep["f1_weighted"] == pytest.approx(f1, abs=1e-6)


def test_class_weights_imbalanced(spark):
    df = spark.createDataFrame([(1,)] * 12 + [(0,)] * 2, "label int")
    w = {r.label: r.weight for r in metrics.class_weights(df).collect()}
    assert w == {1: 1.0, 0: 6.0}


def test_standardize_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    r = metrics.standardize(df, ["a", "b"]).collect()
    assert [x.a_z for x in r] == pytest.approx([-0.70710678, 0.70710678])
    assert [x.b_z for x in r] == [0.0, 0.0]


def test_grid_spec_matches_arange():
    import numpy as np
    for lo, hi, step in [(0.0, 2029.0, 20.0), (-9.3, 4.33, 0.05), (1.0, 1.0, 0.5)]:
        n = math.ceil((hi - lo) / step) if hi > lo else 0
        assert n == len(np.arange(lo, hi, step))
    assert GridSpec(0, 0, 1, 2, 3).nx == 2


def test_pack_patches_ignores_duplicate_copies(spark):
    bands = [[float(c * 100 + p) for p in range(4)] for c in range(2)]
    df = spark.createDataFrame([("a", 2, 2, 2, bands, [0, 1, 1, 0])],
                               "patch_id string, n_bands int, h int, w int, bands array<array<double>>, "
                               "mask array<int>")
    px = patches.explode_patches(df, 2)
    packed = patches.pack_patches(px.unionByName(px).unionByName(px), 2, 2, 2).collect()
    assert len(packed) == 1 and packed[0]["bands"] == bands and packed[0]["mask"] == [0, 1, 1, 0]


def test_empty_inputs(spark):
    """Operators return empty or null results on empty input, no error."""
    from terrapix.operators import monitor
    empty_pred = spark.createDataFrame([], "label double, prediction double, score double")
    a = metrics.auc_rank(empty_pred, n=2).first()
    assert a["auc"] is None
    r = metrics.classification_report(empty_pred).first()
    assert r is None or r["accuracy"] is None
    assert metrics.confusion_wide(empty_pred).count() == 0
    res = spark.createDataFrame([], "task_id long, worker_id string, status string, crop_pixels long, "
                                "noncrop_pixels long, ts timestamp")
    t = monitor.monitor_totals(res).first()
    assert t["tasks"] == 0 and t["crop_ratio"] == 0.0 and t["tasks_per_sec"] == 0.0
    assert monitor.progress(res, n=2).count() == 0
    tasks = spark.createDataFrame([], "task_id long, xmin double, ymin double, xmax double, ymax double")
    sc_ = spark.createDataFrame([], "scene_id long, scene_ts timestamp, cloud_cover double, xmin double, "
                                "ymin double, xmax double, ymax double")
    w = [SearchWindow(1, "p", "2024-01-01", "2024-02-01", 10.0)]
    assert scenes.match_scenes(tasks, sc_, w, 10.0).count() == 0


def test_invalid_box_meets_nothing(spark):
    a = spark.createDataFrame([(1, 5.0, 5.0, 1.0, 1.0)], "id long, xmin double, ymin double, xmax double, "
                              "ymax double")
    b = spark.createDataFrame([(2, 0.0, 0.0, 10.0, 10.0)], "sid long, xmin double, ymin double, xmax double, "
                              "ymax double")
    assert box_join(prefixed(a, "l_"), prefixed(b, "r_"), 3.0).count() == 0


def test_rasterize_envelope_mode_and_full_mask(spark):
    schema = "task_id long, parcel_id long, binary_id int, xmin double, ymin double, xmax double, ymax double"
    pairs = spark.createDataFrame([(1, 1, 1, 0.0, 0.0, 3.0, 2.0), (1, 2, 0, 2.0, 1.0, 4.0, 4.0)], schema)
    ringed = pairs.withColumn("rings", F.array(box_ring("xmin", "ymin", "xmax", "ymax")))
    tasks = spark.createDataFrame([(1, 0.0, 0.0, 4.0, 4.0)], "task_id long, xmin double, ymin double, "
                                  "xmax double, ymax double")
    g = patches.pixel_grid(tasks, 1.0)
    env = {(r.pixel_idx, r.mask_class) for r in patches.rasterize(pairs.join(g, "task_id"), exact=False).collect()}
    ring = {(r.pixel_idx, r.mask_class) for r in patches.rasterize(ringed.join(g, "task_id")).collect()}
    assert env == ring and len(env) == 11
    dense = patches.full_mask(patches.rasterize(ringed.join(g, "task_id")), g).collect()
    assert len(dense) == 16
    assert sum(r.label for r in dense) == 5            # crop pixels not overwritten by parcel 2
    assert sum(1 for r in dense if r.mask_class is None) == 5   # background stays distinguishable
