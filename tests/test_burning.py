"""Polygons are burned where they are: nothing a task holds grows with the table."""

import random

from pyspark.sql import functions as F

from terrapix.operators import patches as pt
from terrapix.operators import spans as sp
from terrapix.operators import spatial
from terrapix.plans import patch_production as pp
from terrapix.sources import derived
from tests.conftest import SF_SMALL

PAIRS = ("task_id long, parcel_id long, binary_id int, rings array<array<struct<x:double,y:double>>>, "
         "gx0 double, gy1 double, res double, h int, w int")
NO_ID = 10**9  # a parcel without id lies above all others


def polygons(n=400, seed=5):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        x, y = rng.uniform(-3, 11), rng.uniform(-3, 11)
        ring = [(x + rng.uniform(0, 6), y + rng.uniform(0, 6)) for _ in range(rng.choice([3, 4, 5]))]
        rings = [ring + ring[:1]] + ([[(x + 1, y + 1), (x + 2, y + 1), (x + 2, y + 3), (x + 1, y + 1)]] if k % 3 == 0 else [])
        # some parcels come in several rows, some classes are unknown
        rows.append((rng.choice([0, 1, None]), rng.choice([k, k // 7, None]), rng.choice([0, 1, 1, None]), rings, 0.0, 12.0, 1.0, 12, 9))
    return rows


def crossings_paired(rows):
    """Even-odd over all rows of a (task, parcel) on each pixel row, by hand."""
    cross, seen = {}, {}
    for t, p, k, rings, gx0, gy1, res, h, w in rows:
        for ring in rings if k is not None else []:
            for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
                for r in range(h):
                    cy = gy1 - (r + 0.5) * res
                    if y1 != y2 and min(y1, y2) <= cy < max(y1, y2):
                        cross.setdefault((t, p, r), []).append((x1 + (x2 - x1) * (cy - y1) / (y2 - y1), k))
    for (t, p, r), xs in cross.items():
        xs.sort()
        for (xa, k), (xb, other) in zip(xs[::2], xs[1::2]):
            for c in range(rows[0][8]):
                if k == other and xa <= c + 0.5 < xb:
                    seen[(t, r, c)] = max(seen.get((t, r, c), (-1, -1)), (NO_ID if p is None else p, k))
    return seen


def test_rows_of_a_parcel_meet_whatever_the_batches(spark, monkeypatch):
    rows = polygons()
    want = crossings_paired(rows)
    df = spark.createDataFrame([(*r[:3], [[tuple(p) for p in ring] for ring in r[3]], *r[4:]) for r in rows], PAIRS).repartition(6)
    for size, batch in ((None, "10000"), ((400, 400), "7"), ((10_000_000, 5_000_000), "3")):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        try:
            got = pt.rasterize_spans(df, size=size).collect()
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        seen = {}
        for s in got:
            for c in range(s["_a"], s["_b"] + 1):
                assert (s["task_id"], s["_r"], c) not in seen
                seen[(s["task_id"], s["_r"], c)] = (NO_ID if s["parcel_id"] is None else s["parcel_id"], s["mask_class"])
        assert seen == want


def test_few_crossings_at_once_give_the_same(monkeypatch):
    import numpy as np
    import pyarrow as pa
    edges = [[dict(lo=0, hi=4, x1=float(x), y1=0.0, x2=float(x), y2=5.0) for x in (k % 3, k % 3 + 2)] if k % 5 else [] for k in range(50)]
    t = pa.table({"task_id": pa.array([0] * 50), "w": pa.array([9] * 50, pa.int32()), "parcel_id": pa.array(range(50)), "binary_id": pa.array([1] * 50, pa.int32()),
                  "gx0": [0.0] * 50, "gy1": [5.0] * 50, "res": [1.0] * 50, "edges": pa.array(edges)})
    begins = sp._begins(t, ["task_id", "parcel_id"])
    assert begins.all()
    whole = pa.concat_tables(sp._filled(t, begins, ["task_id"])).to_pylist()
    assert len(whole) == 40 * 5
    monkeypatch.setattr(sp, "CROSSINGS", 1)
    parts = list(sp._filled(t, begins, ["task_id"]))
    assert len(parts) == 40 and pa.concat_tables(parts).to_pylist() == whole
    assert not sp._begins(pa.table({"k": pa.array([None, None, 1, 1])}), ["k"])[[1, 3]].any()
    assert np.array_equal(sp._begins(pa.table({"k": pa.array([None, 1, None, 2])}), ["k"]), [True] * 4)


def test_no_crossing_is_shuffled(spark):
    """Crossings are paired in the task that has the polygon: no window over them,
    and what is shuffled after painting is bounded by the pixels."""
    df = spark.createDataFrame(polygons(), PAIRS)
    plan = pt.rasterize_spans(df, size=(400, 400))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "_pair" not in plan
    assert plan.count("Exchange hashpartitioning") == 2


def test_partitions_follow_the_polygons(spark):
    df = spark.createDataFrame(polygons(20), PAIRS)
    parts = [pt._gathered(df, ("task_id",), (n, 10)).rdd.getNumPartitions() for n in (0, 10, 10_000_000, 145_000_000, 1_000_000_000)]
    assert parts == [8, 8, 40, 200, 500]
    assert [spatial._join_parts([{0: n}, {0: 1}], [0]) for n in (0, 3_000_000, 100_000_000, 400_000_000)] == [8, 30, 200, 400]
    assert spatial._join_parts([{0: 1_000_000, 1: 1_000_000}, {1: 5}], [0, 1]) == 30  # lower boxes lie on both levels


def test_pairs_are_not_shuffled_for_their_grid(spark, monkeypatch):
    """The tasks bring their grids into the box join: no second join of the pairs."""
    seen = []
    burn = pt.rasterize_spans
    monkeypatch.setattr(pp.pt, "rasterize_spans", lambda p, **k: seen.append(p) or burn(p, **k))
    tasks = spark.createDataFrame([(k, 20.0 * k, 0.0, 20.0 * k + 20, 20.0) for k in range(4)], "task_id long, xmin double, ymin double, xmax double, ymax double")
    parcels = derived.parcels(spark, SF_SMALL).withColumn("binary_id", F.lit(1))
    made = pp.produce_all(tasks, parcels, derived.scenes(spark, SF_SMALL), derived.FIXTURE_WINDOWS, res=1.0, parcel_cell=20.0, scene_cell=50.0)
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    boxes = plan.index("Project" if plan.startswith("Project") else "Join")
    assert boxes == 0 and plan.split("\n")[1].lstrip("+- :").startswith("Join") and "_level" in plan.split("\n")[1]
    assert made.results.count() == 4
