"""Burning by spans."""

import random

import numpy as np

from terrapix.operators import patches as pt
from terrapix.operators import spans as sp

SPANS = "task_id long, w int, _r int, parcel_id long, binary_id int, _a int, _b int"


def pixels_of(rows):
    """(task, row, column) -> (parcel, label) of the highest parcel."""
    out = {}
    for t, _, r, p, k, a, b in rows:
        for c in range(a, b + 1):
            out[(t, r, c)] = max(out.get((t, r, c), (-1, -1)), (p, k))
    return out


def check(got, rows):
    seen = {}
    for s in got:
        for c in range(s["_a"], s["_b"] + 1):
            assert (s["task_id"], s["_r"], c) not in seen  # disjoint
            seen[(s["task_id"], s["_r"], c)] = (s["parcel_id"], s["binary_id"])
    assert seen == pixels_of(rows)


def test_visible_spans_equal_pixels(spark, monkeypatch):
    rng = random.Random(4)
    rows = []
    for _ in range(3000):
        a = rng.randrange(40)
        rows.append((rng.choice([0, 1, 2, None]), 64, rng.randrange(6), rng.randrange(300), rng.choice([0, 1, 7]), a, a + rng.randrange(20)))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "170")
    try:
        check(sp.visible_spans(spark.createDataFrame(rows, SPANS).repartition(5), ["task_id", "w", "_r"]).collect(), rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sp.visible_spans(spark.createDataFrame([], SPANS), ["task_id", "w", "_r"]).count() == 0


def test_canvases_of_bounded_size_give_the_same(monkeypatch):
    import pyarrow as pa
    rng = random.Random(6)
    rows = [(rng.randrange(3), 64, rng.randrange(3), rng.randrange(500), rng.randrange(2), a, a + rng.randrange(25)) for a in (rng.randrange(35) for _ in range(800))]
    table = pa.table({n.split()[0]: [r[i] for r in rows] for i, n in enumerate(SPANS.split(", "))})
    for cells in (1, 30, 300, 3000):  # below one span, one row, all rows
        monkeypatch.setattr(sp, "CELLS", cells)
        check(sp._painted(table, ["task_id", "w", "_r"]).to_pylist(), rows)


def test_a_crowded_pixel_row(spark):
    """100,000 polygons on one row: no row per pixel anywhere, and few rows meet
    in the task that owns the pixel row."""
    n, w = 100_000, 512
    df = spark.range(0, n, 1, 8).selectExpr("CAST(0 AS BIGINT) AS task_id", f"{w} AS w", "3 AS _r", "id AS parcel_id", "CAST(id % 2 AS INT) AS binary_id",
                                            "CAST(id * 7919 % 400 AS INT) AS _a", "CAST(id * 7919 % 400 + 1 + id % 100 AS INT) AS _b")
    rows = [tuple(r) for r in df.collect()]
    got = sp.visible_spans(df, ["task_id", "w", "_r"])
    out = got.collect()
    assert len(out) <= w
    check(out, rows)
    first = sp.visible_spans.__doc__ and df.mapInArrow(lambda it: (b for x in it for b in sp._painted(sp.pa.Table.from_batches([x]), ["task_id", "w", "_r"]).to_batches()), df.schema)
    assert first.count() <= n // 20  # what is shuffled


def test_counts_from_spans_equal_counts_from_pixels(spark):
    from terrapix.plans import queries as Q
    from tests.conftest import SF_SMALL
    tasks, pairs, spec = Q.task_pairs(spark, SF_SMALL, shape="diamond")
    g = pairs.withColumns(pt.cell_grid_columns(spec, 1.0))
    grid = tasks.select("i", "j", pt.F.lit(20).alias("h"), pt.F.lit(20).alias("w"))
    a = pt.mask_counts(pt.rasterize_spans(g, key=("i", "j")), grid, key=("i", "j"))
    b = pt.mask_counts(pt.rasterize(g, key=("i", "j")), grid, key=("i", "j"))
    assert a.exceptAll(b).count() == 0 and a.count() == b.count() > 0


def test_a_grid_without_pixels_has_no_mask(spark):
    grid = spark.createDataFrame([(1, 0, 5), (2, 1, 2)], "task_id long, h int, w int")
    burned = spark.createDataFrame([(2, 2, 0, 1, 1, 9, 1)], "task_id long, w int, _r int, _a int, _b int, parcel_id long, mask_class int")
    rows = pt.full_mask(burned, grid).orderBy("pixel_idx").collect()
    assert [(r["task_id"], r["pixel_idx"], r["label"]) for r in rows] == [(2, 0, 0), (2, 1, 1)]


def test_paint_keeps_the_last():
    a, b, k = sp.paint(np.array([0, 0, 1]), np.array([0, 2, 5]), np.array([9, 4, 5]), np.array([0, 1, 2]))
    assert list(zip(a.tolist(), b.tolist(), k.tolist())) == [(0, 1, 0), (2, 4, 1), (5, 9, 0), (5, 5, 2)]
