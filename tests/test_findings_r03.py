"""Steps that the review of round 3 found to outgrow their input."""

import io
import random
from contextlib import redirect_stdout

from terrapix.operators import metrics, ml, scenes
from terrapix.schema import SearchWindow


def plan(df):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_partitions_of_a_fit_follow_its_rows():
    assert [ml.fit_partitions(n) for n in (0, 10, 8 * ml.FIT_ROWS, 8 * ml.FIT_ROWS + 1)] == [8, 8, 8, 9]
    assert ml.fit_partitions(100 * ml.FIT_ROWS) == 100


def test_fit_reads_its_rows_once(spark):
    rng = random.Random(4)
    reads = spark.sparkContext.accumulator(0)

    def seen(it):
        for b in it:
            reads.add(b.num_rows)
            yield b
    rows = [(f"p{k % 7}", k, float(k % 2), rng.random() + k % 2) for k in range(400)]
    df = spark.createDataFrame(rows, "patch_id string, pixel_idx long, label double, a double")
    model = ml.fit_forest(df.mapInArrow(seen, df.schema), ["a"], ml.ForestParams(3, 3))
    assert reads.value == 400
    plain = ml.forest_pipeline(["a"], ml.ForestParams(3, 3)).fit(ml.stable_input(df))
    assert model.stages[-1].toDebugString.split("\n", 1)[1] == plain.stages[-1].toDebugString.split("\n", 1)[1]


def test_class_weights_are_counted_once(spark):
    df = spark.createDataFrame([(1,), (1,), (0,)], "label int")
    w = metrics.class_weights(df, threshold=1.0)
    assert "Aggregate" not in plan(w)
    assert {(r.label, r.n, r.weight) for r in w.collect()} == {(0, 1, 2.0), (1, 2, 1.0)}


def test_scene_search_drops_what_cannot_win(spark):
    """Random boxes of many sizes against every pair; of a crowd of scenes over one
    place few are left to test (before: every task met every scene there)."""
    rng = random.Random(11)

    def box(big):
        x, y = rng.uniform(-300, 300), rng.uniform(-300, 300)
        return x, y, x + rng.uniform(0, big), y + rng.uniform(0, big)
    tasks = [(k, *box(rng.choice([1, 20, 400]))) for k in range(150)]
    cat = [(k, "2024-01-05", float(rng.randrange(9)), *box(rng.choice([0, 50, 60, 500]))) for k in range(300)]
    t = spark.createDataFrame(tasks, "task_id long, xmin double, ymin double, xmax double, ymax double")
    s = spark.createDataFrame(cat, "scene_id long, scene_ts string, cloud_cover double, xmin double, ymin double, xmax double, ymax double").selectExpr("* except (scene_ts)", "to_timestamp(scene_ts) AS scene_ts")
    ws = [SearchWindow(1, "a", "2024-01-01", "2024-02-01", 2.0), SearchWindow(2, "b", "2024-01-01", "2024-02-01", 8.0)]
    want = {}
    for k, a, b, c, d in tasks:
        hits = [(1 if cl < 2 else 2, cl, i) for i, _, cl, x0, y0, x1, y1 in cat if cl < 8 and x0 <= c and x1 >= a and y0 <= d and y1 >= b]
        want[k] = min(hits, default=(None, None, None))
    for strategy in ("tiered", "single"):
        got = {r.task_id: (r.priority, r.cloud_cover, r.scene_id) for r in scenes.match_scenes(t, s, ws, 50.0, strategy).collect()}
        assert got == want
    assert "_bound" in plan(scenes.match_scenes(t, s, ws, 50.0, "single"))


def test_workers_hold_little():
    from terrapix.llm import op4_sentencepiece as op4
    assert 2 * op4.CACHED + op4.PARTS + op4.PAIRS <= 600_000
