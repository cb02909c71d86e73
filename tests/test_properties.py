"""Property tests (hypothesis): distributed operators equal brute force."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terrapix.operators import ordering, patches
from terrapix.operators.spatial import box_join, prefixed

SET = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

box = st.tuples(st.integers(0, 60), st.integers(0, 60), st.integers(0, 25), st.integers(0, 25))


@SET
@given(st.lists(box, min_size=1, max_size=25), st.lists(box, min_size=1, max_size=25),
       st.sampled_from([3.0, 10.0, 40.0]))
def test_box_join_equals_brute_force(spark, a, b, cell):
    A = [(i, float(x), float(y), float(x + w), float(y + h)) for i, (x, y, w, h) in enumerate(a)]
    B = [(j, float(x), float(y), float(x + w), float(y + h)) for j, (x, y, w, h) in enumerate(b)]
    sch = "id long, xmin double, ymin double, xmax double, ymax double"
    got = box_join(prefixed(spark.createDataFrame(A, sch), "l_"),
                   prefixed(spark.createDataFrame(B, sch).withColumnRenamed("id", "sid"), "r_"), cell)
    pairs = sorted((r.id, r.sid) for r in got.select("id", "sid").collect())
    brute = sorted((i, j) for (i, ax0, ay0, ax1, ay1) in A for (j, bx0, by0, bx1, by1) in B
                   if bx0 <= ax1 and bx1 >= ax0 and by0 <= ay1 and by1 >= ay0)
    assert pairs == brute


@SET
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(-3, 9)), min_size=1, max_size=60),
       st.integers(1, 6))
def test_running_totals_equal_python(spark, vals, n):
    rows = [(t, k, v) for k, (t, v) in enumerate(vals)]
    df = spark.createDataFrame(rows, "t long, k long, v long")
    out = {r.k: (r.rn, r.cum_v) for r in ordering.running_totals(df, ["t", "k"], ["v"], n=n, row_number="rn")
           .collect()}
    acc = 0
    for i, (t, k, v) in enumerate(sorted(rows)):
        acc += v
        assert out[k] == (i + 1, acc)


@SET
@given(st.integers(1, 3), st.integers(1, 4), st.integers(1, 4), st.integers(0, 10_000))
def test_explode_pack_roundtrip(spark, c, h, w, seed):
    import random
    rnd = random.Random(seed)
    bands = [[float(rnd.randint(0, 9999)) for _ in range(h * w)] for _ in range(c)]
    mask = [rnd.randint(0, 1) for _ in range(h * w)]
    df = spark.createDataFrame([("p", c, h, w, bands, mask)],
                               "patch_id string, n_bands int, h int, w int, bands array<array<double>>, "
                               "mask array<int>")
    back = patches.pack_patches(patches.explode_patches(df, c), c, h, w).first()
    assert back["bands"] == bands and back["mask"] == mask
    assert F is not None
