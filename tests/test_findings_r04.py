"""Steps that the review of round 4 found to outgrow their limits."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import functions as F

from terrapix.operators import forest, ml, sampling

FEATURES = list("abcde")
SCORES = ["id", "rawPrediction", "probability", "prediction"]


@pytest.fixture(scope="module")
def rows(spark):
    """6000 rows in three partitions: one feature of few values, one of many zeros, some NaN and null."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(6000, 5))
    x[:, 1] = np.round(x[:, 1])
    x[rng.random(6000) < 0.1, 2] = 0
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=6000) * 0.7 > 0).astype(float)
    x[:20, 3] = np.nan
    data = [(k, *(None if k < 5 and c == 4 else float(v) for c, v in enumerate(r)), float(t)) for k, (r, t) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(data, "id long, a double, b double, c double, d double, e double, label double").repartition(3, "id").cache()


def grown(rows, est, **more):
    pre = Pipeline(stages=[ml.assembler(FEATURES), ml.scaler()]).fit(rows)
    s = pre.stages[-1]
    return pre.transform(rows), forest.grow(rows, FEATURES, s.mean.toArray(), s.std.toArray(), 5980, 2, est, **more)


@pytest.mark.parametrize("depth", [1, 6, 12])
def test_tree_without_draws_is_mllibs(rows, depth):
    est = RandomForestClassifier(featuresCol="scaled_features", numTrees=1, maxDepth=depth, featureSubsetStrategy="all", seed=42, bootstrap=False)
    scaled, model = grown(rows, est, bagged=False)
    same = est.fit(scaled)
    assert model.toDebugString.split("\n", 1)[1] == same.toDebugString.split("\n", 1)[1]
    assert model.featureImportances == same.featureImportances


def test_grown_forest_scores_as_mllib_does_with_its_nodes(rows, tmp_dir):
    est = ml.forest(ml.ForestParams(20, 8, 1.0, "gini", "sqrt", 42))
    scaled, model = grown(rows, est)
    model.write().overwrite().save(f"{tmp_dir}/m")
    loaded = RandomForestClassificationModel.load(f"{tmp_dir}/m")
    a, b = model.transform(scaled).select(SCORES), loaded.transform(scaled).select(SCORES)
    assert a.schema.simpleString() == b.schema.simpleString()
    assert a.count() == 5980 and a.exceptAll(b).isEmpty()
    def right(m):
        return m.transform(scaled).agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0]
    assert abs(right(model) - right(est.fit(scaled))) < 0.02
    assert model.getNumTrees == 20 and len({t.toDebugString.split("\n", 1)[1] for t in model.trees}) == 20


def test_large_training_sets_are_not_bagged_by_mllib(rows, monkeypatch):
    calls = []
    monkeypatch.setattr(ml.binned, "grow", lambda *a, f=forest.grow: calls.append(a[4:6]) or f(*a))
    p = ml.ForestParams(5, 4)
    large = ml.fit_forest(rows, FEATURES, p, ["id"], least=3, large=5979)
    assert calls == [(5980, 2)] and isinstance(large.stages[-1], forest.GrownForestModel)
    again = ml.fit_forest(rows, FEATURES, p, ["id"], least=3, large=5979)
    assert large.stages[-1].toDebugString.split("\n", 1)[1] == again.stages[-1].toDebugString.split("\n", 1)[1]
    calls.clear()
    small = ml.fit_forest(rows, FEATURES, p, ["id"], least=3, large=5980)
    assert not calls and type(small.stages[-1]) is RandomForestClassificationModel
    assert ml.score(large, rows).where("p1 BETWEEN 0 AND 1 AND prediction = CAST(p1 > 0.5 AS double)").count() == 5980


def test_counts_hold_every_row_whatever_the_blocks(rows, monkeypatch):
    est = ml.forest(ml.ForestParams(4, 6, 1.0, "gini", "sqrt", 42))
    _, whole = grown(rows, est)
    monkeypatch.setattr(forest, "TASK_BYTES", 1)  # one tree a pass
    _, single = grown(rows, est)
    assert whole.toDebugString.split("\n", 1)[1] == single.toDebugString.split("\n", 1)[1]


def test_draws_are_poisson():
    steps = forest.poisson_steps(0.8)
    idx, weight = forest.drawn(steps, [42, 0, 0, 0], 1 << 17)
    w = np.zeros(1 << 17)
    w[idx] = weight
    assert weight.min() == 1 and abs(w.mean() - 0.8) < 0.01 and abs(w.var() - 0.8) < 0.02
    assert abs((w == 0).mean() - np.exp(-0.8)) < 0.01


def test_classes_kept_whole_need_no_number(spark):
    df = spark.createDataFrame([(f"p{k % 3}", k, label) for k, label in enumerate([1, 0, 0, 0, None] * 40)], "patch_id string, pixel_idx long, label int")
    out = {r[0]: r[1] for r in sampling.stratified_sample(df, {1: 1.0, 0: 0.5}).groupBy("label").count().collect()}
    assert out[1] == 40 and 0 < out[0] < 120 and None not in out
    tagged = sampling.balance_tagged(df.where("label is not null"))
    assert [x.count() for x in sampling.balance_split(df.where("label is not null"))] == [tagged.where(F.col("_split") == s).count() for s in ("train", "test")]
