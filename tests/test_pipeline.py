"""Plans end to end: training job, model persistence, reports, pixel table."""

import os

import pytest
from pyspark.sql import functions as F

from terrapix.functions.dates import parse_interval
from terrapix.functions.spectral import name_bands
from terrapix.operators import ml
from terrapix.operators import patches as pt
from terrapix.plans import patch_production as pp
from terrapix.plans.training import train_and_evaluate
from terrapix.sources import derived
from tests.conftest import SF_SMALL


def test_training_job_small_forest(spark):
    res = train_and_evaluate(derived.pixels(spark, SF_SMALL), forest=ml.ForestParams(5, 4, 0.8, "gini", "auto", 42))
    assert set(res.counts["balanced"]) == {0, 1}
    assert 0.0 <= res.metrics["auc"] <= 1.0 and 0.0 <= res.metrics["f1_weighted"] <= 1.0
    assert sum(n for _, _, n in res.confusion) > 0
    imps = [v for _, v in res.importances]
    assert imps == sorted(imps) and sum(imps) == pytest.approx(1.0)


def test_training_is_reproducible(spark):
    p = ml.ForestParams(3, 3, 0.8, "gini", "auto", 42)
    a = train_and_evaluate(derived.pixels(spark, SF_SMALL), forest=p)
    b = train_and_evaluate(derived.pixels(spark, SF_SMALL).repartition(5), forest=p)
    assert a.confusion == b.confusion and a.importances == b.importances


def test_model_save_load_and_reports(spark, tmp_dir):
    from terrapix.operators import features as feat
    f = feat.pixel_features(derived.pixels(spark, SF_SMALL), keep=("patch_id", "pixel_idx"))
    model = ml.forest_pipeline(feat.FEATURES_V1, ml.ForestParams(3, 3, 1.0, "gini", "auto", 1)).fit(f)
    path = os.path.join(tmp_dir, "model")
    ml.save_model(model, path)
    again = ml.load_model(path)
    a = ml.score(model, f).select("prediction").collect()
    b = ml.score(again, f).select("prediction").collect()
    assert a == b
    ml.write_report_csv(ml.importances(model, feat.FEATURES_V1), os.path.join(tmp_dir, "imp"))
    back = spark.read.option("header", True).csv(os.path.join(tmp_dir, "imp"))
    assert back.count() == 4 and back.columns == ["feature", "importance"]
    pdf = ml.collect_sample(f, 100)
    assert 0 < len(pdf) < 300


def test_pixel_rows_and_write(spark, tmp_dir):
    results = spark.createDataFrame([(1, "w", "success"), (2, "w", "failed_empty_mask")],
                                    "task_id long, worker_id string, status string")
    bands = [[float(c * 10 + p) for p in range(4)] for c in range(3)]
    rasters = spark.createDataFrame([(1, 3, 2, 2, bands), (2, 3, 2, 2, bands)],
                                    "task_id long, n_bands int, h int, w int, bands array<array<double>>")
    mask = spark.createDataFrame([(1, 0, 1), (1, 3, 0)], "task_id long, pixel_idx long, label long")
    px = pp.pixel_rows(results, rasters, mask, 3)
    rows = {r.pixel_idx: r for r in px.collect()}
    assert len(rows) == 4 and rows[0].label == 1 and rows[1].label == 0 and rows[2].band_2 == 22.0
    assert rows[0].patch_id == "task_1_worker_w"
    out = os.path.join(tmp_dir, "pixels")
    pp.write_pixels(px, out, buckets=4)
    pp.write_pixels(px, out, buckets=4)  # a replay replaces its batch
    back = spark.read.parquet(out)
    assert back.count() == 4 and "task_bucket" in back.columns


def test_fill_missing_and_name_bands(spark):
    df = spark.createDataFrame([("a", 1, 1, 2, [[1.0, None]], [0, 1])],
                               "patch_id string, n_bands int, h int, w int, bands array<array<double>>, "
                               "mask array<int>")
    assert pt.fill_missing(df).first().bands == [[1.0, 0.0]]
    named = name_bands(spark.createDataFrame([(1, 2, 3)], "band_0 int, band_2 int, band_4 int"))
    assert named.columns == ["blue", "nir", "red"]


def test_parse_interval(spark):
    import datetime as dt
    r = spark.createDataFrame([("2023-04-15/2023-06-15",)], "s string").select(parse_interval("s").alias("w")).first()
    assert (r.w.d0, r.w.d1) == (dt.date(2023, 4, 15), dt.date(2023, 6, 16))
    assert F is not None


def test_label_filter_reaches_parquet_scan(spark, tmp_dir):
    """The label filter runs on the raw integer column before the cast, so it
    is a pushed Parquet filter; only the needed columns are read."""
    import io
    from contextlib import redirect_stdout

    from terrapix.operators import features as feat
    from terrapix.sources import files
    path = os.path.join(tmp_dir, "pixels")
    derived.pixels(spark, SF_SMALL).write.parquet(path)
    px = files.read_pixels(spark, path)
    f = feat.drop_invalid(feat.pixel_features(px), feat.FEATURES_V1)
    buf = io.StringIO()
    with redirect_stdout(buf):
        f.explain("formatted")
    plan = buf.getvalue()
    assert "In(label, [0,1])" in plan or "In(label, [0, 1])" in plan
    assert "ReadSchema: struct<band_1:bigint,band_2:bigint,band_4:bigint,band_8:bigint,label:bigint>" in plan


def test_report_f1_equals_mllib_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    from terrapix.operators import metrics
    rows = [(1.0, 1.0)] * 7 + [(1.0, 0.0)] * 3 + [(0.0, 0.0)] * 5 + [(0.0, 1.0)] * 4 + [(2.0, 0.0)] * 2
    df = spark.createDataFrame(rows, "label double, prediction double")
    ours = metrics.classification_report(df).first()
    mllib = MulticlassClassificationEvaluator(metricName="f1").evaluate(df)
    acc = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(df)
    assert ours.f1_weighted == pytest.approx(mllib) and ours.accuracy == pytest.approx(acc)
