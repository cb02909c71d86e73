"""Training job: pixels -> features -> balanced sample -> split -> fit ->
one scored frame -> every metric (section 3.3 of the blueprint).

Differences from a naive script: the label filter reaches the Parquet scan
(it runs before the cast); class balancing and the split are key-hash
filters (reproducible, no extra shuffles, train/test disjoint); the
balanced frame is persisted once instead of being rescanned per action; the
predictions are persisted once and all metrics read that copy.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from terrapix.operators import features as feat
from terrapix.operators import metrics, ml, sampling
from terrapix.schema import DEFAULT_BANDS, BandSpec

KEY = ("patch_id", "pixel_idx")


@dataclass
class TrainingResult:
    timings: dict = field(default_factory=dict)
    counts: dict = field(default_factory=dict)
    metrics: dict = field(default_factory=dict)
    confusion: list = field(default_factory=list)
    importances: list = field(default_factory=list)
    model: object = None


def balanced_features(pixels: DataFrame, bands: BandSpec = DEFAULT_BANDS,
                      fractions: dict | None = None, seed: int = 42,
                      features=feat.FEATURES_V1) -> DataFrame:
    idx = tuple(f for f in ("ndvi", "ndwi", "ndmi") if f in features) or ("ndvi",)
    f = feat.pixel_features(pixels, bands, indices=idx, keep=KEY)
    return sampling.stratified_sample(f, fractions or {1: 0.1, 0: 0.025}, seed)


def train_and_evaluate(pixels: DataFrame, bands: BandSpec = DEFAULT_BANDS, fractions: dict | None = None,
                       seed: int = 42, forest: ml.ForestParams = ml.FOREST_V1,
                       features=feat.FEATURES_V1, train_fraction: float = 0.8,
                       partitions: int = ml.FIT_PARTITIONS) -> TrainingResult:
    res = TrainingResult()
    t = time.time()
    bal = balanced_features(pixels, bands, fractions, seed, features).persist(StorageLevel.MEMORY_AND_DISK)
    per_class = {int(r["label"]): r["count"] for r in bal.groupBy("label").count().collect()}
    res.counts["balanced"] = per_class
    res.timings["balance"] = time.time() - t

    t = time.time()
    train, test = sampling.hash_split(bal, [train_fraction, 1 - train_fraction], seed)
    model = ml.fit_forest(train, features, forest, KEY, partitions)
    res.model = model
    res.timings["train"] = time.time() - t

    t = time.time()
    pred = ml.score(model, test).select("label", "prediction", "rawPrediction", "p1").persist(
        StorageLevel.MEMORY_AND_DISK)
    res.metrics.update(ml.evaluate(pred, f1=False))
    # one aggregation of the predictions; every other metric reads that table
    conf_rows = metrics.confusion_long(pred).collect()
    res.confusion = [tuple(r) for r in conf_rows]
    conf = pred.sparkSession.createDataFrame(conf_rows, "label double, prediction double, count long")
    rep = metrics.report_from_confusion(conf).first().asDict()
    res.metrics.update({k: rep[k] for k in ("accuracy", "f1_weighted", "weighted_precision", "weighted_recall")})
    res.metrics["f1"] = rep["f1_weighted"]
    res.timings["evaluate"] = time.time() - t
    res.importances = [tuple(r) for r in ml.importances(model, features).collect()]
    pred.unpersist()
    bal.unpersist()
    return res
