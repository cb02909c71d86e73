"""MLlib pipeline: assemble -> standardise -> classifier; scoring, metrics,
importances, model persistence (K1-K8, F15, F16, A19).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrapix.operators import forest as binned
from terrapix.operators.features import drop_invalid
from terrapix.operators.metrics import auc_rank


@dataclass(frozen=True)
class ForestParams:
    num_trees: int = 80
    max_depth: int = 12
    subsampling_rate: float = 0.8
    impurity: str = "gini"
    feature_subset: str = "auto"
    seed: int = 42


# the two forest configurations of the original scripts (fixed values)
FOREST_V1 = ForestParams(80, 12, 0.8, "gini", "auto", 42)
FOREST_V2 = ForestParams(100, 10, 1.0, "gini", "sqrt", 42)


def assembler(features, out: str = "features_vec") -> VectorAssembler:
    """Dense feature vector; rows with a null/NaN feature are skipped."""
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="skip")


def scaler(inp: str = "features_vec", out: str = "scaled_features") -> StandardScaler:
    """Mean-centred, unit sample-std features (K2)."""
    return StandardScaler(inputCol=inp, outputCol=out, withMean=True, withStd=True)


def forest(p: ForestParams = FOREST_V1, features: str = "scaled_features",
           label: str = "label", max_memory_mb: int = 1024) -> RandomForestClassifier:
    """Random forest; ``max_memory_mb`` lets one pass over the data grow more
    tree nodes at once (fewer passes; it does not change the model). Rows find
    their node by walking the tree: the same model as with cached node ids, which
    are a number per row and tree, written anew for every group of nodes."""
    return RandomForestClassifier(
        featuresCol=features, labelCol=label, numTrees=p.num_trees, maxDepth=p.max_depth,
        subsamplingRate=p.subsampling_rate, impurity=p.impurity,
        featureSubsetStrategy=p.feature_subset, seed=p.seed, maxMemoryInMB=max_memory_mb,
        cacheNodeIds=False)


def forest_pipeline(features, p: ForestParams = FOREST_V1) -> Pipeline:
    """assembler -> scaler -> random forest (K3, K4)."""
    return Pipeline(stages=[assembler(features), scaler(), forest(p)])


def logistic_pipeline(features, weight: str | None = "weight", max_iter: int = 50,
                      reg: float = 0.0) -> Pipeline:
    """assembler -> scaler -> (class-weighted) logistic regression (K7, K8)."""
    lr = LogisticRegression(featuresCol="scaled_features", labelCol="label", maxIter=max_iter, regParam=reg)
    if weight:
        lr = lr.setWeightCol(weight)
    return Pipeline(stages=[assembler(features), scaler(), lr])


#: least partitions of a training set, and rows from which on there are more;
#: bagging draws per partition, so both are part of the model's definition and
#: never follow the machine
FIT_PARTITIONS, FIT_ROWS = 8, 500_000
#: training rows beyond which forests are grown over binned rows
LARGE_ROWS = 2_000_000


def fit_partitions(rows: int, least: int = FIT_PARTITIONS) -> int:
    """Partitions of a training set: one for each ``FIT_ROWS`` rows."""
    return max(least, -(-rows // FIT_ROWS))


def stable_input(df: DataFrame, key=("patch_id", "pixel_idx"), n: int = FIT_PARTITIONS) -> DataFrame:
    """Training rows in ``n`` partitions by a hash of their key, sorted by key:
    bagging sees the same rows in the same place on every cluster, so equal
    splits give equal forests. Choose ``n`` for the training set
    (``fit_partitions``) and keep it."""
    return df.repartition(n, *key).sortWithinPartitions(*key)


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` computed once for all passes of a fit, and let go after it."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def fit_forest(train: DataFrame, features, p: ForestParams = FOREST_V1, key=("patch_id", "pixel_idx"),
               least: int = FIT_PARTITIONS, large: int = LARGE_ROWS) -> PipelineModel:
    """The forest pipeline fitted on ``stable_input`` of the training rows. The rows
    are computed once (numbers of a row only), then dealt and kept for the fit. With
    more than ``large`` rows the forest is grown by ``forest.grow``: all rows, trees
    and levels as by MLlib, from other random draws."""
    with kept(train.select(*key, "label", *features)) as rows:
        n = fit_partitions(rows.count(), least)
        dealt = stable_input(rows, key, n).persist(StorageLevel.MEMORY_AND_DISK)
        valid = drop_invalid(dealt, features).agg(
            F.count("label").alias("n"), F.max("label").alias("top"),
            F.min(F.col("label").isNotNull() & (F.col("label") >= 0) & (F.col("label") == F.floor("label"))).alias("whole")).first()
    try:
        est = forest(p)
        if valid["n"] <= large or not (valid["whole"] and valid["top"] < 100 and binned.grows(est)):
            return forest_pipeline(features, p).fit(dealt)
        pre = Pipeline(stages=[assembler(features), scaler()]).fit(dealt)
        std = pre.stages[-1]
        model = binned.grow(dealt, features, std.mean.toArray(), std.std.toArray(), valid["n"], max(2, int(valid["top"]) + 1), est)
        return PipelineModel(stages=[*pre.stages, model])
    finally:
        dealt.unpersist()


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Predictions plus a plain double ``p1`` (probability of class 1) (K5)."""
    p = model.transform(df)
    return p.withColumn("p1", vector_to_array("probability")[1])


def evaluate(pred: DataFrame, label: str = "label", f1: bool = True) -> dict:
    """Exact AUC of ``p1`` (ties one half) and weighted F1 (F15, F16). ``pred``
    should be persisted by the caller: each is one pass."""
    out = {"auc": auc_rank(pred, label, "p1").first()["auc"]}
    if f1:
        out["f1"] = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction",
                                                      metricName="f1").evaluate(pred)
    return out


def importances(model: PipelineModel, features) -> DataFrame:
    """Feature importance table, ascending (K6, H2)."""
    spark = SparkSession.getActiveSession()
    imp = model.stages[-1].featureImportances
    rows = [(f, float(imp[i])) for i, f in enumerate(features)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy("importance")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def write_report_csv(df: DataFrame, path: str) -> None:
    """Result-sized report (confusion, importances) as one CSV part."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def collect_sample(df: DataFrame, n: int = 100_000, seed: int = 42):
    """Bounded pandas sample for plotting."""
    from terrapix.operators.sampling import sample_n
    return sample_n(df, n, seed).toPandas()
