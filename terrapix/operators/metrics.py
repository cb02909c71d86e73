"""Classification metrics as aggregations.

Everything after the first aggregation works on tables of at most
(#classes)^2 rows, so one scan of the predictions produces every metric.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapix.operators.ordering import running_totals


def confusion_long(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, count) (F11), ordered by label, prediction (H1)."""
    return (pred.groupBy(F.col(label).cast("double").alias("label"),
                         F.col(prediction).cast("double").alias("prediction"))
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy("label", "prediction"))


def confusion_wide(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                   classes=(0.0, 1.0)) -> DataFrame:
    """One row per label, one count column per predicted class (F12): the
    pivot written as conditional counts in a single aggregation (the class
    list is known, so no distinct pass and no second aggregation stage)."""
    p = pred.select(F.col(label).cast("double").alias("label"),
                    F.col(prediction).cast("double").alias("prediction"))
    return (p.groupBy("label")
            .agg(*[F.count_if(F.col("prediction") == F.lit(float(c))).alias(f"pred_{int(c)}") for c in classes])
            .orderBy("label"))


def _per_class(conf: DataFrame) -> DataFrame:
    """cls, support, predicted, tp from a long confusion table in one pass:
    each (label, prediction, n) row feeds its label's support/tp and its
    prediction's predicted count."""
    e = conf.select(F.explode(F.array(
        F.struct(F.col("label").alias("cls"), F.col("count").alias("support"), F.lit(0).cast("bigint")
                 .alias("predicted"), F.when(F.col("label") == F.col("prediction"), F.col("count"))
                 .otherwise(F.lit(0)).cast("bigint").alias("tp")),
        F.struct(F.col("prediction").alias("cls"), F.lit(0).cast("bigint").alias("support"),
                 F.col("count").cast("bigint").alias("predicted"), F.lit(0).cast("bigint").alias("tp")),
    )).alias("e")).select("e.*")
    return e.groupBy("cls").agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"),
                                F.sum("tp").alias("tp")).where(F.col("support") > 0)


def classification_report(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                          positive: float = 1.0) -> DataFrame:
    """One row: accuracy, positive-class precision/recall, weighted precision,
    recall and F1 (F16, F17). Weighted = by label support; a class never
    predicted has precision 0; F1 is 0 when precision + recall is 0."""
    conf = (pred.groupBy(F.col(label).cast("double").alias("label"),
                         F.col(prediction).cast("double").alias("prediction"))
            .agg(F.count(F.lit(1)).alias("count")))
    return report_from_confusion(conf, positive)


def report_from_confusion(conf: DataFrame, positive: float = 1.0) -> DataFrame:
    """The classification report from a (label, prediction, count) table."""
    pc = _per_class(conf)
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    pc = pc.withColumns({"precision": prec, "recall": rec})
    pc = pc.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                    2 * F.col("precision") * F.col("recall")
                                    / (F.col("precision") + F.col("recall"))).otherwise(0.0))
    tot = F.sum("support").cast("double")
    return pc.agg(
        F.try_divide(F.sum("tp"), tot).alias("accuracy"),
        F.max(F.when(F.col("cls") == positive, F.col("precision"))).alias("precision_pos"),
        F.max(F.when(F.col("cls") == positive, F.col("recall"))).alias("recall_pos"),
        F.try_divide(F.sum(F.col("precision") * F.col("support")), tot).alias("weighted_precision"),
        F.try_divide(F.sum(F.col("recall") * F.col("support")), tot).alias("weighted_recall"),
        F.try_divide(F.sum(F.col("f1") * F.col("support")), tot).alias("f1_weighted"),
    )


def f1_weighted(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return classification_report(pred, label, prediction).select("f1_weighted")


def auc_rank(pred: DataFrame, label: str = "label", score: str = "score",
             n: int | None = None) -> DataFrame:
    """Exact area under the ROC curve (F15), ties counted one half.

    Rows are first reduced to one per distinct score (partial aggregation),
    then the negatives below each score come from distributed running totals.
    """
    per_score = (pred.where(F.col(score).isNotNull())
                 .groupBy(F.col(score).cast("double").alias("s"))
                 .agg(F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("bigint").alias("pos"),
                      F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).cast("bigint").alias("neg")))
    return auc_from_counts(per_score, n)


def auc_from_counts(per_score: DataFrame, n: int | None = None) -> DataFrame:
    """The area from one row for each score ``s`` with its ``pos`` and ``neg``:

    AUC = sum_s pos(s) * (neg(< s) + neg(s)/2) / (P * N) over distinct scores.
    """
    cum = running_totals(per_score, ["s"], ["neg"], n=n)
    contrib = F.col("pos") * (F.col("cum_neg") - F.col("neg") + F.col("neg") / 2.0)
    return cum.agg(
        F.try_divide(F.sum(contrib), F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auc"),
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))


def standardize_fit(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and sample standard deviation per column in one pass."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__m"), F.stddev_samp(c).alias(f"{c}__s")]
    r = df.agg(*aggs).first()
    return {c: (r[f"{c}__m"], r[f"{c}__s"]) for c in cols}


def standardize(df: DataFrame, cols: list[str], stats: dict | None = None, suffix: str = "_z") -> DataFrame:
    """(x - mean) / std with a constant column mapped to 0 (K2)."""
    stats = stats or standardize_fit(df, cols)
    new = {}
    for c in cols:
        m, s = stats[c]
        if m is None or s is None or s == 0:
            new[f"{c}{suffix}"] = F.when(F.col(c).isNotNull(), F.lit(0.0))
        else:
            new[f"{c}{suffix}"] = (F.col(c) - F.lit(m)) / F.lit(s)
    return df.withColumns(new)


def class_weights(df: DataFrame, label: str = "label", threshold: float = 5.0,
                  positive=1, negative=0) -> DataFrame:
    """Per class: rows, positive/negative ratio, imbalance flag and advised
    weight {negative: ratio, positive: 1} when the ratio exceeds the
    threshold, else 1 for both (B22). One aggregation, <= #classes rows, held as
    a local table: what reads the weights does not count the rows again."""
    per = df.groupBy(F.col(label).cast("bigint").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    per = df.sparkSession.createDataFrame(per.collect(), "label bigint, n bigint")
    tot = per.agg(F.sum(F.when(F.col("label") == positive, F.col("n")).otherwise(0)).alias("p"),
                  F.sum(F.when(F.col("label") == negative, F.col("n")).otherwise(0)).alias("q")).first()
    ratio = (tot["p"] / tot["q"]) if tot["q"] else None
    imbalanced = ratio is not None and ratio > threshold
    w = (F.when(F.col("label") == negative, F.lit(float(ratio))).otherwise(F.lit(1.0))
         if imbalanced else F.lit(1.0))
    return per.select("label", "n",
                      F.lit(ratio).cast("double").alias("ratio"),
                      F.lit(imbalanced).alias("imbalanced"), w.alias("weight"))


def with_weight(df: DataFrame, weights: DataFrame, label: str = "label", name: str = "weight") -> DataFrame:
    """Attach the per-class weight column for a weighted fit (K8).

    ``weights`` has one row per class, so it is broadcast."""
    w = weights.select(F.col("label").alias("_wl"), F.col("weight").alias(name))
    return (df.join(F.broadcast(w), F.col(label).cast("bigint") == F.col("_wl"), "left")
            .drop("_wl").fillna(1.0, subset=[name]))
