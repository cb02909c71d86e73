"""Dataset profiles: class shares, band statistics, index ranges, histograms
(F4-F8, F13, F14), as partial aggregations."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrapix.functions.status import label_name
from terrapix.operators.ordering import running_totals


def class_share(pixels: DataFrame, label: str = "label", positive: int = 1) -> DataFrame:
    """Rows, positive rows, positive %, label mean: one job."""
    n = F.count(F.lit(1))
    pos = F.count_if(F.col(label) == positive)
    return pixels.agg(
        n.alias("n_rows"), pos.alias("n_crop"),
        F.round(F.try_divide(pos.cast("double"), n.cast("double")) * 100.0, 6).alias("crop_pct"),
        F.round(F.avg(F.col(label).cast("double")), 6).alias("label_mean"))


def class_counts(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows per label with share of all rows and label name."""
    per = df.groupBy(F.col(label).cast("bigint").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = Window.partitionBy()  # over <= #labels rows
    return (per.withColumn("pct", F.round(F.col("n") * 100.0 / F.sum("n").over(total), 6))
            .withColumn("label_name", label_name("label")))


def class_usage(full: DataFrame, sample: DataFrame, label: str = "label") -> DataFrame:
    """Per label: rows available, rows kept, % of the class used."""
    a = full.groupBy(F.col(label).cast("bigint").alias("label")).agg(F.count(F.lit(1)).alias("n_total"))
    b = sample.groupBy(F.col(label).cast("bigint").alias("label")).agg(F.count(F.lit(1)).alias("n_used"))
    return (a.join(b, "label", "left").fillna(0, subset=["n_used"])
            .withColumn("pct_used", F.round(F.col("n_used") * 100.0 / F.col("n_total"), 6)))


def unpivot(df: DataFrame, cols: list[str], name: str = "band", value: str = "value") -> DataFrame:
    """Wide columns -> (name, value) rows, value as double (``stack``)."""
    return df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], cols, name, value)


def describe_columns(df: DataFrame, cols: list[str], name: str = "feature") -> DataFrame:
    """Typed ``describe()``: count/mean/stddev/min/max per column.

    NaN and null are not counted (pandas semantics)."""
    long = unpivot(df, cols, name, "value").where(F.col("value").isNotNull() & ~F.isnan("value"))
    return long.groupBy(name).agg(
        F.count("value").alias("count"),
        F.round(F.avg("value"), 6).alias("mean"),
        F.round(F.stddev_samp("value"), 6).alias("stddev"),
        F.min("value").alias("min"), F.max("value").alias("max"))


def profile_columns(df: DataFrame, cols: list[str], name: str = "band",
                    quantiles=(0.25, 0.5, 0.75)) -> DataFrame:
    """count/mean/std/min/quartiles/max per column, quantiles exact with linear
    interpolation (pandas ``describe``) (F6).

    One aggregation: ``percentile`` keeps one counter per distinct value, and
    band values are 16-bit numbers, so a column's state has at most 65,536
    entries whatever the number of rows. For columns without such a bound use
    ``exact_quantiles``."""
    long = unpivot(df, cols, name, "value").where(F.col("value").isNotNull() & ~F.isnan("value"))
    out = long.groupBy(name).agg(
        F.count("value").alias("count"),
        F.round(F.avg("value"), 6).alias("mean"),
        F.round(F.stddev_samp("value"), 6).alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
        F.percentile("value", [float(q) for q in quantiles]).alias("_q"))
    return out.select(name, "count", "mean", "std", "min",
                      *[F.round(F.col("_q")[k], 6).alias(f"q{int(round(q * 100))}") for k, q in enumerate(quantiles)], "max")


def exact_quantiles(df: DataFrame, col: str, quantiles=(0.25, 0.5, 0.75)) -> DataFrame:
    """Exact quantiles (linear interpolation) of a column with any number of
    distinct values: counts per value, running counts in value order over
    range buckets, and the values around each position."""
    vc = df.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("double").alias("value")).agg(F.count(F.lit(1)).alias("c"))
    cum = running_totals(vc, ["value"], ["c"])
    n = vc.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n")).first()["n"]
    hi, lo = F.col("cum_c"), F.col("cum_c") - F.col("c")
    aggs, out = [], []
    for k, q in enumerate(quantiles):
        pos = max(n - 1, 0) * float(q)
        k0, k1 = math.floor(pos), math.ceil(pos)
        aggs += [F.max(F.when((lo <= k0) & (hi > k0), F.col("value"))).alias(f"_a{k}"),
                 F.max(F.when((lo <= k1) & (hi > k1), F.col("value"))).alias(f"_b{k}")]
        out.append((F.col(f"_a{k}") + F.lit(pos - k0) * (F.col(f"_b{k}") - F.col(f"_a{k}"))).alias(f"q{int(round(q * 100))}"))
    return cum.agg(*aggs).select(*out)


def value_range(df: DataFrame, cols: list[str]) -> DataFrame:
    """min/max of each column in one pass (F8)."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    return df.agg(*aggs)


def _bounds(df: DataFrame, col: str) -> tuple[float, float]:
    r = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    return r["lo"], r["hi"]


def _bin(col: str, lo: float, hi: float, bins: int):
    if lo is None or hi is None or hi <= lo:
        return F.lit(0).cast("int")
    width = (hi - lo) / bins
    return F.least(F.floor((F.col(col) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, col: str, by: str = "label", bins: int = 50) -> DataFrame:
    """Equal-width histogram on the common [min, max] range, per class; last bin
    closed on the right (F13). One min/max pass, one counting pass."""
    lo, hi = _bounds(df, col)
    width = ((hi - lo) / bins) if (lo is not None and hi is not None and hi > lo) else 0.0
    b = _bin(col, lo, hi, bins)
    return (df.where(F.col(col).isNotNull())
            .groupBy(F.col(by).cast("double").alias(by), b.alias("bin"))
            .agg(F.count(F.lit(1)).alias("count"))
            .withColumn("bin_lo", F.round(F.lit(lo if lo is not None else 0.0) + F.col("bin") * F.lit(width), 6)))


def density_2d(df: DataFrame, x: str, y: str, by: str = "label", bins: int = 20) -> DataFrame:
    """2-D equal-width bin counts per class over the full data."""
    r = df.agg(F.min(x), F.max(x), F.min(y), F.max(y)).first()
    xlo, xhi, ylo, yhi = r
    return (df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
            .groupBy(F.col(by).cast("double").alias(by),
                     _bin(x, xlo, xhi, bins).alias("x_bin"), _bin(y, ylo, yhi, bins).alias("y_bin"))
            .agg(F.count(F.lit(1)).alias("count")))


def profile_bands(pixels: DataFrame, bands: list[str] | None = None) -> DataFrame:
    """F6 on the pixel table's band columns (all ``band_k`` by default)."""
    cols = bands or [c for c in pixels.columns if c.startswith("band_")]
    return profile_columns(pixels, cols, "band")
