"""Reproducible sampling and splitting by key hash.

Rows are kept or assigned by ``u(key, salt)`` (terrapix.functions.hashing),
a pure function of the row's key. Results therefore do not depend on the
physical partitioning, survive executor loss and recomputation unchanged,
and every decision is a filter inside the scan stage (no shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrapix.functions.hashing import sample_salt, split_salt, uniform

DEFAULT_KEY = ("patch_id", "pixel_idx")


def _fraction_expr(label: str, fractions: dict) -> Column:
    e = None
    for k, v in fractions.items():
        cond = F.col(label) == F.lit(k)
        e = F.when(cond, F.lit(float(v))) if e is None else e.when(cond, F.lit(float(v)))
    return e.otherwise(F.lit(0.0)) if e is not None else F.lit(0.0)


def stratified_sample(df: DataFrame, fractions: dict, seed: int = 42, label: str = "label",
                      key=DEFAULT_KEY, salt: str | None = None) -> DataFrame:
    """Keep each row with probability ``fractions[label]``.

    One scan for all classes, so the per-class union (I1) is implicit. Classes kept
    whole need no number of their rows."""
    s = sample_salt(seed) if salt is None else salt
    share = _fraction_expr(label, fractions)
    return df.where((share >= 1.0) | (uniform(*key, salt=s) < share))


def sample_fraction(df: DataFrame, fraction: float, seed: int = 42, key=DEFAULT_KEY,
                    salt: str | None = None) -> DataFrame:
    s = f"f{seed}" if salt is None else salt
    return df.where(uniform(*key, salt=s) < F.lit(min(1.0, max(0.0, float(fraction)))))


def sample_n(df: DataFrame, n: int, seed: int = 42, key=DEFAULT_KEY) -> DataFrame:
    """About ``n`` rows: fraction = min(1, n / count) (J2). Needs one count."""
    total = df.count()
    frac = 1.0 if total == 0 else min(1.0, n / total)
    return df.where(uniform(*key, salt=f"n{seed}") < F.lit(frac))


def exact_sample(df: DataFrame, n: int, seed: int = 42, key=DEFAULT_KEY) -> DataFrame:
    """Exactly min(n, count) rows: the n smallest hash numbers.

    Planned as a top-n (per-partition top-n, then a merge of n-row lists)."""
    u = uniform(*key, salt=f"x{seed}").alias("_u")
    return (df.select("*", u).orderBy("_u", *key).limit(n).drop("_u"))


def hash_split(df: DataFrame, weights=(0.8, 0.2), seed: int = 42, key=DEFAULT_KEY) -> list[DataFrame]:
    """Disjoint, complete split by hash intervals (J4); weights are normalised."""
    tot = float(sum(weights))
    bounds, acc = [], 0.0
    for w in weights:
        lo = acc
        acc += w / tot
        bounds.append((lo, acc))
    u = uniform(*key, salt=split_salt(seed))
    out = []
    for i, (lo, hi) in enumerate(bounds):
        cond = u >= F.lit(lo)
        if i < len(bounds) - 1:
            cond = cond & (u < F.lit(hi))
        out.append(df.where(cond))
    return out


def split_column(df: DataFrame, train_fraction: float = 0.8, seed: int = 42, key=DEFAULT_KEY,
                 name: str = "split") -> DataFrame:
    """Tag rows 'train' / 'test' with the same rule as ``hash_split``."""
    u = uniform(*key, salt=split_salt(seed))
    return df.withColumn(name, F.when(u < F.lit(float(train_fraction)), "train").otherwise("test"))


def balance_fractions(df: DataFrame, label: str = "label") -> dict:
    """Per-class fraction that brings every class down to the smallest (Q10-safe).

    One aggregation; the result has one row per class."""
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}
    if not counts:
        return {}
    smallest = min(counts.values())
    return {k: min(1.0, smallest / v) for k, v in counts.items()}


def balance_tagged(df: DataFrame, seed: int = 42, train_fraction: float = 0.8, label: str = "label",
                   key=DEFAULT_KEY) -> DataFrame:
    """The rows of ``balance_split`` in one frame, tagged 'train' / 'test' in ``_split``."""
    fr = balance_fractions(df, label)
    return split_column(stratified_sample(df, fr, seed, label, key), train_fraction, seed, key, "_split")


def balance_split(df: DataFrame, seed: int = 42, train_fraction: float = 0.8, label: str = "label",
                  key=DEFAULT_KEY) -> tuple[DataFrame, DataFrame]:
    """All rows of the smallest class, the others sampled to match, then an
    80/20 split per class with an independent salt: train and test are
    disjoint by construction (J5, fixes the shared-seed leak)."""
    tagged = balance_tagged(df, seed, train_fraction, label, key)
    return (tagged.where(F.col("_split") == "train").drop("_split"),
            tagged.where(F.col("_split") == "test").drop("_split"))
