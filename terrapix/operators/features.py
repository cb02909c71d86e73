"""Pixel rows -> feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapix.functions.spectral import add_indices, norm_diff_eps, scale_bands
from terrapix.schema import DEFAULT_BANDS, BandSpec

FEATURES_V1 = ("red_b4", "nir_b8", "swir_b11", "ndvi")
FEATURES_V2 = ("red_b4", "nir_b8", "swir_b11", "ndvi", "ndwi", "ndmi")


def pixel_features(pixels: DataFrame, bands: BandSpec = DEFAULT_BANDS,
                   indices: tuple[str, ...] = ("ndvi",),
                   labels: tuple[int, ...] | None = (0, 1),
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """Scaled bands + label (float) + guarded indices.

    The label filter runs on the raw integer column, before the cast, so it
    reaches the Parquet scan as a pushed filter.
    """
    df = pixels
    if labels is not None:
        df = df.where(F.col("label").isin(*labels))
    df = scale_bands(df, bands, keep=("label", *keep))
    df = df.withColumn("label", F.col("label").cast("float"))
    return add_indices(df, indices)


def raw_eps_indices(pixels: DataFrame, bands: BandSpec = DEFAULT_BANDS) -> DataFrame:
    """NDVI/NDWI with an additive epsilon on raw digital numbers."""
    return pixels.select(
        "patch_id", "pixel_idx",
        norm_diff_eps(bands.nir, bands.red).alias("ndvi_raw"),
        norm_diff_eps(bands.green, bands.swir).alias("ndwi_raw"))


def drop_invalid(df: DataFrame, cols) -> DataFrame:
    """Drop rows where any feature is null or NaN (D8, the assembler's 'skip').

    Written as ``nanvl(c, NULL) IS NOT NULL`` (NaN -> null, then one null
    test): the same rows as ``isNotNull & ~isnan``, but it stays cheap after
    Catalyst inlines the feature expressions into the pushed-down filter."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).isNotNull()
    return df.where(cond)


def threshold_predict(df: DataFrame, score: str = "ndvi", threshold: float = 0.2) -> DataFrame:
    """Baseline classifier: prediction = score > threshold (as 0.0/1.0)."""
    return df.withColumns({
        "score": F.col(score).cast("double"),
        "prediction": (F.col(score) > F.lit(threshold)).cast("double"),
    })
