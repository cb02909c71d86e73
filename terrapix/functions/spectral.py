"""Band scaling and spectral indices as native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrapix.schema import DEFAULT_BANDS, INDEX_EPS, RAW_INDEX_EPS, REFLECTANCE_SCALE, BandSpec


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def scale(band, factor: float = REFLECTANCE_SCALE) -> Column:
    """Digital number -> reflectance (B1)."""
    return _c(band) / F.lit(float(factor))


def norm_diff(a, b, eps: float = INDEX_EPS) -> Column:
    """Guarded normalised difference (B4): (a-b)/(a+b) when a+b > eps else 0.0.

    A null input makes the guard null, so the ``otherwise`` branch yields 0.0
    (the row is dropped later only because a raw feature is null); NaN passes
    the guard and propagates.
    """
    a, b = _c(a), _c(b)
    s = a + b
    return F.when(s > F.lit(eps), (a - b) / s).otherwise(F.lit(0.0))


def norm_diff_eps(a, b, eps: float = RAW_INDEX_EPS) -> Column:
    """Epsilon form on raw values, no guard (B5): (a-b)/(a+b+eps)."""
    a, b = _c(a).cast("double"), _c(b).cast("double")
    return (a - b) / (a + b + F.lit(eps))


def scale_bands(df: DataFrame, bands: BandSpec = DEFAULT_BANDS,
                factor: float = REFLECTANCE_SCALE, keep: tuple[str, ...] = ("label",)) -> DataFrame:
    """Project the four bands the trainer uses as reflectance."""
    cols = [
        scale(bands.red, factor).alias("red_b4"),
        scale(bands.nir, factor).alias("nir_b8"),
        scale(bands.swir, factor).alias("swir_b11"),
        scale(bands.green, factor).alias("green_b3"),
    ]
    return df.select(*cols, *[F.col(k) for k in keep])


def add_indices(df: DataFrame, which: tuple[str, ...] = ("ndvi",), eps: float = INDEX_EPS) -> DataFrame:
    """NDVI (nir, red), NDWI (green, swir), NDMI (nir, swir) on scaled bands."""
    pairs = {
        "ndvi": ("nir_b8", "red_b4"),
        "ndwi": ("green_b3", "swir_b11"),
        "ndmi": ("nir_b8", "swir_b11"),
    }
    return df.withColumns({k: norm_diff(*pairs[k], eps=eps) for k in which})


def name_bands(df: DataFrame, bands: BandSpec = DEFAULT_BANDS) -> DataFrame:
    """band_k -> physical band name (B3), for the band columns present."""
    present = set(df.columns)
    return df.withColumnsRenamed({f"band_{k}": n for k, n in enumerate(bands.order)
                                  if f"band_{k}" in present})


def band_columns(n: int) -> list[str]:
    """Dynamic band column names band_0..band_{n-1}."""
    return [f"band_{k}" for k in range(n)]
