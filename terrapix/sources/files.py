"""File sources and sinks: parcels, class map, pixels, patches (NPZ and
Parquet), scene catalog, object inventory, one-file samples
(A1-A4, A10-A17, D9, H4)."""

from __future__ import annotations

import io
import os

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrapix.functions.bits16 import decode16, encode16
from terrapix.functions.curve import box_position
from terrapix.functions.geo import bbox_overlap, rings_meet_box
from terrapix.operators.ordering import running_totals
from terrapix.schema import PATCH_SCHEMA, BandSpec


# --- parcels ----------------------------------------------------------------

def read_parcels(spark: SparkSession, path: str, bbox: tuple | None = None, fmt: str | None = None,
                 class_column: str = "EC_hcat_n", exact: bool = False) -> DataFrame:
    """Parcels whose envelope - with ``exact``, whose polygon - meets ``bbox``
    (closed), from Parquet (envelope columns -> row-group pruning) or a
    GeoPackage (R-tree pushdown) (A1, D1)."""
    fmt = fmt or ("gpkg" if path.endswith(".gpkg") else "parquet")
    if fmt == "gpkg":
        from terrapix.sources import gpkg
        gpkg.register(spark)
        df = spark.read.format("gpkg").option("class_column", class_column).load(path)
    else:
        df = spark.read.parquet(path)
    if bbox is not None:
        box = tuple(F.lit(float(v)) for v in bbox)
        df = df.where(bbox_overlap(("xmin", "ymin", "xmax", "ymax"), box))
        if exact:
            df = df.where(rings_meet_box("rings", box))
    return df


def write_parcels(df: DataFrame, path: str, cell: float, mode: str = "overwrite") -> None:
    """Parcels along a space-filling curve (``write_boxes``)."""
    write_boxes(df, path, cell, mode)


def write_boxes(df: DataFrame, path: str, cell: float, mode: str = "overwrite", files: int | None = None) -> None:
    """Rows with a box (xmin, ymin, xmax, ymax) - parcels, scenes - along the Z
    curve of the cells of their lower left corners, so that each file and row
    group covers a compact area and min/max statistics on the envelope columns
    prune box reads in both directions.  Ties on the curve are dealt by the
    whole corner; rows without a box come first."""
    keys = [box_position(cell), F.col("xmin"), F.col("ymin")]
    dealt = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    dealt.sortWithinPartitions(*keys).write.mode(mode).parquet(path)


def peek(df: DataFrame) -> tuple[T.StructType, str | None]:
    """Schema and CRS from one row (A2)."""
    r = df.select("crs").limit(1).collect() if "crs" in df.columns else []
    return df.schema, (r[0][0] if r else None)


# --- class map ------------------------------------------------------------------

def read_class_map(spark: SparkSession, path: str) -> DataFrame:
    """JSON object {class: 0/1} -> (ec_hcat_n, binary_id) rows (A4)."""
    txt = spark.read.text(path, wholetext=True)
    m = F.from_json("value", T.MapType(T.StringType(), T.IntegerType()))
    return txt.select(F.explode(m).alias("ec_hcat_n", "binary_id"))


def class_map_frame(spark: SparkSession, mapping: dict[str, int]) -> DataFrame:
    return spark.createDataFrame(list(mapping.items()), "ec_hcat_n string, binary_id int")


# --- pixels -----------------------------------------------------------------------

def read_pixels(spark: SparkSession, path: str, bands: BandSpec | None = None) -> DataFrame:
    """Pixel table (patch_id, pixel_idx, label, band_k...) (A15); checks that
    the bands the BandSpec needs are present."""
    df = spark.read.parquet(path)
    if bands is not None:
        need = {bands.red, bands.nir, bands.swir, bands.green}
        missing = need - set(df.columns)
        if missing:
            raise ValueError(f"pixel table lacks band columns {sorted(missing)}")
    return df


# --- patches ----------------------------------------------------------------------

def read_patches(spark: SparkSession, path: str) -> DataFrame:
    """Patch table with band-major array columns (A11, A13); raises when a
    column is missing or of another kind. Bands stored as 16-bit integers come
    back as the values written."""
    df = _checked(spark.read.parquet(path), {
        "patch_id": T.StringType, "n_bands": T.IntegralType, "h": T.IntegralType, "w": T.IntegralType, "bands": T.ArrayType}, path)
    if df.schema["bands"].dataType == T.ArrayType(T.ArrayType(T.ShortType())):
        df = df.withColumn("bands", F.transform("bands", lambda b: F.transform(b, lambda v: decode16(v).cast("double"))))
    return df


def read_rasters(spark: SparkSession, path: str) -> DataFrame:
    """Raster table of the worker (A11): a task's bands as arrays."""
    return _checked(spark.read.parquet(path), {"task_id": T.IntegralType, "h": T.IntegralType, "w": T.IntegralType, "bands": T.ArrayType}, path)


def _checked(df: DataFrame, columns: dict, path: str) -> DataFrame:
    kinds = {f.name: f.dataType for f in df.schema}
    wrong = [c for c, kind in columns.items() if not isinstance(kinds.get(c), kind)]
    if wrong:
        raise ValueError(f"{path}: columns missing or of another type: {wrong}")
    return df


def write_patch_archive(patches: DataFrame, path: str, mode: str = "overwrite", bits16: bool = False) -> None:
    """Patches (bands + mask arrays) as compressed Parquet (A13); with
    ``bits16`` the bands as unsigned 16-bit values, each of them checked."""
    if bits16:
        patches = patches.withColumn("bands", F.transform("bands", lambda b: F.transform(b, encode16)))
    patches.write.mode(mode).option("compression", "zstd").parquet(path)


def _npz_rows(it):
    import numpy as np
    for pdf in it:
        out = []
        for p, content in zip(pdf["path"], pdf["content"]):
            z = np.load(io.BytesIO(content))
            b = np.asarray(z["bands"])
            c, h, w = b.shape
            mask = np.asarray(z["mask"]).reshape(-1) if "mask" in z.files else np.zeros(h * w, dtype=np.int32)
            out.append({
                "patch_id": os.path.splitext(os.path.basename(p))[0],
                "n_bands": int(c), "h": int(h), "w": int(w),
                "bands": [b[k].reshape(-1).astype("float64") for k in range(c)],
                "mask": mask.astype("int32"),
            })
        yield pd.DataFrame(out, columns=[f.name for f in PATCH_SCHEMA.fields])


def read_npz_patches(spark: SparkSession, glob: str) -> DataFrame:
    """``.npz`` archives (bands (C,H,W), mask (H,W)) -> patch rows.

    One file = one patch, decoded with numpy inside the task that reads it;
    the files are spread over tasks by the binary file source."""
    files = spark.read.format("binaryFile").load(glob).select("path", "content")
    return files.mapInPandas(_npz_rows, PATCH_SCHEMA)


# --- scenes ---------------------------------------------------------------------

def read_scenes(spark: SparkSession, path: str) -> DataFrame:
    """Scene catalog table: scene_id, scene_ts, cloud_cover, footprint box
    (A10); raises when a column is missing or of another kind."""
    return _checked(spark.read.parquet(path), {
        "scene_id": (T.IntegralType, T.StringType), "scene_ts": (T.TimestampType, T.TimestampNTZType, T.DateType),
        "cloud_cover": T.NumericType, **{c: T.NumericType for c in ("xmin", "ymin", "xmax", "ymax")}}, path)


# --- object inventory / one-file sample -------------------------------------------

def inventory(spark: SparkSession, path: str, suffix: str = ".parquet") -> DataFrame:
    """Objects under ``path`` ending in ``suffix``: path, size, mtime.

    The binary-file source only opens file content when ``content`` is
    selected, so listing reads metadata only; it is not capped at one
    listing page."""
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
          .option("pathGlobFilter", f"*{suffix}").load(path))
    return df.select("path", F.col("length").alias("size_bytes"), "modificationTime")


def inventory_order(inv: DataFrame, root: str) -> DataFrame:
    """The listed objects by path: position (from 1), name below ``root``, size,
    bytes of all objects up to this one (A16, H4). Numbered by value buckets, not
    in one task."""
    # the listing shows whole URIs: what follows the folder's own path is the name
    below = F.substring_index("path", root.rstrip("/").split("://")[-1].split("/", 1)[-1] + "/", -1)
    named = inv.select(below.alias("name"), "size_bytes")
    return (running_totals(named, ["name"], ["size_bytes"], row_number="position")
            .select("position", "name", "size_bytes", F.col("cum_size_bytes").alias("bytes_to_here")))


def inventory_summary(inv: DataFrame) -> DataFrame:
    """count and total size in MB of the listed objects."""
    return inv.agg(F.count(F.lit(1)).alias("n_files"),
                   F.round(F.coalesce(F.sum("size_bytes"), F.lit(0)) / (1024.0 * 1024.0), 3).alias("total_mb"))


def first_files(inv: DataFrame, n: int = 10) -> DataFrame:
    """First n objects by path with their size in MB (H4)."""
    return (inv.orderBy("path").limit(n)
            .select("path", F.round(F.col("size_bytes") / (1024.0 * 1024.0), 1).alias("size_mb")))


def sample_file(spark: SparkSession, path: str, n: int = 5):
    """One file: (rows, columns, first n rows as a DataFrame)."""
    df = spark.read.parquet(path)
    return df.count(), df.columns, df.limit(n)
