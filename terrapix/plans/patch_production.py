"""Patch production for a set of task messages (the worker's job, batch form).

tasks (one row per task id, whatever the bus repeats) -> parcels meeting each
bbox (range join) -> polygon thresholds and class mapping -> best scene ->
projected raster grid -> rasterised mask -> raster and mask checks -> one result
per task; pixel rows of the successful ones from a raster table.

The streaming loop (terrapix.streaming.patch_stream) calls ``produce`` on
every micro-batch, so batch and stream share one implementation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrapix.functions.geo import to_utm
from terrapix.operators import patches as pt
from terrapix.operators import scenes as sc
from terrapix.operators.spatial import BOX, box_join, prefixed
from terrapix.schema import MIN_POLYGONS_PATCH, REQUESTED_BANDS, STATUS_FAILED, STATUS_SUCCESS, SearchWindow
from terrapix.session import checkpoint_dir


def one_per_task(tasks: DataFrame) -> DataFrame:
    """One row per task id with its box. The bus delivers at least once, so a
    message may come again: the latest by topic time and offset wins when these
    are known, else the largest box - the same row whatever the partitioning."""
    if "bbox" in tasks.columns:
        box = [F.get(F.col("bbox"), F.lit(k)).alias(c) for k, c in enumerate(BOX)]
        extra = F.coalesce(F.size("bbox") == 4, F.lit(False)).alias("_four")
    else:
        box, extra = [F.col(c) for c in BOX], F.lit(True).alias("_four")
    order = [c for c in ("ts", "_partition", "_offset") if c in tasks.columns]
    best = F.max(F.struct(*[F.col(c).alias(f"_o_{c}") for c in order], extra, *box)).alias("_b")
    return tasks.groupBy("task_id").agg(best).select("task_id", F.col("_b._four").alias("_four"), *[F.col(f"_b.{c}").alias(c) for c in BOX])


def box_error() -> Column:
    """Why a task's box cannot be used, null when it can."""
    x0, y0, x1, y1 = (F.col(c) for c in BOX)
    return (F.when(F.col("task_id").isNull(), "task without id")
            .when(~F.col("_four"), "bbox must have four numbers")
            .when(x0.isNull() | y0.isNull() | x1.isNull() | y1.isNull(), "bbox has a missing corner")
            .when(F.isnan(x0) | F.isnan(y0) | F.isnan(x1) | F.isnan(y1), "bbox has a corner that is no number")
            .when((x0 >= x1) | (y0 >= y1), "bbox is inverted or empty"))


def task_boxes(tasks: DataFrame) -> DataFrame:
    """task_id + xmin..ymax from the message's bbox array."""
    if "bbox" in tasks.columns:
        return tasks.select("task_id", *[F.col("bbox")[k].alias(c) for k, c in enumerate(BOX)])
    return tasks.select("task_id", *BOX)


def project_box(df: DataFrame, zone: int) -> DataFrame:
    """xmin..ymax in degrees -> the UTM envelope of the box's corners."""
    corners = [to_utm(F.col(x), F.col(y), zone) for x in ("xmin", "xmax") for y in ("ymin", "ymax")]
    xs, ys = [c[0] for c in corners], [c[1] for c in corners]
    return df.withColumns({"_x0": F.least(*xs), "_y0": F.least(*ys), "_x1": F.greatest(*xs), "_y1": F.greatest(*ys)}) \
        .drop(*BOX).withColumnsRenamed(dict(zip(("_x0", "_y0", "_x1", "_y1"), BOX)))


def project_rings(df: DataFrame, zone: int) -> DataFrame:
    """Every ring point to UTM metres, the envelope from the points."""
    def point(p):
        e, n = to_utm(p["x"], p["y"], zone)
        return F.struct(e.alias("x"), n.alias("y"))
    df = df.withColumn("rings", F.transform("rings", lambda r: F.transform(r, point)))
    flat = F.flatten("rings")
    xs, ys = F.transform(flat, lambda p: p["x"]), F.transform(flat, lambda p: p["y"])
    return df.withColumns({"xmin": F.array_min(xs), "ymin": F.array_min(ys), "xmax": F.array_max(xs), "ymax": F.array_max(ys)})


def task_parcels(tasks: DataFrame, parcels: DataFrame, coarse: float, also: tuple[str, ...] = ()) -> DataFrame:
    """(task, parcel) pairs whose boxes meet (closed edges) (E3, D1), with the
    columns ``also`` of the task."""
    keep = [c for c in ("parcel_id", "binary_id", "rings") if c in parcels.columns]
    t = prefixed(tasks.select("task_id", *BOX, *also) if also else task_boxes(tasks), "t_")
    p = prefixed(parcels.select(*keep, *BOX), "p_")
    pairs = box_join(t, p, coarse, "t_", "p_")
    return pairs.select("task_id", *also, *keep, *[F.col(f"p_{c}").alias(c) for c in BOX])


def polygon_counts(tasks: DataFrame, pairs: DataFrame) -> DataFrame:
    """n_raw (before mapping), polygon_count (mapped), crop/non-crop polygons (F2)."""
    c = pairs.groupBy("task_id").agg(
        F.count(F.lit(1)).alias("n_raw"), F.count("binary_id").alias("polygon_count"),
        F.count_if(F.col("binary_id") == 1).alias("crop_polys"),
        F.count_if(F.col("binary_id") == 0).alias("noncrop_polys"))
    return (task_boxes(tasks).join(c, "task_id", "left")
            .fillna(0, subset=["n_raw", "polygon_count", "crop_polys", "noncrop_polys"]))


@dataclass
class Production:
    """What a set of tasks yields: ``results`` (RESULT_SCHEMA and the patch's
    shape), ``burned`` mask spans and the raster ``grid`` of the tasks that
    were rasterised."""

    results: DataFrame
    burned: DataFrame
    grid: DataFrame

    def pixels(self, rasters: DataFrame, n_bands: int, layout: str = "pixel") -> DataFrame:
        """Pixel rows of the successful tasks."""
        return pixel_rows(self.results, rasters, pt.full_mask(self.burned, self.grid), n_bands, layout)


def produce_all(tasks: DataFrame, parcels: DataFrame, scenes: DataFrame, windows: list[SearchWindow],
                res: float, parcel_cell: float, scene_cell: float, worker_id: str = "spark",
                min_polygons: int = MIN_POLYGONS_PATCH, pixel_path: str | None = None,
                rasters: DataFrame | None = None, n_bands: int = len(REQUESTED_BANDS),
                utm_zone: int | None = None) -> Production:
    """Results, masks and grids for ``tasks``.

    ``parcels`` must carry binary_id (class lookup done) and may carry rings.
    Only tasks passing the polygon thresholds are rasterised and matched. A
    task whose box cannot be used gets the status ``failed`` and the reason.
    With ``utm_zone`` boxes and rings are projected before burning, ``res`` is
    in metres then. With ``rasters`` (task_id, h, w, bands) a raster of another
    size than the grid, or another number of bands, is an invalid shape, and a
    task without raster a failed download.
    """
    known = one_per_task(tasks).withColumn("error", box_error())
    good = known.where(F.col("error").isNull()).select("task_id", *BOX)
    pairs = task_parcels(good, parcels, parcel_cell)
    # one row per task, read by every branch below: the pairs are not made again for each
    checkpoint_dir(tasks.sparkSession)
    counts = polygon_counts(good, pairs).checkpoint()
    eligible = counts.where((F.col("n_raw") >= min_polygons) & (F.col("polygon_count") > 0))
    grid = pt.pixel_grid(project_box(eligible, utm_zone) if utm_zone else eligible, res)
    # the tasks bring their grids into the join: pairs are not shuffled for them
    shapes = task_parcels(eligible.select("task_id", *BOX).join(grid, "task_id"), parcels.where(F.col("binary_id").isNotNull()),
                          parcel_cell, also=("gx0", "gy1", "res", "h", "w"))
    if utm_zone and "rings" in shapes.columns:
        shapes = project_rings(shapes, utm_zone)
    # at most a span per pixel of the grids: masks and pixel rows read the same burning
    burned = pt.rasterize_spans(shapes, size=pt.burn_size(eligible, "polygon_count")).checkpoint()
    masks = pt.mask_counts(burned, grid).join(
        grid.select("task_id", F.array(F.lit(n_bands), "h", "w").alias("shape")), "task_id")
    match = sc.match_scenes(eligible, scenes, windows, coarse=scene_cell)
    if rasters is not None:
        size = F.col("h").cast("int") * F.col("w").cast("int")
        r = rasters.select("task_id", F.array(F.size("bands"), F.col("h"), F.col("w")).alias("_raster"),
                           F.forall("bands", lambda b: F.size(b) == size).alias("_full"))
        masks = (masks.join(r, "task_id", "left")
                 .withColumn("shape_ok", F.col("_full") & (F.col("_raster") == F.col("shape"))).drop("_raster", "_full"))
        match = match.join(r.select("task_id"), "task_id", "left_semi")
    status = pt.patch_status(counts, match, masks, min_polygons).join(masks.select("task_id", "shape"), "task_id", "left")
    ok = F.col("status") == STATUS_SUCCESS
    path = (F.concat(F.lit(pixel_path.rstrip("/") + "/task_"), F.col("task_id").cast("string"),
                     F.lit(f"_worker_{worker_id}")) if pixel_path else F.lit(None).cast("string"))
    bbox = F.array(*[F.col(c).cast("double") for c in BOX]).alias("bbox")
    done = status.join(good, "task_id").select(
        "task_id", F.lit(str(worker_id)).alias("worker_id"), bbox, "status", F.when(ok, path).alias("s3_path"),
        "polygon_count", "crop_pixels", "noncrop_pixels", F.lit(None).cast("string").alias("error"),
        F.current_timestamp().alias("ts"), F.when(ok, F.col("shape")).alias("shape"))
    zero = F.lit(0).cast("bigint")
    failed = known.where(F.col("error").isNotNull()).select(
        "task_id", F.lit(str(worker_id)).alias("worker_id"), bbox, F.lit(STATUS_FAILED).alias("status"),
        F.lit(None).cast("string").alias("s3_path"), zero.alias("polygon_count"), zero.alias("crop_pixels"),
        zero.alias("noncrop_pixels"), "error", F.current_timestamp().alias("ts"), F.lit(None).cast("array<int>").alias("shape"))
    return Production(done.unionByName(failed), burned, grid)


def produce(*args, **kwargs) -> DataFrame:
    """The result rows of ``produce_all``."""
    return produce_all(*args, **kwargs).results


def pixel_rows(results: DataFrame, rasters: DataFrame, burned_mask: DataFrame, n_bands: int,
               layout: str = "pixel") -> DataFrame:
    """Pixel table rows for successful tasks (C1 + mask labels, A12 input).

    ``rasters``: task_id + patch arrays (bands, mask placeholder allowed);
    ``burned_mask``: task_id, pixel_idx, label from ``pt.full_mask``."""
    ok = results.where(F.col("status") == STATUS_SUCCESS).select(
        "task_id", F.concat(F.lit("task_"), F.col("task_id").cast("string"), F.lit("_worker_"),
                            F.col("worker_id")).alias("patch_id"))
    r = rasters.join(ok, "task_id")
    if "mask" not in r.columns:
        r = r.withColumn("mask", F.transform(F.col("bands")[0], lambda _: F.lit(0)))
    px = pt.explode_patches(r, n_bands, layout, keep=("task_id", "patch_id")).drop("label")
    return px.join(burned_mask.select("task_id", "pixel_idx", "label"), ["task_id", "pixel_idx"], "left") \
        .fillna(0, subset=["label"])


#: what a complete pixel batch leaves beside the table
LAYOUT = "pixel_batch long, buckets int, folder string"


def layout_path(path: str) -> str:
    """Where the layout records of a pixel table are."""
    return path.rstrip("/") + "_layout"


def write_pixels(pixels: DataFrame, path: str, batch: int = 0, buckets: int = 64, rows_per_file: int = 5_000_000) -> None:
    """Snappy Parquet in folders ``batch=<id>/task_bucket=<k>``.

    A batch written again replaces its own folder, so a replay leaves no second
    copy. ``buckets`` only names folders (readers prune on them); the number of
    writers follows the shuffle partitions and the rows: a bucket's patches are
    spread by (bucket, task), and no file exceeds ``rows_per_file``. When all
    files are there, a record of the batch with its folder and bucket number is
    left beside the table (``layout_path``): readers learn from it that the
    batch is complete, and how to prune it."""
    folder = f"{path.rstrip('/')}/batch={batch}"
    b = F.pmod(F.col("task_id"), F.lit(buckets)).cast("int").alias("task_bucket")
    (pixels.withColumn("task_bucket", b).repartition("task_bucket", "task_id")
     .write.mode("overwrite").option("compression", "snappy").option("maxRecordsPerFile", rows_per_file)
     .partitionBy("task_bucket").parquet(folder))
    record = pixels.sparkSession.createDataFrame([(batch, buckets, folder)], LAYOUT)
    record.coalesce(1).write.mode("overwrite").json(f"{layout_path(path)}/{batch}")
