"""Task generation: extent, regular grid, closed-edge range join of parcels to
cells, per-cell counts and dense task numbering (A3, B18, B19, E1, E2, D2-D4,
F1, F3, G1, B7).

The range join never compares every parcel with every cell: each parcel
envelope is exploded into the few cell indices it can touch, and the exact
closed-interval test runs on those candidates in the same stage. Per-cell
counting is then an ordinary partial+final aggregation on (i, j), so a dense
cell costs one pre-aggregated row per map task, not a hot reducer.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrapix.schema import MIN_POLYGONS_TASK, GridSpec
from terrapix.session import checkpoint_dir


def extent(parcels: DataFrame) -> DataFrame:
    """Total bounds of the layer: one partial+final aggregation (A3)."""
    return parcels.agg(F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"),
                       F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"))


def grid_spec(parcels: DataFrame, step: float) -> GridSpec:
    """Grid over the extent; cell count per axis = ceil(length / step), the
    length of a half-open ``arange(start, stop, step)`` (B18)."""
    r = extent(parcels).first()
    if r is None or r["xmin"] is None:
        return GridSpec(0.0, 0.0, step, 0, 0)
    nx = max(0, math.ceil((r["xmax"] - r["xmin"]) / step))
    ny = max(0, math.ceil((r["ymax"] - r["ymin"]) / step))
    return GridSpec(float(r["xmin"]), float(r["ymin"]), float(step), int(nx), int(ny))


def cell_bbox(spec: GridSpec, i: Column, j: Column) -> list[Column]:
    """Cell (i, j) = (x, y, x + step, y + step) with x = x0 + i * step (B19);
    coordinates come from the index, never from an accumulated sum."""
    x = F.lit(spec.x0) + i.cast("double") * F.lit(spec.step)
    y = F.lit(spec.y0) + j.cast("double") * F.lit(spec.step)
    return [x.alias("xmin"), y.alias("ymin"), (x + F.lit(spec.step)).alias("xmax"),
            (y + F.lit(spec.step)).alias("ymax")]


def grid_cells(spark: SparkSession, spec: GridSpec) -> DataFrame:
    """All nx * ny cells, generated in parallel from ``range``."""
    n = spec.nx * spec.ny
    r = spark.range(0, n)
    i = F.floor(F.col("id") / F.lit(spec.ny)).cast("bigint") if spec.ny else F.lit(0).cast("bigint")
    j = (F.col("id") % F.lit(spec.ny)) if spec.ny else F.lit(0).cast("bigint")
    return r.select(i.alias("i"), j.alias("j")).select("i", "j", *cell_bbox(spec, F.col("i"), F.col("j")))


def class_lookup(parcels: DataFrame, class_map: DataFrame, drop_unmapped: bool = False) -> DataFrame:
    """Left join with the class map: binary_id null = unmapped (E1);
    ``drop_unmapped`` is the D3 filter. Whether the map is broadcast is left to
    the optimiser's size limit."""
    cm = class_map.select("ec_hcat_n", F.col("binary_id").cast("int"))
    out = parcels.join(cm, "ec_hcat_n", "left")
    return out.where(F.col("binary_id").isNotNull()) if drop_unmapped else out


def _span(lo: Column, hi: Column, origin: float, step: float, n: int) -> Column:
    # candidate indices, widened by one on each side against rounding; the
    # exact closed test below removes the extras in the same stage
    a = F.greatest(F.floor((lo - F.lit(origin)) / F.lit(step)) - 1, F.lit(0))
    b = F.least(F.floor((hi - F.lit(origin)) / F.lit(step)) + 1, F.lit(n - 1))
    return F.sequence(a.cast("bigint"), b.cast("bigint"))


def cell_parcels(parcels: DataFrame, spec: GridSpec) -> DataFrame:
    """Closed-edge range join parcels x cells (E2): a parcel touching a cell
    border belongs to both cells. Output one row per (cell, parcel)."""
    if spec.nx == 0 or spec.ny == 0:
        return parcels.select(F.lit(0).cast("bigint").alias("i"), F.lit(0).cast("bigint").alias("j"),
                              "*").where(F.lit(False))
    ex = (parcels
          .withColumn("i", F.explode(_span(F.col("xmin"), F.col("xmax"), spec.x0, spec.step, spec.nx)))
          .withColumn("j", F.explode(_span(F.col("ymin"), F.col("ymax"), spec.y0, spec.step, spec.ny))))
    cx = F.lit(spec.x0) + F.col("i").cast("double") * F.lit(spec.step)
    cy = F.lit(spec.y0) + F.col("j").cast("double") * F.lit(spec.step)
    hit = ((F.col("xmin") <= cx + F.lit(spec.step)) & (F.col("xmax") >= cx)
           & (F.col("ymin") <= cy + F.lit(spec.step)) & (F.col("ymax") >= cy))
    return ex.where(hit)


def cell_counts(pairs: DataFrame) -> DataFrame:
    """Per non-empty cell: raw polygons, mapped polygons, crop, non-crop (F1).

    Raw counts include unmapped classes (the thresholds count before mapping)."""
    return pairs.groupBy("i", "j").agg(
        F.count(F.lit(1)).alias("n_raw"),
        F.count("binary_id").alias("n_mapped"),
        F.count_if(F.col("binary_id") == 1).alias("crop"),
        F.count_if(F.col("binary_id") == 0).alias("non_crop"))


def number_tasks(cells: DataFrame, order=("i", "j"), name: str = "task_id") -> DataFrame:
    """Dense 0-based id in (i outer, j inner) order without a global sort (G1).

    Per-column counts (one row per grid column i: bounded by nx) give each
    column's offset; the rank inside a column is a window partitioned by i,
    whose partitions are bounded by ny."""
    outer, inner = order
    # both the offsets and the ranks read the cells: materialise them once
    # (at most nx * ny rows) in the shared checkpoint folder instead of
    # recomputing the parcel explode for each branch
    checkpoint_dir(cells.sparkSession)
    cells = cells.checkpoint(eager=True)
    per = cells.groupBy(outer).agg(F.count(F.lit(1)).alias("_k"))
    before = Window.orderBy(outer).rowsBetween(Window.unboundedPreceding, -1)
    off = per.select(outer, F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_off"))
    w = Window.partitionBy(outer).orderBy(inner)
    out = (cells.join(F.broadcast(off), outer)
           .withColumn(name, (F.col("_off") + F.row_number().over(w) - 1).cast("bigint"))
           .drop("_off"))
    # tasks feed several later joins: keep the numbered table (one row per
    # kept cell) instead of re-running the windows for each consumer
    return out.checkpoint(eager=True)


def make_tasks(counts: DataFrame, spec: GridSpec, min_polygons: int = MIN_POLYGONS_TASK) -> DataFrame:
    """Cells with >= min raw polygons and >= 1 mapped polygon become tasks
    (D2, D4), numbered densely (G1), with their bbox (B19)."""
    kept = counts.where((F.col("n_raw") >= min_polygons) & (F.col("n_mapped") > 0))
    t = number_tasks(kept)
    return t.select("task_id", "i", "j", *cell_bbox(spec, F.col("i"), F.col("j")),
                    F.col("n_mapped").alias("polygon_count"), "crop", "non_crop", "n_raw")


def task_messages(tasks: DataFrame, spec: GridSpec, class_map: dict[str, int]) -> DataFrame:
    """Nested task record (B7): bbox array, distribution struct, class map."""
    cmap = F.create_map(*[x for k, v in class_map.items() for x in (F.lit(k), F.lit(v))])
    return tasks.select(
        F.col("task_id"),
        F.array("xmin", "ymin", "xmax", "ymax").alias("bbox"),
        F.lit(spec.step).alias("grid_step"),
        F.col("polygon_count"),
        F.struct(F.col("crop").alias("crop"), F.col("non_crop").alias("non_crop")).alias("binary_distribution"),
        cmap.alias("binary_classes"))


def dataset_stats(tasks: DataFrame, pairs: DataFrame, spec: GridSpec, threshold: float = 5.0) -> DataFrame:
    """One row: tasks, cells, polygons (per-cell sum), crop/non-crop and %,
    imbalance ratio and flag (F3, B15), plus distinct mapped polygons in the
    kept cells (the per-cell sum counts a border polygon once per cell)."""
    kept = tasks.select("i", "j")
    distinct = (pairs.where(F.col("binary_id").isNotNull())
                .join(kept, ["i", "j"], "left_semi").select("parcel_id").distinct()
                .select(F.lit(0).cast("bigint").alias("n"), *[F.lit(0).cast("bigint").alias(c) for c in ("polygon_count", "crop", "non_crop")],
                        F.lit(1).cast("bigint").alias("d")))
    # both kinds of rows in one aggregation: no join of one-row tables
    both = tasks.select(F.lit(1).cast("bigint").alias("n"), "polygon_count", "crop", "non_crop", F.lit(0).cast("bigint").alias("d")).unionByName(distinct)
    s = both.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(name) for c, name in (
        ("n", "n_tasks"), ("polygon_count", "total_polygons"), ("crop", "crop"), ("non_crop", "non_crop"), ("d", "distinct_polygons"))])
    tot = F.col("crop") + F.col("non_crop")
    ratio = F.try_divide(F.col("crop").cast("double"), F.col("non_crop").cast("double"))
    return s.select(
        "n_tasks", F.lit(spec.nx * spec.ny).cast("bigint").alias("n_cells"), "total_polygons", "crop", "non_crop",
        F.round(F.try_divide(F.col("crop").cast("double"), tot.cast("double")) * 100.0, 6).alias("crop_pct"),
        F.round(F.try_divide(F.col("non_crop").cast("double"), tot.cast("double")) * 100.0, 6).alias("non_crop_pct"),
        F.round(ratio, 6).alias("ratio"),
        F.coalesce(ratio > F.lit(threshold), F.lit(False)).alias("imbalanced"),
        "distinct_polygons")
