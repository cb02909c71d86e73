"""Raster patches <-> pixel rows, resampling, rasterisation, mask checks
(C1-C10, E3, E5).

Patches are rows with band-major array columns: ``bands[c][r*w + k]`` and
``mask[r*w + k]``. All array work uses native higher-order functions
(``transform``, ``aggregate``, ``arrays_zip`` + ``inline``), so it is
code-generated JVM work, one pass per patch, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrapix.functions.geo import ring_edges
from terrapix.operators.spans import polygon_spans, visible_spans
from terrapix.schema import (MIN_POLYGONS_PATCH, STATUS_EMPTY_MASK, STATUS_FEW_POLYGONS,
                             STATUS_INVALID_SHAPE, STATUS_NO_BINARY, STATUS_SUCCESS)


def explode_patches(patches: DataFrame, n_bands: int, layout: str = "pixel",
                    keep: tuple[str, ...] = ("patch_id",)) -> DataFrame:
    """One row per pixel: keep cols, pixel_idx, label, band_0..band_{n-1}.

    ``layout="pixel"`` (default): band_k = bands[k][p] - the pixel's own bands.
    ``layout="buffer"``: reproduces a (C,H,W) buffer reshaped to (H*W, C)
    without a transpose: row p, column k = flat[p*C + k].

    The arrays are zipped once and inlined, so each pixel row is built without
    carrying the whole patch along (explode + element_at would copy the
    arrays into every generated row). A patch whose number of bands is not
    ``n_bands`` raises; an empty raster yields no rows.
    """
    bad = F.raise_error(F.concat(F.lit("patch "), F.col(keep[0]).cast("string"), F.lit(" has "),
                                 F.size("bands").cast("string"), F.lit(f" bands, expected {n_bands}")))
    patches = patches.withColumn("bands", F.when(F.size("bands") == n_bands, F.col("bands"))
                                 .otherwise(bad.cast(patches.schema["bands"].dataType)))
    npx = F.size(F.col("bands")[0])
    # an empty band has no pixels (sequence(0, -1) would count down)
    idx = F.when(npx > 0, F.sequence(F.lit(0), npx - 1)).otherwise(F.array().cast("array<int>"))
    if layout == "pixel":
        per_band = [F.col("bands")[k] for k in range(n_bands)]
    elif layout == "buffer":
        flat = F.flatten("bands")
        def pick(k):
            return F.transform(idx, lambda p: F.element_at(flat, p * n_bands + k + 1))
        per_band = [pick(k) for k in range(n_bands)]
    else:
        raise ValueError(f"unknown layout {layout!r}")
    z = F.arrays_zip(idx.alias("pixel_idx"), F.when(npx > 0, F.col("mask")).otherwise(F.array().cast("array<int>")).alias("label"),
                     *[b.alias(f"band_{k}") for k, b in enumerate(per_band)])
    out = patches.select(*keep, F.inline(z))
    return out.withColumns({"pixel_idx": F.col("pixel_idx").cast("bigint"),
                            "label": F.col("label").cast("bigint")})


def _field(arr: str, name: str) -> Column:
    return F.transform(arr, lambda s: s[name])


def pack_patches(pixels: DataFrame, n_bands: int, h: int | None = None, w: int | None = None,
                 sizes: DataFrame | None = None, fill: float = 0.0) -> DataFrame:
    """Inverse of ``explode_patches`` (C3): pixel rows -> band-major arrays.

    Every patch has its own size: ``sizes`` (patch_id, h, w), or one h, w for
    all. Values stand at their pixel index; a missing pixel gets ``fill`` in
    every band and mask 0 (C10), so nothing shifts. What does not fit is
    counted, never dropped unseen: ``n_missing`` pixels absent, ``n_extra``
    pixel rows outside the raster, ``n_conflicts`` pixels whose copies differ
    (the latest copy by ``ts`` wins when that column exists, else the largest
    values - one result whatever the partitioning).

    Copies of a pixel are first reduced on (patch_id, pixel_idx), a partial
    aggregation spread over all tasks, so each patch gathers at most h * w
    rows, a bound set by the raster shape, not by the data volume.
    """
    bands = [f"band_{k}" for k in range(n_bands)]
    if sizes is None:
        if h is None or w is None:
            raise ValueError("pack_patches needs sizes or h and w")
        sizes = pixels.select("patch_id").distinct().select("patch_id", F.lit(h).alias("h"), F.lit(w).alias("w"))
    values = F.struct("label", *bands)
    order = F.struct("ts", values.alias("v")) if "ts" in pixels.columns else F.struct(values.alias("v"))
    one = pixels.groupBy("patch_id", "pixel_idx").agg(
        F.max(order)["v"].alias("_v"), (~F.max(values).eqNullSafe(F.min(values))).alias("_differs"))
    last = F.col("h") * F.col("w") - 1
    wanted = sizes.select("patch_id", "h", "w", F.explode(
        F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))).alias("_i"))
    placed = wanted.join(one.withColumnRenamed("pixel_idx", "_i"), ["patch_id", "_i"], "left")
    item = F.struct(F.col("_i").alias("i"), F.coalesce("_v.label", F.lit(0)).cast("int").alias("m"),
                    *[F.when(F.col("_v").isNull(), F.lit(float(fill))).otherwise(F.col(f"_v.{b}")).alias(f"b{k}")
                      for k, b in enumerate(bands)])
    g = placed.groupBy("patch_id", "h", "w").agg(
        F.array_sort(F.collect_list(item)).alias("px"), F.count_if(F.col("_v").isNull()).alias("n_missing"),
        F.count_if("_differs").alias("n_conflicts"))
    extra = (one.join(sizes, "patch_id").where((F.col("pixel_idx") < 0) | (F.col("pixel_idx") > last))
             .groupBy("patch_id").agg(F.count(F.lit(1)).alias("n_extra")))
    return g.join(extra, "patch_id", "left").select(
        "patch_id", F.lit(n_bands).alias("n_bands"), "h", "w",
        F.array(*[_field("px", f"b{k}") for k in range(n_bands)]).alias("bands"),
        _field("px", "m").alias("mask"),
        "n_missing", F.coalesce("n_extra", F.lit(0)).cast("bigint").alias("n_extra"), "n_conflicts")


def fill_missing(patches: DataFrame, value: float = 0.0) -> DataFrame:
    """Missing raster values -> ``value`` (the download's fill value)."""
    return patches.withColumn("bands", F.transform(
        "bands", lambda b: F.transform(b, lambda v: F.coalesce(v, F.lit(float(value))))))


def mask_stats(patches: DataFrame) -> DataFrame:
    """crop (mask==1) / non-crop (mask==0) pixel counts and the empty-mask and
    shape checks (C7-C9) - per-row array functions, no shuffle."""
    m = F.col("mask")
    shape_ok = (F.size("bands") == F.col("n_bands")) & F.forall(
        "bands", lambda b: F.size(b) == F.col("h") * F.col("w"))
    return patches.select(
        "patch_id",
        F.size(F.filter(m, lambda x: x == 1)).cast("bigint").alias("crop_pixels"),
        F.size(F.filter(m, lambda x: x == 0)).cast("bigint").alias("noncrop_pixels"),
        (F.coalesce(F.array_max(m), F.lit(0)) == 0).alias("empty_mask"),
        shape_ok.alias("shape_ok"),
        F.array(F.col("n_bands"), F.col("h"), F.col("w")).alias("shape"))


def _src(i: Column, n_in: Column, n_out: int) -> Column:
    # output index -> input coordinate, corners aligned: i * (n_in-1) / (n_out-1)
    if n_out <= 1:
        return F.lit(0.0)
    return i.cast("double") * (n_in - 1).cast("double") / F.lit(float(n_out - 1))


def resample_bilinear(patches: DataFrame, out_h: int, out_w: int) -> DataFrame:
    """Per-band linear zoom (order 1) to out_h x out_w (C4)."""
    h, w = F.col("h"), F.col("w")
    idx = F.sequence(F.lit(0), F.lit(out_h * out_w - 1))

    def sample(band: Column) -> Column:
        def at(o):
            r, c = F.floor(o / out_w), o % out_w
            sr, sc = _src(r, h, out_h), _src(c, w, out_w)
            r0, c0 = F.floor(sr), F.floor(sc)
            r1, c1 = F.least(r0 + 1, h - 1), F.least(c0 + 1, w - 1)
            fr, fc = sr - r0, sc - c0

            def v(rr, cc):
                return F.element_at(band, (rr * w + cc + 1).cast("int"))
            return ((1 - fr) * (1 - fc) * v(r0, c0) + (1 - fr) * fc * v(r0, c1)
                    + fr * (1 - fc) * v(r1, c0) + fr * fc * v(r1, c1))
        return F.transform(idx, at)
    # new shape columns are attached after the transform: a lateral alias
    # named h/w in the same projection would shadow the input's h/w
    out = patches.select("patch_id", "n_bands", F.transform("bands", sample).alias("_bands"),
                         *([c for c in ["mask"] if c in patches.columns]))
    return out.select("patch_id", "n_bands", F.lit(out_h).alias("h"), F.lit(out_w).alias("w"),
                      F.col("_bands").alias("bands"), *([c for c in ["mask"] if c in out.columns]))


def resample_nearest(patches: DataFrame, out_h: int, out_w: int, col: str = "mask",
                     binarize: bool = True) -> DataFrame:
    """Nearest-neighbour zoom (order 0; index = floor(coord + 0.5)), then
    ``> 0.5`` -> 1 for masks (C5)."""
    h, w = F.col("h"), F.col("w")
    idx = F.sequence(F.lit(0), F.lit(out_h * out_w - 1))

    def at(o):
        r, c = F.floor(o / out_w), o % out_w
        rr = F.floor(_src(r, h, out_h) + 0.5)
        cc = F.floor(_src(c, w, out_w) + 0.5)
        v = F.element_at(F.col(col), (rr * w + cc + 1).cast("int"))
        return F.when(v > 0.5, 1).otherwise(0) if binarize else v
    out = patches.select("patch_id", F.transform(idx, at).alias("_r"))
    return out.select("patch_id", F.lit(out_h).alias("h"), F.lit(out_w).alias("w"), F.col("_r").alias(col))


# --- rasterisation ----------------------------------------------------------

def pixel_grid(tasks: DataFrame, res: float, key: tuple[str, ...] = ("task_id",)) -> DataFrame:
    """Raster grid of each task box: origin at the top-left corner, north-up,
    h = ceil(height / res), w = ceil(width / res)."""
    return tasks.select(
        *key, F.col("xmin").alias("gx0"), F.col("ymax").alias("gy1"), F.lit(float(res)).alias("res"),
        F.ceil((F.col("ymax") - F.col("ymin")) / F.lit(res)).cast("int").alias("h"),
        F.ceil((F.col("xmax") - F.col("xmin")) / F.lit(res)).cast("int").alias("w"))


def cell_grid_columns(spec, res: float) -> dict[str, Column]:
    """Pixel-grid columns of grid cell (i, j), computed from the index alone,
    so cell-keyed rows need no join to learn their raster geometry."""
    x = F.lit(spec.x0) + F.col("i").cast("double") * F.lit(spec.step)
    y = F.lit(spec.y0) + F.col("j").cast("double") * F.lit(spec.step)
    n = int(-(-spec.step // res))  # ceil(step / res)
    return {"gx0": x, "gy1": y + F.lit(spec.step), "res": F.lit(float(res)),
            "h": F.lit(n), "w": F.lit(n)}


#: polygons that a task burns: up to ``BURN_TASKS`` tasks (writers keep nothing in
#: memory for so many) ``BURN_FEW`` each, beyond them more, ``BURN_MANY`` at most
BURN_FEW, BURN_MANY, BURN_TASKS, BURN_LEAST = 250_000, 2_000_000, 200, 8


def burn_size(tasks: DataFrame, count: str) -> tuple[int, int]:
    """(sum, largest) of a column of polygon counts, one row per patch."""
    r = tasks.agg(F.sum(count).alias("n"), F.max(count).alias("m")).first()
    return int(r["n"] or 0), int(r["m"] or 0)


def _gathered(p: DataFrame, key: tuple[str, ...], size: tuple[int, int] | None) -> DataFrame:
    """Polygons of a patch side by side, those of one parcel next to each other: as
    many partitions as the polygons need, a crowded patch in several."""
    rows, most = size or burn_size(p.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")), "_n")
    n = max(min(-(-rows // BURN_FEW), BURN_TASKS), -(-rows // BURN_MANY), BURN_LEAST)
    part = F.pmod(F.hash("parcel_id"), F.lit(max(1, -(-most // BURN_FEW))))
    return p.repartition(n, *key, part).sortWithinPartitions(*key, "parcel_id")


def rasterize_spans(pairs: DataFrame, key: tuple[str, ...] = ("task_id",), exact: bool = True,
                    size: tuple[int, int] | None = None) -> DataFrame:
    """Burn each mapped polygon's binary label onto its patch's pixel grid.

    ``pairs``: key columns, parcel_id, binary_id, xmin..ymax[, rings] and the
    grid columns gx0, gy1, res, h, w (``pixel_grid`` joined on the key, or
    ``cell_grid_columns`` for grid cells). A pixel is burned when its centre
    is inside the polygon (even-odd rule over all rings, so holes and
    multi-part polygons work; the envelope when ``exact=False`` or no rings);
    where polygons overlap, the later one (higher parcel_id) wins.

    Scanline rasterisation by spans:
      1. polygons are shuffled on the patch, a crowded patch to several tasks
         (``size``: polygons in all and of the largest patch, counted when not
         known), and sorted by patch and parcel;
      2. every non-horizontal edge meets the pixel rows whose centre line it
         crosses (half-open in y); crossings of a parcel and row, ordered by x,
         pair 1-2, 3-4, ... into inside spans (even-odd), in the task that has
         the polygon: no crossing is shuffled (``spans.polygon_spans``);
      3. overlapping spans of a pixel row are merged by priority
         (``spans.visible_spans``): in the task that made them, then on
         (patch, pixel row).
    The closed-envelope mode (``exact=False``) emits its span directly.

    Returns disjoint spans: key, w, _r, _a, _b (inclusive), parcel_id, mask_class.
    """
    rings = exact and "rings" in pairs.columns
    p = pairs.where(F.col("binary_id").isNotNull()).select(
        *key, "parcel_id", "binary_id", "gx0", "gy1", "res", "h", "w", *(["rings"] if rings else ["xmin", "ymin", "xmax", "ymax"]))
    p = _gathered(p, key, size)
    gy1, res = F.col("gy1"), F.col("res")
    if rings:
        def rows(e):  # rows whose centre cy = gy1 - (r + .5) * res satisfies ylo <= cy < yhi
            lo, hi = F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])
            r_lo = F.greatest(F.floor((gy1 - hi) / res - 0.5) + 1, F.lit(0))
            r_hi = F.least(F.floor((gy1 - lo) / res - 0.5), F.col("h") - 1)
            return F.struct(r_lo.cast("int").alias("lo"), r_hi.cast("int").alias("hi"), *[e[c].alias(c) for c in ("x1", "y1", "x2", "y2")])
        sloped = F.filter(ring_edges("rings"), lambda e: e["y1"] != e["y2"])
        met = F.filter(F.transform(sloped, rows), lambda e: e["lo"] <= e["hi"])
        shapes = p.select(*key, "w", "parcel_id", "binary_id", "gx0", "gy1", "res", met.alias("edges"))
        return polygon_spans(shapes, list(key)).withColumnRenamed("binary_id", "mask_class")
    # closed envelope: centre in [xmin, xmax] x [ymin, ymax]
    r_lo = F.greatest(F.ceil((gy1 - F.col("ymax")) / res - 0.5), F.lit(0))
    r_hi = F.least(F.floor((gy1 - F.col("ymin")) / res - 0.5), F.col("h") - 1)
    a = F.greatest(F.ceil((F.col("xmin") - F.col("gx0")) / res - 0.5), F.lit(0)).cast("int")
    b = F.least(F.floor((F.col("xmax") - F.col("gx0")) / res - 0.5), F.col("w") - 1).cast("int")
    spans = (p.where((r_lo <= r_hi) & (a <= b))
             .select(*key, "w", F.explode(F.sequence(r_lo.cast("int"), r_hi.cast("int"))).alias("_r"),
                     "parcel_id", "binary_id", a.alias("_a"), b.alias("_b")))
    return visible_spans(spans, [*key, "w", "_r"]).withColumnRenamed("binary_id", "mask_class")


def span_pixels(spans: DataFrame, key: tuple[str, ...] = ("task_id",)) -> DataFrame:
    """A row for each burned pixel of disjoint spans: key, pixel_idx, mask_class."""
    px = spans.select(*key, "w", "_r", "mask_class", F.explode(F.sequence("_a", "_b")).alias("_c"))
    return px.select(*key, (F.col("_r") * F.col("w") + F.col("_c")).cast("bigint").alias("pixel_idx"), F.col("mask_class").cast("int").alias("mask_class"))


def rasterize(pairs: DataFrame, key: tuple[str, ...] = ("task_id",), exact: bool = True) -> DataFrame:
    """Sparse burned pixels (key, pixel_idx, mask_class) of ``rasterize_spans``."""
    return span_pixels(rasterize_spans(pairs, key, exact), key)


def mask_counts(burned: DataFrame, grid: DataFrame, key: tuple[str, ...] = ("task_id",)) -> DataFrame:
    """Per patch: crop pixels (mask 1), non-crop pixels (mask 0: non-crop
    polygons plus unburned background), background pixels, empty flag.

    Computed from the disjoint spans (or sparse burned pixels) and the grid
    size, without materialising pixels. ``grid`` has the key and h, w."""
    n = (F.col("_b") - F.col("_a") + 1).cast("bigint") if "_a" in burned.columns else F.lit(1).cast("bigint")
    per = burned.groupBy(*key).agg(
        F.sum(F.when(F.col("mask_class") == 1, n).otherwise(0)).alias("crop_pixels"),
        F.sum(F.when(F.col("mask_class") == 0, n).otherwise(0)).alias("class0_pixels"))
    g = grid.select(*key, (F.col("h") * F.col("w")).cast("bigint").alias("n_pixels"))
    j = g.join(per, list(key), "left").fillna(0, subset=["crop_pixels", "class0_pixels"])
    return j.select(
        *key, "crop_pixels",
        (F.col("n_pixels") - F.col("crop_pixels")).alias("noncrop_pixels"),
        (F.col("n_pixels") - F.col("crop_pixels") - F.col("class0_pixels")).alias("background_pixels"),
        (F.col("crop_pixels") == 0).alias("empty_mask"))


def full_mask(burned: DataFrame, grid: DataFrame, key: tuple[str, ...] = ("task_id",)) -> DataFrame:
    """Dense mask rows: key, pixel_idx, label (0/1, background 0) and
    nullable mask_class (null = background) (C6, Q4). ``burned`` are disjoint
    spans or sparse pixels; a grid without pixels has no rows."""
    if "_a" in burned.columns:
        burned = span_pixels(burned, key)
    last = F.col("h") * F.col("w") - 1
    idx = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    allpx = (grid.select(*key, F.explode(idx).alias("pixel_idx"))
             .withColumn("pixel_idx", F.col("pixel_idx").cast("bigint")))
    return (allpx.join(burned, [*key, "pixel_idx"], "left")
            .withColumn("label", F.coalesce(F.col("mask_class"), F.lit(0)).cast("bigint")))


def patch_status(tasks: DataFrame, scene_match: DataFrame | None, masks: DataFrame | None,
                 min_polygons: int = MIN_POLYGONS_PATCH) -> DataFrame:
    """Result status in the order the checks run; first failing one wins.

    ``tasks`` carry n_raw (polygons meeting the box before class mapping) and
    polygon_count (mapped). Statuses: skipped_few_polygons,
    skipped_no_binary_classes, failed_download, invalid_image_shape,
    failed_empty_mask, success. Pixel counts are reported on success only.
    """
    t = tasks
    if scene_match is not None:
        t = t.join(scene_match.select("task_id", "scene_id", "season"), "task_id", "left")
    else:
        t = t.withColumns({"scene_id": F.lit(None).cast("bigint"), "season": F.lit(None).cast("string")})
    if masks is not None:
        t = t.join(masks, "task_id", "left")
    shape_ok = F.col("shape_ok") if "shape_ok" in t.columns else F.lit(True)
    status = (F.when(F.col("n_raw") < min_polygons, STATUS_FEW_POLYGONS)
              .when(F.col("polygon_count") == 0, STATUS_NO_BINARY)
              .when(F.col("scene_id").isNull(), "failed_download")
              .when(~shape_ok, STATUS_INVALID_SHAPE)
              .when(F.coalesce(F.col("empty_mask"), F.lit(True)), STATUS_EMPTY_MASK)
              .otherwise(STATUS_SUCCESS))
    ok = status == STATUS_SUCCESS
    return t.select(
        "task_id", status.alias("status"),
        F.when(F.col("n_raw") >= min_polygons, F.col("polygon_count")).otherwise(0).cast("bigint")
        .alias("polygon_count"),
        F.when(ok, F.col("crop_pixels")).otherwise(0).cast("bigint").alias("crop_pixels"),
        F.when(ok, F.col("noncrop_pixels")).otherwise(0).cast("bigint").alias("noncrop_pixels"),
        "scene_id", "season")
