"""Pipeline-shaped inputs derived from the benchmark tables.

The benchmark directory holds TPC-H-like tables; the pipeline needs pixels,
parcels, scenes, task results and raster patches. Each is derived with plain
integer arithmetic (so a SQL oracle computes the very same rows) and its size
grows with the input table it comes from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrapix.schema import SearchWindow


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


# --- pixels <- lineitem ----------------------------------------------------

def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """patch_id, pixel_idx, label, band_1/2/4/8 (green, nir, red, swir16)."""
    l = table(spark, sf_dir, "lineitem")
    ok, pk, sk = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    nir = (F.when(pk % 97 == 0, F.lit(None))
           .when(pk % 89 == 0, F.lit(0))
           .otherwise((pk * 13 + ok * 7 + F.when(F.col("l_returnflag") == "R", 2500).otherwise(0)) % 10000))
    red = F.when(pk % 89 == 0, F.lit(0)).otherwise((pk * 31 + ok) % 6000)
    label = (F.when(F.col("l_returnflag") == "R", 1)
             .when(F.col("l_returnflag") == "N", 0)
             .otherwise(F.when(F.col("l_linestatus") == "O", 0).otherwise(2)))
    return l.select(
        F.concat(F.lit("task_"), _s(ok % 50), F.lit("_worker_"), _s(sk % 3)).alias("patch_id"),
        (ok * 100000000000 + pk * 1000000 + sk * 10 + F.col("l_linenumber")).alias("pixel_idx"),
        (F.floor("l_extendedprice").cast("bigint") % 10000).alias("band_1"),
        nir.cast("bigint").alias("band_2"),
        red.cast("bigint").alias("band_4"),
        ((ok * 17 + sk) % 10000).alias("band_8"),
        label.cast("bigint").alias("label"),
    )


# --- parcels <- orders -----------------------------------------------------

FIXTURE_GRID_STEP = 20.0

# Fixture class map (fixed): priority classes standing in for land-cover
# classes; '5-LOW' is deliberately unmapped.
FIXTURE_CLASS_MAP = {"1-URGENT": 1, "2-HIGH": 1, "3-MEDIUM": 1, "4-NOT SPECIFIED": 0}


def parcels(spark: SparkSession, sf_dir: str, with_rings: bool = True, shape: str = "box") -> DataFrame:
    """Parcels in integer milli-degree coordinates: axis-aligned boxes, or
    (``shape="diamond"``) the rhombus through the box's edge midpoints."""
    o = table(spark, sf_dir, "orders")
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    xmin = (ok * 37) % 2000
    ymin = (ok * 91 + ck * 13) % 1500
    df = o.select(
        ok.alias("parcel_id"),
        F.col("o_orderpriority").alias("ec_hcat_n"),
        xmin.cast("double").alias("xmin"),
        ymin.cast("double").alias("ymin"),
        (xmin + 1 + ck % 30).cast("double").alias("xmax"),
        (ymin + 1 + ok % 20).cast("double").alias("ymax"),
    )
    if with_rings and shape == "diamond":
        cx = (F.col("xmin") + F.col("xmax")) / 2
        cy = (F.col("ymin") + F.col("ymax")) / 2

        def pt(x, y):
            return F.struct(x.alias("x"), y.alias("y"))
        ring = F.array(pt(cx, F.col("ymin")), pt(F.col("xmax"), cy), pt(cx, F.col("ymax")),
                       pt(F.col("xmin"), cy), pt(cx, F.col("ymin")))
        df = df.withColumn("rings", F.array(ring))
    elif with_rings:
        from terrapix.functions.geo import box_ring
        df = df.withColumn("rings", F.array(box_ring("xmin", "ymin", "xmax", "ymax")))
    return df.withColumn("crs", F.lit("EPSG:4258"))


def class_map(spark: SparkSession, mapping: dict[str, int] | None = None) -> DataFrame:
    mapping = FIXTURE_CLASS_MAP if mapping is None else mapping
    return spark.createDataFrame(list(mapping.items()), "ec_hcat_n string, binary_id int")


# --- scenes, tasks to match <- events, orders -------------------------------

def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    u, ev = F.col("user_id"), F.col("event_id")
    cx = (u * 53 + ev * 7) % 2000
    cy = (u * 29 + ev * 11) % 1500
    return e.select(
        ev.alias("scene_id"),
        F.col("ts").alias("scene_ts"),
        (F.col("value") / 5.0).alias("cloud_cover"),
        (cx - 25).cast("double").alias("xmin"), (cy - 25).cast("double").alias("ymin"),
        (cx + 25).cast("double").alias("xmax"), (cy + 25).cast("double").alias("ymax"),
    )


def match_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20 x 20 task boxes for scene matching, one per order."""
    o = table(spark, sf_dir, "orders")
    ok = F.col("o_orderkey")
    x, y = (ok * 37) % 2000, (ok * 91) % 1500
    return o.select(ok.alias("task_id"),
                    x.cast("double").alias("xmin"), y.cast("double").alias("ymin"),
                    (x + 20).cast("double").alias("xmax"), (y + 20).cast("double").alias("ymax"))


# Fixture search tiers (fixed): half-open [d0, d1), cloud strictly below.
FIXTURE_WINDOWS = [
    SearchWindow(1, "peak", "2024-01-10", "2024-01-12", 2.0),
    SearchWindow(2, "early", "2024-01-05", "2024-01-10", 3.0),
    SearchWindow(3, "late", "2024-01-12", "2024-01-16", 4.0),
    SearchWindow(4, "full", "2024-01-01", "2024-01-31", 20.0),
]


# --- task results <- events ------------------------------------------------

def task_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    px = F.floor(F.col("value") * 100).cast("bigint")
    status = (F.when(F.col("event_type").isin("purchase", "click"), "success")
              .when(F.col("event_type") == "view", "skipped_few_polygons")
              .when(F.col("event_type") == "signup", "failed_empty_mask")
              .otherwise("failed_download"))
    return e.select(
        F.col("event_id").alias("task_id"),
        F.concat(F.lit("w"), _s(F.col("user_id") % 4)).alias("worker_id"),
        F.col("ts"),
        status.alias("status"),
        px.alias("crop_pixels"),
        (F.lit(50000).cast("bigint") - px).alias("noncrop_pixels"),
    )


def retried_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task results where every task was processed twice (task_id = event_id
    div 2): the reprocessing case that needs de-duplication."""
    r = task_results(spark, sf_dir)
    return r.withColumn("task_id", F.floor(F.col("task_id") / 2).cast("bigint"))


# --- patches <- embeddings -------------------------------------------------

def patches(spark: SparkSession, sf_dir: str, c: int = 4, h: int = 4, w: int = 4) -> DataFrame:
    """Each 64-float embedding read as a (C,H,W) band-major raster.

    bands[c][p] = embedding[c*h*w + p]; mask pixel = 1 when band 0 > 0.
    """
    e = table(spark, sf_dir, "embeddings")
    n = h * w
    emb = F.col("embedding")
    bands = F.transform(F.sequence(F.lit(0), F.lit(c - 1)),
                        lambda k: F.transform(F.slice(emb, k * n + 1, n), lambda v: v.cast("double")))
    return e.select(
        F.concat(F.lit("vec_"), _s(F.col("vec_id"))).alias("patch_id"),
        F.lit(c).alias("n_bands"), F.lit(h).alias("h"), F.lit(w).alias("w"),
        bands.alias("bands"),
    ).withColumn("mask", F.transform(F.col("bands")[0], lambda v: F.when(v > 0, 1).otherwise(0)))


def task_rasters(spark: SparkSession, sf_dir: str, tasks: DataFrame, size: int = 20, c: int = 4) -> DataFrame:
    """A (c, size, size) raster for each task from the embeddings: task t reads
    vector t mod n; pixel p of band k is the vector's element k * 16 + p mod 16."""
    e = table(spark, sf_dir, "embeddings")
    n = e.count()
    idx = F.sequence(F.lit(0), F.lit(size * size - 1))

    def band(k):
        return F.transform(idx, lambda p: F.element_at("embedding", F.lit(k * 16 + 1) + p % 16).cast("double"))
    bands = F.array(*[band(k) for k in range(c)])
    t = tasks.select("task_id", (F.col("task_id") % F.lit(max(n, 1))).alias("vec_id"))
    return t.join(e, "vec_id").select("task_id", F.lit(c).alias("n_bands"), F.lit(size).alias("h"), F.lit(size).alias("w"), bands.alias("bands"))


def sized_patch_pixels(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Pixel rows of patches with sizes of their own (h = 1 + id mod 4, w = 1 +
    id div 4 mod 4), every pixel twice, without the pixels whose (id + index)
    is a multiple of 5, and one pixel beyond the raster; and the sizes."""
    e = table(spark, sf_dir, "embeddings")
    v = F.col("vec_id")
    sized = e.select(F.concat(F.lit("vec_"), _s(v)).alias("patch_id"), v, (v % 4 + 1).cast("int").alias("h"),
                     (F.floor(v / 4) % 4 + 1).cast("int").alias("w"), "embedding")
    px = sized.select("patch_id", "vec_id", "embedding", F.explode(F.sequence(F.lit(0), F.col("h") * F.col("w"))).alias("p"))
    rows = px.where((F.col("vec_id") + F.col("p")) % 5 != 0).select(
        "patch_id", F.col("p").cast("bigint").alias("pixel_idx"), F.when(F.element_at("embedding", F.col("p") + 1) > 0, 1).otherwise(0).cast("bigint").alias("label"),
        *[F.element_at("embedding", F.lit(k * 16 + 1) + F.col("p")).cast("double").alias(f"band_{k}") for k in range(3)])
    return rows.unionByName(rows), sized.select("patch_id", "h", "w")


def pixel_results(px: DataFrame) -> DataFrame:
    """A result for each patch of a pixel table (task_<id>_worker_<w>): the
    worker's message came later the larger (task * 7 + worker * 5) mod 11."""
    ids = px.select("patch_id").distinct()
    task = F.regexp_extract("patch_id", r"task_(\d+)_worker_(.+)", 1).cast("bigint")
    worker = F.regexp_extract("patch_id", r"task_(\d+)_worker_(.+)", 2)
    second = (task * 7 + worker.cast("bigint") * 5) % 11
    return ids.select(task.alias("task_id"), worker.alias("worker_id"), F.timestamp_seconds(second).alias("ts"), F.lit("success").alias("status"))


# --- scene tiles <- orders ----------------------------------------------------

TILE_SIZE, TILE_BANDS, TILE_COARSE = 16, 3, (2,)


def tile_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task boxes off the pixel grid, on both sides of the origin, each with one of
    five scenes (every 50th has none)."""
    t = match_tasks(spark, sf_dir)
    shift = {"xmin": -1000.25, "ymin": -700.5, "xmax": -1000.25, "ymax": -700.5}
    scene = F.when(F.col("task_id") % 50 == 0, F.lit(None)).otherwise(F.col("task_id") % 5)
    return t.select("task_id", scene.cast("bigint").alias("scene_id"), *[(F.col(c) + d).alias(c) for c, d in shift.items()])


def scene_tiles(tasks: DataFrame) -> DataFrame:
    """The tiles under the tasks' boxes, as an archive holds them, without those
    whose (5x + 3y + scene) is a multiple of 7. A value is made of its scene, band
    and place; band 2 is coarse."""
    size, half = TILE_SIZE, TILE_SIZE // 2
    lo, hi = (lambda c: F.floor(F.floor(c) / size)), (lambda c: F.floor((F.ceil(c) - 1) / size))
    t = tasks.where("scene_id IS NOT NULL").select("scene_id", F.explode(F.sequence(lo(F.col("xmin")), hi(F.col("xmax")))).alias("tile_x"), "ymin", "ymax")
    t = t.select("scene_id", "tile_x", F.explode(F.sequence(lo(F.col("ymin")), hi(F.col("ymax")))).alias("tile_y")).distinct()
    t = t.where(F.pmod(F.col("tile_x") * 5 + F.col("tile_y") * 3 + F.col("scene_id"), F.lit(7)) != 0)

    def band(k: int, n: int) -> Column:
        def value(p):
            x, y = F.col("tile_x") * n + p % n, F.col("tile_y") * n + (n - 1) - F.floor(p / n)
            return F.pmod(F.col("scene_id") * 31 + x * 7 + y * 13 + k * 101 + x * y, F.lit(10000)).cast("int")
        return F.transform(F.sequence(F.lit(0), F.lit(n * n - 1)), value)
    return t.withColumn("bands", F.array(*[band(k, half if k in TILE_COARSE else size) for k in range(TILE_BANDS)]))
