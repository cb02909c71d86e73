"""Registered queries: one per operator family, each over the whole input.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose
columns are named like its DuckDB twin in ``terrapix.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrapix.operators import features as feat
from terrapix.operators import metrics
from terrapix.sources import derived

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# --- shared building blocks -------------------------------------------------

def features_v2(spark: SparkSession, sf_dir: str, keep=("patch_id", "pixel_idx")) -> DataFrame:
    px = derived.pixels(spark, sf_dir)
    return feat.pixel_features(px, indices=("ndvi", "ndwi", "ndmi"), keep=keep)


def threshold_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = feat.drop_invalid(features_v2(spark, sf_dir), feat.FEATURES_V1)
    return feat.threshold_predict(f, "ndvi", 0.2)


# --- step 1: the minimum slice ---------------------------------------------

@register("ndvi_confusion")
def q_ndvi_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pixels -> label filter -> reflectance -> NDVI -> drop invalid ->
    threshold prediction -> confusion matrix."""
    return metrics.confusion_long(threshold_predictions(spark, sf_dir))


# --- step 2: features and profiles -------------------------------------------

from terrapix.operators import profile  # noqa: E402

BAND_COLS = ["band_1", "band_2", "band_4", "band_8"]


@register("spectral_indices")
def q_spectral_indices(spark, sf_dir):
    """Reflectance bands, float label, guarded NDVI/NDWI/NDMI."""
    return features_v2(spark, sf_dir)


@register("raw_eps_indices")
def q_raw_eps_indices(spark, sf_dir):
    """Epsilon-form indices on raw digital numbers."""
    return feat.raw_eps_indices(derived.pixels(spark, sf_dir))


@register("class_share")
def q_class_share(spark, sf_dir):
    """total rows, crop rows and share, label mean in one pass."""
    return profile.class_share(derived.pixels(spark, sf_dir))


@register("class_counts")
def q_class_counts(spark, sf_dir):
    """Rows per label with share and name."""
    return profile.class_counts(derived.pixels(spark, sf_dir))


@register("profile_bands")
def q_profile_bands(spark, sf_dir):
    """count/mean/std/min/quartiles/max per band, exact quantiles."""
    return profile.profile_columns(derived.pixels(spark, sf_dir), BAND_COLS)


@register("describe_features")
def q_describe_features(spark, sf_dir):
    """typed describe() of the notebook's feature table."""
    return profile.describe_columns(
        features_v2(spark, sf_dir), ["red_b4", "nir_b8", "swir_b11", "ndvi", "ndwi", "ndmi", "label"])


@register("index_range")
def q_index_range(spark, sf_dir):
    """F8: min/max of the raw-epsilon indices."""
    return profile.value_range(q_raw_eps_indices(spark, sf_dir), ["ndvi_raw", "ndwi_raw"])


@register("ndvi_histogram")
def q_ndvi_histogram(spark, sf_dir):
    """50 common equal-width NDVI bins per class, full data."""
    f = feat.drop_invalid(features_v2(spark, sf_dir), feat.FEATURES_V1)
    return profile.histogram(f, "ndvi", "label", 50)


@register("ndvi_red_density")
def q_ndvi_red_density(spark, sf_dir):
    """red x NDVI 20x20 density per class, full data."""
    f = feat.drop_invalid(features_v2(spark, sf_dir), feat.FEATURES_V1)
    return profile.density_2d(f, "red_b4", "ndvi", "label", 20)


# --- step 3: sampling ----------------------------------------------------------

from terrapix.operators import sampling  # noqa: E402

KEY = ["patch_id", "pixel_idx"]


def features_v1(spark, sf_dir):
    return feat.pixel_features(derived.pixels(spark, sf_dir), indices=("ndvi",), keep=tuple(KEY))


def balanced(spark, sf_dir):
    """J1 with the trainer's fractions {crop: 0.1, non-crop: 0.025}, seed 42."""
    return sampling.stratified_sample(features_v1(spark, sf_dir), {1: 0.1, 0: 0.025}, seed=42)


@register("stratified_sample")
def q_stratified_sample(spark, sf_dir):
    """Per-class hash sample in one scan."""
    return balanced(spark, sf_dir)


@register("sample_n")
def q_sample_n(spark, sf_dir):
    """About n rows of the balanced set (fraction = n / count)."""
    return sampling.sample_n(balanced(spark, sf_dir), 1000, seed=42)


@register("exact_sample")
def q_exact_sample(spark, sf_dir):
    """Exactly 20,000 valid feature rows (smallest hash numbers)."""
    f = feat.drop_invalid(features_v1(spark, sf_dir), feat.FEATURES_V1)
    return sampling.exact_sample(f, 20000, seed=42)


@register("hash_split")
def q_hash_split(spark, sf_dir):
    """80/20 split of the balanced set, tagged per row."""
    return sampling.split_column(balanced(spark, sf_dir), 0.8, seed=42)


@register("balance_split")
def q_balance_split(spark, sf_dir):
    """Minority class whole, majority sampled to match, 80/20 per class;
    plus the train/test overlap (0 by construction)."""
    f = feat.drop_invalid(features_v1(spark, sf_dir), feat.FEATURES_V1)
    train, test = sampling.balance_split(f, seed=42, train_fraction=0.8)
    counts = (train.withColumn("split", F.lit("train"))
              .unionByName(test.withColumn("split", F.lit("test")))
              .groupBy("split", F.col("label").cast("double").alias("label"))
              .agg(F.count(F.lit(1)).alias("n")))
    leak = (train.select(*KEY).join(test.select(*KEY), KEY, "inner")
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit("overlap").alias("split"), F.lit(-1.0).alias("label"), "n"))
    return counts.unionByName(leak)


# --- step 4: metrics -------------------------------------------------------------

@register("confusion_wide")
def q_confusion_wide(spark, sf_dir):
    """label x predicted-class counts."""
    return metrics.confusion_wide(threshold_predictions(spark, sf_dir))


@register("auc_rank")
def q_auc_rank(spark, sf_dir):
    """exact ROC AUC of the NDVI score (rank statistic, ties 1/2)."""
    a = metrics.auc_rank(threshold_predictions(spark, sf_dir), "label", "score")
    return a.select(F.round("auc", 6).alias("auc"), "n_pos", "n_neg")


@register("f1_weighted")
def q_f1_weighted(spark, sf_dir):
    """F16: support-weighted F1 of the threshold classifier."""
    return metrics.f1_weighted(threshold_predictions(spark, sf_dir)).select(
        F.round("f1_weighted", 6).alias("f1_weighted"))


@register("accuracy_pr")
def q_accuracy_pr(spark, sf_dir):
    """accuracy, positive-class and weighted precision/recall, weighted F1."""
    r = metrics.classification_report(threshold_predictions(spark, sf_dir))
    return r.select(*[F.round(c, 6).alias(c) for c in r.columns])


@register("standardize")
def q_standardize(spark, sf_dir):
    """Z-scores of the balanced features (mean, sample std)."""
    b = feat.drop_invalid(balanced(spark, sf_dir), feat.FEATURES_V1)
    z = metrics.standardize(b, list(feat.FEATURES_V1))
    return z.select(*KEY, F.col("label").cast("double").alias("label"),
                    *[F.round(f"{c}_z", 6).alias(f"{c}_z") for c in feat.FEATURES_V1])


@register("class_weight")
def q_class_weight(spark, sf_dir):
    """Imbalance ratio and advised class weights over pixel labels 0/1."""
    px = derived.pixels(spark, sf_dir).where(F.col("label").isin(0, 1))
    return metrics.class_weights(px)


# --- step 5: grid and tasks ------------------------------------------------------

from terrapix.operators import grid  # noqa: E402


def grid_inputs(spark, sf_dir):
    parcels = derived.parcels(spark, sf_dir, with_rings=False)
    spec = grid.grid_spec(parcels, derived.FIXTURE_GRID_STEP)
    looked = grid.class_lookup(parcels, derived.class_map(spark))
    pairs = grid.cell_parcels(looked, spec)
    return parcels, spec, pairs


@register("extent")
def q_extent(spark, sf_dir):
    """Layer bounds and grid size."""
    parcels = derived.parcels(spark, sf_dir, with_rings=False)
    spec = grid.grid_spec(parcels, derived.FIXTURE_GRID_STEP)
    return grid.extent(parcels).select(
        "*", F.lit(spec.nx).cast("bigint").alias("nx"), F.lit(spec.ny).cast("bigint").alias("ny"))


@register("class_lookup")
def q_class_lookup(spark, sf_dir):
    """Parcels left-joined with the broadcast class map (null = unmapped)."""
    parcels = derived.parcels(spark, sf_dir, with_rings=False)
    return grid.class_lookup(parcels, derived.class_map(spark)).select("parcel_id", "ec_hcat_n", "binary_id")


@register("grid_cells")
def q_grid_cells(spark, sf_dir):
    """Every grid cell with its bbox."""
    parcels = derived.parcels(spark, sf_dir, with_rings=False)
    return grid.grid_cells(spark, grid.grid_spec(parcels, derived.FIXTURE_GRID_STEP))


@register("cell_parcels")
def q_cell_parcels(spark, sf_dir):
    """Closed-edge range join of parcels to cells."""
    _, _, pairs = grid_inputs(spark, sf_dir)
    return pairs.select("i", "j", "parcel_id", "binary_id")


@register("cell_counts")
def q_cell_counts(spark, sf_dir):
    """raw / mapped / crop / non-crop polygons per non-empty cell."""
    _, _, pairs = grid_inputs(spark, sf_dir)
    return grid.cell_counts(pairs)


@register("tasks")
def q_tasks(spark, sf_dir):
    """Kept cells numbered densely in (i, j) order."""
    _, spec, pairs = grid_inputs(spark, sf_dir)
    return grid.make_tasks(grid.cell_counts(pairs), spec)


@register("dataset_stats")
def q_dataset_stats(spark, sf_dir):
    """Global task statistics (per-cell sums and distinct polygons)."""
    _, spec, pairs = grid_inputs(spark, sf_dir)
    tasks = grid.make_tasks(grid.cell_counts(pairs), spec)
    return grid.dataset_stats(tasks, pairs, spec)


# --- step 6: scenes and patches ------------------------------------------------

from terrapix.operators import patches as pt  # noqa: E402
from terrapix.operators import scenes as sc  # noqa: E402

RESAMPLE_OUT = 6  # 4x4 -> 6x6: source coordinates i*3/5 never fall on .5


@register("match_scenes")
def q_match_scenes(spark, sf_dir):
    """First tier with a hit, lowest cloud inside it, per task."""
    return sc.match_scenes(derived.match_tasks(spark, sf_dir), derived.scenes(spark, sf_dir),
                           derived.FIXTURE_WINDOWS, coarse=50.0)


@register("explode_patches")
def q_explode_patches(spark, sf_dir):
    """Patch arrays -> one row per pixel (pixel-major layout)."""
    return pt.explode_patches(derived.patches(spark, sf_dir), 4)


@register("explode_patches_buffer")
def q_explode_patches_buffer(spark, sf_dir):
    """C1 (layout='buffer'): the reshape-without-transpose row layout."""
    return pt.explode_patches(derived.patches(spark, sf_dir), 4, layout="buffer")


@register("pack_patches")
def q_pack_patches(spark, sf_dir):
    """Pixel rows -> patch arrays; checks the round trip exactly."""
    orig = derived.patches(spark, sf_dir)
    packed = pt.pack_patches(pt.explode_patches(orig, 4), 4, 4, 4)
    flat = F.flatten("bands")
    checksum = F.aggregate(F.sequence(F.lit(1), F.size(flat)), F.lit(0.0),
                           lambda acc, i: acc + F.element_at(flat, i) * i)
    o = orig.select("patch_id", F.col("bands").alias("o_bands"), F.col("mask").alias("o_mask"))
    return packed.join(o, "patch_id").select(
        "patch_id", "n_bands", "h", "w",
        F.round(checksum, 6).alias("checksum"),
        F.aggregate("mask", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("mask_ones"),
        ((F.col("bands") == F.col("o_bands")) & (F.col("mask") == F.col("o_mask"))).alias("same"))


@register("mask_stats")
def q_mask_stats(spark, sf_dir):
    """Crop / non-crop pixels, empty mask, shape check per patch."""
    return pt.mask_stats(derived.patches(spark, sf_dir)).drop("shape")


@register("resample_bilinear")
def q_resample_bilinear(spark, sf_dir):
    """C4: per-band linear zoom 4x4 -> 6x6, as pixel rows."""
    r = pt.resample_bilinear(derived.patches(spark, sf_dir).drop("mask"), RESAMPLE_OUT, RESAMPLE_OUT)
    r = r.withColumn("mask", F.array_repeat(F.lit(0), RESAMPLE_OUT * RESAMPLE_OUT))
    e = pt.explode_patches(r, 4).drop("label")
    return e.select("patch_id", "pixel_idx", *[F.round(f"band_{k}", 6).alias(f"band_{k}") for k in range(4)])


@register("resample_nearest")
def q_resample_nearest(spark, sf_dir):
    """Nearest zoom of the mask 4x4 -> 6x6, binarised (> 0.5)."""
    r = pt.resample_nearest(derived.patches(spark, sf_dir), RESAMPLE_OUT, RESAMPLE_OUT)
    return r.select("patch_id", F.posexplode("mask").alias("pixel_idx", "mask")).withColumn(
        "pixel_idx", F.col("pixel_idx").cast("bigint"))


def task_pairs(spark, sf_dir, with_rings=True, shape="box"):
    """Grid tasks and the cell-keyed (cell, parcel) pairs."""
    parcels = derived.parcels(spark, sf_dir, with_rings=with_rings, shape=shape)
    spec = grid.grid_spec(parcels, derived.FIXTURE_GRID_STEP)
    looked = grid.class_lookup(parcels, derived.class_map(spark))
    pairs = grid.cell_parcels(looked, spec)
    tasks = grid.make_tasks(grid.cell_counts(pairs), spec)
    return tasks, pairs, spec


def cell_masks(tasks, pairs, spec, res=1.0):
    """Rasterise per grid cell and attach task ids: burning needs no join,
    and the per-cell counts join the (one row per cell) task table."""
    g = pairs.withColumns(pt.cell_grid_columns(spec, res))
    burned = pt.rasterize_spans(g, key=("i", "j"), size=pt.burn_size(tasks, "n_raw"))
    n = int(-(-spec.step // res))
    tg = tasks.select("task_id", "i", "j", F.lit(n).alias("h"), F.lit(n).alias("w"))
    return pt.mask_counts(burned, tg.select("i", "j", "h", "w"), key=("i", "j")).join(
        tg.select("task_id", "i", "j"), ["i", "j"]).drop("i", "j")


@register("rasterize_boxes")
def q_rasterize_boxes(spark, sf_dir):
    """Burn mapped parcels (pixel-centre rule, later parcel
    wins) on each task's 1-unit grid; per-task mask counts."""
    tasks, pairs, spec = task_pairs(spark, sf_dir)
    return cell_masks(tasks, pairs, spec)


@register("patch_results")
def q_patch_results(spark, sf_dir):
    """Patch production (batch core of the worker): thresholds, class
    mapping, scene choice, rasterisation, mask checks -> one result per task."""
    tasks, pairs, spec = task_pairs(spark, sf_dir)
    masks = cell_masks(tasks, pairs, spec)
    m = sc.match_scenes(tasks.select("task_id", "xmin", "ymin", "xmax", "ymax"),
                        derived.scenes(spark, sf_dir), derived.FIXTURE_WINDOWS, coarse=50.0)
    return pt.patch_status(tasks, m, masks)


# --- step 7: monitor (batch) -----------------------------------------------------

from terrapix.operators import monitor as mon  # noqa: E402
from terrapix.schema import TASK_SCHEMA  # noqa: E402
from terrapix.sources import messages as msg  # noqa: E402


@register("monitor_totals")
def q_monitor_totals(spark, sf_dir):
    """Global counters, success-only pixel totals, crop
    ratio, elapsed time and rate."""
    return mon.monitor_totals(derived.task_results(spark, sf_dir))


@register("monitor_by_worker")
def q_monitor_by_worker(spark, sf_dir):
    """Per-worker counters sorted by worker id."""
    return mon.monitor_by_worker(derived.task_results(spark, sf_dir))


@register("progress")
def q_progress(spark, sf_dir):
    """Running totals after every 20th result in time order."""
    return mon.progress(derived.task_results(spark, sf_dir), every=20)


@register("dedupe_results")
def q_dedupe_results(spark, sf_dir):
    """One (latest) result per task when tasks were processed twice."""
    return mon.dedupe_results(derived.retried_results(spark, sf_dir))


@register("worker_runtime")
def q_worker_runtime(spark, sf_dir):
    """first/last result, run time and rate per worker."""
    return mon.worker_runtime(derived.task_results(spark, sf_dir))


@register("every_nth")
def q_every_nth(spark, sf_dir):
    """The every-5th-task log selection."""
    return mon.every_nth(derived.task_results(spark, sf_dir), 5)


@register("json_roundtrip")
def q_json_roundtrip(spark, sf_dir):
    """Task records -> keyed JSON -> parsed back, flattened."""
    tasks, _, spec = task_pairs(spark, sf_dir, with_rings=False)
    m = grid.task_messages(tasks, spec, derived.FIXTURE_CLASS_MAP)
    frames = msg.encode(m, msg.task_key())
    back = msg.decode(frames, TASK_SCHEMA, keep=("key",)).where("_ok")
    return back.select(
        "key", "task_id",
        *[F.col("bbox")[k].alias(n) for k, n in enumerate(["xmin", "ymin", "xmax", "ymax"])],
        "grid_step", "polygon_count",
        F.col("binary_distribution.crop").alias("crop"), F.col("binary_distribution.non_crop").alias("non_crop"),
        F.size("binary_classes").alias("n_classes"),
        F.col("binary_classes")["1-URGENT"].alias("class_1_urgent"))


# --- step 9: machine learning (rows-only checks: no SQL twin) --------------------

from terrapix.operators import ml  # noqa: E402
from terrapix.plans import training  # noqa: E402


def _fit_v1(spark, sf_dir):
    bal = training.balanced_features(derived.pixels(spark, sf_dir))
    train, test = sampling.hash_split(bal, [0.8, 0.2], 42)
    model = ml.fit_forest(train, feat.FEATURES_V1, ml.FOREST_V1, KEY)
    return model, test


@register("rf_scores")
def q_rf_scores(spark, sf_dir):
    """K1-K5: 80-tree forest on the balanced split; test-set predictions."""
    model, test = _fit_v1(spark, sf_dir)
    return ml.score(model, test).select(*KEY, "label", "prediction", F.round("p1", 6).alias("p1"))


@register("rf_importance")
def q_rf_importance(spark, sf_dir):
    """K6, H2: feature importances, ascending."""
    model, _ = _fit_v1(spark, sf_dir)
    return ml.importances(model, feat.FEATURES_V1)


@register("rf_v2_scores")
def q_rf_v2_scores(spark, sf_dir):
    """K3 (notebook variant): 6 features, J5 balance + split, 100 trees depth 10.
    The tagged rows are written once: key hashes are not computed again to score."""
    path = _folder(spark, "rf-v2-rows")
    tagged = sampling.balance_tagged(features_v2(spark, sf_dir), seed=42)
    tagged.select(*KEY, "label", *feat.FEATURES_V2, "_split").write.parquet(path)
    rows = spark.read.parquet(path)
    train, test = (rows.where(F.col("_split") == x).drop("_split") for x in ("train", "test"))
    model = ml.fit_forest(train, feat.FEATURES_V2, ml.FOREST_V2, KEY)
    return ml.score(model, test).select(*KEY, "label", "prediction", F.round("p1", 6).alias("p1"))


@register("lr_weighted")
def q_lr_weighted(spark, sf_dir):
    """Class-weighted logistic regression on the unbalanced features."""
    f = feat.drop_invalid(features_v1(spark, sf_dir), feat.FEATURES_V1)
    train, test = sampling.hash_split(f, [0.8, 0.2], 42)
    w = metrics.class_weights(train, threshold=1.0)
    with ml.kept(metrics.with_weight(train, w).select("label", "weight", *feat.FEATURES_V1)) as rows:
        model = ml.logistic_pipeline(feat.FEATURES_V1, "weight").fit(rows)
    return ml.score(model, test).select(*KEY, "label", "prediction", F.round("p1", 6).alias("p1"))


# --- step 10: geometry and worker-path extras ---------------------------------

from terrapix.functions.geo import to_utm  # noqa: E402
from terrapix.plans import patch_production as pp  # noqa: E402


@register("utm_project")
def q_utm_project(spark, sf_dir):
    """Parcel corners (fixture degrees) -> UTM zone 30 metres."""
    p = derived.parcels(spark, sf_dir, with_rings=False)
    lon = F.lit(-9.0) + F.col("xmin") / 200.0
    lat = F.lit(36.0) + F.col("ymin") / 200.0
    e, n = to_utm(lon, lat, 30)
    return p.select("parcel_id", F.round(e, 2).alias("easting"), F.round(n, 2).alias("northing"))


@register("rasterize_polygons")
def q_rasterize_polygons(spark, sf_dir):
    """Scanline even-odd burn of rhombus parcels (non-rectangular
    rings) on each task's grid; per-task mask counts."""
    tasks, pairs, spec = task_pairs(spark, sf_dir, shape="diamond")
    return cell_masks(tasks, pairs, spec)


@register("worker_results")
def q_worker_results(spark, sf_dir):
    """E3, L1 batch core: task messages (bbox) -> bbox range join with parcels
    -> thresholds, scene, mask -> result per task."""
    tasks, _, spec = task_pairs(spark, sf_dir, with_rings=False)
    msgs = grid.task_messages(tasks, spec, derived.FIXTURE_CLASS_MAP)
    parcels = grid.class_lookup(derived.parcels(spark, sf_dir), derived.class_map(spark))
    r = pp.produce(msgs, parcels, derived.scenes(spark, sf_dir), derived.FIXTURE_WINDOWS,
                   res=1.0, parcel_cell=derived.FIXTURE_GRID_STEP, scene_cell=50.0, worker_id="1")
    return r.select("task_id", "status", "polygon_count", "crop_pixels", "noncrop_pixels")


def _production(spark, sf_dir):
    tasks, _, spec = task_pairs(spark, sf_dir, with_rings=False)
    msgs = grid.task_messages(tasks, spec, derived.FIXTURE_CLASS_MAP)
    parcels = grid.class_lookup(derived.parcels(spark, sf_dir), derived.class_map(spark))
    rasters = derived.task_rasters(spark, sf_dir, tasks)
    # every message twice: the bus delivers at least once
    made = pp.produce_all(msgs.unionByName(msgs), parcels, derived.scenes(spark, sf_dir), derived.FIXTURE_WINDOWS, res=1.0,
                          parcel_cell=derived.FIXTURE_GRID_STEP, scene_cell=50.0, worker_id="1", pixel_path="pixels",
                          rasters=rasters, n_bands=4)
    return made, rasters


@register("ready_events")
def q_ready_events(spark, sf_dir):
    """Image-ready records of the worker's successful results, with the
    shape of each patch's own grid, from task messages that come twice."""
    made, _ = _production(spark, sf_dir)
    return msg.ready_events(made.results).select(
        "task_id", "worker_id", "s3_path", F.col("shape")[0].alias("c"), F.col("shape")[1].alias("h"), F.col("shape")[2].alias("w"))


@register("worker_pixels")
def q_worker_pixels(spark, sf_dir):
    """Every pixel row the worker writes, as one line per patch:
    rows, labels and index-weighted sums of the bands."""
    made, rasters = _production(spark, sf_dir)
    px = made.pixels(rasters, 4)
    return px.groupBy("patch_id").agg(
        F.count(F.lit(1)).alias("n_pixels"), F.sum("label").alias("crop_pixels"), F.sum(F.col("pixel_idx") * F.col("label")).alias("label_at"),
        *[F.round(F.sum(F.col(f"band_{k}") * (F.col("pixel_idx") + 1)), 4).alias(f"band_{k}") for k in range(4)])


@register("pack_patches_sized")
def q_pack_patches_sized(spark, sf_dir):
    """Patches of differing sizes from pixel rows with repeated,
    missing and surplus pixels; values stay at their index."""
    rows, sizes = derived.sized_patch_pixels(spark, sf_dir)
    p = pt.pack_patches(rows, 3, sizes=sizes)
    def weighted(k):
        return F.aggregate(F.sequence(F.lit(1), F.size(F.col("bands")[k])), F.lit(0.0), lambda acc, i: acc + F.element_at(F.col("bands")[k], i) * i)
    return p.select("patch_id", "h", "w", "n_missing", "n_extra", "n_conflicts", *[F.round(weighted(k), 6).alias(f"band_{k}") for k in range(3)],
                    F.aggregate("mask", F.lit(0).cast("bigint"), lambda acc, x: acc + x).alias("mask_ones"))


@register("class_usage")
def q_class_usage(spark, sf_dir):
    """per class, valid rows available, rows kept by the balancing sample, % used."""
    full = feat.drop_invalid(features_v1(spark, sf_dir), feat.FEATURES_V1)
    used = sampling.stratified_sample(full, {1: 0.1, 0: 0.025}, seed=42)
    return profile.class_usage(full, used)


INVENTORY = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings"]


@register("inventory")
def q_inventory(spark, sf_dir):
    """Rows of each Parquet table of the data folder."""
    parts = [derived.table(spark, sf_dir, t).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("name"), "n_rows") for t in INVENTORY]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- machine learning and sources, as rows that a twin can check -----------------

import uuid  # noqa: E402

from pyspark.ml import Pipeline  # noqa: E402
from pyspark.ml.functions import vector_to_array  # noqa: E402

from terrapix.functions.curve import box_position  # noqa: E402
from terrapix.functions.spectral import name_bands  # noqa: E402
from terrapix.session import scratch_path  # noqa: E402
from terrapix.sources import files  # noqa: E402


def _folder(spark, name):
    return scratch_path(spark, f"queries/{name}-{uuid.uuid4().hex}")


@register("ml_standardize")
def q_ml_standardize(spark, sf_dir):
    """Assembler and scaler of the pipeline give z-scores."""
    b = balanced(spark, sf_dir)
    model = Pipeline(stages=[ml.assembler(feat.FEATURES_V1), ml.scaler()]).fit(b)
    z = model.transform(b).withColumn("_z", vector_to_array("scaled_features"))
    return z.select(*KEY, F.col("label").cast("double").alias("label"),
                    *[F.round(F.col("_z")[k], 6).alias(f"{c}_z") for k, c in enumerate(feat.FEATURES_V1)])


@register("rf_test_rows")
def q_rf_test_rows(spark, sf_dir):
    """K4, K5: the forest scores every valid test row once, with a class."""
    model, test = _fit_v1(spark, sf_dir)
    s = ml.score(model, test)
    ok = F.col("prediction").isin(0.0, 1.0) & (F.col("p1") >= 0) & (F.col("p1") <= 1) & ((F.col("p1") > 0.5) == (F.col("prediction") == 1.0))
    tie = F.abs(F.col("p1") - 0.5) < 1e-12
    return s.groupBy(*KEY, F.col("label").cast("double").alias("label")).agg(F.count(F.lit(1)).alias("n"), F.min(ok | tie).alias("ok"))


@register("rf_importance_rows")
def q_rf_importance_rows(spark, sf_dir):
    """K6, H2: an importance for every feature, in [0, 1], summing to 1, over
    the rows that trained the forest."""
    model, _ = _fit_v1(spark, sf_dir)
    i = ml.importances(model, feat.FEATURES_V1)
    n = sampling.hash_split(feat.drop_invalid(balanced(spark, sf_dir), feat.FEATURES_V1), [0.8, 0.2], 42)[0].count()
    return i.agg(F.count(F.lit(1)).alias("features"), F.round(F.sum("importance"), 6).alias("total"),
                 F.min((F.col("importance") >= 0) & (F.col("importance") <= 1)).alias("ok")).withColumn("n_train", F.lit(n).cast("bigint"))


@register("lr_weight_rows")
def q_lr_weight_rows(spark, sf_dir):
    """The training rows of the weighted regression with their weights."""
    f = feat.drop_invalid(features_v1(spark, sf_dir), feat.FEATURES_V1)
    train, _ = sampling.hash_split(f, [0.8, 0.2], 42)
    w = metrics.with_weight(train, metrics.class_weights(train, threshold=1.0))
    return w.select(*KEY, F.col("label").cast("double").alias("label"), F.round("weight", 6).alias("weight"))


@register("parcels_source")
def q_parcels_source(spark, sf_dir):
    """The parcel layer written and read through the source, box filter
    pushed; closed edges."""
    path = _folder(spark, "parcels")
    files.write_parcels(derived.parcels(spark, sf_dir, with_rings=False), path, derived.FIXTURE_GRID_STEP)
    return files.read_parcels(spark, path, bbox=(200.0, 150.0, 900.0, 700.0)).select("parcel_id", "ec_hcat_n", *["xmin", "ymin", "xmax", "ymax"])


@register("patches_source")
def q_patches_source(spark, sf_dir):
    """Patches with missing values archived, read back and
    filled."""
    path = _folder(spark, "patches")
    p = derived.patches(spark, sf_dir)
    holes = p.withColumn("bands", F.transform("bands", lambda b: F.transform(b, lambda v: F.when(v < -0.5, F.lit(None)).otherwise(v))))
    files.write_patch_archive(holes, path)
    px = pt.explode_patches(pt.fill_missing(files.read_patches(spark, path)), 4)
    return px.select("patch_id", "pixel_idx", "label", *[f"band_{k}" for k in range(4)])


@register("patches_u16")
def q_patches_u16(spark, sf_dir):
    """Patches of unsigned 16-bit bands archived as 16-bit integers,
    read back and exploded."""
    path = _folder(spark, "patches-u16")
    whole = F.transform("bands", lambda b: F.transform(b, lambda v: F.floor(v * 1024).cast("double") + 32768))
    files.write_patch_archive(derived.patches(spark, sf_dir).withColumn("bands", whole), path, bits16=True)
    return pt.explode_patches(files.read_patches(spark, path), 4).select("patch_id", "pixel_idx", "label", *[f"band_{k}" for k in range(4)])


@register("parcel_curve")
def q_parcel_curve(spark, sf_dir):
    """Each parcel's position on the space-filling curve of the layout."""
    cell = derived.FIXTURE_GRID_STEP
    return derived.parcels(spark, sf_dir, with_rings=False).select("parcel_id", box_position(cell).alias("curve_position"))


@register("file_inventory")
def q_file_inventory(spark, sf_dir):
    """The data folder's Parquet files by name, with sizes and
    running bytes, from the listing alone."""
    return files.inventory_order(files.inventory(spark, sf_dir), sf_dir)


@register("scenes_source")
def q_scenes_source(spark, sf_dir):
    """A10: the scene catalog written and read through the checked reader."""
    path = _folder(spark, "scenes")
    files.write_boxes(derived.scenes(spark, sf_dir), path, derived.FIXTURE_GRID_STEP)
    return files.read_scenes(spark, path)


@register("pixels_source")
def q_pixels_source(spark, sf_dir):
    """Pixel rows written by task bucket (twice: a replay) and
    read back with their band names."""
    path = _folder(spark, "pixels")
    px = derived.pixels(spark, sf_dir).withColumn("task_id", F.regexp_extract("patch_id", r"task_(\d+)_", 1).cast("bigint"))
    for _ in range(2):
        pp.write_pixels(px, path, batch=0)
    return name_bands(files.read_pixels(spark, path).select("patch_id", "pixel_idx", "label", "band_1", "band_2", "band_4", "band_8"))


@register("dedupe_pixels")
def q_dedupe_pixels(spark, sf_dir):
    """Only the pixels of each task's winning result stay, when two workers
    produced the same task."""
    px = derived.pixels(spark, sf_dir)
    return mon.dedupe_pixels(px, derived.pixel_results(px))


@register("dedupe_pixels_batches")
def q_dedupe_pixels_batches(spark, sf_dir):
    """The same worker left a patch in two batches of the pixel table; the
    batch of the winning result stays, once."""
    px = derived.pixels(spark, sf_dir)
    task = F.regexp_extract("patch_id", r"task_(\d+)_", 1).cast("bigint")
    again = px.where(task % 3 == 0).withColumn("band_1", F.col("band_1") + 1)
    both = px.withColumn("batch", F.lit(0)).unionByName(again.withColumn("batch", F.lit(2)))
    first = derived.pixel_results(px).withColumn("batch", F.lit(0))
    # the second delivery's message came later for even tasks, before the first for odd ones
    shift = F.when(F.col("task_id") % 2 == 0, 100).otherwise(-100)
    second = first.where(F.col("task_id") % 3 == 0).withColumns({
        "batch": F.lit(2), "ts": F.timestamp_seconds(F.unix_seconds("ts") + shift)})
    return mon.dedupe_pixels(both, first.unionByName(second))


# --- rasters cut from scenes ------------------------------------------------------

from terrapix.operators import mosaic  # noqa: E402


def _cut(spark, sf_dir):
    tasks, path = derived.tile_tasks(spark, sf_dir), _folder(spark, "tiles")
    mosaic.write_tiles(derived.scene_tiles(tasks), path)
    return tasks, mosaic.read_tiles(spark, path, tasks)


@register("scene_pixels")
def q_scene_pixels(spark, sf_dir):
    """Every task's raster cut out of its scene's tiles on a 1-unit grid,
    a band of double pixel size brought to it, fill 0; a line of sums a task."""
    tasks, tiles = _cut(spark, sf_dir)
    px = mosaic.cut_pixels(tasks, tiles, 1.0, derived.TILE_SIZE, derived.TILE_BANDS, derived.TILE_COARSE)
    return px.groupBy("task_id").agg(
        F.count(F.lit(1)).alias("n_pixels"), F.sum("pixel_idx").alias("at"),
        *[F.sum(F.col(f"band_{k}") * (F.col("pixel_idx") + 1)).cast("bigint").alias(f"band_{k}") for k in range(derived.TILE_BANDS)])


@register("scene_rasters")
def q_scene_rasters(spark, sf_dir):
    """The same rasters as arrays, as the worker takes them."""
    tasks, tiles = _cut(spark, sf_dir)
    r = mosaic.cut_rasters(tasks, tiles, 1.0, derived.TILE_SIZE, derived.TILE_BANDS, derived.TILE_COARSE)

    def weighted(k):
        return F.aggregate(F.transform(F.col("bands")[k], lambda v, i: v * (i + 1)), F.lit(0.0), lambda a, v: a + v).cast("bigint")
    return r.select("task_id", "h", "w", *[weighted(k).alias(f"band_{k}") for k in range(derived.TILE_BANDS)])


# --- streams over whole derived tables -------------------------------------------

from terrapix.schema import READY_SCHEMA, RESULT_SCHEMA  # noqa: E402
from terrapix.streaming.monitor_stream import run_monitor_stream  # noqa: E402
from terrapix.streaming.patch_stream import run_patch_stream  # noqa: E402
from terrapix.streaming.progress_stream import run_progress_stream  # noqa: E402
from terrapix.streaming.score_stream import run_score_stream  # noqa: E402


class NdviThreshold:
    """The threshold classifier in a model's place."""

    def transform(self, df):
        return feat.threshold_predict(feat.drop_invalid(df, feat.FEATURES_V1), "ndvi", 0.2)


def ready_of(px, table, batch):
    """Ready events of a derived pixel table: shape [4, 1, rows of the patch]."""
    n = px.groupBy("patch_id").agg(F.count(F.lit(1)).cast("int").alias("n"))
    task = F.regexp_extract("patch_id", r"task_(\d+)_", 1).cast("bigint")
    return n.select(task.alias("task_id"), F.regexp_extract("patch_id", r"_worker_(.+)", 1).alias("worker_id"), F.lit(None).cast("array<double>").alias("bbox"),
                    F.concat(F.lit(f"{table}/batch={batch}/"), "patch_id").alias("s3_path"), F.array(F.lit(4), F.lit(1), "n").alias("shape"), F.lit(0.0).alias("timestamp"))


@register("score_stream")
def q_score_stream(spark, sf_dir):
    """The scoring stream over a pixel table that grows in three
    batches, each announced before, with or after its pixels; the confusion and the
    exact AUC that the last batch left."""
    base = _folder(spark, "score-stream")
    table, src, out = f"{base}/pixels", f"{base}/ready", f"{base}/out"
    px = derived.pixels(spark, sf_dir).withColumn("task_id", F.regexp_extract("patch_id", r"task_(\d+)_", 1).cast("bigint"))
    for k in range(3):
        pp.write_pixels(px.where(F.col("task_id") % 3 == k), table, batch=k, buckets=8 * (k + 1))
        soon = (k + 1) % 3  # announced a batch early, but for the first
        msg.write_json_lines(msg.encode(ready_of(px.where(F.col("task_id") % 3 == soon), table, soon)), src)
        stream = msg.valid(msg.read_json_stream(spark, src, READY_SCHEMA))
        run_score_stream(stream, table, NdviThreshold(), f"{base}/checkpoint", out).awaitTermination()
    last = spark.read.parquet(f"{out}/report").agg(F.max("batch")).first()[0]
    auc = spark.read.parquet(f"{out}/report/batch={last}").select(F.round("auc", 6).alias("auc"), "n_pos", "n_neg")
    return spark.read.parquet(f"{out}/confusion/batch={last}").crossJoin(auc)  # one row


@register("worker_stream")
def q_worker_stream(spark, sf_dir):
    """The patch stream over task messages that come twice, the second
    time together with the rest; every task has one result (a failed one is tried
    again, the latest counts)."""
    base = _folder(spark, "worker-stream")
    tasks, _, spec = task_pairs(spark, sf_dir, with_rings=False)
    msgs = msg.encode(grid.task_messages(tasks, spec, derived.FIXTURE_CLASS_MAP), msg.task_key())
    parcels = grid.class_lookup(derived.parcels(spark, sf_dir), derived.class_map(spark))
    first = F.crc32("value") % 2 == 0
    for part in (msgs.where(first), msgs):
        msg.write_json_lines(part, f"{base}/tasks")
        run_patch_stream(msg.read_json_stream(spark, f"{base}/tasks", TASK_SCHEMA), parcels, derived.scenes(spark, sf_dir), derived.FIXTURE_WINDOWS, f"{base}/out",
                         f"{base}/checkpoint", res=1.0, parcel_cell=derived.FIXTURE_GRID_STEP, scene_cell=50.0, worker_id="1").awaitTermination()
    made = spark.read.parquet(f"{base}/out/results").select("task_id", "ts", "worker_id", "status", "polygon_count", "crop_pixels", "noncrop_pixels")
    return mon.dedupe_results(made).drop("ts", "worker_id")


def _result_stream(spark, sf_dir, base):
    res = derived.task_results(spark, sf_dir)
    msg.write_json_lines(msg.encode(res.withColumn("ts", F.col("ts").cast("timestamp"))), f"{base}/in")
    return msg.valid(msg.read_json_stream(spark, f"{base}/in", RESULT_SCHEMA))


@register("monitor_stream")
def q_monitor_stream(spark, sf_dir):
    """The monitor over the whole result topic as a stream; the
    per-worker counters that its last batch left."""
    base = _folder(spark, "monitor-stream")
    run_monitor_stream(_result_stream(spark, sf_dir, base), f"{base}/out", f"{base}/checkpoint").awaitTermination()
    t = spark.read.parquet(f"{base}/out/by_worker")
    t = t.where(F.col("batch") == t.agg(F.max("batch")).first()[0])
    return t.select("worker_id", "tasks", "success", "skipped", "failed", "patches", "crop_pixels", "noncrop_pixels")


@register("progress_stream")
def q_progress_stream(spark, sf_dir):
    """Snapshots after every 20th message of the result topic as a stream."""
    base = _folder(spark, "progress-stream")
    run_progress_stream(_result_stream(spark, sf_dir, base), f"{base}/out", f"{base}/checkpoint", every=20).awaitTermination()
    ts = derived.task_results(spark, sf_dir).schema["ts"].dataType
    return spark.read.parquet(f"{base}/out/snapshots").drop("batch").withColumn("ts", F.col("ts").cast(ts))
