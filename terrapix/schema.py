"""Schemas of the data model and fixed values the results depend on."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the original pipeline's for equal results)
# ---------------------------------------------------------------------------

# Land-cover class -> binary label (0 = non-crop, 1 = crop), 63 entries,
# in the order of the original mapping file.
CLASS_MAP: dict[str, int] = {
    "other_tree_wood_forest": 0,
    "tree_wood_forest": 0,
    "oak": 0,
    "birch": 0,
    "populus": 0,
    "willows_osiers": 0,
    "eucalyptus": 0,
    "afforestation_reforestation": 0,
    "poaceae_grasses": 0,
    "pasture_meadow_grassland_grass": 0,
    "shrubberries_shrubs": 0,
    "fallow_land_not_crop": 0,
    "unmaintained": 0,
    "not_known_and_other": 0,
    "nurseries_nursery": 0,
    "kitchen_gardens": 0,
    "orchards_fruits": 1,
    "unspecified_orchards_fruits": 1,
    "vineyards_wine_vine_rebland_grapes": 1,
    "olive_plantations": 1,
    "citrus_plantations": 1,
    "berries_berry_species": 1,
    "cherry_cherries": 1,
    "peach": 1,
    "apricots": 1,
    "nectarine": 1,
    "plums": 1,
    "fig": 1,
    "pomegranate": 1,
    "kiwi": 1,
    "quinces": 1,
    "medlar_loquat": 1,
    "apples": 1,
    "pears": 1,
    "blueberry": 1,
    "blackberry": 1,
    "raspberry_raspberries": 1,
    "gooseberry_gooseberries_cranberries": 1,
    "elder_elderberry": 1,
    "almond": 1,
    "hazelnuts_hazel": 1,
    "walnuts": 1,
    "pistachio": 1,
    "sweet_chestnuts": 1,
    "carob": 1,
    "avocado": 1,
    "common_soft_wheat": 1,
    "durum_hard_wheat": 1,
    "barley": 1,
    "oats": 1,
    "rye": 1,
    "spelt": 1,
    "emmer": 1,
    "triticale": 1,
    "grain_maize_corn_popcorn": 1,
    "rice": 1,
    "millet_sorghum": 1,
    "buckwheat": 1,
    "quinoa": 1,
    "teff": 1,
    "other_cereals": 1,
    "meslin": 1,
    "cereal": 1,
}

# Bands requested from the scene, in request order.
REQUESTED_BANDS = ["blue", "green", "red", "nir", "rededge1",
                   "rededge2", "rededge3", "nir08", "swir16", "swir22"]

# Band order the trainer assumes (alphabetical stacking): index -> name.
TRAINER_BAND_ORDER = ["blue", "green", "nir", "nir08", "red",
                      "rededge1", "rededge2", "rededge3", "swir16", "swir22"]

# Scene search tiers: (season, "start/end" inclusive dates, max cloud % strictly below),
# listed in priority order (first tier with a hit wins).
SEARCH_WINDOWS = [
    ("peak_spring", "2023-04-15/2023-06-15", 10),
    ("early_spring", "2023-03-01/2023-04-14", 20),
    ("early_summer", "2023-06-16/2023-07-30", 20),
    ("full_year", "2023-01-01/2023-12-31", 30),
]

GRID_STEP_DEG = 0.05          # task cell size in degrees
MIN_POLYGONS_TASK = 3         # raw polygons for a cell to become a task
MIN_POLYGONS_PATCH = 5        # raw polygons for a task to be rasterised
REFLECTANCE_SCALE = 10000.0   # digital number -> reflectance
INDEX_EPS = 0.001             # guard of the normalised differences
RAW_INDEX_EPS = 1e-8          # additive epsilon of the raw-value form
UTM_ZONE = 30                 # raster CRS EPSG:32630
PATCH_SIZE = 256              # optional resample target

# Result statuses, in the order the checks run (first failing check wins).
STATUS_SUCCESS = "success"
STATUS_FEW_POLYGONS = "skipped_few_polygons"
STATUS_NO_BINARY = "skipped_no_binary_classes"
STATUS_FAILED_DOWNLOAD = "failed_download"
STATUS_INVALID_SHAPE = "invalid_image_shape"
STATUS_EMPTY_MASK = "failed_empty_mask"
STATUS_FAILED = "failed"

LABEL_NAMES = {0: "Non-Crop", 1: "Crop"}


@dataclass(frozen=True)
class BandSpec:
    """Which ``band_k`` column holds which physical band.

    The default is the trainer's mapping (alphabetical stacking). Whether the
    stacking keeps request order is not decidable from the data, so it is an
    explicit parameter instead of a hidden assumption.
    """
    order: tuple[str, ...] = tuple(TRAINER_BAND_ORDER)

    def index(self, name: str) -> int:
        return self.order.index(name)

    def column(self, name: str) -> str:
        return f"band_{self.index(name)}"

    @property
    def red(self) -> str:
        return self.column("red")

    @property
    def nir(self) -> str:
        return self.column("nir")

    @property
    def swir(self) -> str:
        return self.column("swir16")

    @property
    def green(self) -> str:
        return self.column("green")


DEFAULT_BANDS = BandSpec()
REQUEST_ORDER_BANDS = BandSpec(tuple(REQUESTED_BANDS))


@dataclass(frozen=True)
class SearchWindow:
    priority: int
    season: str
    d0: str          # inclusive start (date or timestamp literal)
    d1: str          # exclusive end
    max_cloud: float  # strictly below


def windows_from_intervals(spec=SEARCH_WINDOWS) -> list[SearchWindow]:
    """Turn ("name", "start/end", max) tiers with an inclusive end date into
    half-open windows [start, end + 1 day)."""
    import datetime as _dt
    out = []
    for k, (season, interval, cloud) in enumerate(spec, start=1):
        a, b = interval.split("/")
        end = _dt.date.fromisoformat(b) + _dt.timedelta(days=1)
        out.append(SearchWindow(k, season, a, end.isoformat(), float(cloud)))
    return out


# ---------------------------------------------------------------------------
# Message and table schemas
# ---------------------------------------------------------------------------

BBOX = T.ArrayType(T.DoubleType())

TASK_SCHEMA = T.StructType([
    T.StructField("task_id", T.LongType()),
    T.StructField("bbox", BBOX),
    T.StructField("grid_step", T.DoubleType()),
    T.StructField("polygon_count", T.LongType()),
    T.StructField("binary_distribution", T.StructType([
        T.StructField("crop", T.LongType()),
        T.StructField("non_crop", T.LongType()),
    ])),
    T.StructField("binary_classes", T.MapType(T.StringType(), T.IntegerType())),
])

RESULT_SCHEMA = T.StructType([
    T.StructField("task_id", T.LongType()),
    T.StructField("worker_id", T.StringType()),
    T.StructField("bbox", BBOX),
    T.StructField("status", T.StringType()),
    T.StructField("s3_path", T.StringType()),
    T.StructField("polygon_count", T.LongType()),
    T.StructField("crop_pixels", T.LongType()),
    T.StructField("noncrop_pixels", T.LongType()),
    T.StructField("error", T.StringType()),
    T.StructField("ts", T.TimestampType()),
])

READY_SCHEMA = T.StructType([
    T.StructField("task_id", T.LongType()),
    T.StructField("worker_id", T.StringType()),
    T.StructField("bbox", BBOX),
    T.StructField("s3_path", T.StringType()),
    T.StructField("shape", T.ArrayType(T.IntegerType())),
    T.StructField("timestamp", T.DoubleType()),
])

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])

PARCEL_SCHEMA = T.StructType([
    T.StructField("parcel_id", T.LongType()),
    T.StructField("ec_hcat_n", T.StringType()),
    T.StructField("xmin", T.DoubleType()),
    T.StructField("ymin", T.DoubleType()),
    T.StructField("xmax", T.DoubleType()),
    T.StructField("ymax", T.DoubleType()),
    T.StructField("rings", T.ArrayType(T.ArrayType(POINT))),
    T.StructField("crs", T.StringType()),
])

PATCH_SCHEMA = T.StructType([
    T.StructField("patch_id", T.StringType()),
    T.StructField("n_bands", T.IntegerType()),
    T.StructField("h", T.IntegerType()),
    T.StructField("w", T.IntegerType()),
    T.StructField("bands", T.ArrayType(T.ArrayType(T.DoubleType()))),
    T.StructField("mask", T.ArrayType(T.IntegerType())),
])


@dataclass
class GridSpec:
    """Regular grid: origin, step and cell counts (half-open ``arange``)."""
    x0: float
    y0: float
    step: float
    nx: int
    ny: int
    extra: dict = field(default_factory=dict)
