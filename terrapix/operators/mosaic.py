"""Rasters cut out of scenes.

A scene is stored as square tiles on one pixel grid: tile (x, y) of a scene holds
the pixels [x*size, (x+1)*size) by [y*size, (y+1)*size), counted from the raster
system's origin eastwards and northwards, each band as an array of rows from north
to south.  Bands named ``coarse`` have pixels twice as wide and are stored at half
the size.  A task's raster is the box of pixels that its own box touches, cut out
of the tiles of its scene; what no tile covers is fill.

The join is an equi-join: a task is exploded into the tiles it covers (its box
over the tile size, whatever the archive holds), left-joined to the tile table on
(scene, x, y), and every tile hands out its own part of the raster.  Tiles do not
overlap, so each pixel comes out once, with all bands, in the task that read the
tile: no pixel is shuffled or grouped.  Cells without a tile hand out fill.

Whole rasters (``cut_rasters``) are cut where their tiles are: tasks go to a block of
tiles by their lower left corner, tiles to the blocks that need them, and a sorted
partition lays a block's tiles on a canvas and cuts its tasks out of it one by one.
Tiles are shuffled, pixels of rasters never; a block with many tasks is dealt in
pieces.

``write_tiles`` keeps tiles in folders by a hash of the scene, ordered by scene and
place inside, so a batch of tasks reads the folders of its scenes only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BUCKETS = 64


def _bucket(scene: Column, buckets: int) -> Column:
    return F.pmod(F.crc32(scene.cast("string").cast("binary")), F.lit(buckets)).cast("int")


def write_tiles(tiles: DataFrame, path: str, buckets: int = BUCKETS, mode: str = "overwrite") -> None:
    """Tiles (scene_id, tile_x, tile_y, bands) as Parquet in ``scene_bucket``
    folders; a hot scene is spread over files by its places."""
    t = tiles.withColumn("scene_bucket", _bucket(F.col("scene_id"), buckets))
    (t.repartition("scene_bucket", "scene_id", F.floor(F.col("tile_x") / 16), F.floor(F.col("tile_y") / 16))
     .sortWithinPartitions("scene_bucket", "scene_id", "tile_x", "tile_y")
     .write.mode(mode).option("compression", "zstd").partitionBy("scene_bucket").parquet(path))


def read_tiles(spark: SparkSession, path: str, tasks: DataFrame | None = None, buckets: int = BUCKETS) -> DataFrame:
    """The tile table; with ``tasks`` (scene_id) only the folders of their scenes."""
    tiles = spark.read.parquet(path)
    missing = [c for c in ("scene_id", "tile_x", "tile_y", "bands", "scene_bucket") if c not in tiles.columns]
    if missing:
        raise ValueError(f"{path}: columns missing: {missing}")
    if tasks is None:
        return tiles
    # at most one row a bucket
    needed = [r[0] for r in tasks.where("scene_id IS NOT NULL").select(_bucket(F.col("scene_id"), buckets)).distinct().collect()]
    return tiles.where(F.col("scene_bucket").isin(needed))


def raster_grid(tasks: DataFrame, res: float) -> DataFrame:
    """The pixels that a task's box touches: _x0, _x1, _y0, _y1 (half open, in
    pixels of the raster system) and the raster's h and w. Boxes without area, or
    with missing corners, have no pixels."""
    r = F.lit(float(res))
    t = tasks.withColumns({"_x0": F.floor(F.col("xmin") / r), "_x1": F.ceil(F.col("xmax") / r), "_y0": F.floor(F.col("ymin") / r), "_y1": F.ceil(F.col("ymax") / r)})
    return t.withColumns({"h": F.greatest(F.col("_y1") - F.col("_y0"), F.lit(0)).cast("int"), "w": F.greatest(F.col("_x1") - F.col("_x0"), F.lit(0)).cast("int")})


def cut_pixels(tasks: DataFrame, tiles: DataFrame, res: float, size: int, n_bands: int, coarse: tuple[int, ...] = (), fill: int = 0) -> DataFrame:
    """Pixel rows (task_id, pixel_idx, band_0 ..) of the tasks' rasters, row-major
    from north to south.

    ``tasks``: task_id, scene_id (null: everything is fill), xmin .. ymax in the
    raster system; ``tiles``: scene_id, tile_x, tile_y, bands; ``size``: pixels of a
    tile's side (even when there are coarse bands). Missing values are fill; a tile
    with too few bands, or values, is fill there."""
    if coarse and size % 2:
        raise ValueError("tiles with coarse bands need an even size")
    s = F.lit(size)
    g = raster_grid(tasks.select("task_id", "scene_id", "xmin", "ymin", "xmax", "ymax"), res).where("h > 0 AND w > 0")

    def covered(a: str, b: str) -> Column:
        return F.explode(F.sequence(F.floor(F.col(a) / s), F.floor((F.col(b) - 1) / s)))
    cells = g.withColumn("tile_x", covered("_x0", "_x1")).withColumn("tile_y", covered("_y0", "_y1"))
    one = tiles.select("scene_id", F.col("tile_x").cast("bigint").alias("tile_x"), F.col("tile_y").cast("bigint").alias("tile_y"), "bands")
    j = cells.join(one, ["scene_id", "tile_x", "tile_y"], "left")
    # the tile's part of the raster: columns [_a, _b], rows [_c, _d] (northwards)
    j = j.withColumns({"_a": F.greatest("_x0", F.col("tile_x") * s), "_b": F.least("_x1", (F.col("tile_x") + 1) * s) - 1,
                       "_c": F.greatest("_y0", F.col("tile_y") * s), "_d": F.least("_y1", (F.col("tile_y") + 1) * s) - 1})
    half = size // 2
    # a row for each pixel of the part, its values picked out of the tile's bands:
    # plain arithmetic on the offset, no arrays are built
    j = j.withColumn("_wide", F.col("_b") - F.col("_a") + 1)
    j = j.withColumn("_n", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_wide") * (F.col("_d") - F.col("_c") + 1) - 1)))
    north, east = F.expr("_n div _wide"), F.col("_n") % F.col("_wide")
    y, x = F.col("_d") - north, F.col("_a") + east
    row = ((F.col("tile_y") + 1) * s - 1 - y).cast("int")
    column = (x - F.col("tile_x") * s).cast("int")  # of the tile

    def value(k: int) -> Column:
        at = F.expr("_row div 2 * {0} + _column div 2".format(half)).cast("int") if k in coarse else F.col("_row") * size + F.col("_column")
        return F.coalesce(F.get(F.get(F.col("bands"), F.lit(k)), at), F.lit(fill)).alias(f"band_{k}")
    start = (F.col("_y1") - 1 - y) * F.col("w") + x - F.col("_x0")
    px = j.select("task_id", start.alias("pixel_idx"), "bands", row.alias("_row"), column.alias("_column"))
    return px.select("task_id", "pixel_idx", *[value(k) for k in range(n_bands)])


def _values(name: str) -> Column:
    return F.transform("_p", lambda v: v[name].cast("double"))


def _packed(tasks: DataFrame, tiles: DataFrame, res: float, size: int, n_bands: int, coarse: tuple[int, ...], fill: int) -> DataFrame:
    """Rasters from pixel rows that meet by task."""
    px = cut_pixels(tasks, tiles, res, size, n_bands, coarse, fill)
    names = [f"band_{b}" for b in range(n_bands)]
    packed = px.groupBy("task_id").agg(F.array_sort(F.collect_list(F.struct("pixel_idx", *names))).alias("_p"))
    sized = raster_grid(tasks, res).select("task_id", "h", "w")
    return packed.join(sized, "task_id").select("task_id", "h", "w", F.array(*[_values(c) for c in names]).alias("bands"))


#: tiles along a block's side; tasks of a block in one piece; pixels in a batch of rasters
BLOCK, PIECE, PIXELS = 16, 20_000, 1 << 20


class _Canvas:
    """A block's tiles, and those of its neighbours to the north and east, laid out
    side by side: band, row from the north, column."""

    def __init__(self, x: int, y: int, side: int, size: int, n_bands: int, coarse: tuple[int, ...], fill: int):
        self.x, self.top, self.size, self.coarse = x * side, (y + 2) * side, size, coarse
        self.bands = np.full((n_bands, 2 * side, 2 * side), float(fill))
        self.fill = float(fill)

    def lay(self, x: int, y: int, bands) -> None:
        top, left, n = self.top - (y + 1) * self.size, x * self.size - self.x, self.size
        for k in range(min(len(self.bands), len(bands or ()))):
            wide = n // 2 if k in self.coarse else n
            values = np.full(wide * wide, self.fill)
            own = [self.fill if v is None else v for v in (bands[k] or ())[:wide * wide]]
            values[:len(own)] = own
            tile = values.reshape(wide, wide)
            if k in self.coarse:
                tile = tile.repeat(2, 0).repeat(2, 1)
            self.bands[k, top:top + n, left:left + n] = tile

    def cut(self, x0: int, y1: int, h: int, w: int) -> np.ndarray:
        top, left = self.top - y1, x0 - self.x
        return self.bands[:, top:top + h, left:left + w].reshape(len(self.bands), -1)


def _rasters(ids: list, h: list, w: list, parts: list[np.ndarray], names: list[str], id_type: pa.DataType) -> pa.RecordBatch:
    n_bands = len(parts[0])
    sizes = np.repeat([p.shape[1] for p in parts], n_bands)
    inner = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(np.concatenate([p.ravel() for p in parts])))
    outer = pa.ListArray.from_arrays(pa.array(np.arange(len(parts) + 1) * n_bands, pa.int32()), inner)
    return pa.RecordBatch.from_arrays([pa.array(ids, id_type), pa.array(h, pa.int32()), pa.array(w, pa.int32()), outer], names)


def cut_rasters(tasks: DataFrame, tiles: DataFrame, res: float, size: int, n_bands: int, coarse: tuple[int, ...] = (), fill: int = 0) -> DataFrame:
    """The rasters as the worker takes them: task_id, n_bands, h, w, bands.

    Tasks that share their id, and those of scenes that hold a tile twice, have the
    pixels of all of them in one raster: these are packed from pixel rows."""
    if coarse and size % 2:
        raise ValueError("tiles with coarse bands need an even size")
    known = tasks.select("task_id", "scene_id", "xmin", "ymin", "xmax", "ymax")
    twice = tiles.groupBy("scene_id", "tile_x", "tile_y").agg(F.count(F.lit(1)).alias("_k")).where("_k > 1").select("scene_id").distinct()
    known = known.withColumn("_times", F.count(F.lit(1)).over(Window.partitionBy("task_id"))).join(
        twice.withColumn("_twice", F.lit(True)), "scene_id", "left").withColumn("_plain", F.expr("_times = 1 AND _twice IS NULL"))
    rest = _packed(known.where("NOT _plain").drop("_times", "_twice", "_plain"), tiles, res, size, n_bands, coarse, fill)

    # a block's side doubles until the raster is no longer than it
    one = raster_grid(known.where("_plain"), res).where("h > 0 AND w > 0")
    base = F.lit(size * BLOCK).cast("bigint")
    long = F.greatest("h", "w").cast("double") / base
    one = one.withColumn("_level", F.greatest(F.lit(0), F.ceil(F.log2(long))).cast("int"))
    side = base * F.pow(F.lit(2.0), F.col("_level")).cast("bigint")
    block = ["scene_id", "_level", "_bx", "_by"]
    one = one.withColumns({"_bx": F.floor(F.col("_x0") / side), "_by": F.floor(F.col("_y0") / side)}).withColumn("_block", F.struct(*block))
    blocks = one.groupBy("_block").agg(F.ceil(F.count(F.lit(1)) / PIECE).cast("int").alias("_pieces"), F.max("_x1").alias("_east"), F.max("_y1").alias("_north"))
    levels = [r[0] for r in one.select("_level").distinct().collect()]  # a few numbers

    cut = one.join(blocks.select("_block", "_pieces"), "_block").select(
        "_block", F.pmod(F.xxhash64("task_id"), F.col("_pieces")).cast("int").alias("_piece"), F.lit(1).alias("_kind"),
        F.col("_x0").alias("_x"), F.col("_y1").alias("_y"), "h", "w", "task_id", F.lit(None).cast(tiles.schema["bands"].dataType).alias("bands"))
    t = tiles.where("scene_id IS NOT NULL").select("scene_id", F.col("tile_x").cast("bigint").alias("_x"), F.col("tile_y").cast("bigint").alias("_y"), "bands",
                                                   F.explode(F.array(*[F.lit(k) for k in levels]).cast("array<int>")).alias("_level"))
    for at, own in (("_bx", "_x"), ("_by", "_y")):
        home = F.floor(F.col(own) * size / side)
        t = t.withColumn(at, F.explode(F.array(home - 1, home)))
    t = t.select(F.struct(*block).alias("_block"), "_x", "_y", "bands").join(blocks, "_block").where((F.col("_x") * size < F.col("_east")) & (F.col("_y") * size < F.col("_north")))
    laid = t.select("_block", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1)).alias("_piece"), F.lit(0).alias("_kind"), "_x", "_y",
                    F.lit(0).alias("h"), F.lit(0).alias("w"), F.lit(None).cast(tasks.schema["task_id"].dataType).alias("task_id"), "bands")
    rows = laid.unionByName(cut).select("_block", "_piece", "_kind", F.col("_block._level").alias("_level"), F.col("_block._bx").alias("_bx"), F.col("_block._by").alias("_by"),
                                        "_x", "_y", "h", "w", "task_id", "bands")
    names = ["task_id", "h", "w", "bands"]

    def run(batches) -> Iterator[pa.RecordBatch]:
        at, canvas = None, None
        for b in batches:
            id_type = b.schema.field("task_id").type
            c = {n: b.column(n) for n in ("_block", "_piece", "_kind", "_level", "_bx", "_by", "_x", "_y", "h", "w", "task_id")}
            c = {n: v.to_pylist() for n, v in c.items()}
            bands = b.column("bands")
            ids, hs, ws, parts, n = [], [], [], [], 0
            for i in range(b.num_rows):
                key = (c["_block"][i], c["_piece"][i])
                if key != at:
                    at, canvas = key, _Canvas(c["_bx"][i], c["_by"][i], size * BLOCK << c["_level"][i], size, n_bands, coarse, fill)
                if not c["_kind"][i]:
                    canvas.lay(c["_x"][i], c["_y"][i], bands[i].as_py())
                    continue
                part = canvas.cut(c["_x"][i], c["_y"][i], c["h"][i], c["w"][i])
                ids.append(c["task_id"][i]), hs.append(c["h"][i]), ws.append(c["w"][i]), parts.append(part)
                n += part.size
                if n >= PIXELS:
                    yield _rasters(ids, hs, ws, parts, names, id_type)
                    ids, hs, ws, parts, n = [], [], [], [], 0
            if ids:
                yield _rasters(ids, hs, ws, parts, names, id_type)
    id_name = tasks.schema["task_id"].dataType.simpleString()
    whole = (rows.repartition("_block", "_piece").sortWithinPartitions("_block", "_piece", "_kind")
             .mapInArrow(run, f"task_id {id_name}, h int, w int, bands array<array<double>>"))
    return whole.unionByName(rest).where("task_id IS NOT NULL").select("task_id", F.lit(n_bands).alias("n_bands"), "h", "w", "bands")
