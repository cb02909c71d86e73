"""Rasters cut out of scene tiles."""

import io
import math
import random
import re
from contextlib import redirect_stdout

from terrapix.operators import mosaic

TASKS = "task_id long, scene_id long, xmin double, ymin double, xmax double, ymax double"
TILES = "scene_id long, tile_x int, tile_y int, bands array<array<int>>"


def plain(tasks, tiles, res, size, n_bands, coarse):
    """Pixel by pixel."""
    by = {(s, x, y): b for s, x, y, b in tiles}
    out = {}
    for t, s, xmin, ymin, xmax, ymax in tasks:
        if None in (xmin, ymin, xmax, ymax):
            continue
        x0, x1, y0, y1 = math.floor(xmin / res), math.ceil(xmax / res), math.floor(ymin / res), math.ceil(ymax / res)
        for y in range(y1 - 1, y0 - 1, -1):
            for x in range(x0, x1):
                bands = by.get((s, x // size, y // size))
                row, col = size - 1 - y % size, x % size
                value = []
                for k in range(n_bands):
                    b = bands[k] if bands and k < len(bands) and bands[k] else []
                    at = (row // 2) * (size // 2) + col // 2 if k in coarse else row * size + col
                    value.append((b[at] if at < len(b) else None) or 0)
                out[(t, (y1 - 1 - y) * (x1 - x0) + x - x0)] = tuple(value)
    return out


def example():
    rng = random.Random(8)
    size = 4
    tiles = [(s, x, y, [[rng.randrange(1, 60000) for _ in range(size * size)], [rng.randrange(1, 60000) for _ in range(4)]])
             for s in (1, 2) for x in range(-3, 4) for y in range(-3, 4) if rng.random() < 0.8]
    tiles[0] = (*tiles[0][:3], [[None] * 16, [7] * 4])
    tiles[1] = (*tiles[1][:3], [tiles[1][3][0][:5]])  # too few values, a band less
    tasks = [(k, rng.choice([1, 2, 9, None]), *(lambda x, y: (x, y, x + rng.uniform(0.1, 60), y + rng.uniform(0.1, 60)))(rng.uniform(-110, 80), rng.uniform(-110, 80))) for k in range(25)]
    tasks += [(100, 1, 10.0, 10.0, 10.0, 20.0), (101, 1, None, 0.0, 5.0, 5.0), (102, 1, -40.0, -40.0, 40.0, 40.0), (103, 2, 30.0, 20.0, 10.0, 40.0)]
    return tasks, tiles


def test_cut_pixels_equals_pixel_by_pixel(spark):
    tasks, tiles = example()
    args = (10.0, 4, 2, (1,))
    got = mosaic.cut_pixels(spark.createDataFrame(tasks, TASKS), spark.createDataFrame(tiles, TILES), *args).collect()
    want = plain([t for t in tasks if t[0] < 100 or t[0] == 102], tiles, *args)
    assert {(r["task_id"], r["pixel_idx"]): (r["band_0"], r["band_1"]) for r in got} == want and len(got) == len(want)


def test_cut_rasters_feed_the_worker(spark):
    from terrapix.operators.patches import explode_patches
    tasks, tiles = example()
    t, g = spark.createDataFrame(tasks, TASKS), spark.createDataFrame(tiles, TILES)
    rasters = mosaic.cut_rasters(t, g, 10.0, 4, 2, (1,))
    whole = next(r for r in rasters.collect() if r["task_id"] == 102)
    assert (whole["h"], whole["w"], len(whole["bands"]), len(whole["bands"][0])) == (8, 8, 2, 64)
    px = explode_patches(rasters.selectExpr("*", "transform(bands[0], v -> 0) AS mask"), 2, keep=("task_id",)).drop("label")
    same = mosaic.cut_pixels(t, g, 10.0, 4, 2, (1,)).selectExpr("task_id", "pixel_idx", "CAST(band_0 AS DOUBLE) AS band_0", "CAST(band_1 AS DOUBLE) AS band_1")
    assert px.exceptAll(same).count() == 0 and px.count() == same.count() > 0


def test_tiles_of_the_tasks_scenes_only(spark, tmp_dir):
    tasks, tiles = example()
    mosaic.write_tiles(spark.createDataFrame(tiles, TILES), tmp_dir)
    one = spark.createDataFrame(tasks, TASKS).where("scene_id = 2 OR scene_id IS NULL")
    read = mosaic.read_tiles(spark, tmp_dir, one)
    buf = io.StringIO()
    with redirect_stdout(buf):
        mosaic.cut_pixels(one, read, 10.0, 4, 2, (1,)).explain("formatted")
    assert re.search(r"PartitionFilters: \[.*scene_bucket", buf.getvalue()) and "CartesianProduct" not in buf.getvalue()
    assert read.select("scene_bucket").distinct().count() == 1 < spark.read.parquet(tmp_dir).select("scene_bucket").distinct().count()
    assert {r["scene_id"] for r in read.select("scene_id").distinct().collect()} == {2}
    assert read.count() == sum(t[0] == 2 for t in tiles)


def test_nothing_to_cut(spark):
    t, g = spark.createDataFrame([], TASKS), spark.createDataFrame([], TILES)
    assert mosaic.cut_pixels(t, g, 10.0, 4, 2).count() == 0 and mosaic.cut_rasters(t, g, 10.0, 4, 2).count() == 0
    only = spark.createDataFrame([(1, 5, 0.0, 0.0, 20.0, 10.0)], TASKS)
    assert [tuple(r) for r in mosaic.cut_pixels(only, g, 10.0, 4, 1).orderBy("pixel_idx").collect()] == [(1, 0, 0), (1, 1, 0)]


def test_rasters_are_cut_without_a_shuffle_of_pixels(spark):
    """Blocks of tiles, pieces of a block and repeated ids and tiles give what pixel
    rows give; before, every pixel row of every raster was shuffled."""
    tasks, tiles = example()
    tasks += [(200, 1, -2500.0, -2500.0, 2500.0, 2500.0), (7, 2, 3.0, 4.0, 55.0, 31.0), (None, 1, 0.0, 0.0, 20.0, 20.0)]
    tiles += [(4, 0, 0, [[5] * 16, [6] * 4]), (4, 0, 0, [[3] * 16, [2] * 4])]
    tasks += [(300, 4, -15.0, -5.0, 25.0, 33.0)]
    t, g = spark.createDataFrame(tasks, TASKS), spark.createDataFrame(tiles, TILES)
    args = (10.0, 4, 2, (1,), 9)
    piece, mosaic.PIECE = mosaic.PIECE, 2
    try:
        made = mosaic.cut_rasters(t, g, *args)
        got = sorted((r["task_id"], r["h"], r["w"], r["bands"]) for r in made.collect())
    finally:
        mosaic.PIECE = piece
    want = sorted((r["task_id"], r["h"], r["w"], r["bands"]) for r in mosaic._packed(t, g, *args).collect())
    assert got == want and len(got) > 25


def test_pixels_are_picked_without_building_arrays(spark):
    tasks, tiles = example()
    buf = io.StringIO()
    with redirect_stdout(buf):
        mosaic.cut_pixels(spark.createDataFrame(tasks, TASKS), spark.createDataFrame(tiles, TILES), 10.0, 4, 2, (1,)).explain()
    assert "arrays_zip" not in buf.getvalue()
