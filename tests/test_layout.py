"""Curve layout, 16-bit bands, the ordered inventory."""

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from terrapix.functions.bits16 import decode16, encode16
from terrapix.functions.curve import cell_index, interleave
from terrapix.sources import files
from tests.conftest import SF_SMALL


def test_interleave_equals_bit_by_bit(spark):
    pairs = [(0, 0), (1, 0), (0, 1), (5, 9), (2**31 - 1, 0), (2**31 - 1, 2**31 - 1), (123456789, 987654321), (None, 3)]
    got = spark.createDataFrame(pairs, "x long, y long").select("x", "y", interleave(F.col("x"), F.col("y")).alias("z")).collect()
    for r in got:
        want = None if r.x is None else sum((r.x >> b & 1) << 2 * b | (r.y >> b & 1) << 2 * b + 1 for b in range(31))
        assert r.z == want
    ends = spark.sql("SELECT explode(array(-1e30D, -0.5D, 0D, 1e30D, null)) v").select(cell_index(F.col("v"), 1.0)).collect()
    assert [r[0] for r in ends] == [0, 2**30 - 1, 2**30, 2**31 - 1, None]


@pytest.mark.parametrize("box", [(30, 30, 38, 38), (0, 30, 64, 32), (30, 0, 32, 64)])
def test_a_box_reads_few_row_groups_in_both_directions(spark, tmp_path, box):
    side, n = 64, 64
    cells = spark.range(side * side).select(F.col("id").alias("parcel_id"), (F.col("id") % side).cast("double").alias("xmin"), F.floor(F.col("id") / side).cast("double").alias("ymin"))
    boxes = cells.withColumns({"xmax": F.col("xmin") + 0.5, "ymax": F.col("ymin") + 0.5})
    path = str(tmp_path / "boxes")
    files.write_boxes(boxes, path, 1.0, files=n)
    groups = met = 0
    for f in glob.glob(path + "/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        names = meta.schema.names
        for g in range(meta.num_row_groups):
            s = {c: meta.row_group(g).column(names.index(c)).statistics for c in ("xmin", "ymin", "xmax", "ymax")}
            groups += 1
            met += s["xmin"].min <= box[2] and s["xmax"].max >= box[0] and s["ymin"].min <= box[3] and s["ymax"].max >= box[1]
    assert groups >= n // 2
    assert met <= groups // 3
    got = {r.parcel_id for r in files.read_parcels(spark, path, bbox=box).collect()}
    want = {r.parcel_id for r in boxes.where(f"xmin <= {box[2]} AND xmax >= {box[0]} AND ymin <= {box[3]} AND ymax >= {box[1]}").collect()}
    assert got == want


def test_boxes_that_are_null_or_all_equal_are_kept(spark, tmp_path):
    rows = [(1, None, None, None, None), (2, 1.0, 1.0, 2.0, 2.0), (2, 1.0, 1.0, 2.0, 2.0)]
    df = spark.createDataFrame(rows, "id int, xmin double, ymin double, xmax double, ymax double")
    for frame, n in ((df, 3), (df.limit(0), 0)):
        files.write_boxes(frame, str(tmp_path / "b"), 1.0)
        assert spark.read.schema(df.schema).parquet(str(tmp_path / "b")).count() == n


def test_sixteen_bit_values_come_back_and_others_are_refused(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (32768.0,), (65535.0,), (None,)], "v double")
    assert df.select(encode16(F.col("v")).alias("s")).schema["s"].dataType.simpleString() == "smallint"
    assert [r[0] for r in df.select(decode16(encode16(F.col("v")))).collect()] == [0, 1, 32768, 65535, None]
    for wrong in (-1.0, 65536.0, 0.5, float("nan"), float("inf")):
        with pytest.raises(Exception, match="16-bit"):
            spark.createDataFrame([(wrong,)], "v double").select(encode16(F.col("v"))).collect()


def test_sixteen_bit_archive_is_smaller(spark, tmp_path):
    band = F.transform(F.sequence(F.lit(0), F.lit(399)), lambda p: (F.pmod(F.xxhash64("id", p), F.lit(65536))).cast("double"))
    p = spark.range(50).select(F.concat(F.lit("p"), F.col("id")).alias("patch_id"), F.lit(1).alias("n_bands"), F.lit(20).alias("h"), F.lit(20).alias("w"),
                               F.array(band).alias("bands"), F.array(F.lit(0)).alias("mask")).coalesce(1)
    size = {}
    for bits16 in (False, True):
        path = str(tmp_path / str(bits16))
        files.write_patch_archive(p, path, bits16=bits16)
        size[bits16] = sum(os.path.getsize(f) for f in glob.glob(path + "/*.parquet"))
        back = files.read_patches(spark, path)
        assert back.schema["bands"].dataType.simpleString() == "array<array<double>>"
        assert {(r.patch_id, tuple(r.bands[0])) for r in back.collect()} == {(r.patch_id, tuple(r.bands[0])) for r in p.collect()}
    assert size[True] < size[False]


def test_inventory_lists_names_sizes_and_order(spark, tmp_path, duck_small):
    got = [tuple(r) for r in E.queries()["file_inventory"](spark, SF_SMALL).orderBy("position").collect()]
    listed = duck_small.sql(f"SELECT filename, size FROM read_blob('{SF_SMALL}/*.parquet')").fetchall()
    want, total = [], 0
    for i, (name, size) in enumerate(sorted((os.path.basename(f), s) for f, s in listed), 1):
        total += size
        want.append((i, name, size, total))
    assert got == want
    (tmp_path / "sub").mkdir()
    for name in ("b.parquet", "sub/a.parquet", "c.txt"):
        (tmp_path / name).write_bytes(b"x" * 3)
    inv = files.inventory(spark, str(tmp_path))
    assert [tuple(r) for r in files.inventory_order(inv, str(tmp_path)).orderBy("position").collect()] == [(1, "b.parquet", 3, 3), (2, "sub/a.parquet", 3, 6)]
