"""Connectors: GeoPackage, NPZ, inventory, class map, JSON messages."""

import json
import os
import sqlite3
import struct

import numpy as np
import pytest

from terrapix.schema import CLASS_MAP, RESULT_SCHEMA
from terrapix.sources import files, gpkg, messages


def _wkb_polygon(rings):
    b = struct.pack("<BII", 1, 3, len(rings))
    for r in rings:
        b += struct.pack("<I", len(r)) + b"".join(struct.pack("<dd", x, y) for x, y in r)
    return b


def _gp(wkb, srs=4258):
    # header: magic, version 0, flags = little endian, no envelope
    return b"GP" + bytes([0, 1]) + struct.pack("<i", srs) + wkb


def _make_gpkg(path):
    con = sqlite3.connect(path)
    con.executescript("""
    CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT, srs_id INTEGER PRIMARY KEY, organization TEXT,
      organization_coordsys_id INTEGER, definition TEXT, description TEXT);
    CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT, identifier TEXT);
    CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT, geometry_type_name TEXT,
      srs_id INTEGER, z TINYINT, m TINYINT);
    CREATE TABLE parcels (fid INTEGER PRIMARY KEY, geom BLOB, EC_hcat_n TEXT);
    CREATE VIRTUAL TABLE rtree_parcels_geom USING rtree(id, minx, maxx, miny, maxy);
    INSERT INTO gpkg_spatial_ref_sys VALUES ('ETRS89', 4258, 'epsg', 4258, '', '');
    INSERT INTO gpkg_contents VALUES ('parcels', 'features', 'parcels');
    INSERT INTO gpkg_geometry_columns VALUES ('parcels', 'geom', 'MULTIPOLYGON', 4258, 0, 0);
    """)
    outer = [(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)]
    hole = [(3, 3), (7, 3), (7, 7), (3, 7), (3, 3)]
    poly_hole = _wkb_polygon([outer, hole])
    a = _wkb_polygon([[(20, 0), (22, 0), (22, 2), (20, 2), (20, 0)]])
    b = _wkb_polygon([[(30, 0), (31, 0), (31, 1), (30, 0)]])
    multi = struct.pack("<BII", 1, 6, 2) + a + b
    far = _wkb_polygon([[(100, 100), (101, 100), (101, 101), (100, 100)]])
    rows = [(1, _gp(poly_hole), "barley"), (2, _gp(multi), "oak"), (3, _gp(far), "unknown_class")]
    con.executemany("INSERT INTO parcels VALUES (?, ?, ?)", rows)
    con.executemany("INSERT INTO rtree_parcels_geom VALUES (?, ?, ?, ?, ?)",
                    [(1, 0, 10, 0, 10), (2, 20, 31, 0, 2), (3, 100, 101, 100, 101)])
    con.commit()
    con.close()


def test_gpkg_reader_and_bbox_pushdown(spark, tmp_dir):
    p = os.path.join(tmp_dir, "parcels.gpkg")
    _make_gpkg(p)
    df = files.read_parcels(spark, p).orderBy("parcel_id")
    rows = df.collect()
    assert [r.parcel_id for r in rows] == [1, 2, 3]
    assert rows[0].crs == "EPSG:4258" and len(rows[0].rings) == 2
    assert len(rows[1].rings) == 2 and (rows[1].xmin, rows[1].xmax) == (20.0, 31.0)
    near = files.read_parcels(spark, p, bbox=(0, 0, 25, 5))
    assert sorted(r.parcel_id for r in near.collect()) == [1, 2]
    sch, crs = files.peek(df)
    assert crs == "EPSG:4258" and "rings" in sch.fieldNames()


def test_wkb_z_and_empty():
    w = struct.pack("<BII", 1, 1003, 1) + struct.pack("<I", 4) + b"".join(
        struct.pack("<ddd", x, y, 5.0) for x, y in [(0, 0), (1, 0), (1, 1), (0, 0)])
    srs, rings = gpkg.parse_gpkg_geometry(_gp(w, 32630))
    assert srs == 32630 and rings == [[(0, 0), (1, 0), (1, 1), (0, 0)]]
    assert gpkg.parse_gpkg_geometry(b"GP" + bytes([0, 0x11]) + struct.pack("<i", 1))[1] == []


def test_npz_reader(spark, tmp_dir):
    for k in range(3):
        bands = (np.arange(10 * 4 * 5, dtype=np.uint16).reshape(10, 4, 5) + k)
        mask = (np.arange(20).reshape(4, 5) % 3 == 0).astype(np.uint8)
        np.savez_compressed(os.path.join(tmp_dir, f"task_{k}_worker_1.npz"), bands=bands, mask=mask)
    df = files.read_npz_patches(spark, os.path.join(tmp_dir, "*.npz"))
    rows = {r.patch_id: r for r in df.collect()}
    r = rows["task_1_worker_1"]
    assert (r.n_bands, r.h, r.w) == (10, 4, 5)
    assert r.bands[2][3] == 2 * 20 + 3 + 1
    assert sum(r.mask) == 7  # README check: count of mask == 1


def test_inventory(spark, tmp_dir):
    spark.range(10).write.parquet(os.path.join(tmp_dir, "a"))
    spark.range(10).write.parquet(os.path.join(tmp_dir, "b"))
    with open(os.path.join(tmp_dir, "note.txt"), "w") as fh:
        fh.write("x")
    inv = files.inventory(spark, tmp_dir)
    s = files.inventory_summary(inv).first()
    expected = sum(1 for _, _, fs in os.walk(tmp_dir) for f in fs if f.endswith(".parquet"))
    assert s.n_files == expected and expected >= 2 and s.total_mb > 0
    assert files.first_files(inv, 1).count() == 1
    n, cols, head = files.sample_file(spark, os.path.join(tmp_dir, "a"))
    assert n == 10 and cols == ["id"] and head.count() == 5


def test_class_map_json(spark, tmp_dir):
    p = os.path.join(tmp_dir, "classes_mapping.json")
    with open(p, "w") as fh:
        json.dump(CLASS_MAP, fh, indent=2)
    cm = files.read_class_map(spark, p)
    got = {r.ec_hcat_n: r.binary_id for r in cm.collect()}
    assert got == CLASS_MAP and len(got) == 63
    assert sum(1 for v in got.values() if v == 0) == 16


def test_decode_defaults_and_rejects(spark, tmp_dir):
    lines = [json.dumps({"task_id": 1, "worker_id": "7", "status": "success", "crop_pixels": 3,
                         "noncrop_pixels": 4}),
             "this is not json",
             json.dumps({"task_id": 2}),
             json.dumps({"task_id": 1, "worker_id": "8", "status": "failed", "error": "boom"})]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    dec = messages.decode(df, RESULT_SCHEMA)
    assert messages.rejects(dec).count() == 1
    from terrapix.operators.monitor import monitor_totals, normalize_results
    v = normalize_results(messages.valid(dec))
    r = {x.task_id: x for x in v.collect() if x.task_id == 2}
    assert r[2].worker_id == "unknown" and r[2].status == "unknown" and r[2].crop_pixels == 0
    t = monitor_totals(messages.valid(dec), ts=None).first()
    assert (t.tasks, t.success, t.failed, t.crop_pixels) == (3, 1, 2, 3)


def test_encode_roundtrip_binary(spark):
    df = spark.createDataFrame([(5, [1.0, 2.0, 3.0, 4.0])], "task_id long, bbox array<double>")
    fr = messages.to_kafka(messages.encode(df, messages.task_key()))
    assert fr.schema["value"].dataType.typeName() == "binary"
    back = messages.decode(fr, RESULT_SCHEMA, keep=("key",)).first()
    assert back.key == bytearray(b"task_5") and back.task_id == 5 and back.bbox == [1.0, 2.0, 3.0, 4.0]


@pytest.mark.parametrize("bad", [b"XX", None])
def test_parse_non_gpkg(bad):
    assert gpkg.parse_gpkg_geometry(bad) == (None, [])
