"""GeoPackage parcels as a Spark data source (A1, A2).

``spark.read.format("gpkg").option("path", p).load()`` yields
parcel_id, ec_hcat_n, xmin, ymin, xmax, ymax, rings, crs.

* partitions = feature-id ranges, read in parallel by the executors (the
  file must be on storage every executor can open);
* comparisons on the envelope columns are pushed down and answered with the
  GeoPackage R-tree index when present, so a bbox read touches only the
  features whose envelopes can meet the box (Spark still re-checks them);
* geometries are decoded per row by a small WKB reader: polygons and
  multipolygons (2-D, Z or M), all rings flattened - the even-odd rule used
  downstream makes holes and parts work without nesting.
"""

from __future__ import annotations

import sqlite3
import struct

from pyspark.sql.datasource import (DataSource, DataSourceReader, GreaterThan, GreaterThanOrEqual,
                                    InputPartition, LessThan, LessThanOrEqual)

SCHEMA = ("parcel_id long, ec_hcat_n string, xmin double, ymin double, xmax double, ymax double, "
          "rings array<array<struct<x: double, y: double>>>, crs string")

_ENV_DOUBLES = {0: 0, 1: 4, 2: 6, 3: 6, 4: 8}


def parse_gpkg_geometry(blob: bytes):
    """GeoPackage binary -> (srs_id, rings) with rings as [[(x, y), ...], ...]."""
    if blob is None or len(blob) < 8 or blob[:2] != b"GP":
        return None, []
    flags = blob[3]
    bo = "<" if flags & 1 else ">"
    srs_id = struct.unpack(bo + "i", blob[4:8])[0]
    n_env = _ENV_DOUBLES.get((flags >> 1) & 7, 0)
    if flags & 0x10:  # empty geometry
        return srs_id, []
    rings, _ = _read_wkb(blob, 8 + 8 * n_env)
    return srs_id, rings


def _read_wkb(b: bytes, off: int):
    bo = "<" if b[off] == 1 else ">"
    (typ,) = struct.unpack_from(bo + "I", b, off + 1)
    off += 5
    has_z = bool(typ & 0x80000000) or (typ % 10000) // 1000 in (1, 3)
    has_m = bool(typ & 0x40000000) or (typ % 10000) // 1000 in (2, 3)
    base = (typ & 0x0FFFFFFF) % 1000
    dims = 2 + has_z + has_m
    if base == 3:  # polygon
        (n,) = struct.unpack_from(bo + "I", b, off)
        off += 4
        rings = []
        for _ in range(n):
            (m,) = struct.unpack_from(bo + "I", b, off)
            off += 4
            vals = struct.unpack_from(bo + "d" * (m * dims), b, off)
            off += 8 * m * dims
            rings.append([(vals[k * dims], vals[k * dims + 1]) for k in range(m)])
        return rings, off
    if base == 6:  # multipolygon
        (n,) = struct.unpack_from(bo + "I", b, off)
        off += 4
        rings = []
        for _ in range(n):
            part, off = _read_wkb(b, off)
            rings.extend(part)
        return rings, off
    raise ValueError(f"unsupported WKB geometry type {typ}")


def _meta(path: str, table: str | None):
    con = sqlite3.connect(f"file:{path}?mode=ro", uri=True)
    try:
        if table is None:
            layers = [r[0] for r in con.execute("SELECT table_name FROM gpkg_contents WHERE data_type = 'features' ORDER BY table_name")]
            if len(layers) != 1:
                raise ValueError(f"{path} has the feature layers {layers}: name one with the option table")
            table = layers[0]
        geom, srs = con.execute("SELECT column_name, srs_id FROM gpkg_geometry_columns WHERE table_name = ?",
                                (table,)).fetchone()
        crs = None
        r = con.execute("SELECT organization, organization_coordsys_id FROM gpkg_spatial_ref_sys "
                        "WHERE srs_id = ?", (srs,)).fetchone()
        if r:
            crs = f"{r[0].upper()}:{r[1]}"
        pk = [c[1] for c in con.execute(f'PRAGMA table_info("{table}")') if c[5]]
        fid = pk[0] if pk else "rowid"
        lo, hi, n = con.execute(f'SELECT min("{fid}"), max("{fid}"), count(*) FROM "{table}"').fetchone()
        rtree = f"rtree_{table}_{geom}"
        has_rtree = con.execute("SELECT count(*) FROM sqlite_master WHERE name = ?", (rtree,)).fetchone()[0] > 0
        return dict(table=table, geom=geom, crs=crs, fid=fid, lo=lo, hi=hi, n=n,
                    rtree=rtree if has_rtree else None)
    finally:
        con.close()


class _Range(InputPartition):
    def __init__(self, lo: int, hi: int):
        super().__init__((lo, hi))
        self.lo, self.hi = lo, hi


class GeoPackageReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.cls = options.get("class_column", "EC_hcat_n")
        self.meta = _meta(self.path, options.get("table"))
        # splits follow the number of features
        rows = int(options.get("rowsPerPartition", "50000"))
        self.n = int(options.get("numPartitions", max(1, -(-self.meta["n"] // rows))))
        self.box: dict[str, tuple[str, float]] = {}

    # envelope constraints -> R-tree query; Spark re-checks every filter
    def pushFilters(self, filters):
        ops = {GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
        rt = {"xmin": "minx", "xmax": "maxx", "ymin": "miny", "ymax": "maxy"}
        for f in filters:
            op = ops.get(type(f))
            if op and len(f.attribute) == 1 and f.attribute[0] in rt and isinstance(f.value, (int, float)):
                self.box[f"{rt[f.attribute[0]]} {op} ?"] = float(f.value)
            yield f

    def partitions(self):
        lo, hi = self.meta["lo"], self.meta["hi"]
        if lo is None:
            return [_Range(0, -1)]
        step = max(1, (hi - lo + self.n) // self.n)
        return [_Range(a, min(hi, a + step - 1)) for a in range(lo, hi + 1, step)]

    def read(self, partition: _Range):
        m = self.meta
        con = sqlite3.connect(f"file:{self.path}?mode=ro", uri=True)
        try:
            t, g, fid = m["table"], m["geom"], m["fid"]
            sql = f'SELECT t."{fid}", t."{self.cls}", t."{g}" FROM "{t}" t'
            args: list = []
            where = [f't."{fid}" BETWEEN ? AND ?']
            args += [partition.lo, partition.hi]
            if self.box and m["rtree"]:
                sql += f' JOIN "{m["rtree"]}" r ON r.id = t."{fid}"'
                for cond, v in self.box.items():
                    where.append("r." + cond)
                    args.append(v)
            sql += " WHERE " + " AND ".join(where)
            for pid, cls, blob in con.execute(sql, args):
                rings = parse_gpkg_geometry(blob)[1] if blob is not None else []
                pts = [p for r in rings for p in r]
                if not pts:  # no geometry: a row without envelope, which meets nothing but can be counted
                    yield (int(pid), cls, None, None, None, None, [], m["crs"])
                    continue
                xs, ys = [p[0] for p in pts], [p[1] for p in pts]
                yield (int(pid), cls, min(xs), min(ys), max(xs), max(ys),
                       [[(float(x), float(y)) for x, y in r] for r in rings], m["crs"])
        finally:
            con.close()


class GeoPackageDataSource(DataSource):
    @classmethod
    def name(cls):
        return "gpkg"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return GeoPackageReader(dict(self.options))


def register(spark) -> None:
    """Register the source; its reader answers envelope filters, which Spark
    only offers to Python sources with filter pushdown switched on."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(GeoPackageDataSource)
