"""Geometry as native Column math: boxes, even-odd point-in-polygon, UTM."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def box_ring(xmin, ymin, xmax, ymax) -> Column:
    """Closed counter-clockwise ring of an axis-aligned box."""
    x0, y0, x1, y1 = _c(xmin), _c(ymin), _c(xmax), _c(ymax)

    def pt(x, y):
        return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.array(pt(x0, y0), pt(x1, y0), pt(x1, y1), pt(x0, y1), pt(x0, y0))


def bbox_overlap(a: tuple, b: tuple) -> Column:
    """Closed-interval box intersection (D1): touching edges count."""
    axmin, aymin, axmax, aymax = map(_c, a)
    bxmin, bymin, bxmax, bymax = map(_c, b)
    return (axmin <= bxmax) & (axmax >= bxmin) & (aymin <= bymax) & (aymax >= bymin)


def _corners(ring: Column) -> Column:
    """0..n-1 of a ring's points. The edge after the last point leads back to
    the first: it closes an open ring and has no length in a closed one."""
    return F.when(F.size(ring) > 0, F.sequence(F.lit(0), F.size(ring) - 1)).otherwise(F.array().cast("array<int>"))


def point_in_rings(px, py, rings) -> Column:
    """Even-odd ray test over every edge of every ring (E5).

    Holes and multi-part polygons need no special case: a hole's edges flip
    the parity back. Evaluated with ``aggregate`` over the edge index, so it
    stays in the JVM (no Python UDF).
    """
    px, py, rings = _c(px), _c(py), _c(rings)

    def crossing(p, q):
        straddles = (p["y"] > py) != (q["y"] > py)
        x_at = p["x"] + (q["x"] - p["x"]) * (py - p["y"]) / (q["y"] - p["y"])
        # CASE keeps the division away from horizontal edges
        return F.when(straddles, px < x_at).otherwise(F.lit(False))

    def ring_parity(acc, ring):
        return F.aggregate(_corners(ring), acc, lambda a, k: a != crossing(ring[k], ring[(k + 1) % F.size(ring)]))

    return F.when(F.size(rings) > 0, F.aggregate(rings, F.lit(False), ring_parity)).otherwise(F.lit(False))


def segment_meets_box(e: Column, box: tuple) -> Column:
    """Whether an edge (x1, y1, x2, y2) meets a closed box: no separating axis
    among x, y and the edge's normal."""
    x0, y0, x1, y1 = map(_c, box)
    hx, hy = (x1 - x0) / 2, (y1 - y0) / 2
    dx, dy = (e["x2"] - e["x1"]) / 2, (e["y2"] - e["y1"]) / 2
    mx, my = (e["x1"] + e["x2"]) / 2 - (x0 + x1) / 2, (e["y1"] + e["y2"]) / 2 - (y0 + y1) / 2
    return ((F.abs(mx) <= hx + F.abs(dx)) & (F.abs(my) <= hy + F.abs(dy))
            & (F.abs(mx * dy - my * dx) <= hx * F.abs(dy) + hy * F.abs(dx)))


def rings_meet_box(rings, box: tuple) -> Column:
    """Whether a polygon meets a closed box (D1 exact): an edge does, or the
    box lies inside."""
    return F.exists(ring_edges(rings), lambda e: segment_meets_box(e, box)) | point_in_rings(box[0], box[1], rings)


def ring_edges(rings) -> Column:
    """All edges of all rings as structs (x1, y1, x2, y2)."""
    rings = _c(rings)

    def ring_to_edges(ring):
        def edge(k):
            to = ring[(k + 1) % F.size(ring)]
            return F.struct(ring[k]["x"].alias("x1"), ring[k]["y"].alias("y1"), to["x"].alias("x2"), to["y"].alias("y2"))
        return F.transform(_corners(ring), edge)
    return F.flatten(F.transform(rings, ring_to_edges))


# --- transverse Mercator (UTM) ---------------------------------------------
# WGS84 ellipsoid and UTM constants (published, fixed values).
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
UTM_K0 = 0.9996
UTM_FALSE_EASTING = 500000.0
DEG = math.pi / 180.0


def utm_central_meridian(zone: int) -> float:
    return -183.0 + 6.0 * zone


def to_utm(lon, lat, zone: int = 30) -> tuple[Column, Column]:
    """Project geographic degrees to UTM easting/northing (northern zones).

    Series expansion of the transverse Mercator projection (Snyder 1987,
    USGS PP 1395, eqs. 8-9..8-10), accurate to millimetres inside a zone.
    """
    lon, lat = _c(lon), _c(lat)
    a, f = WGS84_A, WGS84_F
    e2 = f * (2 - f)
    e4, e6 = e2 * e2, e2 * e2 * e2
    ep2 = e2 / (1 - e2)
    phi = lat * F.lit(DEG)
    lam = (lon - F.lit(utm_central_meridian(zone))) * F.lit(DEG)
    s, c = F.sin(phi), F.cos(phi)
    n = F.lit(a) / F.sqrt(F.lit(1.0) - F.lit(e2) * s * s)
    t = F.tan(phi) * F.tan(phi)
    cc = F.lit(ep2) * c * c
    aa = lam * c
    m = F.lit(a) * (
        F.lit(1 - e2 / 4 - 3 * e4 / 64 - 5 * e6 / 256) * phi
        - F.lit(3 * e2 / 8 + 3 * e4 / 32 + 45 * e6 / 1024) * F.sin(2 * phi)
        + F.lit(15 * e4 / 256 + 45 * e6 / 1024) * F.sin(4 * phi)
        - F.lit(35 * e6 / 3072) * F.sin(6 * phi))
    a2 = aa * aa
    x = F.lit(UTM_K0) * n * (
        aa + (F.lit(1.0) - t + cc) * a2 * aa / 6
        + (F.lit(5.0) - 18 * t + t * t + 72 * cc - F.lit(58 * ep2)) * a2 * a2 * aa / 120
    ) + F.lit(UTM_FALSE_EASTING)
    y = F.lit(UTM_K0) * (m + n * F.tan(phi) * (
        a2 / 2 + (F.lit(5.0) - t + 9 * cc + 4 * cc * cc) * a2 * a2 / 24
        + (F.lit(61.0) - 58 * t + t * t + 600 * cc - F.lit(330 * ep2)) * a2 * a2 * a2 / 720))
    return x, y


def utm_constants(zone: int = 30) -> dict[str, float]:
    """The numeric constants of ``to_utm`` (for SQL twins and tests)."""
    a, f = WGS84_A, WGS84_F
    e2 = f * (2 - f)
    return {"a": a, "e2": e2, "ep2": e2 / (1 - e2), "k0": UTM_K0,
            "lon0": utm_central_meridian(zone), "fe": UTM_FALSE_EASTING, "pi": math.pi}
