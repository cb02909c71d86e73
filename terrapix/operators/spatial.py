"""Box-overlap (range) join without a cross join.

Every box has a level: on level k cells are ``size * 2**k`` wide, and a box's own
level is the first on which it is no longer than a cell, so it covers at most
2 x 2 cells there, however large it is. A pair meets on the higher of its two
levels: boxes are exploded to the cells they cover on their own level and on the
higher ones that occur, and equi-joined on (level, cell). The exact
closed-interval test follows, and a pair is kept only in the cell holding the
lower-left corner of the two boxes' intersection, so every overlapping pair
appears exactly once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BOX = ("xmin", "ymin", "xmax", "ymax")
#: boxes that a task of a join takes, on all their levels
JOIN_FEW, JOIN_MANY, JOIN_TASKS, JOIN_LEAST = 100_000, 1_000_000, 200, 8
_TOP = 40  # beyond this level a cell is larger than any coordinate in use


def box_level(size: float, prefix: str = "") -> Column:
    """0 for boxes up to ``size``, one more for each doubling."""
    x0, y0, x1, y1 = (F.col(f"{prefix}{c}") for c in BOX)
    length = F.greatest(x1 - x0, y1 - y0, F.lit(float(size)))
    return F.least(F.ceil(F.log2(length / F.lit(float(size))) - F.lit(1e-9)).cast("int"), F.lit(_TOP))


def _usable(df: DataFrame, prefix: str) -> DataFrame:
    # a box with min > max (or a null corner) meets nothing
    x0, y0, x1, y1 = (F.col(f"{prefix}{c}") for c in BOX)
    return df.where((x0 <= x1) & (y0 <= y1))


def _side(size: float, fine: int = 1) -> Column:
    return F.lit(float(size)) * F.pow(F.lit(2.0), F.col("_level")) / F.lit(float(fine))


def _cell(v: Column, size: float, fine: int = 1) -> Column:
    return F.floor(v / _side(size, fine))


def cell_edges(size: float, fine: int = 1) -> list[Column]:
    """West, east, south and north edge of the cell (_level, _cx, _cy)."""
    side = _side(size, fine)
    return [F.col("_cx") * side, (F.col("_cx") + 1) * side, F.col("_cy") * side, (F.col("_cy") + 1) * side]


def explode_cells(df: DataFrame, size: float, levels: list[int], prefix: str, own: str, fine: int = 1) -> DataFrame:
    """One row per box, level (its own and the occurring ones above) and cell; with
    ``fine`` cells are that much narrower than their level's."""
    x0, y0, x1, y1 = (F.col(f"{prefix}{c}") for c in BOX)
    above = F.filter(F.array(*[F.lit(k) for k in levels]), lambda k: k >= F.col(own))
    e = _usable(df, prefix).withColumn(own, box_level(size, prefix)).withColumn("_level", F.explode(above))
    return (e.withColumn("_cx", F.explode(F.sequence(_cell(x0, size, fine), _cell(x1, size, fine))))
             .withColumn("_cy", F.explode(F.sequence(_cell(y0, size, fine), _cell(y1, size, fine)))))


def _level_counts(df: DataFrame, prefix: str, size: float) -> dict[int, int]:
    """Boxes of each level that occurs: at most _TOP + 1 numbers."""
    found = _usable(df, prefix).groupBy(box_level(size, prefix).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return {r["k"]: r["n"] for r in found.collect()}


def box_levels(frames: list[tuple[DataFrame, str]], size: float) -> list[int]:
    """The levels that occur among the boxes of some (frame, prefix): at most
    _TOP + 1 numbers."""
    found: set[int] = set()
    for df, prefix in frames:
        found |= set(_level_counts(df, prefix, size))
    return sorted(found) or [0]


def _join_parts(counts: list[dict[int, int]], levels: list[int]) -> int:
    """Partitions of a join of boxes: they follow the boxes, so that what a task sorts
    does not grow with the table; beyond ``JOIN_TASKS`` (writers keep nothing in
    memory for so many) only where ``JOIN_MANY`` boxes would meet in a task."""
    laid = max(sum(n * sum(k >= own for k in levels) for own, n in c.items()) for c in counts)
    return max(min(-(-laid // JOIN_FEW), JOIN_TASKS), -(-laid // JOIN_MANY), JOIN_LEAST)


def box_join(left: DataFrame, right: DataFrame, size: float,
             lp: str = "l_", rp: str = "r_", levels: list[int] | None = None) -> DataFrame:
    """Pairs of overlapping boxes. ``left`` / ``right`` carry box columns
    already renamed with prefixes ``lp`` / ``rp`` (e.g. l_xmin ... r_ymax).
    ``levels`` may be given when known (``box_levels`` of supersets of both
    sides), to save reading expensive sides for it; else the boxes are counted
    with their levels, and the join has as many partitions as they need."""
    on = ["_level", "_cx", "_cy"]
    counts = None
    if levels is None:
        counts = [_level_counts(left, lp, size), _level_counts(right, rp, size)]
        levels = sorted(counts[0].keys() | counts[1].keys()) or [0]
    le = explode_cells(left, size, levels, lp, "_ll")
    re = explode_cells(right, size, levels, rp, "_rl")
    if counts:
        n = _join_parts(counts, levels)
        le, re = le.repartition(n, *on), re.repartition(n, *on)
    j = le.join(re, on)
    hit = ((F.col(f"{rp}xmin") <= F.col(f"{lp}xmax")) & (F.col(f"{rp}xmax") >= F.col(f"{lp}xmin"))
           & (F.col(f"{rp}ymin") <= F.col(f"{lp}ymax")) & (F.col(f"{rp}ymax") >= F.col(f"{lp}ymin")))
    meeting = F.col("_level") == F.greatest("_ll", "_rl")
    ref_x = F.greatest(F.col(f"{lp}xmin"), F.col(f"{rp}xmin"))
    ref_y = F.greatest(F.col(f"{lp}ymin"), F.col(f"{rp}ymin"))
    owner = (_cell(ref_x, size) == F.col("_cx")) & (_cell(ref_y, size) == F.col("_cy"))
    return j.where(meeting & hit & owner).drop("_level", "_cx", "_cy", "_ll", "_rl")


def prefixed(df: DataFrame, prefix: str, cols=BOX) -> DataFrame:
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in cols})
