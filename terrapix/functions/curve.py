"""A space-filling curve over cells, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: cells lie between -2^30 and 2^30 - 1 from the origin
_HALF = 1 << 30
#: fixed values: shifts and masks that spread 31 bits over every other bit
_SPREAD = [(16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)]


def cell_index(value: Column, cell: float) -> Column:
    """The number of the cell that holds a coordinate, 0 or more; coordinates
    beyond the outermost cell count as in it, null has none."""
    i = F.greatest(F.lit(float(-_HALF)), F.least(F.lit(float(_HALF - 1)), value / F.lit(float(cell))))
    return F.when(value.isNotNull(), F.floor(i) + _HALF)


def _spread(x: Column) -> Column:
    for shift, mask in _SPREAD:
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask))
    return x


def interleave(x: Column, y: Column) -> Column:
    """Position on the Z curve of a cell (bits of y and x in turn), a long;
    null where either is null."""
    return _spread(x.cast("bigint")).bitwiseOR(F.shiftleft(_spread(y.cast("bigint")), 1))


def box_position(cell: float, xmin: str = "xmin", ymin: str = "ymin") -> Column:
    """Position on the curve of the cell with a box's lower left corner."""
    return interleave(cell_index(F.col(xmin), cell), cell_index(F.col(ymin), cell))
