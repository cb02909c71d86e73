"""Date helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_interval(col, inclusive_end: bool = True) -> Column:
    """'start/end' date interval -> struct(d0 date, d1 date) with d1 exclusive
    (an inclusive end date becomes end + 1 day)."""
    c = F.col(col) if isinstance(col, str) else col
    parts = F.split(c, "/")
    d0 = F.to_date(parts[0])
    d1 = F.to_date(parts[1])
    if inclusive_end:
        d1 = F.date_add(d1, 1)
    return F.struct(d0.alias("d0"), d1.alias("d1"))
