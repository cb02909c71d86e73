"""The rows with the smallest keys, without a list of that length from every task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 4096


def smallest(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The ``k`` rows smallest by ``keys`` and some beyond them, for the caller to
    sort and limit: at most ``2 * k`` rows, or those equal in every key.

    The keys are long columns between -2^61 and 2^61.  Histograms of at most
    ``BINS`` rows narrow the first key to the value at which ``k`` rows are
    reached; where more than ``2 * k`` rows share that value, the next key
    decides among them.  ``rows`` is read several times: give a written table.
    Rows whose key is null are left out."""
    name, rest = keys[0], keys[1:]
    key = F.col(name)
    low, high, n = rows.agg(F.min(key), F.max(key), F.count(key)).first()
    before, reached = 0, n  # rows below low, rows up to high
    while n > k and low < high and reached > 2 * k:
        width = (high - low) // BINS + 1
        at = F.expr(f"(`{name}` - ({low}L)) div {width}L").alias("at")
        reached = before
        for b, count in sorted(tuple(r) for r in rows.filter(key.between(low, high)).groupBy(at).count().collect()):
            before, reached = reached, reached + count
            if reached >= k:
                break
        low, high = low + b * width, min(high, low + (b + 1) * width - 1)
    if rest and reached > 2 * k:
        return rows.filter(key < low).unionByName(smallest(rows.filter(key == low), rest, k - before))
    return rows.filter(key <= high)
