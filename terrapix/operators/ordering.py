"""Global order numbers and running totals without a single-partition window.

``Window.orderBy(...)`` with no partitioning moves every row into one task.
Instead every row gets a bucket from its own order values: bucket bounds are
approximate quantiles of the first order column, and a value that fills several
buckets by itself is cut again.  The bucket is a plain expression, so nothing has
to be materialised: per-bucket totals (one row per bucket) supply the offsets, and
one window partitioned by the bucket finishes the job with a single shuffle of the
rows.

Keys of any type.  Quantiles need numbers, so every order column is read through a
code that never falls where the value rises: numbers, dates, times and booleans as
doubles, strings and binaries as the number of their next ``PREFIX`` bytes (Spark
orders both byte by byte).  Rows that share a hot code are cut by what decides
next: the following bytes of the same column while its values differ, then the
next column.  All hot codes of a level are looked at in one job.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BUCKET = "_tp_bucket"
_PLAIN = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)
_BYTES = (T.StringType, T.BinaryType)
#: bytes of a string in one code (exact as a double), levels of refinement, leaves of a tree of comparisons
PREFIX, LEVELS, LEAVES = 6, 32, 256
_HEAD = 4096  # bytes looked at for a common prefix


def _n_buckets(df: DataFrame, n: int | None) -> int:
    return n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def code(col: str, typ: T.DataType, at: int = 0) -> Column:
    """The column's order code as a double; of strings and binaries the ``PREFIX``
    bytes from ``at`` on. Null for nulls, 0 for types without an order code."""
    if isinstance(typ, _BYTES):
        part = F.substring(F.col(col).cast("binary"), at + 1, PREFIX)
        # of values that differ by trailing zero bytes the shorter comes first
        return F.conv(F.rpad(F.hex(part), 2 * PREFIX, "0"), 16, 10).cast("double") * 8 + F.octet_length(part)
    if isinstance(typ, (T.DateType, T.TimestampNTZType)):
        return F.col(col).cast("timestamp").cast("double")
    if isinstance(typ, _PLAIN):
        return F.col(col).cast("double")
    return F.when(F.col(col).isNotNull(), F.lit(0.0))


def _tree(value: Column, bounds: list[float], first: int, last: int) -> Column:
    """Number of bounds below the value, by a balanced tree of comparisons."""
    if first == last:
        return F.lit(first)
    mid = (first + last) // 2
    return F.when(value <= F.lit(bounds[mid]), _tree(value, bounds, first, mid)).otherwise(_tree(value, bounds, mid + 1, last))


def _below(value: Column, bounds: list[float]) -> Column:
    """Number of bounds below the value: a tree of at most ``LEAVES`` leaves, and
    inside a leaf a short list."""
    if len(bounds) < LEAVES:
        return _tree(value, bounds, 0, len(bounds))
    step = -(-len(bounds) // LEAVES)
    coarse = _tree(value, bounds[step - 1::step], 0, len(bounds) // step)
    runs = [bounds[k:k + step] for k in range(0, len(bounds), step)] + [[]]
    own = F.get(F.array(*[F.array(*[F.lit(b) for b in r]).cast("array<double>") for r in runs]), coarse)
    return (coarse * step + F.size(F.filter(own, lambda b: b < value))).cast("int")


@dataclass
class _Node:
    """Rows to be cut: the condition that picks them, the column and byte that
    decide, the buckets they deserve; then the bounds and the hot codes."""

    rows: Column
    col: int
    at: int
    share: int
    bounds: list[float] = field(default_factory=list)
    hot: dict[float, "_Node"] = field(default_factory=dict)


def _look(df: DataFrame, order_cols: list[str], nodes: list[_Node]) -> list[_Node]:
    """Bounds and hot codes of a level's nodes, in one job; returns the next level."""
    types = [df.schema[c].dataType for c in order_cols]
    which, value = F.lit(None).cast("int"), F.lit(None).cast("double")
    for k, node in enumerate(nodes):
        which = F.when(node.rows, F.lit(k)).otherwise(which)
        value = F.when(node.rows, code(order_cols[node.col], types[node.col], node.at)).otherwise(value)
    seen = df.withColumns({"_tp_k": which, "_tp_v": value}).where("_tp_k IS NOT NULL")
    most = max(node.share for node in nodes)
    shares = [j / (2 * most) for j in range(1, 2 * most)]
    got = {r["_tp_k"]: sorted(x for x in (r["q"] or []) if x is not None and x == x)
           for r in seen.groupBy("_tp_k").agg(F.percentile_approx("_tp_v", shares, 40 * most).alias("q")).collect()}
    hot: list[tuple[int, float, int]] = []
    for k, node in enumerate(nodes):
        q = got.get(k, [])
        cuts = [q[min(len(q) - 1, j * len(q) // node.share)] for j in range(1, node.share)] if q else []
        node.bounds = sorted(set(cuts))
        hot += [(k, x, cuts.count(x) + 1) for x in node.bounds if cuts.count(x) > 1]
    if not hot:
        return []
    # does the deciding column still differ among the rows of a hot code?
    wanted = df.sparkSession.createDataFrame([(k, x) for k, x, _ in hot], "_tp_k int, _tp_v double")
    def ends(c, typ):
        """Do the values differ, and the leading bytes of the least and greatest."""
        head = F.substring(F.col(c).cast("binary"), 1, _HEAD) if isinstance(typ, _BYTES) else F.lit(None).cast("binary")
        return F.struct((~F.min(c).eqNullSafe(F.max(c))).alias("differ"), F.min(head).alias("low"), F.max(head).alias("high"))
    groups = seen.join(F.broadcast(wanted), ["_tp_k", "_tp_v"], "left_semi").groupBy("_tp_k", "_tp_v")
    found = {(r["_tp_k"], r["_tp_v"]): r["e"] for r in groups.agg(  # a row for each hot code
        F.array(*[ends(c, t) for c, t in zip(order_cols, types)]).alias("e")).collect()}
    following = []
    for k, x, share in hot:
        node = nodes[k]
        rows = node.rows & (code(order_cols[node.col], types[node.col], node.at) == F.lit(x))
        own = found.get((k, x))
        if own is not None and own[node.col]["differ"]:
            if not isinstance(types[node.col], _BYTES):
                continue  # values that share a double
            # what the least and the greatest share, all share: go on behind it
            same = len(os.path.commonprefix([bytes(own[node.col]["low"]), bytes(own[node.col]["high"])]))
            child = _Node(rows, node.col, max(node.at + PREFIX, same), share)
        elif node.col + 1 < len(order_cols):
            child = _Node(rows, node.col + 1, 0, share)
        else:
            continue
        node.hot[x] = child
        following.append(child)
    return following


def _path(node: _Node, order_cols: list[str], types: list[T.DataType]) -> Column:
    """The places of a row from this node on, as an array (arrays are ordered
    element by element)."""
    value = code(order_cols[node.col], types[node.col], node.at)
    hot = value.isin([float(x) for x in node.hot]) if node.hot else F.lit(False)
    # a hot code is the greatest of its bucket; it stands behind the others
    place = F.when(value.isNull(), F.lit(-1)).otherwise(2 * _below(value, node.bounds) + F.when(hot, 1).otherwise(0)).cast("int")
    rest = F.array().cast("array<int>")
    for x, child in node.hot.items():
        rest = F.when(value == F.lit(x), _path(child, order_cols, types)).otherwise(rest)
    return F.concat(F.array(place), rest) if node.hot else F.array(place)


def range_bucket(df: DataFrame, order_cols: list[str], n: int | None = None) -> Column:
    """A bucket (an array of places) that rises with the order of ``order_cols``,
    nulls first: about ``n`` buckets of like size, whatever the columns' types and
    however many rows share a value or a long prefix. Only rows equal in all order
    columns (or beyond ``LEVELS`` cuts) cannot be told apart."""
    n = _n_buckets(df, n)
    types = [df.schema[c].dataType for c in order_cols]
    root = _Node(F.lit(True), 0, 0, max(n, 1))
    if n <= 1:
        return F.array(F.lit(0))
    level, depth = [root], 0
    while level and depth < LEVELS:
        level, depth = _look(df, order_cols, level), depth + 1
    return _path(root, order_cols, types)


def running_totals(df: DataFrame, order_cols: list[str], sum_cols: list[str],
                   n: int | None = None, row_number: str | None = None,
                   prefix: str = "cum_") -> DataFrame:
    """Add inclusive running sums ``cum_<c>`` (and optionally a 1-based global
    row number) in the total order given by ``order_cols``.

    ``order_cols`` must identify rows uniquely for the order to be total. The
    input is read for the bounds, the totals and the result: pass something
    that is cheap to read again.
    """
    r = df.withColumn(_BUCKET, range_bucket(df, order_cols, n))
    totals = r.groupBy(_BUCKET).agg(*[F.sum(c).alias(c) for c in sum_cols], F.count(F.lit(1)).alias("_tp_n"))
    before = Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    # one row per bucket: ordering this table in one task is bounded by n
    offsets = totals.select(
        _BUCKET,
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_tp_off_{c}") for c in sum_cols],
        F.coalesce(F.sum("_tp_n").over(before), F.lit(0)).alias("_tp_off_n"))
    within = (Window.partitionBy(_BUCKET).orderBy(*[F.col(c) for c in order_cols])
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    new = {f"_tp_in_{c}": F.sum(c).over(within) for c in sum_cols}
    if row_number:
        new["_tp_in_n"] = F.row_number().over(within)
    j = r.withColumns(new).join(F.broadcast(offsets), _BUCKET)  # one row per bucket
    out = {f"{prefix}{c}": F.col(f"_tp_off_{c}") + F.col(f"_tp_in_{c}") for c in sum_cols}
    if row_number:
        out[row_number] = F.col("_tp_off_n") + F.col("_tp_in_n")
    return j.withColumns(out).drop(_BUCKET, "_tp_off_n", "_tp_in_n", *[f"_tp_off_{c}" for c in sum_cols], *[f"_tp_in_{c}" for c in sum_cols])
