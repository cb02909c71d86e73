"""Overlapping spans of pixel rows -> the visible ones.

A span is (row, first column, last column) with a priority; where spans overlap,
the highest priority is seen.  ``visible_spans`` returns disjoint spans: a row of
the table for each stretch of one winner, never a row per pixel.

Twice the same step: in the tasks that make the spans, a batch at a time, and
after a shuffle on the pixel row.  A crowded pixel row is thus reduced to at most
its width in every batch before it is shuffled, and its parts meet as painted
stretches, whatever the number of polygons.  Painting is numpy on a canvas of the
batch's rows: columns of the spans in the order of their priority, the last write
stays; a canvas is at most ``CELLS`` pixels, or one pixel row and one span.

``polygon_spans`` makes the spans from polygons' edges, where the polygons are: rows
of one parcel stand side by side, and what a batch paints goes on to the pixel rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

CELLS = 1 << 22
#: edge crossings laid out at once, or those of one parcel
CROSSINGS = 1 << 20
_ORDER = ("parcel_id", "binary_id")


def paint(group: np.ndarray, first: np.ndarray, last: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, index of the winning span) of the visible stretches, by group
    and column. ``group`` numbers the pixel rows from 0, ``rank`` orders spans."""
    groups = int(group.max()) + 1
    low = np.full(groups, np.iinfo(np.int64).max)
    high = np.full(groups, -1, np.int64)
    np.minimum.at(low, group, first)
    np.maximum.at(high, group, last)
    size = np.maximum(high - low + 1, 0)
    base = np.cumsum(size) - size
    order = np.argsort(rank, kind="stable")
    length = (last - first + 1)[order]
    start = (base[group] + first - low[group])[order]
    cell = np.repeat(start - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
    canvas = np.full(int(size.sum()), -1, np.int64)
    canvas[cell] = np.repeat(order, length)
    new = np.ones(len(canvas), bool)
    new[1:] = canvas[1:] != canvas[:-1]
    new[base[size > 0]] = True
    at = np.flatnonzero(new)
    end = np.append(at[1:], len(canvas))
    seen = canvas[at] >= 0
    at, end = at[seen], end[seen]
    row = np.searchsorted(base, at, "right") - 1
    return at - base[row] + low[row], end - 1 - base[row] + low[row], canvas[at]


def _canvas(spans: pa.Table, group: np.ndarray) -> pa.Table:
    """The visible spans of a table, on one canvas."""
    spans = spans.combine_chunks()
    first, last = (spans.column(c).to_numpy().astype(np.int64) for c in ("_a", "_b"))
    rank = np.empty(spans.num_rows, np.int64)
    rank[pc.sort_indices(spans, [(c, "ascending") for c in _ORDER]).to_numpy()] = np.arange(spans.num_rows)
    a, b, winner = paint(np.unique(group, return_inverse=True)[1], first, last, rank)
    out = spans.take(pa.array(winner))
    for name, values in (("_a", a), ("_b", b)):
        k = out.schema.get_field_index(name)
        out = out.set_column(k, out.schema.field(k), pa.array(values, out.schema.field(k).type))
    return out


def _painted(spans: pa.Table, by: list[str]) -> pa.Table:
    """The visible spans of a table, on canvases of bounded size: cut between pixel
    rows; a pixel row beyond the bound is painted piece by piece onto itself."""
    n = spans.num_rows
    if not n:
        return spans
    group = spans.select(by).to_pandas().groupby(by, dropna=False, sort=False).ngroup().to_numpy()
    order = np.argsort(group, kind="stable")
    spans, group = spans.take(pa.array(order)), group[order]
    total = np.concatenate([[0], np.cumsum(pc.subtract(spans.column("_b"), spans.column("_a")).to_numpy().astype(np.int64) + 1)])
    begins = np.searchsorted(group, group, "left")  # first span of the row of each span
    parts, at = [], 0
    while at < n:
        z = max(at + 1, int(np.searchsorted(total, total[at] + CELLS, "right")) - 1)
        if z < n and begins[z] > at:
            z = int(begins[z])
        if z == n or begins[z] == z:
            parts.append(_canvas(spans.slice(at, z - at), group[at:z]))
            at = z
            continue
        end = int(np.searchsorted(group, group[at], "right"))
        row = spans.slice(at, 0)
        while at < end:
            z = min(end, max(at + 1, int(np.searchsorted(total, total[at] + CELLS, "right")) - 1))
            both = pa.concat_tables([row, spans.slice(at, z - at)])
            row, at = _canvas(both, np.zeros(both.num_rows, np.int64)), z
        parts.append(row)
    return pa.concat_tables(parts)


def _begins(table: pa.Table, columns: list[str]) -> np.ndarray:
    """Whether each row differs from the one before in some column; nulls are equal."""
    new = np.ones(table.num_rows, bool)
    new[1:] = False
    for c in columns:
        v = table.column(c).combine_chunks()
        a, b = v.slice(0, len(v) - 1), v.slice(1)
        differ = pc.if_else(pc.or_(pc.is_null(a), pc.is_null(b)), pc.xor(pc.is_null(a), pc.is_null(b)), pc.fill_null(pc.not_equal(a, b), False))
        new[1:] |= np.asarray(differ.to_numpy(zero_copy_only=False), bool)
    return new


def _filled(polygons: pa.Table, begins: np.ndarray, key: list[str]) -> Iterator[pa.Table]:
    """The inside spans of polygons (even-odd over the rows of a parcel, which
    ``begins`` marks), a bounded number of crossings at a time."""
    edges = polygons.column("edges").combine_chunks()
    size = pc.fill_null(pc.list_value_length(edges), 0).to_numpy().astype(np.int64)
    flat = edges.flatten()
    lo, hi, x1, y1, x2, y2 = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("lo", "hi", "x1", "y1", "x2", "y2"))
    owner = np.repeat(np.arange(len(size)), size)
    parcel = np.cumsum(begins) - 1
    w, gx0, gy1, res, binary = (polygons.column(c).to_numpy() for c in ("w", "gx0", "gy1", "res", "binary_id"))
    high = hi.astype(np.int64) - lo + 1
    total = np.concatenate([[0], np.cumsum(high)])
    first = np.searchsorted(parcel[owner], np.arange(parcel[-1] + 2))  # first edge of each parcel

    def column(v, o):  # first pixel column whose centre is >= v
        c = np.ceil((v - gx0[o]) / res[o] - 0.5)
        return np.where(np.isnan(c), 0, np.clip(c, -1, 1 << 31)).astype(np.int64)
    at = 0
    while at <= parcel[-1]:
        end = max(at + 1, int(np.searchsorted(total[first], total[first[at]] + CROSSINGS, "right")) - 1)
        e = np.repeat(np.arange(first[at], first[end]), high[first[at]:first[end]])
        r = lo[e] + (np.arange(len(e)) - (total[e] - total[first[at]]))
        o = owner[e]
        with np.errstate(all="ignore"):
            x = x1[e] + (x2[e] - x1[e]) * (gy1[o] - (r + 0.5) * res[o] - y1[e]) / (y2[e] - y1[e])
        order = np.lexsort((x, r, parcel[o]))
        x, r, o = x[order], r[order], o[order]
        at = end
        if len(x) < 2:
            continue
        new = np.ones(len(x), bool)
        new[1:] = (r[1:] != r[:-1]) | (parcel[o[1:]] != parcel[o[:-1]])
        begin = np.flatnonzero(new)
        odd = (np.arange(len(x)) - np.repeat(begin, np.diff(np.append(begin, len(x))))) % 2 == 1
        b = np.flatnonzero(odd)  # the second of each two
        a = b - 1
        for v in (binary, w, gx0, res):
            same = v[o[a]] == v[o[b]]
            a, b = a[same], b[same]
        with np.errstate(all="ignore"):
            left, right = np.maximum(column(x[a], o[a]), 0), np.minimum(column(x[b], o[b]) - 1, w[o[b]] - 1)
        seen = left <= right
        made = polygons.select([*key, "w", *_ORDER]).take(pa.array(o[a][seen]))
        for name, v in (("_r", r[a]), ("_a", left), ("_b", right)):
            made = made.append_column(pa.field(name, pa.int32()), pa.array(v[seen].astype(np.int32)))
        yield made.select([*key, "w", "_r", *_ORDER, "_a", "_b"])


def polygon_spans(polygons: DataFrame, key: list[str]) -> DataFrame:
    """The visible spans of polygons: key, w, parcel_id, binary_id, grid origin gx0,
    gy1, res, and ``edges`` with the first and last pixel row (lo, hi) that each
    meets. Rows of a (key, parcel_id) stand side by side in their partition."""
    by = [*key, "w", "_r"]

    def spans_of(it) -> Iterator[pa.RecordBatch]:
        """A batch's last parcel goes on in the next."""
        rest: pa.Table | None = None
        for batch in it:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if rest is not None:
                table = pa.concat_tables([rest, table])
            begins = _begins(table, [*key, "parcel_id"])
            cut = int(np.flatnonzero(begins)[-1])
            rest = table.slice(cut)
            if cut:
                for made in _filled(table.slice(0, cut), begins[:cut], key):
                    yield from _painted(made, by).to_batches()
        if rest is not None:
            for made in _filled(rest, _begins(rest, [*key, "parcel_id"]), key):
                yield from _painted(made, by).to_batches()
    types = {f.name: f.dataType.simpleString() for f in polygons.schema}
    types |= {c: "int" for c in ("_r", "_a", "_b")}
    schema = ", ".join(f"{c} {types[c]}" for c in (*by, *_ORDER, "_a", "_b"))
    return _merged(polygons.mapInArrow(spans_of, schema), by)


def visible_spans(spans: DataFrame, by: list[str]) -> DataFrame:
    """Disjoint spans (``by``, parcel_id, binary_id, _a, _b): of overlapping spans
    of one pixel row the one of the highest parcel is seen. ``by`` names the
    columns that tell pixel rows apart, ``_a`` and ``_b`` are inclusive."""
    columns = [*by, *_ORDER, "_a", "_b"]
    spans = spans.select(*columns)

    def batches_of(it) -> Iterator[pa.RecordBatch]:
        for b in it:
            yield from _painted(pa.Table.from_batches([b]), by).to_batches()

    return _merged(spans.mapInArrow(batches_of, spans.schema), by)


def _merged(part: DataFrame, by: list[str]) -> DataFrame:
    """The visible of a table's spans, met on their pixel row."""
    def rows_of(it) -> Iterator[pa.RecordBatch]:
        """Batches ordered by pixel row: the last row of a batch goes on in the next."""
        rest: pa.Table | None = None
        for b in it:
            if not b.num_rows:
                continue
            table = pa.Table.from_batches([b])
            if rest is not None:
                table = pa.concat_tables([rest, table])
            keys = table.select(by).slice(table.num_rows - 1).to_pylist()[0]
            same = pa.array(np.ones(table.num_rows, bool))
            for c, v in keys.items():
                column = table.column(c)
                hit = pc.is_null(column) if v is None else pc.fill_null(pc.equal(column, pa.scalar(v, column.type)), False)
                same = pc.and_(same, hit)
            rest = _painted(table.filter(same), by)
            yield from _painted(table.filter(pc.invert(same)), by).to_batches()
        if rest is not None:
            yield from rest.to_batches()
    return part.repartition(*by).sortWithinPartitions(*by).mapInArrow(rows_of, part.schema)

