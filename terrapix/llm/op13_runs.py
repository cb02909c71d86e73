"""13. Periodic run detection: longest common extensions by difference cover.

A run is a stretch of consecutive words with smallest period q (words q apart
are equal), at least ``EXPONENT`` periods and ``MIN_LENGTH`` words long, that no
neighbouring word extends.  All runs of a text are found, in any text length:

* Harmonic grid.  A run of period p and 4p words or more holds three multiples
  of p in a row whose words equal the word p further on.  For every p the words
  at multiples of p are compared with their neighbours on the grid (n/p compares,
  n log n for all p); only such triples go on.
* Longest common extension of (i, i + p) to the right, and on the reversed words
  to the left, gives the run's borders.  ``Extensions`` answers it with a
  difference cover D modulo v = 13: only suffixes starting at cover positions are
  sorted, by prefix doubling over blocks of v words (a cover position plus v is a
  cover position again).  A query compares fewer than v words until both
  positions fall on the cover, takes the fewest common blocks of neighbours
  between the two ranks from a sparse table, and compares the words of the first
  block that differs.
* A run counts at its first grid position only, and a stretch found under several
  multiples of its period counts under the smallest.

Documents of an Arrow batch are handled together, about a MB at a time; words are
64-bit hashes salted by document, so nothing matches across documents.  Suffixes
are sorted only for documents with triples left after a few words' comparison.
One document is the unit of work: memory follows ``textvec.CHUNK_BYTES`` or the
longest text, work is n log n in it.  No shuffle.

Defined cases: a null or empty text has no words and no runs; words are equal
byte by byte (no case folding); white space is ASCII's; a repeated row has the
same runs; null ids are carried; an empty table gives an empty one; extra columns
are ignored, or carried by ``collapse``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapix.llm import textvec as tv
from terrapix.llm.worker import release, small_batches

EXPONENT, MIN_LENGTH = 4, 6
#: fixed values: a perfect difference cover, every difference modulo 13 occurs once
COVER_PERIOD, COVER = 13, (0, 1, 3, 9)
#: words compared before suffixes are sorted
_PEEK = 4
_SALT = np.uint64(0x9E3779B97F4A7C15)


def _start_of_difference() -> np.ndarray:
    """For each difference d, the cover element a with a + d in the cover."""
    out = np.zeros(COVER_PERIOD, np.int64)
    for a in COVER:
        for b in COVER:
            out[(b - a) % COVER_PERIOD] = a
    return out


_FIRST = _start_of_difference()
_SLOT = np.full(COVER_PERIOD, -1, np.int64)
_SLOT[list(COVER)] = np.arange(len(COVER))


class Extensions:
    """Longest common extensions to the right between positions of one array."""

    def __init__(self, words: np.ndarray):
        v, d = COVER_PERIOD, len(COVER)
        self.n = len(words)
        blocks = -(-self.n // v)
        self.words = np.concatenate([words, np.zeros((blocks + 2) * v - self.n, np.uint64)])
        at = (np.arange(blocks)[:, None] * v + np.array(COVER)).ravel()
        key = tv.shingles(self.words[:(blocks + 1) * v + v - 1], v)[at]
        rank = np.unique(key, return_inverse=True)[1] + 1
        levels, step, m = [rank], d, len(at)
        while len(levels[-1]) and levels[-1].max() < m and step < m + d:
            following = np.zeros(m, np.int64)
            following[:max(0, m - step)] = levels[-1][step:]
            pair = levels[-1] * (m + 1) + following
            levels.append(np.unique(pair, return_inverse=True)[1] + 1)
            step *= 2
        order = np.argsort(levels[-1], kind="stable")
        self.rank = np.empty(m, np.int64)
        self.rank[order] = np.arange(m)
        # common prefixes of neighbours in whole blocks, by the doubling's levels
        x, y = order[:-1].copy(), order[1:].copy()
        common = np.zeros(max(m - 1, 0), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            padded = np.concatenate([levels[k], np.zeros(1, np.int64)])
            left, right = padded[np.minimum(x, m)], padded[np.minimum(y, m)]
            same = (left == right) & (left > 0)
            hop = np.where(same, d << k, 0)
            x, y = x + hop, y + hop
            common += np.where(same, v << k, 0)
        self.table = [common]
        while 2 << (len(self.table) - 1) <= len(common):
            half = 1 << (len(self.table) - 1)
            self.table.append(np.minimum(self.table[-1][:-half], self.table[-1][half:]))

    def _compare(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from (i, j) on, at most ``most`` (up to the cover period)."""
        out = np.zeros(len(i), np.int64)
        live = np.flatnonzero((most > 0) & (np.maximum(i, j) < self.n))
        for t in range(COVER_PERIOD):
            a, b = i[live] + t, j[live] + t
            live = live[(np.maximum(a, b) < self.n) & (self.words[np.minimum(a, self.n)] == self.words[np.minimum(b, self.n)])]
            if not len(live):
                break
            out[live] = t + 1
            live = live[most[live] > t + 1]
        return out

    def _slot(self, at: np.ndarray) -> np.ndarray:
        return at // COVER_PERIOD * len(COVER) + _SLOT[at % COVER_PERIOD]

    def right(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common extension of each pair i < j."""
        shift = (_FIRST[(j - i) % COVER_PERIOD] - i) % COVER_PERIOD
        out = self._compare(i, j, shift)
        whole = np.flatnonzero((out == shift) & (j + shift < self.n))
        if len(whole):
            a = self.rank[self._slot(i[whole] + shift[whole])]
            b = self.rank[self._slot(j[whole] + shift[whole])]
            low, high = np.minimum(a, b), np.maximum(a, b)
            level = np.frexp((high - low).astype(np.float64))[1] - 1
            for k in np.unique(level):
                of = np.flatnonzero(level == k)
                row = self.table[k]
                out[whole[of]] += np.minimum(row[low[of]], row[high[of] - (1 << int(k))])
            out[whole] += self._compare(i[whole] + out[whole], j[whole] + out[whole], np.full(len(whole), COVER_PERIOD))
        return out


def _triples(w: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(i, p): i, i + p and i + 2p are multiples of p whose words equal the word
    p further on, for every p from ``low`` to ``high``."""
    n = len(w)
    starts, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    turn = min(high, max(low - 1, int(np.sqrt(n))))
    for p in range(low, turn + 1):  # few periods, many grid points: along the grid
        grid = w[::p]
        same = grid[:-1] == grid[1:]
        if len(same) > 2:
            i = np.flatnonzero(same[:-2] & same[1:-1] & same[2:])
            if len(i):
                starts.append(i * p)
                periods.append(np.full(len(i), p))
    # many periods, few grid points: along the periods
    p = np.arange(turn + 1, high + 1)
    k = 0
    while len(p) and (k + 3) * p[0] < n:
        p = p[(k + 3) * p < n]
        hit = p[w[k * p] == w[(k + 1) * p]]
        hit = hit[w[(k + 1) * hit] == w[(k + 2) * hit]]
        hit = hit[w[(k + 2) * hit] == w[(k + 3) * hit]]
        if len(hit):
            starts.append(k * hit)
            periods.append(hit)
        k += 1
    return np.concatenate(starts), np.concatenate(periods)


def _borders(w: np.ndarray, i: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of the stretches whose first grid position is i."""
    forward = Extensions(w).right(i, i + p)
    live = forward > 2 * p
    i, p, forward = i[live], p[live], forward[live]
    if not len(i):
        return i, i, p
    back = Extensions(np.ascontiguousarray(w[::-1]))
    n = len(w)
    before = np.zeros(len(i), np.int64)
    some = np.flatnonzero(i > 0)
    before[some] = back.right(n - i[some] - p[some], n - i[some])
    live = (before < p) & (before + p + forward >= np.maximum(MIN_LENGTH, EXPONENT * p))
    return (i - before)[live], (before + p + forward)[live], p[live]


class _Reach:
    """The stretches found so far, by how far those starting before a word reach."""

    def __init__(self, start: np.ndarray, length: np.ndarray, period: np.ndarray):
        order = np.lexsort((period, start))
        self.start, end, period = start[order], (start + length)[order], period[order]
        self.end = np.maximum.accumulate(end)
        further = np.ones(len(end), bool)  # of equal reach the first, the smallest period
        further[1:] = end[1:] > self.end[:-1]
        self.period = period[np.maximum.accumulate(np.where(further, np.arange(len(end)), 0))]

    def repeats(self, i: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Triples that lie in a stretch whose period divides theirs: what they
        belong to is that stretch again."""
        if not len(self.start):
            return np.zeros(len(i), bool)
        k = np.searchsorted(self.start, i, "right") - 1
        return (k >= 0) & (self.end[k] > i + 3 * p) & (p % self.period[k] == 0)


def runs_of(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length, period) of all runs, by document, start and
    period.  ``words`` are hashes, ``first`` the first word of each document and
    the total at the end."""
    sizes = np.diff(first)
    longest = int(sizes.max(initial=0))
    of = np.repeat(np.arange(len(sizes)), sizes)
    w = tv.mix(words + tv.mix(of.astype(np.uint64) + np.uint64(1)) * _SALT)
    w |= np.uint64(1)  # 0 stands for the end
    start = length = period = np.zeros(0, np.int64)
    low, top = 1, longest // EXPONENT
    while low <= top:  # periods by eights, so that multiples of a period found are seen as such
        high = min(top, low * 8 - 1)
        i, p = _triples(w, low, high)
        low = high + 1
        again = _Reach(start, length, period).repeats(i, p)
        i, p = i[~again], p[~again]
        for t in range(1, _PEEK):  # a run with three grid points goes on for 2p words
            live = (t > 2 * p) | ((i + p + t < len(w)) & (w[np.minimum(i + t, len(w) - 1)] == w[np.minimum(i + p + t, len(w) - 1)]))
            i, p = i[live], p[live]
        if not len(i):
            continue
        # suffixes are sorted for the documents that still have triples
        busy = np.zeros(len(sizes), bool)
        busy[of[i]] = True
        gone = np.cumsum(np.where(busy, 0, sizes))
        s, n, q = _borders(w[busy[of]], i - gone[of[i]], p)
        left = gone[busy][np.searchsorted(np.cumsum(sizes[busy]), s, "right")]
        start, length, period = np.concatenate([start, s + left]), np.concatenate([length, n]), np.concatenate([period, q])
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.ones(len(start), bool)  # of equal stretches the smallest period
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    return of[start] if len(start) else start, start - first[of[start]] if len(start) else start, length, period


@dataclass
class Document:
    """A row's runs as arrays, and its words when anything is dropped."""

    n_words: int
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray
    raw: bytes

    def best(self) -> int | None:
        """The run of greatest length/period; ties: smallest start, then period."""
        at = None
        for k, (s, n, q) in enumerate(zip(self.start.tolist(), self.length.tolist(), self.period.tolist())):
            if at is None:
                at, best = k, (n, q, s)
                continue
            left, right = n * best[1], best[0] * q
            if left > right or (left == right and (s, q) < (best[2], best[1])):
                at, best = k, (n, q, s)
        return at

    def listing(self) -> str:
        return "".join(f"{s},{n},{q}\n" for s, n, q in zip(self.start.tolist(), self.length.tolist(), self.period.tolist()))

    def collapsed(self) -> bytes:
        """The words that no run repeats, joined by one space: of each run its
        first period stays."""
        words = self.raw.split()
        if not len(self.start):
            return b" ".join(words)
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, self.start + self.period, 1)
        np.add.at(edge, self.start + self.length, -1)
        return b" ".join([words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()])


Rewrite = Callable[[object, bytes], bytes]


def _documents(batch: pa.RecordBatch, rewrite: Rewrite | None) -> Iterator[Document]:
    """The rows of a batch (id, text) in order."""
    texts = batch.column(1)
    if rewrite is not None:
        ids = batch.column(0).to_pylist()
        texts = pa.array([rewrite(i, t or b"") for i, t in zip(ids, texts.to_pylist())], pa.large_binary() if texts.nbytes > 1 << 30 else pa.binary())
    for _, _, buf, off in tv.chunks(texts):
        starts, ends, first = tv.word_spans(buf, off, tv.SPACE)
        h = tv.span_hashes(buf, starts, ends, lower=False) if len(buf) else np.zeros(0, np.uint64)
        doc, start, length, period = runs_of(h, first)
        at = np.searchsorted(doc, np.arange(len(off)))
        raw = buf.tobytes()
        for r in range(len(off) - 1):
            s = slice(at[r], at[r + 1])
            yield Document(int(first[r + 1] - first[r]), start[s], length[s], period[s], raw[off[r]:off[r + 1]])


def _thin(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, period): a row for each run; start is a word's number."""
    def run(batches):
        release()
        for b in batches:
            found = list(_documents(b, None))
            counts = [len(d.start) for d in found]
            cat = lambda k: pa.array(np.concatenate([getattr(d, k) for d in found]) if found else np.zeros(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(np.repeat(np.arange(len(found)), counts), pa.int64())), cat("start"), cat("length"), cat("period")],
                                             ["doc_id", "start", "length", "period"])
    thin = _thin(docs, id_col, text_col)
    return thin.mapInArrow(run, f"doc_id {thin.schema['doc_id'].dataType.simpleString()}, start long, length long, period long")


def summary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite: Rewrite | None = None) -> DataFrame:
    """One row for each document: (doc_id, n_words, n_runs, start, length, period,
    exponent_milli, runs_sha256, collapsed_sha256); the run is the one of greatest
    exponent.  ``rewrite(id, bytes)`` may change a text before it is read."""
    def run(batches):
        release()
        for b in batches:
            rows = []
            for d in _documents(b, rewrite):
                k = d.best()
                one = (None,) * 4 if k is None else (int(d.start[k]), int(d.length[k]), int(d.period[k]), 1000 * int(d.length[k]) // int(d.period[k]))
                rows.append((d.n_words, len(d.start), *one, hashlib.sha256(d.listing().encode()).hexdigest(), hashlib.sha256(d.collapsed()).hexdigest()))
            columns = list(zip(*rows)) if rows else [()] * 8
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, pa.int64()) for c in columns[:6]], *[pa.array(c, pa.string()) for c in columns[6:]]],
                                             ["doc_id", "n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])
    thin = _thin(docs, id_col, text_col)
    kind = thin.schema["doc_id"].dataType.simpleString()
    return thin.mapInArrow(run, f"doc_id {kind}, n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string")


def collapse(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with each run cut to its first period, words joined by one
    space; texts without runs and all other columns stay as they are."""
    small_batches(docs.sparkSession)
    k = docs.columns.index(text_col)

    def run(batches):
        release()
        for b in batches:
            old = b.column(k).to_pylist()
            texts = pa.RecordBatch.from_arrays([pa.nulls(b.num_rows), b.column(k).cast(pa.binary())], ["doc_id", "text"])
            new = [d.collapsed().decode("utf-8", "replace") if len(d.start) else t for t, d in zip(old, _documents(texts, None))]
            yield pa.RecordBatch.from_arrays([pa.array(new, b.schema.field(j).type) if j == k else b.column(j) for j in range(b.num_columns)], names=b.schema.names)
    return docs.mapInArrow(run, docs.schema)
