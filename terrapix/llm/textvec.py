"""Vectorised text primitives shared by the operators.

Texts arrive as Arrow string batches; words, lines and their 64-bit hashes are
computed on the raw UTF-8 bytes with numpy, a chunk of documents at a time, so
the memory of a task is bounded by ``CHUNK_BYTES`` (or one document, when a
single text is longer).  All separators used by the operators are ASCII, so
byte-level splitting equals code-point-level splitting.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
#: ASCII white space: space, \t, \n, \v, \f, \r
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: everything but 0-9, letters and non-ASCII
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

_MUL = np.uint64(0x9E3779B97F4A7C15 | 1)
_INV = np.uint64(pow(int(_MUL), -1, 1 << 64))
_rng = np.random.default_rng(20240229)
_BYTES = _rng.integers(1, 1 << 63, (2, 256), dtype=np.uint64) | np.uint64(1)  # two independent hash functions
_BYTES_LOWER = _BYTES.copy()
_BYTES_LOWER[:, 0x41:0x5B] = _BYTES[:, 0x61:0x7B]
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """mul**i and mul**-i (mod 2**64) for i in 0..n."""
    if len(_powers[0]) <= n:
        size = max(n + 1, CHUNK_BYTES + 1)
        for k, base in enumerate((_MUL, _INV)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut an Arrow string/binary column into runs of rows of about ``limit``
    bytes: (first row, end row, bytes, offsets of rows in them).  Nulls are
    empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if len(texts) == 0:
        return
    kind = texts.type
    if pa.types.is_string(kind) or pa.types.is_binary(kind):
        if texts.null_count:
            texts = texts.fill_null(b"" if pa.types.is_binary(kind) else "")
        width = np.int32
    else:
        texts = texts.cast(pa.large_string()).fill_null("")
        width = np.int64
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, width)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i, n = 0, len(texts)
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j, raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool, which: int = 0) -> np.ndarray:
    """64-bit hash of each byte span; ``lower`` folds A-Z.  ``which`` names one
    of two independent functions, for 128-bit keys."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _power_tables(len(buf))
    run = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((_BYTES_LOWER if lower else _BYTES)[which][buf] * up[:len(buf)], out=run[1:])
    h = (run[ends] - run[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_spans(buf: np.ndarray, offsets: np.ndarray, sep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a chunk, and the first word of each row
    (with the total at the end).  Words never cross rows."""
    n = len(buf)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    inside = ~sep[buf]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cut = offsets[(offsets > 0) & (offsets < n)]
    first[cut] |= inside[cut]
    last[cut - 1] |= inside[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets, "left")


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n consecutive words (no row boundaries here)."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    m = len(hashes) - n + 1
    h = np.zeros(m, np.uint64)
    for k in range(n):
        h = h * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[k:k + m]
    return mix(h)


def window_rows(first: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which of the ``total - n + 1`` windows of n words stay within one row."""
    m = max(0, total - n + 1)
    ok = np.ones(m, bool)
    for k in range(1, n):
        cut = first[1:-1] - k
        ok[cut[(cut >= 0) & (cut < m)]] = False
    return ok


def line_spans(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every line (the text between line feeds); an
    empty row has one empty line."""
    feeds = np.flatnonzero(buf == 0x0A)
    starts = np.concatenate([off[:-1], feeds + 1])
    rows = np.concatenate([np.arange(len(off) - 1), np.searchsorted(off, feeds, "right") - 1])
    order = np.lexsort((starts, rows))
    starts, rows = starts[order], rows[order]
    ends = np.empty_like(starts)
    ends[:-1] = np.where(rows[1:] == rows[:-1], starts[1:] - 1, off[rows[:-1] + 1])
    if len(ends):
        ends[-1] = off[rows[-1] + 1]
    return starts, ends, rows


def per_row(cum: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums per row from values per byte or word."""
    run = np.zeros(len(cum) + 1, np.int64)
    np.cumsum(cum, out=run[1:])
    return run[offsets[1:]] - run[offsets[:-1]]
