"""6. Benchmark decontamination: a generalised suffix automaton.

The words of all benchmark items are compiled into one suffix automaton.  Words
of a document are streamed through it, tracking the longest suffix that is a
factor of some item; whenever that match is at least ``window`` words long, its
last ``window`` words are an item's window and are hit, and the automaton's
state names the items.  An item shorter than a window is one window by itself.
Only runs of words that all occur in the items are streamed, since any other
word resets the automaton.

The items are read in blocks of at most ``BLOCK_WORDS`` words; each block's
automaton is broadcast, and blocks follow one another over the documents, so
the broadcast has a bound whatever the size of the benchmark.

Defined cases: a null or empty text has no words and no hits; an item without
words has no window; items of equal text are all named; items without id mark
hits but are not named, ids repeated count once; an empty benchmark leaves all
documents clean; an empty table gives an empty result; ``scan`` ignores extra
columns, ``decontaminate`` carries them untouched.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapix.llm import textvec as tv
from terrapix.llm.worker import release, small_batches

WINDOW, BLOCK_WORDS, MAX_COVERAGE = 10, 1_000_000, 0.5
_SLOTS = 18


def word_hashes(buf: np.ndarray, off: np.ndarray):
    starts, ends, first = tv.word_spans(buf, off, tv.NOT_ALNUM)
    return tv.span_hashes(buf, starts, ends, lower=True), starts, ends, first


class Automaton:
    """Generalised suffix automaton over word hashes."""

    def __init__(self, items: list[tuple[str | None, np.ndarray]], window: int):
        self.window = window
        self.vocab = np.unique(np.concatenate([h for _, h in items])) if items else np.zeros(0, np.uint64)
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.names: dict[int, set] = defaultdict(set)  # state -> items that hold its words
        short: dict[int, dict[int, set]] = defaultdict(lambda: defaultdict(set))  # state -> length -> items
        self.least = window
        ended = []
        for name, h in items:
            if not len(h):
                continue
            last = 0
            for w in np.searchsorted(self.vocab, h).tolist():
                last = self._extend(last, w)
                ended.append((last, name))
            if len(h) < window:
                self.least = min(self.least, len(h))
                ended.append((last, (name, len(h))))
        # states are final only now: cloning has ended
        for state, what in ended:
            if isinstance(what, tuple):
                short[self._holder(state, what[1])][what[1]].add(what[0])
        up = [self._holder(s, window) if self.length[s] >= window else -1 for s in range(len(self.link))]
        self.full = up
        for state, what in ended:  # an item is named by every window state above its prefixes
            if not isinstance(what, tuple) and up[state] >= 0:
                self.names[up[state]].add(what)
        self.names = dict(self.names)
        self.short = {s: dict(d) for s, d in short.items()}
        order = sorted(range(len(self.link)), key=self.length.__getitem__)
        self.short_up = [-1] * len(self.link)  # nearest state, itself included, that ends a short item
        for s in order:
            self.short_up[s] = s if s in self.short else self.short_up[self.link[s]] if s else -1
        self._slots = None

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:
            q = self.next[last][w]
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, q, w)
        cur = len(self.next)
        self.next.append({}), self.length.append(self.length[last] + 1), self.link.append(0)
        p = last
        while p != -1 and w not in self.next[p]:
            self.next[p][w] = cur
            p = self.link[p]
        if p != -1:
            q = self.next[p][w]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, w)
        return cur

    def _clone(self, p: int, q: int, w: int) -> int:
        c = len(self.next)
        self.next.append(dict(self.next[q])), self.length.append(self.length[p] + 1), self.link.append(self.link[q])
        self.link[q] = c
        while p != -1 and self.next[p].get(w) == q:
            self.next[p][w] = c
            p = self.link[p]
        return c

    def _holder(self, state: int, n: int) -> int:
        """The suffix state whose strings include the last n words."""
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def ids(self, h: np.ndarray) -> np.ndarray:
        """Vocabulary number of each word, -1 for words of no item."""
        out = np.full(len(h), -1, np.int64)
        if len(self.vocab):
            if self._slots is None:
                self._slots = np.zeros(1 << _SLOTS, bool)
                self._slots[(self.vocab >> np.uint64(64 - _SLOTS)).astype(np.int64)] = True
            at = np.flatnonzero(self._slots[(h >> np.uint64(64 - _SLOTS)).astype(np.int64)])
            k = np.minimum(np.searchsorted(self.vocab, h[at]), len(self.vocab) - 1)
            hit = self.vocab[k] == h[at]
            out[at[hit]] = k[hit]
        return out

    def stream(self, h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, dict[int, set]]:
        """Which words of a chunk are hit, and the items met in each row."""
        n = len(h)
        hit, met = np.zeros(n, bool), defaultdict(set)
        w = self.ids(h)
        inside = w >= 0
        if not inside.any():
            return hit, met
        begin, end = inside.copy(), inside.copy()
        begin[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        cut = first[(first > 0) & (first < n)]
        begin[cut] |= inside[cut]
        end[cut - 1] |= inside[cut - 1]
        b, e = np.flatnonzero(begin), np.flatnonzero(end) + 1
        long = e - b >= self.least
        rows = np.searchsorted(first, b[long], "right") - 1
        nxt, link, length, window = self.next, self.link, self.length, self.window
        for lo, hi, row in zip(b[long].tolist(), e[long].tolist(), rows.tolist()):
            v = size = 0
            for i, x in enumerate(w[lo:hi].tolist(), lo):
                while v and x not in nxt[v]:
                    v = link[v]
                    size = length[v]
                if x in nxt[v]:
                    v = nxt[v][x]
                    size += 1
                if size >= window:
                    hit[i - window + 1:i + 1] = True
                    met[row] |= self.names[self.full[v]]
                s = self.short_up[v]
                while s > 0:
                    for k, names in self.short[s].items():
                        if k <= size:
                            hit[i - k + 1:i + 1] = True
                            met[row] |= names
                    s = self.short_up[link[s]] if link[s] > 0 else -1
        return hit, met


def automata(benchmark: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> list[Automaton]:
    """One automaton for each block of items.  The benchmark is a test set that
    is read block by block; the driver holds the blocks' automata."""
    items = benchmark.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t")).orderBy("i", "t")
    out, block, held = [], [], 0
    for r in items.toLocalIterator():
        t = (r["t"] or "").encode()
        h = word_hashes(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0]
        if held + len(h) > BLOCK_WORDS and block:
            out.append(Automaton(block, window))
            block, held = [], 0
        block.append((r["i"], h))
        held += len(h)
    if block:
        out.append(Automaton(block, window))
    return out


def _scan_chunk(found: list[Automaton], buf: np.ndarray, off: np.ndarray):
    h, starts, ends, first = word_hashes(buf, off)
    hit, met = np.zeros(len(h), bool), defaultdict(set)
    for a in found:
        one, items = a.stream(h, first)
        hit |= one
        for row, names in items.items():
            met[row] |= names
    return hit, met, starts, ends, first


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_hit, the items met (sorted as strings)."""
    small_batches(docs.sparkSession)
    thin = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = [docs.sparkSession.sparkContext.broadcast(a) for a in automata(benchmark, window)]  # BLOCK_WORDS each

    def run(batches):
        release()
        found = [s.value for s in shared]
        for b in batches:
            words, hits, items = [], [], []
            for r0, r1, buf, off in tv.chunks(b.column(1)):
                hit, met, _, _, first = _scan_chunk(found, buf, off)
                words.append(np.diff(first)), hits.append(tv.per_row(hit, first))
                items += [sorted(x for x in met.get(r, ()) if x is not None) for r in range(r1 - r0)]
            both = [np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (words, hits)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(both[0]), pa.array(both[1]), pa.array(items, pa.list_(pa.string()))], ["doc_id", "n_words", "n_hit", "items"])
    return thin.mapInArrow(run, f"doc_id {thin.schema['doc_id'].dataType.simpleString()}, n_words long, n_hit long, items array<string>")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE, text_col: str = "text") -> DataFrame:
    """``docs`` without the hit spans; a document whose hit words exceed the
    ``max_coverage`` share goes as a whole.  A span reaches from its first to
    its last hit word; what stands between spans stays."""
    small_batches(docs.sparkSession)
    at, schema = docs.columns.index(text_col), docs.schema
    shared = [docs.sparkSession.sparkContext.broadcast(a) for a in automata(benchmark, window)]

    def run(batches):
        release()
        found = [s.value for s in shared]
        for b in batches:
            texts, keep = b.column(at).to_pylist(), np.ones(b.num_rows, bool)
            changed = False
            for r0, r1, buf, off in tv.chunks(b.column(at)):
                hit, _, starts, ends, first = _scan_chunk(found, buf, off)
                for r in np.flatnonzero(tv.per_row(hit, first)).tolist():
                    a, z = int(first[r]), int(first[r + 1])
                    marks = hit[a:z]
                    keep[r0 + r] = marks.sum() <= max_coverage * (z - a)
                    raw, here, parts = buf[off[r]:off[r + 1]].tobytes(), 0, []
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
                    for s, e in zip(edge[::2].tolist(), edge[1::2].tolist()):
                        parts.append(raw[here:int(starts[a + s] - off[r])])
                        here = int(ends[a + e - 1] - off[r])
                    texts[r0 + r] = b"".join([*parts, raw[here:]]).decode()
                    changed = True
            cols = list(b.columns)
            if changed:
                cols[at] = pa.array(texts, b.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(cols, schema=b.schema).filter(pa.array(keep))
    return docs.mapInArrow(run, schema)
