"""7. Quality rules: isolation forest on rule statistics.

Every document gets rule statistics (words, symbols, duplicate lines, repeated
three-word windows, upper case, immediate repeats, punctuation).  An isolation
forest is grown on a bounded sample of labelled rows (``SAMPLE`` rows, a
``CONTAMINATION`` share of them labelled bad); documents that random splits
isolate quickly have short paths and a high anomaly score.  The threshold is
calibrated on the scores of *all* labelled rows: the score that maximises
(bad rows rejected) - ``GOOD_WEIGHT`` x (good rows rejected), as shares.

Defined cases: a null text has no words and fails the base rule (n_words < 50);
documents failing the base rule are never kept; repeated rows get equal
verdicts; without labelled rows the forest is grown on a sample of all rows and
the threshold is ``DEFAULT_THRESHOLD``; without any rows it keeps by the base
rule alone (and has nothing to judge); extra columns are carried untouched by
``judge`` and ignored elsewhere.  Labels repeated for an id count once, the
worst wins; null labels are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapix.llm import textvec as tv
from terrapix.llm.store import written
from terrapix.llm.worker import release, small_batches

SAMPLE, TREES, PSI, CONTAMINATION, GOOD_WEIGHT, DEFAULT_THRESHOLD, SEED = 20_000, 128, 256, 0.05, 20.0, 0.62, 7
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_upper", "n_punct", "n_echo"]
#: duplicate lines and repeated windows are left to the base rule
FEATURES = ["mean_word", "symbols", "upper", "punct", "echo"]
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[list(b"!?;:=+/\\_^~@[](){}\"'`")] = True


def chunk_stats(buf: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """The statistics of the rows of one chunk."""
    n = len(off) - 1
    starts, ends, first = tv.word_spans(buf, off, tv.SPACE)
    words = np.diff(first)
    point = (buf & 0xC0) != 0x80
    h = tv.span_hashes(buf, starts, ends, lower=False) if len(buf) else np.zeros(0, np.uint64)
    # three-word windows found twice or more in their row
    win, inside = tv.shingles(h, 3), tv.window_rows(first, 3, len(h))
    row_of = np.repeat(np.arange(n, dtype=np.uint64), words)
    salt = tv.mix(np.arange(n, dtype=np.uint64) + np.uint64(1))
    covered = np.zeros(len(h) + 2, bool)
    if len(win):
        at = np.flatnonzero(inside)
        key = win[at] ^ salt[row_of[at].astype(np.int64)]
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        hit = at[twice]
        for k in range(3):
            covered[hit + k] = True
    echo = np.zeros(len(h), bool)
    if len(h) > 1:
        echo[1:] = (h[1:] == h[:-1]) & (row_of[1:] == row_of[:-1])
    # lines with a word, equal to an earlier line of their row
    line_s, line_e, line_row = tv.line_spans(buf, off)
    wordy = np.searchsorted(starts, line_s, "left") < np.searchsorted(starts, line_e, "left")
    line_s, line_e, line_row = line_s[wordy], line_e[wordy], line_row[wordy]
    key = tv.span_hashes(buf, line_s, line_e, lower=False) ^ salt[line_row] if len(line_s) else np.zeros(0, np.uint64)
    _, firsts = np.unique(key, return_index=True)
    lines = np.bincount(line_row, minlength=n)
    dup = lines - np.bincount(line_row[firsts], minlength=n)
    return {
        "n_words": words, "word_chars": tv.per_row(point & ~tv.SPACE[buf], off), "n_symbols": tv.per_row(_SYMBOL[buf], off),
        "n_dup_lines": dup, "n_repeat_words": tv.per_row(covered[:len(h)], first),
        "n_upper": tv.per_row(_UPPER[buf], off), "n_punct": tv.per_row(_PUNCT[buf], off), "n_echo": tv.per_row(echo, first),
    }


def batch_stats(texts: pa.Array) -> dict[str, np.ndarray]:
    parts = [chunk_stats(buf, off) for _, _, buf, off in tv.chunks(texts)]
    return {k: np.concatenate([p[k] for p in parts]).astype(np.int64) if parts else np.zeros(0, np.int64) for k in BASE + EXTRA}


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    """Rates that do not depend on a document's length, one row each."""
    words, chars = np.maximum(s["n_words"], 1), np.maximum(s["word_chars"], 1)
    return np.column_stack([
        np.minimum(s["word_chars"] / words, 40.0), s["n_symbols"] / chars, s["n_upper"] / chars, s["n_punct"] / chars, s["n_echo"] / words,
    ])


def base_failed(s: dict[str, np.ndarray]) -> np.ndarray:
    return (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])


def _expected_path(n: float) -> float:
    """Mean path length of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (np.log(n - 1.0) + 0.5772156649) - 2.0 * (n - 1.0) / n


@dataclass
class Forest:
    """Isolation trees as flat arrays: split feature (-1: leaf), cut, children,
    and a leaf's path length."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    path: np.ndarray
    roots: np.ndarray
    scale: float
    threshold: float = DEFAULT_THRESHOLD

    @staticmethod
    def grow(x: np.ndarray, trees: int = TREES, psi: int = PSI, seed: int = SEED) -> "Forest":
        rng = np.random.default_rng(seed)
        psi = min(psi, len(x))
        deepest = int(np.ceil(np.log2(max(psi, 2)))) + 2
        feature, cut, left, path, roots = [], [], [], [], []

        def node() -> int:
            feature.append(-1), cut.append(0.0), left.append(0), path.append(0.0)
            return len(feature) - 1

        for _ in range(trees if psi else 0):
            roots.append(node())
            todo = [(roots[-1], x[rng.choice(len(x), psi, replace=False)], 0)]
            while todo:
                at, rows, depth = todo.pop()
                low, high = rows.min(0), rows.max(0)
                usable = np.flatnonzero(high > low)
                if depth >= deepest or len(rows) <= 1 or not len(usable):
                    path[at] = depth + _expected_path(len(rows))
                    continue
                f = int(rng.choice(usable))
                feature[at], cut[at] = f, float(rng.uniform(low[f], high[f]))
                a, b = node(), node()
                left[at] = a
                right = rows[:, f] > cut[at]
                todo += [(a, rows[~right], depth + 1), (b, rows[right], depth + 1)]
        return Forest(*(np.array(v, t) for v, t in ((feature, np.int32), (cut, float), (left, np.int32), (path, float), (roots, np.int32))), scale=max(_expected_path(psi), 1e-9))

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly score 2**(-mean path / expected path), in (0, 1)."""
        total = np.zeros(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            live = np.arange(len(x))
            while len(live):
                f = self.feature[at[live]]
                live, f = live[f >= 0], f[f >= 0]
                here = at[live]
                at[live] = self.left[here] + (x[live, f] > self.cut[here])
            total += self.path[at]
        return 2.0 ** (-total / max(len(self.roots), 1) / self.scale) if len(self.roots) else np.zeros(len(x))


def rule_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the statistics of every row."""
    small_batches(docs.sparkSession)
    thin = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    names = BASE + EXTRA

    def run(batches):
        release()
        for b in batches:
            s = batch_stats(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(s[k]) for k in names)], ["doc_id", *names])
    return thin.mapInArrow(run, f"doc_id {thin.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"{k} long" for k in names))


def _columns(rows, names) -> dict[str, np.ndarray]:
    return {k: np.array([r[k] for r in rows], np.int64) for k in names}


def fit(stats: DataFrame, labels: DataFrame | None, label_col: str = "quality") -> Forest:
    """Grow on a bounded sample, calibrate on all labelled rows."""
    names = BASE + EXTRA
    known = None
    if labels is not None:
        good = (labels.filter(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull())
                .groupBy("doc_id").agg(F.min(label_col).cast("int").alias("good")))
        known = stats.join(good, "doc_id")
        order = F.xxhash64(F.lit(SEED), "doc_id", *names)
        bad = known.filter("good = 0").orderBy(order).limit(int(SAMPLE * CONTAMINATION)).collect()
        fine = known.filter("good = 1").orderBy(order).limit(int(SAMPLE * (1 - CONTAMINATION))).collect()
        # the bad share stays the stated one when few rows are labelled
        bad = bad[:max(1, int(len(fine) * CONTAMINATION / (1 - CONTAMINATION)))]
        sample = bad + fine
    if not known or not sample:
        sample = stats.orderBy(F.xxhash64(F.lit(SEED), "doc_id", *names)).limit(SAMPLE).collect()
        s = _columns(sample, names)
        return Forest.grow(features(s))
    forest = Forest.grow(features(_columns(sample, names)))
    forest.threshold = _calibrate(known, forest)
    return forest


def _calibrate(known: DataFrame, forest: Forest) -> float:
    """Histogram the scores of every labelled row that passes the base rule."""
    bins = 1000
    rows = (scored(known.filter(~_base_failed_col()), forest, keep=["good"])
            .groupBy("good", F.floor(F.col("score") * bins).cast("int").alias("bin")).count().collect())
    hist = np.zeros((2, bins + 1))
    for r in rows:
        hist[min(max(r["good"], 0), 1), min(r["bin"], bins)] += r["count"]
    if not hist[0].sum() or not hist[1].sum():
        return DEFAULT_THRESHOLD
    above = hist[:, ::-1].cumsum(1)[:, ::-1] / hist.sum(1, keepdims=True)  # share scoring in this bin or higher
    gain = above[0] - GOOD_WEIGHT * above[1]
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    return float(best[len(best) // 2]) / bins  # the middle of the best thresholds


def _base_failed_col():
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def scored(stats: DataFrame, forest: Forest, keep: list[str]) -> DataFrame:
    """``keep`` columns of a statistics frame and the anomaly score."""
    cols = stats.select(*keep, *(c for c in BASE + EXTRA if c not in keep))
    model = stats.sparkSession.sparkContext.broadcast(forest)  # TREES * PSI nodes at most

    def run(batches):
        for b in batches:
            s = {k: b.column(b.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in BASE + EXTRA}
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), pa.array(model.value.score(features(s)))], [*keep, "score"])
    kinds = ", ".join(f"`{k}` {cols.schema[k].dataType.simpleString()}" for k in keep)
    return cols.mapInArrow(run, f"{kinds}, score double")


def quality(docs: DataFrame, labels: DataFrame | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the base statistics, base_failed, score and kept of every row."""
    stats = written(rule_stats(docs, id_col, text_col), "quality-stats")
    forest = fit(stats, labels)
    return (scored(stats, forest, ["doc_id", *BASE]).withColumn("base_failed", _base_failed_col())
            .withColumn("kept", ~F.col("base_failed") & (F.col("score") < F.lit(forest.threshold))))


def judge(docs: DataFrame, forest: Forest, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    small_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(forest)
    at = docs.columns.index(text_col)

    def run(batches):
        release()
        for b in batches:
            s = batch_stats(b.column(at))
            ok = ~base_failed(s) & (model.value.score(features(s)) < model.value.threshold)
            yield b.filter(pa.array(ok))
    return docs.mapInArrow(run, docs.schema)


def filter_documents(docs: DataFrame, labels: DataFrame | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fit on ``docs`` and keep the documents that pass."""
    stats = written(rule_stats(docs, id_col, text_col), "quality-stats")
    return judge(docs, fit(stats, labels), text_col)
