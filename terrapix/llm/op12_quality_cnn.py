"""12. Quality classifier: a byte-level convolutional network in numpy.

Every text is read whole, as bytes, in chunks of ``CHUNK`` bytes that overlap by
half.  A byte has ``EMBED`` learned numbers, a learned filter looks at ``WIDTH``
bytes in a row, and a chunk's features are the largest answer of each filter in
it, rectified.  A hidden layer and a logistic unit turn them into the chunk's
log-odds; the document's are the mean over its chunks, weighed by their bytes, and
one probability comes out.

Since a filter sees bytes, its answer is a sum of table entries: tables of
65,536 x filters numbers, one for each pair of places of the window, replace
embedding and multiplication when scoring.

Training: gradients of the class-weighted log loss by backpropagation (max
pooling passes a gradient to the byte window that won), Adam steps on small
batches of documents.  The training rows, a bounded sample, are dealt to
``SHARDS`` groups by a hash of the id; in each of ``ROUNDS`` Spark jobs every
group takes an epoch from the shared parameters in its own task, and the driver
averages the parameters (some thousand numbers a group) weighed by rows; at the
end the log-odds are shifted so that the cut that serves the training rows best
lies at ``THRESHOLD``.  The driver never sees a text.  Rows of a group are taken in the order of their hash,
so the model does not depend on the partitioning.

Bounded: of the labelled rows whose crc32(doc_id as text) mod 5 is not 0, the
``PER_CLASS`` rows of each label with the smallest hash of the id, their whole
texts.  Everything is scored.

Defined cases: a null or empty text is one chunk of padding; repeated rows score
equally; labels repeated for an id count once (the smallest: bad wins), null
labels and ids are no training rows; without rows of both classes the model is
constant (score 0.5); a null id is not held out; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrapix.llm import textvec as tv
from terrapix.llm.store import written
from terrapix.llm.worker import release, small_batches

EMBED, WIDTH, FILTERS, HIDDEN = 8, 6, 16, 8
CHUNK = 512
PER_CLASS, SHARDS, ROUNDS, BATCH, RATE, SEED = 1_200, 8, 30, 16, 4e-3, 12
THRESHOLD, GOOD_WEIGHT = 0.3, 5.0
_HALF = CHUNK // 2
_PAD = 0


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def laid_out(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The rows of a chunk of the table as padded bytes: each row begins with
    WIDTH - 1 bytes of padding, so that no window reaches its text from the row
    before, and takes whole half-chunks.  Returns the bytes, the first half-chunk
    of each row and the total, the half-chunks of each row, and the bytes in each
    half-chunk (the row's own padding counts)."""
    sizes = np.diff(off)
    halves = np.maximum(1, -(-(sizes + WIDTH - 1) // _HALF))
    first = np.concatenate([[0], np.cumsum(halves)])
    data = np.full(int(first[-1]) * _HALF + WIDTH - 1, _PAD, np.uint8)
    at = np.arange(len(buf)) + np.repeat(first[:-1] * _HALF + WIDTH - 1 - off[:-1], sizes)
    data[at] = buf
    number = np.arange(first[-1]) - np.repeat(first[:-1], halves)
    filled = np.clip(np.repeat(sizes + WIDTH - 1, halves) - number * _HALF, 1, _HALF)
    return data, first, halves, filled.astype(np.float64)


def pairs_of_halves(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chunks as (left half, right half, row): halves k and k + 1 of a row; a
    row of one half has one chunk of it."""
    halves = np.diff(first)
    chunks = np.maximum(1, halves - 1)
    row = np.repeat(np.arange(len(halves)), chunks)
    left = np.arange(len(row)) - np.repeat(np.cumsum(chunks) - chunks, chunks) + first[row]
    return left, np.minimum(left + 1, first[row + 1] - 1), row


SHAPES = {"embed": (256, EMBED), "filters": (WIDTH, EMBED, FILTERS), "filter_bias": (FILTERS,), "hidden": (FILTERS, HIDDEN), "hidden_bias": (HIDDEN,), "out": (HIDDEN,), "out_bias": (1,)}


def initial() -> dict[str, np.ndarray]:
    rng = np.random.default_rng(SEED)
    scale = {"embed": 0.5, "filters": 1 / np.sqrt(WIDTH * EMBED), "hidden": 1 / np.sqrt(FILTERS), "out": 1 / np.sqrt(HIDDEN)}
    return {k: (rng.standard_normal(s) * scale[k] if k in scale else np.zeros(s)).astype(np.float32) for k, s in SHAPES.items()}


def packed(parameters: dict[str, np.ndarray]) -> bytes:
    return b"".join(np.ascontiguousarray(parameters[k], np.float32).tobytes() for k in SHAPES)


def unpacked(raw: bytes) -> dict[str, np.ndarray]:
    flat, out, at = np.frombuffer(raw, np.float32), {}, 0
    for k, s in SHAPES.items():
        size = int(np.prod(s))
        out[k] = flat[at:at + size].reshape(s).copy()
        at += size
    return out


def place_tables(p: dict[str, np.ndarray]) -> np.ndarray:
    """What each byte adds to each filter, by its place in the window."""
    return np.einsum("be,wef->wbf", p["embed"], p["filters"]).astype(p["embed"].dtype)


def answers(data: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """Filter answers at every byte, from the table of each window place."""
    n, byte = len(data) - WIDTH + 1, data.astype(np.intp)
    out = tables[0].take(byte[:n], axis=0)
    for k in range(1, WIDTH):
        out += tables[k].take(byte[k:k + n], axis=0)
    return out


@dataclass
class Model:
    """The network's parameters, None for the constant model, and the shift of
    the log-odds that puts the calibrated cut at ``THRESHOLD``."""

    parameters: dict[str, np.ndarray] | None
    shift: float = 0.0

    def _pairs(self) -> np.ndarray:
        """Tables of two neighbouring places, by both bytes."""
        if not hasattr(self, "_kept"):
            one = place_tables(self.parameters)
            self._kept = np.stack([(one[k][:, None, :] + one[k + 1][None, :, :]).reshape(65536, FILTERS) for k in range(0, WIDTH, 2)])
        return self._kept

    def log_odds(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        n = len(off) - 1
        if self.parameters is None:
            return np.zeros(n)
        p, tables = self.parameters, self._pairs()
        data, first, _, filled = laid_out(buf, off)
        tops = np.empty((int(first[-1]), FILTERS), np.float32)
        step = 64  # half-chunks at a time, to stay in the processor's cache
        for a in range(0, len(tops), step):
            z = min(len(tops), a + step)
            byte = data[a * _HALF:z * _HALF + WIDTH - 1].astype(np.intp)
            pair, m = byte[:-1] * 256 + byte[1:], (z - a) * _HALF
            out = tables[0].take(pair[:m], axis=0)
            for k in range(1, WIDTH // 2):
                out += tables[k].take(pair[2 * k:2 * k + m], axis=0)
            tops[a:z] = out.reshape(z - a, _HALF, FILTERS).max(axis=1)
        left, right, row = pairs_of_halves(first)
        pooled = np.maximum(np.maximum(tops[left], tops[right]) + p["filter_bias"], 0)
        hidden = np.maximum(pooled @ p["hidden"] + p["hidden_bias"], 0)
        odds = (hidden @ p["out"] + p["out_bias"][0]).astype(np.float64)
        weight = filled[left] + np.where(right > left, filled[right], 0)
        return np.bincount(row, odds * weight, minlength=n) / np.bincount(row, weight, minlength=n)

    def scores(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row."""
        return 1.0 / (1.0 + np.exp(-np.clip(self.log_odds(buf, off) + self.shift, -50, 50)))


def gradients(buf: np.ndarray, off: np.ndarray, target: np.ndarray, share: np.ndarray, p: dict[str, np.ndarray]) -> tuple[float, dict[str, np.ndarray]]:
    """Weighted log loss of the rows and its gradients."""
    data, first, _, filled = laid_out(buf, off)
    n, halves = len(off) - 1, int(first[-1])
    z = answers(data, place_tables(p)).reshape(halves, _HALF, FILTERS)
    where = z.argmax(axis=1)
    tops = np.take_along_axis(z, where[:, None, :], axis=1)[:, 0, :]
    left, right, row = pairs_of_halves(first)
    second = tops[right] > tops[left]
    raw = np.where(second, tops[right], tops[left]) + p["filter_bias"]
    pooled = np.maximum(raw, 0)
    before = pooled @ p["hidden"] + p["hidden_bias"]
    hidden = np.maximum(before, 0)
    odds = hidden @ p["out"] + p["out_bias"][0]
    weight = filled[left] + np.where(right > left, filled[right], 0)
    weight /= np.bincount(row, weight, minlength=n)[row]
    total = np.bincount(row, odds * weight, minlength=n)
    prob = 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))
    loss = float(-(share * (target * np.log(prob + 1e-9) + (1 - target) * np.log(1 - prob + 1e-9))).sum())
    d_odds = ((share * (prob - target))[row] * weight).astype(np.float32)
    d_before = np.outer(d_odds, p["out"]) * (before > 0)
    d_raw = (d_before @ p["hidden"].T) * (raw > 0)
    # each (chunk, filter) sends its gradient to the winning window's bytes
    chunk, f = np.nonzero(d_raw)
    half = np.where(second[chunk, f], right[chunk], left[chunk])
    at = half * _HALF + where[half, f]
    g = d_raw[chunk, f]
    d_embed, d_filters = np.zeros((256, EMBED)), np.zeros(SHAPES["filters"])
    for k in range(WIDTH):
        byte = data[at + k]
        spread = np.bincount(f * 256 + byte, g, minlength=FILTERS * 256).reshape(FILTERS, 256)  # filter x byte
        d_filters[k] = (spread @ p["embed"]).T
        d_embed += spread.T @ p["filters"][k].T
    return loss, {"embed": d_embed, "filters": d_filters, "filter_bias": d_raw.sum(axis=0), "hidden": pooled.T @ d_before, "hidden_bias": d_before.sum(axis=0),
                  "out": hidden.T @ d_odds, "out_bias": np.array([d_odds.sum()])}


def epoch(texts: list[bytes], target: np.ndarray, share: np.ndarray, p: dict[str, np.ndarray], moments: dict[str, np.ndarray], rate: float) -> None:
    """Adam steps over the rows in batches, in place."""
    for a in range(0, len(texts), BATCH):
        some = texts[a:a + BATCH]
        off = np.concatenate([[0], np.cumsum([len(t) for t in some])])
        _, g = gradients(np.frombuffer(b"".join(some), np.uint8), off, target[a:a + BATCH], share[a:a + BATCH], p)
        moments["steps"] = moments.get("steps", 0) + 1
        t = moments["steps"]
        for k, d in g.items():
            m, v = moments.setdefault(f"m_{k}", np.zeros(SHAPES[k])), moments.setdefault(f"v_{k}", np.zeros(SHAPES[k]))
            m += 0.1 * (d - m)
            v += 0.01 * (d * d - v)
            p[k] -= (rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)).astype(np.float32)


def _training_rows(docs: DataFrame, labels: DataFrame, label_col: str) -> DataFrame:
    known = (labels.filter(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min(label_col).cast("int").alias("label")))
    draw = F.xxhash64(F.lit(SEED), "doc_id")
    picked = known.filter("label = 1").orderBy(draw, "doc_id").limit(PER_CLASS).unionByName(
        known.filter("label = 0").orderBy(draw, "doc_id").limit(PER_CLASS))
    one = docs.join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))  # 2 * PER_CLASS ids
    draw = F.xxhash64(F.lit(SEED + 1), "doc_id")
    return one.select(F.pmod(draw, F.lit(SHARDS)).cast("int").alias("shard"), draw.alias("draw"), F.col("text").cast("binary").alias("text"), "label")


def _cut(odds: np.ndarray, label: np.ndarray) -> float:
    """The cut with the greatest share of bad rows below it less ``GOOD_WEIGHT``
    times the share of good rows below it; the middle of the best gap."""
    order = np.argsort(odds, kind="stable")
    odds, bad = odds[order], label[order] == 0
    gain = np.concatenate([[0.0], np.cumsum(np.where(bad, 1 / max(1, bad.sum()), -GOOD_WEIGHT / max(1, (~bad).sum())))])
    edges = np.concatenate([[odds[0] - 1], odds, [odds[-1] + 1]])
    best = int(np.argmax(gain))
    return float(edges[best] + edges[best + 1]) / 2


def _round(start: bytes, number: int, weight: dict[int, float]):
    """A group's epoch from the shared parameters."""
    def work(table):
        release()
        table = table.sort_by([("draw", "ascending"), ("label", "ascending")])
        label = table.column("label").to_numpy()
        texts = [t or b"" for t in table.column("text").to_pylist()]
        order = np.random.default_rng([SEED, number]).permutation(len(texts))
        p = unpacked(start)
        epoch([texts[k] for k in order], label[order].astype(np.float64), np.where(label == 1, weight[1], weight[0])[order], p, {}, RATE * (1 - number / ROUNDS))
        return pa.table({"shard": pa.array([table.column("shard")[0].as_py()], pa.int32()), "n": pa.array([len(texts)], pa.int64()), "parameters": pa.array([packed(p)], pa.binary())})
    return work


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Train on the bounded sample, parameters averaged after every round."""
    small_batches(docs.sparkSession)
    thin = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = written(_training_rows(thin, labels, label_col), "quality-cnn-sample")
    size = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if not size.get(0) or not size.get(1):
        return Model(None)
    weight = {k: min(size[0], size[1]) / size[k] / BATCH for k in (0, 1)}  # both classes weigh the same
    shared = initial()
    for number in range(ROUNDS):
        work = _round(packed(shared), number, weight)
        out = rows.groupBy("shard").applyInArrow(work, "shard int, n long, parameters binary").collect()
        out = sorted((r["shard"], r["n"], bytes(r["parameters"])) for r in out)
        total = sum(n for _, n, _ in out)
        parts = [(n / total, unpacked(raw)) for _, n, raw in out]
        shared = {k: sum(w * q[k] for w, q in parts).astype(np.float32) for k in SHAPES}
    model = Model(shared)

    def judge(batches):
        for b in batches:
            odds = [model.log_odds(buf, off) for _, _, buf, off in tv.chunks(b.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(odds) if odds else np.zeros(0)), b.column(1)], ["odds", "label"])
    seen = rows.select("text", "label").mapInArrow(judge, "odds double, label int").collect()  # 2 * PER_CLASS pairs
    seen = sorted((r["odds"], r["label"]) for r in seen)
    cut = _cut(np.array([o for o, _ in seen]), np.array([k for _, k in seen]))
    return Model(shared, float(np.log(THRESHOLD / (1 - THRESHOLD))) - cut)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    small_batches(docs.sparkSession)
    thin = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some thousand numbers

    def run(batches):
        release()
        for b in batches:
            parts = [shared.value.scores(buf, off) for _, _, buf, off in tv.chunks(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.concatenate(parts) if parts else np.zeros(0))], ["doc_id", "score"])
    kind = thin.schema["doc_id"].dataType.simpleString()
    return (thin.mapInArrow(run, f"doc_id {kind}, score double")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))
