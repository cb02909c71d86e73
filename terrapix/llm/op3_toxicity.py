"""3. Toxicity: multiple-instance learning with noisy-or.

A document is a bag of sentences.  A sentence's score is a logistic function of
its distinct words and word beginnings (``PREFIXES`` bytes, so that inflected
forms share a weight); the document's score is the noisy-or 1 - prod(1 - p) of its
sentences.  Only document labels are used: the noisy-or likelihood is maximised
by gradient steps, which find by themselves which sentences carry the label.
``locate`` then returns the offending sentences.

Training rows are a bounded sample: of the labelled rows whose
crc32(doc_id as text) mod 5 is not 0, the ``PER_CLASS`` rows of each label with
the smallest hash of the id.  Words are known by 64-bit hashes; the model keeps
at most ``MAX_WORDS`` words.

Defined cases: a null or empty text has no sentences and scores the prior of a
single empty sentence; repeated rows score equally; labels repeated for an id
count once (the largest), null labels and ids are ignored for training; without
labelled rows of both classes every score is the prior; a null id is not held
out; extra columns are ignored.
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

PER_CLASS, MAX_WORDS, STEPS, RATE, L1, SEED = 4_000, 5_000, 160, 0.25, 5e-3, 3
#: share of the toxic bags in the likelihood
TOXIC_SHARE = 0.2
PREFIXES = (4, 5, 7)
_BITS = 20
_END = np.zeros(256, bool)
_END[list(b".!?\n")] = True


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sentence_words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Feature hashes, the sentence of each, the row of each sentence, and the
    sentence and span of each word, for the rows of a chunk.  Sentences end at . ! ? or a line feed."""
    starts, ends, first = tv.word_spans(buf, off, tv.NOT_ALNUM)
    h = tv.span_hashes(buf, starts, ends, lower=True) if len(buf) else np.zeros(0, np.uint64)
    row = np.repeat(np.arange(len(off) - 1), np.diff(first))
    if not len(h):
        return h, row, row, row, starts, ends
    stops = np.concatenate([[0], np.cumsum(_END[buf], dtype=np.int64)])[starts]
    new = np.ones(len(h), bool)
    new[1:] = (stops[1:] != stops[:-1]) | (row[1:] != row[:-1])
    sentence = np.cumsum(new) - 1
    parts, of = [h], [sentence]
    for k in PREFIXES:
        long = np.flatnonzero(ends - starts > k)
        parts.append(tv.mix(tv.span_hashes(buf, starts[long], starts[long] + k, lower=True) + np.uint64(k)))
        of.append(sentence[long])
    return np.concatenate(parts), np.concatenate(of), row[new], sentence, starts, ends


@dataclass
class Model:
    """Word weights in an open table by hash prefix, checked by the full hash."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float

    @staticmethod
    def of(words: np.ndarray, weights: np.ndarray, bias: float) -> "Model":
        order = np.argsort(words)
        return Model(words[order], weights[order].astype(np.float64), float(bias))

    def table(self) -> np.ndarray:
        if not hasattr(self, "_slots"):
            slots = np.zeros(1 << _BITS, bool)
            slots[(self.keys >> np.uint64(64 - _BITS)).astype(np.int64)] = True
            self._slots = slots
        return self._slots

    def word_weights(self, h: np.ndarray) -> np.ndarray:
        """Weights of the words; unknown words weigh 0."""
        out = np.zeros(len(h))
        if len(self.keys):
            at = np.flatnonzero(self.table()[(h >> np.uint64(64 - _BITS)).astype(np.int64)])
            k = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
            hit = self.keys[k] == h[at]
            out[at[hit]] = self.weights[k[hit]]
        return out

    def sentence_scores(self, h: np.ndarray, sentence: np.ndarray, sentences: int) -> np.ndarray:
        """Probability of each sentence; a word counts once in a sentence."""
        w = self.word_weights(h)
        at = np.flatnonzero(w)
        pair = np.unique(np.column_stack([sentence[at], h[at].view(np.int64)]), axis=0, return_index=True)[1] if len(at) else at
        at = at[pair]
        return 1.0 / (1.0 + np.exp(-(self.bias + np.bincount(sentence[at], w[at], minlength=sentences))))

    def chunk(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Noisy-or score of each row of a chunk."""
        h, sentence, row_of, _, _, _ = sentence_words(buf, off)
        n = len(off) - 1
        p = self.sentence_scores(h, sentence, len(row_of))
        none = np.bincount(row_of, np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=n)
        empty = np.bincount(row_of, minlength=n) == 0
        prior = 1.0 / (1.0 + np.exp(-self.bias))
        return np.where(empty, prior, -np.expm1(none))


def _training_rows(docs: DataFrame, labels: DataFrame, label_col: str) -> DataFrame:
    known = (labels.filter(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max(label_col).cast("int").alias("label")))
    draw = F.xxhash64(F.lit(SEED), "doc_id")
    picked = known.filter("label = 1").orderBy(draw, "doc_id").limit(PER_CLASS).unionByName(
        known.filter("label = 0").orderBy(draw, "doc_id").limit(PER_CLASS))
    return docs.join(F.broadcast(picked), "doc_id")  # 2 * PER_CLASS ids


def _bag(texts: pa.Array, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (sentence, feature hash) pairs of one document."""
    one = [sentence_words(buf, off)[:2] for _, _, buf, off in tv.chunks(texts.slice(i, 1))]
    h, s = one[0] if one else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    pairs = np.unique(np.column_stack([s, h.view(np.int64)]), axis=0) if len(h) else np.zeros((0, 2), np.int64)
    return pairs[:, 0], np.ascontiguousarray(pairs[:, 1])


def _document_counts(batches):
    """Training documents of the batch that hold each feature, by label."""
    for b in batches:
        labels = b.column(2).to_numpy(zero_copy_only=False)
        for label in (0, 1):
            rows = np.flatnonzero(labels == label).tolist()
            words = [np.unique(_bag(b.column(1), i)[1]) for i in rows]
            f, n = np.unique(np.concatenate(words), return_counts=True) if words else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(f), pa.array(n.astype(np.int64) * (1 - label)), pa.array(n.astype(np.int64) * label)], ["word", "clean", "toxic"])


def _featurise(chosen):
    """Per training document: its sentences and chosen features, and how many
    sentences it has."""
    def run(batches):
        known = chosen.value
        for b in batches:
            hashes, sentences, counts = [], [], []
            for i in range(b.num_rows):
                s, h = _bag(b.column(1), i)
                k = np.minimum(np.searchsorted(known, h), max(len(known) - 1, 0))
                at = np.flatnonzero(known[k] == h) if len(known) else np.zeros(0, np.int64)
                counts.append(int(s.max()) + 1 if len(s) else 1)
                sentences.append(s[at].astype(np.int32).tobytes())
                hashes.append(k[at].astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(2), pa.array(hashes, pa.binary()), pa.array(sentences, pa.binary()), pa.array(counts, pa.int32())], ["label", "words", "sentences", "n"])
    return run


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Train on the bounded sample.  Features are chosen by Spark: the
    ``MAX_WORDS`` whose share of documents differs most between the labels, of
    those in three training documents or more.  Only these reach the driver."""
    small_batches(docs.sparkSession)
    thin = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = written(_training_rows(thin, labels, label_col).dropDuplicates(["doc_id"]).select("doc_id", "text", "label"), "toxicity-sample")
    size = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if not size.get(0) or not size.get(1):
        return Model.of(np.zeros(0, np.uint64), np.zeros(0), -6.0)
    gap = F.abs(F.col("toxic") / size[1] - F.col("clean") / size[0])
    words = (rows.mapInArrow(_document_counts, "word long, clean long, toxic long").groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
             .filter(F.col("clean") + F.col("toxic") >= 3).orderBy(gap.desc(), "word").limit(MAX_WORDS).select("word").toPandas()["word"].to_numpy(np.int64))
    words = np.sort(words)
    bags = rows.mapInArrow(_featurise(docs.sparkSession.sparkContext.broadcast(words)), "label int, words binary, sentences binary, n int").collect()
    # an order that does not depend on the partitioning
    bags = sorted((r["label"], bytes(r["words"]), bytes(r["sentences"]), r["n"]) for r in bags)
    w, bias = train([(y, np.frombuffer(f, np.int32), np.frombuffer(s, np.int32), n) for y, f, s, n in bags], len(words))
    kept = np.flatnonzero(w)
    return Model.of(words.view(np.uint64)[kept], w[kept], bias)


def train(bags: list[tuple[int, np.ndarray, np.ndarray, int]], features: int) -> tuple[np.ndarray, float]:
    """Maximise the class-weighted noisy-or likelihood of (label, feature
    numbers, their sentences, number of sentences) bags by Adam steps with a
    soft threshold on weights; returns the weights and the bias."""
    y = np.array([b[0] for b in bags], float)
    sizes = np.array([b[3] for b in bags], np.int64)
    base = np.concatenate([[0], np.cumsum(sizes)])
    index = np.concatenate([b[1] for b in bags]).astype(np.int64)
    sentence = np.concatenate([b[2].astype(np.int64) + base[i] for i, b in enumerate(bags)])
    bag_of = np.repeat(np.arange(len(bags)), sizes)
    weight = np.where(y > 0, TOXIC_SHARE / y.sum(), (1 - TOXIC_SHARE) / (1 - y).sum())
    w, bias = np.zeros(features), -5.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, STEPS + 1):
        z = bias + np.bincount(sentence, w[index], minlength=base[-1])
        p = np.clip(1.0 / (1.0 + np.exp(-z)), 1e-9, 1 - 1e-9)
        none = np.clip(np.exp(np.bincount(bag_of, np.log1p(-p), minlength=len(bags))), 1e-12, 1 - 1e-9)
        # d loglik / dz_s = p_s * (y * none / (1 - none) - (1 - y))
        g_bag = weight * (y * none / (1 - none) - (1 - y))
        g = g_bag[bag_of] * p
        gw, gb = np.bincount(index, g[sentence], minlength=len(w)), g.sum()
        m, v = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        c1, c2 = 1 - 0.9 ** step, 1 - 0.99 ** step
        w += RATE * (m / c1) / (np.sqrt(v / c2) + 1e-4)
        bias += RATE * (mb / c1) / (np.sqrt(vb / c2) + 1e-4)
        w = np.sign(w) * np.maximum(np.abs(w) - RATE * L1, 0.0)
    return w, bias


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    small_batches(docs.sparkSession)
    thin = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # MAX_WORDS words at most

    def run(batches):
        release()
        for b in batches:
            parts = [shared.value.chunk(buf, off) for _, _, buf, off in tv.chunks(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.concatenate(parts) if parts else np.zeros(0))], ["doc_id", "score"])
    kind = thin.schema["doc_id"].dataType.simpleString()
    return (thin.mapInArrow(run, f"doc_id {kind}, score double")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))


def locate(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", at_least: float = 0.5) -> DataFrame:
    """The offending sentences: (doc_id, sentence, start, end, score, text);
    start and end are byte offsets of the first and last word."""
    small_batches(docs.sparkSession)
    thin = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            out: list[tuple] = []
            for r0, _, buf, off in tv.chunks(b.column(1)):
                h, sentence, row_of, of_word, starts, ends = sentence_words(buf, off)
                p = shared.value.sentence_scores(h, sentence, len(row_of))
                for s in np.flatnonzero(p >= at_least):
                    a, z = np.searchsorted(of_word, [s, s + 1])
                    row = int(row_of[s])
                    number = int(s - np.searchsorted(row_of, row))
                    out.append((r0 + row, number, int(starts[a] - off[row]), int(ends[z - 1] - off[row]), float(p[s]), bytes(buf[starts[a]:ends[z - 1]]).decode("utf-8", "replace")))
            rows = [o[0] for o in out]
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(pa.array(rows, pa.int64())), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.int64()),
                pa.array([o[3] for o in out], pa.int64()), pa.array([o[4] for o in out], pa.float64()), pa.array([o[5] for o in out], pa.string())],
                ["doc_id", "sentence", "start", "end", "score", "text"])
    kind = thin.schema["doc_id"].dataType.simpleString()
    return thin.mapInArrow(run, f"doc_id {kind}, sentence long, start long, end long, score double, text string")
