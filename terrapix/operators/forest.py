"""Random forest over binned rows, for training sets too large for MLlib's passes.

The same kind of forest as ``RandomForestClassifier``: up to ``BINS`` bins a feature from
MLlib's split rule, Poisson bagging of every row for every tree, a random subset of features
at each node, Gini gain, children of one class and equal-voting leaves merged as MLlib does.
The model comes back as MLlib's ``RandomForestClassificationModel``; rows are scored by the
same tables, with the numbers MLlib's walk over the nodes gives.

What differs is where the numbers are kept. MLlib holds a bagged row (about 500 bytes for 100
trees) and follows each row through each tree by hash maps. Here a row is a byte a feature and
one for its label; its weights are drawn again in each pass from (seed, tree, partition, chunk),
its node is read from tables of reachable leaves, five levels at a time, and whole chunks are
counted at once. The draws are numpy's, so the trees are other draws than MLlib's.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapix.session import scratch_path

BINS, CHUNK, BLOCK, STEP, DEEPEST = 32, 1 << 17, 1 << 15, 5, 12
#: bytes of a task's histograms; more trees than that take another pass
TASK_BYTES = 160_000_000
EPSILON = 2.0 ** -52

NODES = ("treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, "
         "gain: double, leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>")


def subset_size(strategy: str, features: int, trees: int) -> int:
    """Features tried at a node."""
    if strategy == "all" or (strategy == "auto" and trees == 1):
        return features
    return math.ceil(math.sqrt(features))


def grows(est: RandomForestClassifier) -> bool:
    """Whether ``grow`` knows these parameters."""
    return (est.getImpurity() == "gini" and est.getMaxBins() == BINS and est.getMaxDepth() <= DEEPEST and est.getMinInstancesPerNode() == 1
            and est.getMinInfoGain() == 0.0 and est.getMinWeightFractionPerNode() == 0.0 and est.getFeatureSubsetStrategy() in ("auto", "sqrt", "all"))


# --- splits and bins ----------------------------------------------------------

def thresholds(values: np.ndarray, expected: float) -> np.ndarray:
    """MLlib's candidate splits of a feature from sampled values; ``expected``: rows the
    sample stands for, those missing from it counted as zeros."""
    v, c = np.unique(values[values != 0.0], return_counts=True)
    c = c.astype(float)
    if not len(v):
        return np.empty(0)
    found = c.sum()
    if expected - found > EPSILON * found * 100:
        at = int(np.searchsorted(v, 0.0))
        v, c = np.insert(v, at, 0.0), np.insert(c, at, expected - found)
    if len(v) <= BINS:
        return (v[:-1] + v[1:]) / 2.0
    stride = expected / BINS
    out, current, target = [], c[0], stride
    for i in range(1, len(v)):
        before, current = current, current + c[i]
        if abs(before - target) < abs(current - target):
            out.append((v[i - 1] + v[i]) / 2.0)
            target += stride
    return np.array(out[:BINS - 1])


def _scaled(batches: Iterator[pa.RecordBatch], features, mean, scale) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Scaled features (a row each) and labels of the rows without null or NaN."""
    for b in batches:
        x = np.stack([b.column(f).cast(pa.float64()).to_numpy(zero_copy_only=False) for f in features])  # null: NaN
        ok = ~np.isnan(x).any(axis=0)
        yield (x[:, ok] - mean[:, None]) * scale[:, None], b.column("label").to_numpy(zero_copy_only=False)[ok]


def _sampled(batches, features, mean, scale):
    for x, _ in _scaled(batches, features, mean, scale):
        yield pa.RecordBatch.from_arrays([pa.array(r) for r in x], names=list(features))


def _binned(batches, features, mean, scale, cuts):
    """Chunks of rows: a byte a feature (its bin) and one for the label, feature by feature."""
    part, chunk, held, n = TaskContext.get().partitionId(), 0, [], 0

    def out(codes):
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([chunk], pa.int32()), pa.array([codes.tobytes()], pa.binary())], names=["part", "chunk", "codes"])
    for x, label in _scaled(batches, features, mean, scale):
        held.append(np.stack([*(np.searchsorted(cut, r).astype(np.uint8) for cut, r in zip(cuts, x, strict=True)), label.astype(np.uint8)]))
        n += len(label)
        while n >= CHUNK:
            rows = np.concatenate(held, axis=1)
            yield out(rows[:, :CHUNK])
            chunk, held, n = chunk + 1, [rows[:, CHUNK:]], n - CHUNK
    if n:
        yield out(np.concatenate(held, axis=1))


# --- a pass over the rows -----------------------------------------------------

def poisson_steps(rate: float) -> np.ndarray:
    """Numbers of 32 bits from which on a draw is 1, 2, ... (Poisson)."""
    out, term, total, k = [], math.exp(-rate), 0.0, 0
    while (total := total + term) * 2.0 ** 32 < 2 ** 32 - 0.5:
        out.append(min(2 ** 32 - 1, round(total * 2.0 ** 32)))
        k += 1
        term *= rate / k
    return np.array(out, np.uint32)


def drawn(steps: np.ndarray, key: list[int], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a chunk with a weight over 0, and their weights."""
    u = np.random.SFC64(key).random_raw(n // 2 + 1).view(np.uint32)[:n]
    idx = np.flatnonzero(u >= steps[0])
    u, weight = u[idx], np.ones(len(idx), np.uint8)
    for s in steps[1:]:
        more = u >= s
        if not more.any():
            break
        weight += more
    return idx, weight.astype(np.float64)


def _leaf_masks(feature: np.ndarray, cut: np.ndarray, features: int, levels: int) -> np.ndarray:
    """For subtrees of ``levels`` levels (heap order, root at 1): the leaves, as bits, that a
    bin of a feature leaves reachable; the lowest bit of the features' common ones is the leaf."""
    n, bins = len(feature), np.arange(BINS)
    out = np.full((n, features, BINS), (1 << (1 << levels)) - 1, np.uint32)
    for e in range(levels):
        half = 1 << (levels - e - 1)
        for pos in range(1 << e):
            j = (1 << e) + pos
            gone = np.uint32((((1 << half) - 1) << (pos * 2 * half)) ^ 0xFFFFFFFF)
            s = np.flatnonzero(feature[:, j] >= 0)
            out[s, feature[s, j]] &= np.where(bins > cut[s, j, None], gone, np.uint32(0xFFFFFFFF))
    return out


def _pairs(masks: np.ndarray) -> list[np.ndarray]:
    """Masks of two features at once, by subtree and both bins."""
    f = masks.shape[1]
    return [(masks[:, a, :, None] & masks[:, a + 1, None, :] if a + 1 < f else np.repeat(masks[:, a, :, None], BINS, axis=2)).ravel() for a in range(0, f, 2)]


class Walk:
    """Finds the nodes of a level for many rows of one tree."""

    def __init__(self, feature: np.ndarray, cut: np.ndarray, features: int, level: int):
        self.feature, self.cut, self.level, self.stages = feature, cut, level, []
        for top in range(0, min(level, 2 * STEP), STEP):
            levels, roots = min(STEP, level - top), np.arange(1 << top, 2 << top)
            heap = np.zeros((len(roots), 1 << levels), np.int64)
            for j in range(1, 1 << levels):
                e = j.bit_length() - 1
                heap[:, j] = (roots << e) + (j - (1 << e))
            self.stages.append((levels, _pairs(_leaf_masks(feature[heap], cut[heap], features, levels))))

    def slots(self, pairs: list[np.ndarray], bins: np.ndarray | None) -> np.ndarray:
        """Nodes of the level, from 0, of rows by their bins and pairs of bins; of a row
        that stays further up, the leftmost below. ``bins`` is read from level 10 on."""
        at = np.zeros(len(pairs[0]), np.int64)
        for top, (levels, tables) in enumerate(self.stages):
            base, mask = at * (BINS * BINS) if top else None, None
            for table, p in zip(tables, pairs, strict=True):
                m = table.take(base + p if top else p)
                mask = m if mask is None else np.bitwise_and(mask, m, out=mask)
            low = mask & (~mask + np.uint32(1))
            at = (at << levels) + ((low.astype(np.float32).view(np.int32) >> 23) - 127)
        for e in range(2 * STEP, self.level):
            node = at + (1 << e)
            f = self.feature[node]
            at = 2 * at + ((f >= 0) & (bins[np.maximum(f, 0), np.arange(len(at))] > self.cut[node]))
        return at


def bin_pairs(codes: np.ndarray, features: int) -> list[np.ndarray]:
    return [codes[a].astype(np.uint16) * np.uint16(BINS) + (codes[a + 1] if a + 1 < features else 0) for a in range(0, features, 2)]


def _counted(batches, level: int, trees: dict[int, tuple], features: int, classes: int, steps, seed: int):
    """Weights by node, feature, bin and class of a level, for the nodes and features wanted,
    of all rows of this task; a record for each tree."""
    width = BINS * classes
    size = width << level
    walks = {t: Walk(feature, cut, features, level) for t, (feature, cut, _, _) in trees.items()}
    total = {t: np.zeros((features, size), np.uint32) for t in trees}
    for b in batches:
        for part, chunk, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
            codes = np.frombuffer(raw.as_buffer(), np.uint8).reshape(features + 1, -1)
            n = codes.shape[1]
            keyed = codes[:-1].astype(np.uint16) * np.uint16(classes) + codes[-1]  # small, for the caches
            pairs = bin_pairs(codes, features)
            for t, walk in walks.items():
                if steps is None:
                    idx, weight = np.arange(n), None
                else:
                    idx, weight = drawn(steps, [seed, t, part, chunk], n)
                base = np.zeros(len(idx), np.int64)
                for i in range(0, len(idx) if level else 0, BLOCK):
                    some = idx[i:i + BLOCK]
                    np.multiply(walk.slots([p.take(some) for p in pairs], codes[:, some] if level > 2 * STEP else None), width, out=base[i:i + BLOCK])
                for f in range(features):
                    total[t][f] += np.bincount(keyed[f].take(idx) + base, weight, size).astype(np.uint32)
    for t, (_, _, nodes, subset) in trees.items():
        h = total.pop(t).reshape(features, 1 << level, width)[subset.T, nodes].swapaxes(0, 1)
        h = h.astype(np.uint16) if h.size and h.max() < 1 << 16 else h
        yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([h.itemsize], pa.int32()), pa.array([h.tobytes()], pa.binary())], names=["tree", "bytes", "counts"])


def gini(counts: np.ndarray) -> np.ndarray:
    """Gini impurity over the last axis, 0 without rows; sums in MLlib's order."""
    n = counts.sum(axis=-1)
    out = np.ones(n.shape)
    for c in range(counts.shape[-1]):
        share = counts[..., c] / np.where(n > 0, n, 1.0)
        out -= share * share
    return np.where(n > 0, out, 0.0)


def best_splits(h: np.ndarray, subset: np.ndarray, n_cuts: np.ndarray) -> np.ndarray:
    """For each node of ``h`` (node, feature of its subset, bin, class): feature, bin, gain,
    class weights left and right. The first of the best; gain -inf if none is valid."""
    left = h.cumsum(axis=2)
    whole = left[:, :, -1:, :]
    left = left[:, :, :-1]
    right = whole - left
    nl, nr = left.sum(axis=-1), right.sum(axis=-1)
    n = np.where(nl + nr > 0, nl + nr, 1.0)
    gain = gini(whole) - nl / n * gini(left) - nr / n * gini(right)
    valid = (nl >= 1) & (nr >= 1) & (gain >= 0) & (np.arange(h.shape[2] - 1) < n_cuts[subset][:, :, None])
    gain = np.where(valid, gain, -np.inf)
    flat = gain.reshape(len(h), -1)
    best = flat.argmax(axis=1)
    i, (k, b) = np.arange(len(h)), np.unravel_index(best, gain.shape[1:])
    return np.column_stack([subset[i, k], b, flat[i, best], left[i, k, b], right[i, k, b]])


def _chosen(batches, trees: dict[int, tuple], classes: int, n_cuts):
    """The sum of the tasks' counts for each tree, and its best splits."""
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for t, size, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
            h = np.frombuffer(raw.as_buffer(), np.uint16 if size == 2 else np.uint32)
            if t in total:
                total[t] += h
            else:
                total[t] = h.astype(np.float64)
    for t, h in total.items():
        subset = trees[t]
        found = best_splits(h.reshape(*subset.shape, BINS, classes), subset, n_cuts)
        yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([found.tobytes()], pa.binary())], names=["tree", "splits"])


# --- the forest ---------------------------------------------------------------

class Trees:
    """All trees in heap order (root at 1): split feature (-1: none) and bin, gain, class weights."""

    def __init__(self, n: int, depth: int, classes: int):
        self.depth, size = depth, 2 << depth
        self.feature, self.cut = np.full((n, size), -1, np.int8), np.zeros((n, size), np.uint8)
        self.gain, self.counts = np.full((n, size), -1.0), np.zeros((n, size, classes))
        self.open = {t: np.array([1]) for t in range(n)}

    def split(self, t: int, level: int, found: np.ndarray) -> None:
        """Take the best splits of a tree's open nodes; its next open nodes follow."""
        nodes, classes = self.open[t], self.counts.shape[2]
        left, right = found[:, 3:3 + classes], found[:, 3 + classes:]
        if level == 0:
            self.counts[t, 1] = left[0] + right[0]
        good = found[:, 2] > 0
        nodes, left, right, found = nodes[good], left[good], right[good], found[good]
        self.feature[t, nodes], self.cut[t, nodes], self.gain[t, nodes] = found[:, 0], found[:, 1], found[:, 2]
        self.counts[t, 2 * nodes], self.counts[t, 2 * nodes + 1] = left, right
        after = np.concatenate([2 * nodes[gini(left) >= EPSILON], 2 * nodes[gini(right) >= EPSILON] + 1]) if level + 1 < self.depth else nodes[:0]
        self.open[t] = np.sort(after)

    def prune(self) -> None:
        """Leaves of one parent that vote alike are merged, from the bottom up."""
        vote = self.counts.argmax(axis=2)
        for level in range(self.depth - 1, -1, -1):
            i = np.arange(1 << level, 2 << level)
            leaf = self.feature < 0
            alike = ~leaf[:, i] & leaf[:, 2 * i] & leaf[:, 2 * i + 1] & (vote[:, 2 * i] == vote[:, 2 * i + 1])
            self.feature[:, i] = np.where(alike, -1, self.feature[:, i])


def _saved(batches, trees: Trees, cuts):
    """Rows of MLlib's node table, a tree for each id."""
    for b in batches:
        for t in b.column(0).to_pylist():
            feature, order = trees.feature[t], [1]
            for i in order:
                if feature[i] >= 0:
                    order += [2 * i, 2 * i + 1]
            number = {i: k for k, i in enumerate(order)}
            counts = trees.counts[t]
            impurity = gini(counts)
            rows = []
            for i in order:
                f = int(feature[i])
                split = {"featureIndex": f, "leftCategoriesOrThreshold": [float(cuts[f][trees.cut[t, i]])] if f >= 0 else [], "numCategories": -1}
                rows.append({"id": number[i], "prediction": float(counts[i].argmax()), "impurity": float(impurity[i]), "impurityStats": counts[i].tolist(), "rawCount": int(counts[i].sum()),
                             "gain": float(trees.gain[t, i]) if f >= 0 else -1.0, "leftChild": number[2 * i] if f >= 0 else -1, "rightChild": number[2 * i + 1] if f >= 0 else -1, "split": split})
            kind = pa.struct([("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())), ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()),
                              ("split", pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())]))])
            yield pa.RecordBatch.from_arrays([pa.array([t] * len(rows), pa.int32()), pa.array(rows, kind)], names=["treeID", "nodeData"])


class Votes:
    """Raw votes and probabilities of scaled rows, as MLlib's model of the trees gives them:
    each tree adds its leaf's class shares, in the order of the trees."""

    def __init__(self, trees: Trees, cuts: list[np.ndarray]):
        self.depth, self.feature, self.cut, self.cuts, self.walks = trees.depth, trees.feature, trees.cut, cuts, None
        counts = trees.counts.copy()
        for i in range(1, 1 << trees.depth):
            leaf = trees.feature[:, i] < 0
            for child in (2 * i, 2 * i + 1):
                counts[leaf, child] = counts[leaf, i]
        counts = counts[:, 1 << trees.depth:]
        whole = counts.sum(axis=2, keepdims=True)
        self.shares = np.divide(counts, whole, out=np.zeros_like(counts), where=whole != 0)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"walks": None}

    def __call__(self, rows: pa.Array) -> pa.Array:
        features, n, classes = len(self.cuts), len(rows), self.shares.shape[2]
        if self.walks is None:  # once for each worker
            self.walks = [Walk(f, c, features, self.depth) for f, c in zip(self.feature, self.cut, strict=True)]
        x = rows.flatten().to_numpy(zero_copy_only=False).reshape(n, features)
        bins = np.stack([np.searchsorted(cut, x[:, f]) for f, cut in enumerate(self.cuts)]).astype(np.uint8)
        pairs, raw = bin_pairs(bins, features), np.zeros((n, classes))
        for walk, shares in zip(self.walks, self.shares, strict=True):
            raw += shares.take(walk.slots(pairs, bins), axis=0)
        whole = np.zeros(n)
        for c in range(classes):
            whole += raw[:, c]
        out = np.hstack([raw, raw / np.where(whole == 0, 1.0, whole)[:, None]])
        return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * (2 * classes)), pa.array(out.ravel()))


class GrownForestModel(RandomForestClassificationModel):
    """MLlib's model that adds the columns of ``transform`` by ``Votes``; saved and loaded,
    it is MLlib's own, which gives the same numbers."""

    @classmethod
    def of(cls, model: RandomForestClassificationModel, votes: Votes) -> GrownForestModel:
        out = cls(model._java_obj.copy(model._empty_java_param_map()))  # of its own: a wrapper lets its Java object go
        out._transfer_params_from_java()
        out.votes = votes
        return out

    def _transform(self, dataset: DataFrame) -> DataFrame:
        votes, classes = self.votes, self.numClasses

        def voted(rows: pa.Array) -> pa.Array:
            return votes(rows)
        name = f"_votes_{uuid.uuid4().hex}"
        raw, probability = F.slice(name, 1, classes), F.slice(name, classes + 1, classes)
        return dataset.withColumn(name, F.arrow_udf(voted, "array<double>")(vector_to_array(self.getFeaturesCol()))).withColumns({
            self.getRawPredictionCol(): array_to_vector(raw), self.getProbabilityCol(): array_to_vector(probability),
            self.getPredictionCol(): (F.array_position(raw, F.array_max(raw)) - 1).cast("double")}).drop(name)


def _as_model(spark, est: RandomForestClassifier, trees: Trees, cuts, features: int, classes: int) -> GrownForestModel:
    """MLlib's model of the trees: a model of these parameters is saved, its nodes are replaced."""
    path = scratch_path(spark, f"forests/{uuid.uuid4().hex}")
    few = spark.createDataFrame([(Vectors.dense([float(c)] * features), float(c)) for c in range(classes)], [est.getFeaturesCol(), est.getLabelCol()])
    est.fit(few.coalesce(1)).write().overwrite().save(path)
    ids = spark.range(0, len(trees.feature), 1, max(1, min(len(trees.feature), spark.sparkContext.defaultParallelism)))
    ids.mapInArrow(partial(_saved, trees=trees, cuts=cuts), NODES).write.mode("overwrite").parquet(f"{path}/data")
    return GrownForestModel.of(RandomForestClassificationModel.load(path), Votes(trees, cuts))


def grow(dealt: DataFrame, features, mean, std, rows: int, classes: int, est: RandomForestClassifier, bagged: bool = True) -> GrownForestModel:
    """The forest of ``est`` for ``dealt`` (``label`` and ``features``; ``rows`` of them without
    null or NaN, labels 0 to ``classes`` - 1). Draws follow the partitions of ``dealt``."""
    spark, features, seed = dealt.sparkSession, list(features), est.getSeed()
    mean, std = np.asarray(mean, float), np.asarray(std, float)
    scale = np.where(std == 0, 0.0, 1.0 / np.where(std == 0, 1.0, std))
    dealt = dealt.select("label", *features)

    fraction = min(1.0, max(BINS * BINS, 10_000) / rows)
    some = dealt if fraction == 1.0 else dealt.sample(fraction, seed)
    sample = some.mapInArrow(partial(_sampled, features=features, mean=mean, scale=scale), ", ".join(f"`{f}` double" for f in features)).toArrow()
    cuts = [thresholds(sample.column(f).to_numpy(), fraction * rows) for f in features]
    n_cuts = np.array([len(c) for c in cuts])

    n, k = est.getNumTrees(), subset_size(est.getFeatureSubsetStrategy(), len(features), est.getNumTrees())
    trees, steps = Trees(n, est.getMaxDepth(), classes), poisson_steps(est.getSubsamplingRate()) if bagged else None
    codes = dealt.mapInArrow(partial(_binned, features=features, mean=mean, scale=scale, cuts=cuts), "part int, chunk int, codes binary").persist(StorageLevel.MEMORY_AND_DISK)
    tasks = 3 * spark.sparkContext.defaultParallelism  # of a pass; draws follow part and chunk, counts are sums
    try:
        for level in range(est.getMaxDepth()):
            todo = [t for t in range(n) if len(trees.open[t])]
            step = max(1, TASK_BYTES // (4 * len(features) * BINS * classes << level))
            for group in (todo[i:i + step] for i in range(0, len(todo), step)):
                given = {}
                for t in group:
                    rng = np.random.default_rng([seed, t, level])
                    subset = np.sort(rng.random((len(trees.open[t]), len(features))).argsort(axis=1)[:, :k], axis=1)
                    given[t] = (trees.feature[t], trees.cut[t], trees.open[t] - (1 << level), subset)
                counted = codes.coalesce(tasks).mapInArrow(partial(_counted, level=level, trees=given, features=len(features), classes=classes, steps=steps, seed=seed), "tree int, bytes int, counts binary")
                best = counted.repartition(min(len(group), tasks), "tree").mapInArrow(partial(_chosen, trees={t: x[3] for t, x in given.items()}, classes=classes, n_cuts=n_cuts), "tree int, splits binary")
                for t, raw in best.collect():
                    trees.split(t, level, np.frombuffer(raw, np.float64).reshape(-1, 3 + 2 * classes))
    finally:
        codes.unpersist()
    trees.prune()
    return _as_model(spark, est, trees, cuts, len(features), classes)
