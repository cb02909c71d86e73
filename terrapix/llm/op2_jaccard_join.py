"""2. N-gram Jaccard join: adaptive multi-match prefixes.

A document is the set of its distinct 5-word shingles.  Two sets with Jaccard
similarity of at least 0.8 share many shingles, so in one global order (rare
first) the prefixes of length |x| - t + l of both must share at least l
shingles, t = ceil(0.8 |x|).  Each document picks its own l: a longer prefix
costs more list entries but leaves fewer candidates, as the estimated list
sizes tell, and a pair must share at least the smaller l of its two documents
before it is verified on the whole sets.

1. One scan: a 128-bit fingerprint of each document's set, and the
   shingles that repeat within a task, which sum up to the table of frequent shingles that gives
   the order.  (It orders and estimates only; any order is right.)
2. Documents with equal sets are one node.  Nodes' prefixes are dealt out by
   shingle; shingles of a single node end here.
3. In a few rounds every node is verified against a handful of pivots only, the
   nodes of its shingles that come first in a random order of the round; links
   join components, and a round looks only at shingles whose nodes are still in
   different components.  A group of near copies becomes one component after
   work in proportion to its size.
4. What is left are pairs of different components that meet in some shingle.
   All of them are decided: of a pair, the node with the smaller l may pass over
   its l - 1 most crowded shingles (of l shared ones one is left).  Pairs met in
   the others must share l prefix shingles, and those are verified.  Where a
   shingle has more than ``CROWDED`` nodes its pairs are not listed: the nodes
   outside its largest component are queries, held in blocks of ``QUERY_BYTES``
   against the whole sets of all its nodes.  No link between different
   components is lost.

Nodes are known by 64 bits of the fingerprint.

Defined cases: null or empty texts and texts of white space have an empty set
and link with nothing; texts with 1 to 4 words have their whole word sequence as
one shingle; every row is returned, repeated ids link by their texts and share
the smallest id reachable; a row without id gets the smallest id of its group,
or null if the group has none; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrapix.llm import textvec as tv
from terrapix.llm.components import components
from terrapix.llm.store import written
from terrapix.llm.worker import release, small_batches

WORDS, SHARE = 5, (80, 100)  # similarity of at least 80 / 100
#: a shingle met this often among those counted together is reported; entries of the frequent table
REPEATED, FREQUENT = 3, 200_000
#: shingles of a task counted together
COUNTED = 4_000_000
#: choices of l, and what verifying a candidate costs against one list entry
MATCHES, VERIFY_COST = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32), 16.0
#: rounds of pivots, and pivots per shingle group and round (shingles are dealt to as many classes)
ROUNDS, PIVOTS = 3, 4
#: a shingle with more nodes than this is crowded; bytes of sets in a block of queries
CROWDED, QUERY_BYTES = 64, 32 << 20
#: texts that are looked up through a broadcast of their hashes (8 bytes each)
FILTER_NODES = 2_000_000


def _row_sets(texts: pa.Array):
    """(row, sorted distinct shingle hashes) of every row of a column."""
    for r0, r1, buf, off in tv.chunks(texts):
        starts, ends, first = tv.word_spans(buf, off, tv.SPACE)
        h = tv.span_hashes(buf, starts, ends, lower=True)
        win = tv.shingles(h, WORDS)
        for r in range(r1 - r0):
            a, z = int(first[r]), int(first[r + 1])
            if z - a >= WORDS:
                yield r0 + r, np.unique(win[a:z - WORDS + 1])
            elif z > a:
                yield r0 + r, tv.shingles(h[a:z], z - a) ^ np.uint64(z - a)
            else:
                yield r0 + r, win[:0]


def _fingerprint(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed numbers."""
    with np.errstate(over="ignore"):
        a, b = tv.mix(s + np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64), tv.mix(s ^ np.uint64(0xD1B54A32D192ED03)).sum(dtype=np.uint64)
        both = tv.mix(np.array([a + np.uint64(len(s)), b], np.uint64)).view(np.int64)
    return int(both[0]), int(both[1])


def _first_pass(batches):
    """A row per document (id, size, fingerprint), and a row per shingle that
    repeats among ``COUNTED`` (shingle, count)."""
    release()
    held, kind = [], None
    for b in batches:
        sets = [s for _, s in _row_sets(b.column(1))]
        kind = b.column(0).type
        held += sets
        repeated = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        if sum(map(len, held)) >= COUNTED:
            repeated, held = _repeated(held), []
        yield _first_rows(b, sets, *repeated)
    if held:
        none = pa.array([], pa.int64())
        yield _first_rows(pa.RecordBatch.from_arrays([pa.array([], kind), pa.array([], pa.string()), none, none], ["a", "b", "c", "d"]), [], *_repeated(held))


def _repeated(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every = np.sort(np.concatenate(sets))
    edge = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.zeros(0, np.int64)
    count = np.diff(np.append(edge, len(every)))
    often = count >= REPEATED
    return every[edge[often]].view(np.int64), count[often]


def _first_rows(b: pa.RecordBatch, sets: list[np.ndarray], shingle: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
    prints = [_fingerprint(s) for s in sets]
    n, m = len(sets), len(shingle)
    none = lambda k: pa.nulls(k, pa.int64())
    return pa.RecordBatch.from_arrays([
        pa.concat_arrays([b.column(0), pa.nulls(m, b.column(0).type)]),
        pa.concat_arrays([b.column(2), none(m)]),
        pa.concat_arrays([b.column(3), none(m)]),
        pa.concat_arrays([pa.array([len(s) for s in sets], pa.int64()), none(m)]),
        pa.concat_arrays([pa.array([p[0] for p in prints], pa.int64()), none(m)]),
        pa.concat_arrays([pa.array([p[1] for p in prints], pa.int64()), none(m)]),
        pa.concat_arrays([none(n), pa.array(shingle, pa.int64())]),
        pa.concat_arrays([none(n), pa.array(times.astype(np.int64), pa.int64())]),
    ], ["doc_id", "tie", "code", "n", "hi", "lo", "shingle", "times"])


class Order:
    """The global order: shingles outside the frequent table first."""

    def __init__(self, shingles: np.ndarray, times: np.ndarray):
        order = np.argsort(shingles)
        self.shingles, self.times = shingles[order], times[order]

    def frequency(self, s: np.ndarray) -> np.ndarray:
        if not len(self.shingles):
            return np.ones(len(s), np.int64)
        k = np.minimum(np.searchsorted(self.shingles, s), len(self.shingles) - 1)
        return np.where(self.shingles[k] == s, self.times[k], 1)

    def prefix(self, s: np.ndarray) -> tuple[np.ndarray, int]:
        """The prefix of a set and its number of required matches."""
        n = len(s)
        f = self.frequency(s)
        order = np.lexsort((s, f))
        t = -(-SHARE[0] * n // SHARE[1])
        costs = np.cumsum(f[order])
        choices = [l for l in MATCHES if l <= t]
        # entries read, and candidates that can share l of them
        price = [costs[n - t + l - 1] * (1.0 + VERIFY_COST / l) for l in choices]
        l = choices[int(np.argmin(price))]
        return s[order[:n - t + l]], l


def _prefixes(order):
    def run(batches):
        release()
        for b in batches:
            hi, lo, n, need, pre = [], [], [], [], []
            for _, s in _row_sets(b.column(0)):
                if len(s):
                    h, l = _fingerprint(s)
                    p, k = order.value.prefix(s)
                    hi.append(h), lo.append(l), n.append(len(s)), need.append(k), pre.append(p.view(np.int64).tobytes())
            keep = {}
            for i, key in enumerate(zip(hi, lo)):  # copies within a batch
                keep.setdefault(key, i)
            at = list(keep.values())
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for i in at], t) for x, t in ((hi, pa.int64()), (lo, pa.int64()), (n, pa.int32()), (need, pa.int32()), (pre, pa.binary()))], ["hi", "lo", "n", "need", "prefix"])
    return run


def _explode(batches):
    """(shingle, node, n, need) of every prefix shingle."""
    for b in batches:
        sizes = [len(x) // 8 for x in b.column(3).to_pylist()]
        shingle = np.frombuffer(b"".join(b.column(3).to_pylist()), np.int64)
        rep = [np.repeat(b.column(i).to_numpy(zero_copy_only=False), sizes) for i in range(3)]
        yield pa.RecordBatch.from_arrays([pa.array(shingle), *(pa.array(r) for r in rep)], ["shingle", "node", "n", "need"])


def _shared(batches):
    """Of rows sorted by shingle and node: those whose shingle has two nodes or
    more.  Only the last row of the batch before is remembered."""
    held, open_shingle = None, None  # a first row not yet emitted; the shingle already known to be shared
    for b in batches:
        if not b.num_rows:
            continue
        s = b.column(0).to_numpy(zero_copy_only=False)
        if held is not None and s[0] == held.column(0)[0].as_py():
            yield held
            open_shingle = s[0]
        same = np.zeros(len(s) + 1, bool)
        same[1:-1] = s[1:] == s[:-1]
        keep = same[1:] | same[:-1]
        if open_shingle is not None:
            keep |= s == open_shingle
        held = None if keep[-1] else b.slice(b.num_rows - 1, 1)
        open_shingle = s[-1] if keep[-1] else None
        yield b.filter(pa.array(keep))


def _sets_of(batches):
    """(node, its whole set), once for each Arrow batch."""
    for b in batches:
        found = {_fingerprint(s)[0]: s.tobytes() for _, s in _row_sets(b.column(0)) if len(s)}
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.binary())], ["node", "set"])


def _similar(batches):
    """Keep the pairs whose sets are similar enough."""
    for b in batches:
        ok = []
        for x, y in zip(b.column(2), b.column(3)):
            p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            k = np.searchsorted(q, p)
            both = int((q[np.minimum(k, len(q) - 1)] == p).sum())
            ok.append(SHARE[1] * both >= SHARE[0] * (len(p) + len(q) - both))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))


def _sizes_fit(n1, n2):
    return F.least(n1, n2) * SHARE[1] >= F.greatest(n1, n2) * SHARE[0]


class Verifier:
    """Whole sets of the nodes that were ever candidates, written once."""

    def __init__(self, texts: DataFrame, members: DataFrame):
        self.texts, self.sets = texts, None
        # one text of each node
        self.codes = members.filter("n > 0").groupBy("node").agg(F.min("code").alias("code"))

    def fetch(self, nodes: DataFrame) -> DataFrame:
        """(node, set) of all nodes known so far, ``nodes`` among them."""
        if self.sets is not None:
            nodes = nodes.join(self.sets.select("node"), "node", "left_anti")
        codes = written(self.codes.join(nodes, "node", "left_semi").select("code").distinct(), "jaccard-codes")
        wanted = codes.count()
        if wanted or self.sets is None:
            rows = self.texts.join(F.broadcast(codes) if wanted <= FILTER_NODES else codes, "code", "left_semi").select("text")
            sets = written(rows.mapInArrow(_sets_of, "node long, set binary").groupBy("node").agg(F.first("set").alias("set")), "jaccard-sets")
            self.sets = sets if self.sets is None else self.sets.unionByName(sets)
        return self.sets

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose whole sets are similar."""
        sets = self.fetch(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct())
        left = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("x")), "a")
        both = left.join(sets.select(F.col("node").alias("b"), F.col("set").alias("y")), "b").select("a", "b", "x", "y")
        return written(both.mapInArrow(_similar, "a long, b long"), "jaccard-links")


def _rooted(rows: DataFrame, placed: DataFrame | None) -> DataFrame:
    """Rows with the root of their node's component (itself when alone)."""
    if placed is None:
        return rows.withColumn("root", F.col("node"))
    return rows.join(placed, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _joined(placed: DataFrame | None, links: DataFrame) -> DataFrame:
    """The components after more links: only roots are linked."""
    if placed is None:
        return written(components(links), "jaccard-placed")
    a = _rooted(links.withColumnRenamed("a", "node"), placed).select(F.col("root").alias("a"), F.col("b").alias("node"))
    both = _rooted(a, placed).select("a", F.col("root").alias("b"))
    moved = components(both).select(F.col("node").alias("root"), F.col("root").alias("to"))
    own = links.select("a").unionByName(links.select(F.col("b").alias("a"))).select(F.col("a").alias("node"), F.col("a").alias("root"))
    # a node placed before keeps its root; one that is new is its own
    nodes = placed.unionByName(own).groupBy("node").agg(F.min_by("root", F.col("root") == F.col("node")).alias("root"))
    return written(nodes.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "jaccard-placed")


def _mixed(rows: DataFrame) -> DataFrame:
    """The rows of shingles whose nodes are of different components."""
    several = rows.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low != high").select("shingle")
    return rows.join(several, "shingle")


def _pivot_pairs(rows: DataFrame, number: int) -> DataFrame:
    """Nodes with the first node of their shingles, in an order drawn anew for
    each round and class of shingles; pairs of one component are left out, and
    pairs that meet once are left to the last step unless one is enough."""
    draw = F.xxhash64(F.lit(number), F.pmod("shingle", F.lit(PIVOTS)), "node")
    first = rows.groupBy("shingle").agg(F.min(F.struct(draw.alias("draw"), "node", "root", "n", "need")).alias("p"))
    met = rows.join(first, "shingle").filter(F.col("root") != F.col("p.root"))
    return (met.select(F.greatest("node", "p.node").alias("a"), F.least("node", "p.node").alias("b"), "n", F.col("p.n").alias("m"), F.least("need", "p.need").alias("least"))
            .filter(_sizes_fit(F.col("n"), F.col("m"))).groupBy("a", "b").agg(F.count("*").alias("both"), F.first("least").alias("least"))
            .filter(F.col("both") >= F.least(F.lit(2), F.col("least"))).select("a", "b"))


def _remaining_links(rows: DataFrame, tried: DataFrame, verifier: Verifier) -> DataFrame:
    """All links between different components.

    ``rows`` has the shingles met by several components.  The node of a pair
    with the smaller (need, node) looks for the other one, in its prefix
    shingles without the ``need - 1`` most crowded."""
    own = written(rows.groupBy("shingle", "root").agg(F.count("*").alias("own")), "jaccard-own")
    size = own.groupBy("shingle").agg(F.sum("own").alias("size"), F.max_by("root", F.struct("own", "root")).alias("largest"))
    crowd = rows.join(size, "shingle").join(own, ["shingle", "root"]).withColumn("others", F.col("size") - F.col("own"))
    # the shingles of one document: bounded by its prefix
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("others"), "shingle"))
    looks = written(crowd.withColumn("rank", rank).filter(F.col("rank") >= F.col("need")).select("shingle", "node", "n", "need", "root", "size"), "jaccard-looks")
    x = looks.filter(F.col("size") <= CROWDED).select("shingle", F.col("node").alias("a"), F.col("n").alias("n"), F.col("need").alias("need"), F.col("root").alias("ra"))
    y = rows.select("shingle", F.col("node").alias("b"), F.col("n").alias("m"), F.col("need").alias("need_b"), F.col("root").alias("rb"))
    smaller = F.struct(F.col("need"), F.col("a").alias("node")) < F.struct(F.col("need_b").alias("need"), F.col("b").alias("node"))
    met = x.join(y, "shingle").filter((F.col("ra") != F.col("rb")) & smaller & _sizes_fit(F.col("n"), F.col("m"))).select("a", "b", "need").distinct()
    # shared prefix shingles of the pairs that met; shingles of one component are not shared by such a pair
    prefix = rows.groupBy("node").agg(F.collect_list("shingle").alias("s"))
    both = met.join(prefix.select(F.col("node").alias("a"), F.col("s").alias("x")), "a").join(prefix.select(F.col("node").alias("b"), F.col("s").alias("y")), "b")
    pairs = both.filter(F.size(F.array_intersect("x", "y")) >= F.col("need")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = verifier.links(written(pairs.join(tried, ["a", "b"], "left_anti"), "jaccard-rest"))
    # crowded shingles that some node still looks in
    busy = looks.filter(F.col("size") > CROWDED).select("shingle").distinct()
    meeting = written(rows.join(busy, "shingle").join(size.select("shingle", "largest"), "shingle")
                      .groupBy("node").agg(F.first("root").alias("root"), F.max(F.col("root") != F.col("largest")).alias("asks")), "jaccard-crowded")
    if not meeting.isEmpty():
        links = links.unionByName(_query_links(meeting, verifier.fetch(meeting.select("node"))))
    return links


def _query_links(meeting: DataFrame, sets: DataFrame) -> DataFrame:
    """Links of the asking nodes with all nodes of ``meeting`` (node, root,
    asks), block by block of queries."""
    spark = meeting.sparkSession
    rows = written(meeting.join(sets, "node").repartition("node"), "jaccard-queries")
    out: list[DataFrame] = []
    block, held = [], 0

    def close() -> None:
        index = spark.sparkContext.broadcast(QueryIndex(block))  # QUERY_BYTES and one set
        out.append(written(rows.select("node", "root", "set").mapInArrow(lambda batches: index.value.links(batches), "a long, b long"), "jaccard-links"))
        index.destroy()
    for r in rows.filter("asks").select("node", "root", "set").toLocalIterator():
        block.append((r["node"], r["root"], np.frombuffer(bytes(r["set"]), np.uint64)))
        held += len(block[-1][2]) * 8
        if held >= QUERY_BYTES:
            close()
            block, held = [], 0
    if block:
        close()
    links = out[0] if out else spark.createDataFrame([], "a long, b long")
    for o in out[1:]:
        links = links.unionByName(o)
    return links


class QueryIndex:
    """A block of queries by shingle: which queries hold each."""

    def __init__(self, queries: list[tuple[int, int, np.ndarray]]):
        self.nodes = np.array([q[0] for q in queries], np.int64)
        self.roots = np.array([q[1] for q in queries], np.int64)
        self.sizes = np.array([len(q[2]) for q in queries], np.int64)
        every = np.concatenate([q[2] for q in queries])
        who = np.repeat(np.arange(len(queries)), self.sizes)
        order = np.argsort(every, kind="stable")
        self.who = who[order]
        self.shingles, first = np.unique(every[order], return_index=True)
        self.first = np.append(first, len(every))

    def links(self, batches):
        for b in batches:
            a, z = [], []
            for node, root, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                s = np.frombuffer(raw.as_buffer(), np.uint64)
                k = np.minimum(np.searchsorted(self.shingles, s), len(self.shingles) - 1)
                k = k[self.shingles[k] == s]
                count = self.first[k + 1] - self.first[k]
                at = np.repeat(self.first[k] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum()) if len(k) else k
                both = np.bincount(self.who[at], minlength=len(self.nodes))
                ok = np.flatnonzero((SHARE[1] * both >= SHARE[0] * (self.sizes + len(s) - both)) & (self.roots != root))
                a += [max(node, q) for q in self.nodes[ok].tolist()]
                z += [min(node, q) for q in self.nodes[ok].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(z, pa.int64())], ["a", "b"])


def _grouped(thin: DataFrame) -> DataFrame:
    """Of (doc_id, text, tie): doc_id, tie, n, node (the set's fingerprint) and
    group (the component's smallest node, null without shingles) of every row."""
    spark = thin.sparkSession
    small_batches(spark)
    thin = thin.withColumn("code", F.xxhash64("text"))
    texts = thin.select("text", "code")
    kind = thin.schema["doc_id"].dataType.simpleString()
    first = written(thin.mapInArrow(_first_pass, f"doc_id {kind}, tie long, code long, n long, hi long, lo long, shingle long, times long"), "jaccard-docs")
    often = (first.filter(F.col("shingle").isNotNull()).groupBy("shingle").agg(F.sum("times").alias("times"))
             .orderBy(F.desc("times"), "shingle").limit(FREQUENT).toPandas())
    order = spark.sparkContext.broadcast(Order(often["shingle"].to_numpy(np.int64).view(np.uint64), often["times"].to_numpy(np.int64)))
    members = first.filter(F.col("n").isNotNull()).select("doc_id", "tie", "code", "n", F.col("hi").alias("node"))
    # distinct sets, each with its prefix
    nodes = (texts.select("text").mapInArrow(_prefixes(order), "hi long, lo long, n int, need int, prefix binary")
             .groupBy("hi", "lo").agg(F.first("n").alias("n"), F.first("need").alias("need"), F.first("prefix").alias("prefix")))
    lists = nodes.select("hi", "n", "need", "prefix").mapInArrow(_explode, "shingle long, node long, n int, need int")
    shared = written(lists.repartition("shingle").sortWithinPartitions("shingle", "node").mapInArrow(_shared, "shingle long, node long, n int, need int"), "jaccard-shared")
    verifier, placed, tried = Verifier(texts, members), None, None
    for number in range(ROUNDS):
        pairs = _pivot_pairs(_mixed(_rooted(shared, placed)), number)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = written(pairs, "jaccard-pairs")
        tried = pairs if tried is None else tried.unionByName(pairs)
        links = verifier.links(pairs)
        if links.isEmpty():
            break
        placed = _joined(placed, links)
    links = _remaining_links(written(_mixed(_rooted(shared, placed)), "jaccard-left"), tried, verifier)
    final = placed if links.isEmpty() else _joined(placed, links)
    if final is None:
        final = spark.createDataFrame([], "node long, root long")
    return members.join(final, "node", "left").withColumn("group", F.when(F.col("n") > 0, F.coalesce("root", "node"))).select("doc_id", "tie", "n", "node", "group")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    grouped = _grouped(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.lit(0).cast("long").alias("tie")))
    smallest = written(grouped.filter("group is not null").groupBy("group").agg(F.min("doc_id").alias("least")), "jaccard-least")
    return (grouped.join(smallest, "group", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("group").isNotNull(), F.col("least")).otherwise(F.col("doc_id")).alias("component_id")))


#: rows to remove that may be broadcast (16 bytes each)
REMOVED = 1_000_000


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near duplicates: the one with the
    smallest id (and, of equal ids, the smallest text hash).  Rows without
    shingles stay, also when their texts are equal."""
    tie = "tie"
    while tie in docs.columns:
        tie += "_"
    key = docs.withColumn(tie, F.xxhash64(F.col(text_col), F.col(id_col)))
    rows = written(_grouped(key.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(tie).alias("tie"))), "jaccard-rows").filter("group is not null")
    best = rows.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie")).alias("best"))
    placed = rows.join(best, "group").withColumn("stays", F.col("best.tie") == F.col("tie"))
    out = written(placed.filter("not stays").select(F.col("tie").alias(tie)).distinct(), "jaccard-removed")
    small = out.count() <= REMOVED
    left = key.join(F.broadcast(out) if small else out, tie, "left_anti")
    # the row that stays may itself be repeated
    many = written(placed.filter("stays").groupBy(F.col("tie").alias(tie)).count().filter("count > 1").select(tie), "jaccard-repeated")
    if not many.isEmpty():
        single = left.join(many, tie, "left_semi").dropDuplicates([tie])
        left = left.join(many, tie, "left_anti").unionByName(single)
    return left.select(*docs.columns)
