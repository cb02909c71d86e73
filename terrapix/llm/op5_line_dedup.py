"""5. Line dedup: levelled sorted runs of line hashes.

Documents come in batches.  A batch is reduced to its distinct line keys (128
bits of hash) with the number of documents that hold each.  ``LineRuns`` keeps
such keys in sorted runs: each new batch is anti-joined with the settled run
(keys already known to be in enough documents need no more counting) and added
as a run of level 0; ``FANOUT`` runs of a level are merged into one of the next,
and keys that reach the threshold there move to the settled run.  In the end the
levels are merged once and every document loses the lines whose key is settled,
wherever they stand; with ``keep_first`` one copy stays, in the document with
the smallest id.

The settled keys are broadcast only when they fit ``BROADCAST_KEYS``; beyond it
line keys are joined with them by a shuffle and only line numbers return.

Defined cases: a null or empty text is one empty line; keys shorter than
``min_chars`` code points (so blank lines) always stay; every row counts as a
document of its own, also with a repeated or null id; with ``keep_first`` rows
without id hold the copy that stays only when no row with the line has an id,
then one of them, by the hash of its text; an empty table gives an empty result; other columns are carried untouched, whatever
their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrapix.llm import textvec as tv
from terrapix.llm.store import new_folder, written
from terrapix.llm.worker import release, small_batches

BATCHES, FANOUT, BROADCAST_KEYS = 8, 4, 400_000
KEY = ["hi", "lo"]


def line_keys(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """start, end, row, code points of the key, and the two key hashes of every line."""
    s, e, row = tv.line_spans(buf, off)
    ws, we, _ = tv.word_spans(buf, off, tv.SPACE)
    a, z = np.searchsorted(ws, s, "left"), np.searchsorted(ws, e, "left") - 1
    wordy = a <= z
    ks, ke = s.copy(), s.copy()
    ks[wordy], ke[wordy] = ws[a[wordy]], we[z[wordy]]
    points = np.zeros(len(buf) + 1, np.int64)
    np.cumsum((buf & 0xC0) != 0x80, out=points[1:])
    return s, e, row, points[ke] - points[ks], tv.span_hashes(buf, ks, ke, True, 0).view(np.int64), tv.span_hashes(buf, ks, ke, True, 1).view(np.int64)


def _batch_keys(batches: int, min_chars: int):
    """Per Arrow batch: its distinct keys, the number of rows holding each, the
    smallest id among them, and the smallest number of those without id."""
    def run(source):
        release()
        number = TaskContext.get().partitionId() % batches
        for b in source:
            hi, lo, rows = [], [], []
            for r0, _, buf, off in tv.chunks(b.column(1)):
                _, _, row, points, h, l = line_keys(buf, off)
                at = points >= min_chars
                hi.append(h[at]), lo.append(l[at]), rows.append(row[at] + r0)
            if not hi:
                continue
            t = pa.table({"hi": np.concatenate(hi), "lo": np.concatenate(lo), "row": np.concatenate(rows)}).group_by(["hi", "lo", "row"]).aggregate([])
            at = t["row"].combine_chunks()
            t = t.append_column("doc_id", b.column(0).take(at)).append_column("orphan", b.column(2).take(at))
            t = t.group_by(KEY).aggregate([("row", "count"), ("doc_id", "min"), ("orphan", "min")])
            t = t.select(["hi", "lo", "row_count", "doc_id_min", "orphan_min"]).rename_columns(["hi", "lo", "n", "first", "first_orphan"])
            t = t.append_column("batch", pa.array(np.full(len(t), number), pa.int32()))
            yield from t.to_batches()
    return run


class LineRuns:
    """Levelled runs of (hi, lo, n) below the shared folder."""

    def __init__(self, spark: SparkSession, at_least: int):
        self.spark, self.at_least = spark, at_least
        self.folder, self.made = new_folder(spark, "line-runs"), 0
        self.levels: list[list[DataFrame]] = []
        self.settled: list[DataFrame] = []

    def _write(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/run={self.made}"
        self.made += 1
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema("hi long, lo long, n long").parquet(path)

    def _merge(self, runs: list[DataFrame]) -> DataFrame:
        out = runs[0]
        for r in runs[1:]:
            out = out.unionByName(r)
        return out.groupBy(*KEY).agg(F.sum("n").alias("n"))

    def add(self, keys: DataFrame) -> None:
        """A batch's keys, counted: anti-join the settled run, add the rest."""
        fresh = keys.groupBy(*KEY).agg(F.sum("n").alias("n"))
        for run in self.settled:
            fresh = fresh.join(run, KEY, "left_anti")
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(self._write(fresh.sortWithinPartitions(*KEY)))
        level = 0
        while len(self.levels[level]) >= FANOUT:
            self._compact(level)
            level += 1

    def _compact(self, level: int) -> None:
        merged = self._write(self._merge(self.levels[level]).sortWithinPartitions(*KEY))
        self.levels[level] = []
        if level + 1 == len(self.levels):
            self.levels.append([])
        if level + 2 == len(self.levels) and not any(self.levels[level + 1:]):
            # the deepest level: nothing older can add to these counts
            done = self._write(merged.filter(F.col("n") >= self.at_least))
            self.settled = [self._write(self._merge([*self.settled, done]))] if self.settled else [done]
            merged = merged.filter(F.col("n") < self.at_least)
        self.levels[level + 1].append(merged)

    def frequent(self) -> DataFrame:
        """(hi, lo) of the keys found in at least ``at_least`` documents."""
        live = [r for level in self.levels for r in level]
        out = self._merge(live).filter(F.col("n") >= self.at_least).select(*KEY) if live else self.spark.createDataFrame([], "hi long, lo long")
        for run in self.settled:
            out = out.unionByName(run.select(*KEY))
        return written(out.distinct(), "line-settled")


def frequent_lines(docs: DataFrame, at_least: int, min_chars: int, id_col: str, text_col: str, keep_first: bool) -> DataFrame:
    """Settled keys (hi, lo) and, on demand, the smallest id holding each, and the
    smallest number (``orphan``) of a row without id."""
    thin = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), "orphan")
    kind = thin.schema["doc_id"].dataType.simpleString()
    staged = written(thin.mapInArrow(_batch_keys(BATCHES, min_chars), f"hi long, lo long, n long, first {kind}, first_orphan long, batch int"), "line-keys", partition_by="batch")
    runs = LineRuns(docs.sparkSession, at_least)
    for i in range(BATCHES):
        runs.add(staged.filter(F.col("batch") == i).select(*KEY, "n"))
    keys = runs.frequent()
    return staged.join(keys, KEY).groupBy(*KEY).agg(F.min("first").alias("first"), F.min("first_orphan").alias("first_orphan")) if keep_first else keys


class Settled:
    """Settled keys sorted by their first half, for lookups in a task."""

    def __init__(self, hi: np.ndarray, lo: np.ndarray, first: list | None):
        """``first``: the holder of each key, (id, None) or (None, orphan)."""
        order = np.lexsort((lo, hi))
        self.hi, self.lo = hi[order], lo[order]
        self.first = [first[i] for i in order] if first is not None else None

    def find(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """Index of each key, -1 where it is not settled."""
        out = np.full(len(hi), -1, np.int64)
        if len(self.hi):
            i = np.searchsorted(self.hi, hi)
            for _ in range(4):  # equal first halves stand side by side; four of one 64-bit hash are out of reach
                j = np.minimum(i, len(self.hi) - 1)
                ok = (self.hi[j] == hi) & (self.lo[j] == lo)
                out[ok] = j[ok]
                i = i + 1
        return out


def _kept_text(text: bytes, starts: list[int], ends: list[int], drop: list[bool]) -> bytes:
    return b"\n".join(text[s:e] for s, e, d in zip(starts, ends, drop) if not d)


def _drop(b: pa.RecordBatch, text_at: int, dropped_of) -> pa.RecordBatch:
    """The batch with the text column replaced and n_lines, n_dropped added;
    ``dropped_of(first row, lines)`` says which lines of a chunk go."""
    texts, n_lines, n_dropped = [], [], []
    for r0, r1, buf, off in tv.chunks(b.column(text_at)):
        lines = line_keys(buf, off)
        s, e, row = lines[:3]
        gone = dropped_of(r0, lines)
        count, lost = np.bincount(row, minlength=r1 - r0), np.bincount(row[gone], minlength=r1 - r0)
        n_lines.append(count), n_dropped.append(lost)
        raw, ends_of = buf.tobytes(), np.cumsum(count)
        for i in range(r1 - r0):
            if lost[i]:
                at = slice(int(ends_of[i] - count[i]), int(ends_of[i]))
                texts.append(_kept_text(raw, s[at].tolist(), e[at].tolist(), gone[at].tolist()))
            else:
                texts.append(raw[off[i]:off[i + 1]])
    cols = list(b.columns)
    cols[text_at] = pa.array(texts, pa.binary()).cast(pa.string())
    both = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (n_lines, n_dropped)]
    return pa.RecordBatch.from_arrays([*cols, *(pa.array(x.astype(np.int64)) for x in both)], names=[f"c{i}" for i in range(len(cols) + 2)])


def dedup_lines(docs: DataFrame, at_least: int = 10, min_chars: int = 1, keep_first: bool = False,
                id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, list[str]]:
    """``docs`` with frequent lines removed from its text, and two columns
    added: lines before, lines dropped.  Returns the frame and the names of the
    two columns (chosen so that they clash with none of ``docs``)."""
    small_batches(docs.sparkSession)
    spark, names = docs.sparkSession, [_free("n_lines", docs), _free("n_dropped", docs)]
    text_at, id_at = docs.columns.index(text_col), docs.columns.index(id_col)
    internal = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*internal).withColumn(internal[text_at], F.col(internal[text_at]).cast("string"))
    plain = _numbered_orphans(plain, internal[id_at], internal[text_at]) if keep_first else plain.withColumn("orphan", F.lit(None).cast("long"))
    keys = written(frequent_lines(plain, at_least, min_chars, internal[id_at], internal[text_at], keep_first), "line-frequent")
    schema = ", ".join(f"{c} {plain.schema[c].dataType.simpleString()}" for c in internal)
    added = f", c{len(internal)} long, c{len(internal) + 1} long"
    if keys.count() <= BROADCAST_KEYS:
        held = keys.toArrow()
        shared = spark.sparkContext.broadcast(Settled(held["hi"].to_numpy(), held["lo"].to_numpy(), _holders(held) if keep_first else None))

        def run(batches):
            release()
            known = shared.value
            for b in batches:
                ids = list(zip(b.column(id_at).to_pylist(), b.column(len(internal)).to_pylist())) if keep_first else []

                def dropped(r0, lines):
                    _, _, row, points, hi, lo = lines
                    at = known.find(hi, lo)
                    gone = (at >= 0) & (points >= min_chars)
                    if keep_first:
                        _spare_first(gone, at, [ids[r0 + r] for r in row[gone].tolist()], row, known.first)
                    return gone
                yield _drop(pa.RecordBatch.from_arrays(b.columns[:-1], internal), text_at, dropped)
        out = plain.mapInArrow(run, schema + added)
    else:
        out = _by_join(plain, keys, schema, added, internal, text_at, id_at, min_chars, keep_first)
    return out.toDF(*docs.columns, *names), names


def _numbered_orphans(plain: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``plain`` with a number for every row without id (null for the others), in
    the order of their texts' hashes; such rows are written once."""
    some = plain.filter(F.col(id_col).isNull()).withColumn("orphan", F.monotonically_increasing_id())
    some = some.orderBy(F.xxhash64(text_col), "orphan").withColumn("orphan", F.monotonically_increasing_id())
    some = written(some, "line-orphans")
    rest = plain.withColumn("orphan", F.lit(None).cast("long"))
    return rest if some.isEmpty() else rest.filter(F.col(id_col).isNotNull()).unionByName(some)


def _holders(held: pa.Table) -> list[tuple]:
    return [(d, None if d is not None else o) for d, o in zip(held["first"].to_pylist(), held["first_orphan"].to_pylist())]


def _spare_first(gone: np.ndarray, key: np.ndarray, ids: list, row: np.ndarray, first: list) -> None:
    """Let the first line of a key stay in the first document holding it."""
    spared = set()
    for i, doc in zip(np.flatnonzero(gone).tolist(), ids):
        mark = (int(row[i]), int(key[i]))
        if first[key[i]] == doc and mark not in spared:
            spared.add(mark)
            gone[i] = False


def _by_join(plain: DataFrame, keys: DataFrame, schema: str, added: str, internal: list[str], text_at: int, id_at: int, min_chars: int, keep_first: bool) -> DataFrame:
    """The way beyond the broadcast bound: number the rows, join line keys with
    the settled ones, and bring the line numbers back to their rows."""
    numbered = written(plain.withColumn("uid", F.monotonically_increasing_id()), "line-docs")

    def lines(batches):
        for b in batches:
            for r0, r1, buf, off in tv.chunks(b.column(1)):
                _, _, row, points, hi, lo = line_keys(buf, off)
                first = np.searchsorted(row, np.arange(r1 - r0))
                at = np.flatnonzero(points >= min_chars)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row[at] + r0)), pa.array(at - first[row[at]]), pa.array(hi[at]), pa.array(lo[at]), b.column(2).take(pa.array(row[at] + r0)), b.column(3).take(pa.array(row[at] + r0))], ["uid", "line", "hi", "lo", "doc", "orphan"])
    kind = plain.schema[internal[id_at]].dataType.simpleString()
    found = numbered.select("uid", internal[text_at], F.col(internal[id_at]).alias("doc"), "orphan").mapInArrow(lines, f"uid long, line long, hi long, lo long, doc {kind}, orphan long").join(keys, KEY)
    if keep_first:
        stays = found.filter(F.when(F.col("first").isNull(), F.col("orphan") == F.col("first_orphan")).otherwise(F.col("doc") == F.col("first"))).groupBy("uid", *KEY).agg(F.min("line").alias("line"))
        found = found.join(stays, ["uid", "line", *KEY], "left_anti")
    gone = found.groupBy("uid").agg(F.collect_list("line").alias("gone"))
    joined = numbered.join(gone, "uid", "left").select(*internal, "gone")

    def run(batches):
        for b in batches:
            lost = b.column(len(internal)).to_pylist()

            def dropped(r0, lines):
                row = lines[2]
                out = np.zeros(len(row), bool)
                first = np.searchsorted(row, np.arange(row[-1] + 1 if len(row) else 0))
                for r in range(len(first)):
                    if lost[r0 + r]:
                        out[first[r] + np.array(lost[r0 + r])] = True
                return out
            yield _drop(pa.RecordBatch.from_arrays(b.columns[:-1], internal), text_at, dropped)
    return joined.mapInArrow(run, schema + added)


def _free(name: str, docs: DataFrame) -> str:
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name
