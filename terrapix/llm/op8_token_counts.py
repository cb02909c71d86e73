"""8. Token counts: map-side two-tier lookup.

A document's token count is the sum of the counts of its pre-tokens (the runs
between single spaces), because no piece of the model holds a word-start mark
after another character; this is proven from the vocabulary when the model is
loaded, and a model without the property is encoded whole.  Tier one is a
compact broadcast table of the corpus' frequent pre-tokens and their lengths;
tier two is a bounded cache in each Python worker that encodes what the table
lacks with the tokenizer library.  Pre-tokens are never shuffled: only a
bounded summary of each task (``SUMMARY`` candidates with counts) is merged to
choose the ``FREQUENT`` table entries.  The table changes speed, never counts.

Defined cases: null text counts as empty (0 bytes, 0 tokens); rows are counted
one by one, so repeated rows and ids repeat; texts with leading, trailing or
doubled spaces, or with the word-start mark itself, are encoded whole; an empty table gives an empty result; only
the id and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

import uuid
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapix.llm.worker import hold, release, small_batches

#: distinct pre-tokens a task tracks, those it reports, and entries of the table
TRACKED, SUMMARY, FREQUENT = 200_000, 4_096, 100_000
#: entries of a worker's cache before it starts anew
CACHED = 400_000
_MARK = "▁"


class PieceCounter(dict):
    """pre-token -> length; a miss asks the library and is remembered."""

    def __init__(self, model: str):
        super().__init__()
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = (self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size()))
        inner = any(_MARK in p.lstrip(_MARK) for p in pieces)
        probe = ["a b", "  a", "a  b ", "é ﬁ"]
        marked = all("".join(self.sp.encode(t, out_type=str)) == _MARK + t.replace(" ", _MARK) for t in probe)
        self.splits = marked and not inner

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHED:
            self.clear()
        n = self[word] = len(self.sp.encode(word))
        return n


class Frequent(dict):
    """The broadcast tier; what it lacks goes to the worker's cache."""

    def __init__(self, table: tuple[str, bytes], rest: PieceCounter):
        words, lengths = table
        super().__init__(zip(words.split(" ") if words else (), np.frombuffer(lengths, np.uint16).tolist()))
        self.rest = rest

    def __missing__(self, word: str) -> int:
        return self.rest[word]


def piece_counter(model: str) -> PieceCounter:
    return hold(f"pieces of {model}", lambda: PieceCounter(model))


def _simple(text: str) -> bool:
    return bool(text) and text[0] != " " and text[-1] != " " and "  " not in text and _MARK not in text


def _summaries(batches):
    """Each task's most frequent pre-tokens, with a bounded number tracked."""
    release()
    seen: Counter[str] = Counter()
    for b in batches:
        for t in b.column(0).to_pylist():
            if t and _simple(t):
                seen.update(t.split(" "))
                if len(seen) > 2 * TRACKED:
                    seen = Counter(dict(seen.most_common(TRACKED)))
    top = seen.most_common(SUMMARY)
    yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["word", "n"])


def frequent_lengths(docs: DataFrame, model: str, text_col: str = "text") -> tuple[str, bytes]:
    """The compact table: the frequent pre-tokens joined by spaces, and their
    token lengths as 16-bit numbers.  At most FREQUENT entries, of at most 64
    characters each, so at most a few MB."""
    counter = piece_counter(model)
    if not counter.splits:
        return "", b""
    top = (docs.select(F.col(text_col).alias("text")).mapInArrow(_summaries, "word string, n long")
           .filter(F.length("word") <= 64).groupBy("word").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "word").limit(FREQUENT).select("word").toPandas()["word"].tolist())
    lengths = np.array([len(x) for x in counter.sp.encode(top)] if top else [], np.uint16)
    return " ".join(top), lengths.tobytes()


def _count(model: str, table: Broadcast, name: str):
    def run(batches):
        tier = hold(f"lengths {name}", lambda: Frequent(table.value, PieceCounter(model)))  # once for each worker and table
        counter, known = tier.rest, tier.__getitem__
        for b in batches:
            sizes, counts = [], []
            for t in b.column(1).to_pylist():
                t = t or ""
                sizes.append(len(t.encode()))
                if counter.splits and _simple(t):
                    counts.append(sum(map(known, t.split(" "))))
                else:
                    counts.append(len(counter.sp.encode(t)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])
    return run


def token_counts(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    table = spark.sparkContext.broadcast(frequent_lengths(docs, model, text_col))
    thin = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = thin.schema["doc_id"].dataType.simpleString()
    return (thin.mapInArrow(_count(model, table, uuid.uuid4().hex), f"doc_id {kind}, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > F.lit(limit)))


def brute_force(frame: pd.DataFrame, model: str) -> list[tuple[int, int]]:
    """(bytes, tokens) by the library on whole texts; for tests."""
    sp = piece_counter(model).sp
    return [(len((t or "").encode()), len(sp.encode(t or ""))) for t in frame["text"]]
