"""9. Sharding: a uniform shuffle by a hypergeometric communication matrix.

How many rows of each partition go to each shard is drawn first, exactly as a
uniform random permutation of all rows would decide it: the counts of one
partition are multivariate hypergeometric given the room left in the shards.
Each partition then permutes its rows' shard numbers locally, rows are exchanged
once, and each shard is permuted again; slots are gapless.  Shard sizes are
exact (``rows`` law: counts at most one apart).

A shard is ordered in random buckets of about ``ROWS_PER_BUCKET`` rows, so no
task gathers a whole shard; a row's place is its bucket's offset plus its rank
there.  The rows are written with their partition and position first, so that a
retried task sees the same rows; partitions are at most ``MAX_PARTITIONS``,
which bounds the broadcast matrix to ``MAX_PARTITIONS`` x shards numbers.

Defined cases: null ids and texts are rows like others (a null text has 0
bytes); repeated rows are placed independently; fewer rows than shards leave
empty shards; an empty table gives an empty result; all columns are carried and
the added names never clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrapix.llm.store import written

SHARDS, SEED, ROWS_PER_BUCKET, MAX_PARTITIONS = 40, 20240229, 200_000, 50_000
_INDEX = (1 << 33) - 1  # monotonically_increasing_id: partition above bit 33, row below


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Good ones among n drawn without replacement, for urns of any size."""
    if n <= 0 or good <= 0:
        return 0
    if bad <= 0 or n >= good + bad:
        return min(good, n)
    if good + bad < 10**9:
        return int(rng.hypergeometric(good, bad, n))
    # numpy's sampler ends at 10**9: invert the distribution around its mode
    total = good + bad
    mean = n * good / total
    spread = (mean * (bad / total) * (total - n) / (total - 1)) ** 0.5
    low = max(0, n - bad, int(mean - 14 * spread) - 14)
    high = min(n, good, int(mean + 14 * spread) + 14)
    k = np.arange(low, high, dtype=float)
    steps = np.log((good - k) * (n - k)) - np.log((k + 1) * (bad - n + k + 1))
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    p = np.exp(logs - logs.max())
    return low + int(rng.choice(len(p), p=p / p.sum()))


def communication_matrix(sizes: list[int], shards: int, seed: int) -> np.ndarray:
    """Rows from each partition (rows) to each shard (columns)."""
    total = sum(sizes)
    room = [total // shards + (j < total % shards) for j in range(shards)]
    rng = np.random.default_rng(seed)
    out = np.zeros((len(sizes), shards), np.int64)
    for i, n in enumerate(sizes):
        rest = sum(room)
        for j in range(shards):
            rest -= room[j]
            got = hypergeometric(rng, room[j], rest, n)
            out[i, j] = got
            room[j] -= got
            n -= got
    return out


def shuffle_into_shards(df: DataFrame, shards: int = SHARDS, seed: int = SEED, rows_per_bucket: int = ROWS_PER_BUCKET) -> tuple[DataFrame, str, str]:
    """``df`` with a shard and a slot column; returns their names as well."""
    spark = df.sparkSession
    inner = [f"c{i}" for i in range(len(df.columns))]
    rows = df.toDF(*inner)
    if rows.rdd.getNumPartitions() > MAX_PARTITIONS:
        rows = rows.coalesce(MAX_PARTITIONS)
    staged = written(rows.withColumn("pos", F.monotonically_increasing_id()), "shard-rows")
    part = F.shiftright("pos", 33)
    sizes = {r["p"]: r["n"] for r in staged.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}
    parts = sorted(sizes)
    matrix = communication_matrix([sizes[p] for p in parts], shards, seed)
    shared = spark.sparkContext.broadcast(({p: i for i, p in enumerate(parts)}, matrix))

    @F.pandas_udf("int")
    def shard_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        """The partition's shard numbers in a random order, by position: permuted
        once in a task, for all its batches."""
        row, counts = shared.value
        held: dict[int, np.ndarray] = {}
        for pos in batches:
            at = pos.to_numpy(np.int64)
            out = np.zeros(len(at), np.int32)
            for p in np.unique(at >> 33).tolist():
                if p not in held:
                    held.clear()
                    held[p] = np.repeat(np.arange(shards, dtype=np.int32), counts[row[p]])
                    np.random.default_rng((seed, p)).shuffle(held[p])
                mine = (at >> 33) == p
                out[mine] = held[p][at[mine] & _INDEX]
            yield pd.Series(out)

    n = sum(sizes.values())
    buckets = max(1, -(-n // (shards * rows_per_bucket)))
    dealt = (staged.withColumn("shard", shard_of("pos")).withColumn("order", F.xxhash64(F.lit(seed), F.lit("slot"), "pos"))
             .withColumn("bucket", F.pmod(F.shiftrightunsigned("order", 20), F.lit(buckets)).cast("int")))
    counts = {(r["shard"], r["bucket"]): r["n"] for r in dealt.groupBy("shard", "bucket").agg(F.count("*").alias("n")).collect()}
    before, offsets = {}, []
    for shard, bucket in sorted(counts):  # shards x buckets rows
        offsets.append((shard, bucket, before.get(shard, 0)))
        before[shard] = before.get(shard, 0) + counts[shard, bucket]
    offset = spark.createDataFrame(offsets, "shard int, bucket int, before long")
    rank = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("order", "pos")) - 1
    out = dealt.withColumn("rank", rank).join(offset, ["shard", "bucket"])
    names = [_free("shard", df), _free("slot", df)]
    return out.select(*inner, "shard", (F.col("before") + F.col("rank")).alias("slot")).toDF(*df.columns, *names), *names


def _free(name: str, df: DataFrame) -> str:
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
