"""State of a stream as a table of levelled runs.

Every micro-batch leaves one run at level 0; ``fan`` runs of a level are merged
into one of the next.  Which runs hold the state before a batch follows from the
batch's number alone, so a replayed batch reads and rewrites exactly the same
folders, a reader opens at most ``fan - 1`` runs of each level, and a row is
rewritten once a level (log of the number of batches).  Lost runs are an error:
state that starts again from nothing would look right.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Levels:
    """Runs of one schema below ``path``; ``merge`` turns the union of some runs
    into one of the same meaning."""

    def __init__(self, path: str, schema: str, merge: Callable[[DataFrame], DataFrame], fan: int = 8):
        if fan < 2:
            raise ValueError("fan must be 2 or more")
        self.path, self.schema, self.merge, self.fan = path.rstrip("/"), schema, merge, fan

    def runs(self, before: int) -> list[tuple[int, int]]:
        """(level, number) of the runs that hold batches 0 .. before - 1."""
        level, at, out = 0, 0, []
        while self.fan ** (level + 1) <= before:
            level += 1
        for k in range(level, -1, -1):
            size = self.fan ** k
            while at + size <= before:
                out.append((k, at // size))
                at += size
        return out

    def _folder(self, run: tuple[int, int]) -> str:
        return f"{self.path}/level-{run[0]}/run-{run[1]}"

    def _read(self, spark: SparkSession, runs: list[tuple[int, int]]) -> DataFrame:
        if not runs:
            return spark.createDataFrame([], self.schema)
        try:
            return spark.read.schema(self.schema).parquet(*[self._folder(r) for r in runs])
        except AnalysisException as ex:
            raise RuntimeError(f"state of earlier batches is missing: {ex}") from ex

    def read(self, spark: SparkSession, before: int) -> DataFrame:
        """The rows that the batches below ``before`` left, not merged any further."""
        return self._read(spark, self.runs(before))

    def put(self, df: DataFrame, epoch: int) -> None:
        """The run of batch ``epoch``, and the merged runs that it completes."""
        spark = df.sparkSession
        columns = spark.createDataFrame([], self.schema).columns
        df.select(*columns).write.mode("overwrite").parquet(self._folder((0, epoch)))
        level = 1
        while (epoch + 1) % self.fan ** level == 0:
            number = (epoch + 1) // self.fan ** level - 1
            parts = self._read(spark, [(level - 1, number * self.fan + k) for k in range(self.fan)])
            self.merge(parts).select(*columns).write.mode("overwrite").parquet(self._folder((level, number)))
            level += 1


def ledger(path: str, key: str, kind: str, fan: int = 8) -> Levels:
    """Levels of keys that are done, each run ordered by key, so that a lookup
    skips the row groups outside its keys."""
    return Levels(path, f"{key} {kind}", lambda df: df.distinct().repartitionByRange(F.col(key)).sortWithinPartitions(key), fan)


def unseen(df: DataFrame, done: Levels, key: str, before: int) -> DataFrame:
    """Rows of ``df`` whose key no earlier batch left in the ledger. The ledger is
    reduced to the batch's keys first (the batch is the small side, which the
    optimiser broadcasts by its size), so it is scanned but never shuffled."""
    if before <= 0:
        return df
    hits = done.read(df.sparkSession, before).join(df.select(key), key, "left_semi").distinct()
    return df.join(hits, key, "left_anti").select(*df.columns)
