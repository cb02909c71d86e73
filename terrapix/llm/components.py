"""Connected components of a table of links, by alternating stars.

Each round hangs every node below the smallest neighbour it knows (large star,
then small star) until nothing changes; the number of rounds grows with the
logarithm of the longest path.  Rounds are written to the shared folder, so
lineage stays short, and no node's neighbours are ever collected in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapix.llm.store import written


def _both(e: DataFrame) -> DataFrame:
    return e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large(e: DataFrame) -> DataFrame:
    """Links of a node with larger neighbours move to its smallest one."""
    near = _both(e)
    least = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return near.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(e: DataFrame) -> DataFrame:
    """Links of a node with smaller neighbours move to the smallest one."""
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every linked node; ``links`` has columns a and b.  The
    root is the smallest node of the component."""
    e = written(links.filter("a != b").select("a", "b").distinct(), "cc")
    mark = None
    while True:
        e = written(_small(_large(e)), "cc")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
