"""Written intermediates.

A stage that is read more than once, or whose lineage must survive a lost
executor, is written as Parquet below the shared folder that the cluster names
in ``spark.checkpoint.dir`` and read back.  Spark's commit protocol makes the
write safe under retries.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from terrapix.session import scratch_path


def new_folder(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write a frame below the shared folder and read it back."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    w = df.write.mode("overwrite")
    (w.partitionBy(partition_by) if partition_by else w).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)
