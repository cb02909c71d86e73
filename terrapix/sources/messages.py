"""Bus messages: JSON encode/decode, Kafka framing, file fallbacks (A5-A9,
B10-B12, D12).

Kafka is reached through Spark's own ``kafka`` source/sink (the connector
jar must be on the classpath); the same frames can be written to or read
from JSON-lines folders, which is what the tests use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrapix.schema import RESULT_SCHEMA, STATUS_SUCCESS, TASK_SCHEMA

# Topic and consumer-group names (fixed values shared with existing producers)
TASKS_TOPIC = "satellite-tasks"
RESULTS_TOPIC = "satellite-results"
READY_TOPIC = "satellite-images-ready"
WORKER_GROUP = "satellite-workers"


#: times keep their microseconds
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def encode(df: DataFrame, key=None, cols: list[str] | None = None) -> DataFrame:
    """(key, value) string frame: value = JSON object of ``cols``."""
    cols = cols or df.columns
    value = F.to_json(F.struct(*[F.col(c) for c in cols]), _JSON)
    k = F.lit(None).cast("string") if key is None else (F.col(key) if isinstance(key, str) else key)
    return df.select(k.cast("string").alias("key"), value.alias("value"))


def task_key(task_id: str = "task_id"):
    return F.concat(F.lit("task_"), F.col(task_id).cast("string"))


def to_kafka(df: DataFrame) -> DataFrame:
    """UTF-8 bytes for the Kafka sink (key may be null)."""
    return df.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))


def decode(df: DataFrame, schema: T.StructType, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse JSON values; keep an ``_ok`` flag instead of failing the job on a
    bad message (D12). Bytes are decoded as UTF-8 first; ``keep`` columns
    (e.g. the message key) pass through."""
    v = F.col(value)
    if isinstance(df.schema[value].dataType, T.BinaryType):
        v = F.decode(v, "UTF-8")
    full = T.StructType(list(schema.fields) + [T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json(v, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    out = df.select(*keep, v.alias("_raw"), parsed.alias("_m"))
    ok = F.col("_raw").isNotNull() & F.col("_m").isNotNull() & F.col("_m._corrupt").isNull()
    return out.select(*keep, "_raw", ok.alias("_ok"), *[F.col(f"_m.{f.name}") for f in schema.fields])


def valid(decoded: DataFrame) -> DataFrame:
    return decoded.where("_ok").drop("_ok", "_raw")


def rejects(decoded: DataFrame) -> DataFrame:
    return decoded.where(~F.col("_ok")).select("_raw")


# --- Kafka / file I/O ---------------------------------------------------------

def write_topic(df: DataFrame, topic: str, bootstrap: str) -> None:
    """Batch publish keyed JSON frames (A7). Needs the Kafka connector."""
    (to_kafka(df).write.format("kafka")
     .option("kafka.bootstrap.servers", bootstrap).option("topic", topic).save())


def read_topic_stream(spark: SparkSession, topic: str, bootstrap: str, schema: T.StructType,
                      starting: str = "earliest", min_partitions: int | None = None) -> DataFrame:
    """Streaming read of a topic, decoded (A5, A6, L6). Offsets live in the
    query checkpoint, so a restart resumes where the last batch committed."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", topic).option("startingOffsets", starting))
    if min_partitions:
        r = r.option("minPartitions", str(min_partitions))
    return decode_topic(r.load(), schema)


def decode_topic(frames: DataFrame, schema: T.StructType) -> DataFrame:
    """Decoded topic records with their key, topic time, partition and offset.
    Messages that carry no time of their own take the topic's."""
    keep = frames.select(F.col("key").cast("string").alias("_key"), "value", F.col("timestamp").alias("_topic_ts"),
                         F.col("partition").alias("_partition"), F.col("offset").alias("_offset"))
    out = decode(keep, schema, keep=("_key", "_topic_ts", "_partition", "_offset"))
    ts = F.coalesce("ts", "_topic_ts") if "ts" in schema.fieldNames() else F.col("_topic_ts")
    return out.withColumn("ts", ts)


def read_json_stream(spark: SparkSession, path: str, schema: T.StructType,
                     max_files: int | None = None) -> DataFrame:
    """File-based stand-in for a topic: JSON lines dropped into a folder."""
    r = spark.readStream.format("text")
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return decode(r.load(path), schema)


def write_json_lines(df: DataFrame, path: str, mode: str = "append") -> None:
    df.select("value").write.mode(mode).text(path)


def ready_events(results: DataFrame) -> DataFrame:
    """Image-ready records for successful patches only (A9, B9). ``results``
    carry each patch's own shape [bands, height, width]."""
    ok = results.where(F.col("status") == STATUS_SUCCESS)
    return ok.select(
        "task_id", "worker_id", "bbox", "s3_path", "shape",
        (F.unix_micros(F.current_timestamp()) / F.lit(1e6)).alias("timestamp"))


# --- the bus endpoints under their pipeline names (A5-A9) ------------------------

def read_task_stream(spark: SparkSession, bootstrap: str | None = None, path: str | None = None,
                     min_partitions: int | None = None) -> DataFrame:
    """Task messages as a decoded stream: Kafka when ``bootstrap`` is given,
    else JSON lines under ``path``; reads from the earliest offset (A5)."""
    if bootstrap:
        return read_topic_stream(spark, TASKS_TOPIC, bootstrap, TASK_SCHEMA, "earliest", min_partitions)
    return read_json_stream(spark, path, TASK_SCHEMA)


def read_result_stream(spark: SparkSession, bootstrap: str | None = None, path: str | None = None) -> DataFrame:
    """Result messages from the earliest offset, decoded."""
    if bootstrap:
        return read_topic_stream(spark, RESULTS_TOPIC, bootstrap, RESULT_SCHEMA, "earliest")
    return read_json_stream(spark, path, RESULT_SCHEMA)


def write_tasks(tasks: DataFrame, bootstrap: str) -> None:
    """Publish task records keyed ``task_<id>``."""
    write_topic(encode(tasks, task_key()), TASKS_TOPIC, bootstrap)


def write_results(results: DataFrame, bootstrap: str) -> None:
    """Publish result records keyed ``task_<id>``, so that readers can drop the
    repeats of a replayed batch (A8)."""
    write_topic(encode(results, task_key(), RESULT_SCHEMA.fieldNames()), RESULTS_TOPIC, bootstrap)


def write_ready(results: DataFrame, bootstrap: str) -> None:
    """Publish image-ready records for successful patches only."""
    write_topic(encode(ready_events(results), task_key()), READY_TOPIC, bootstrap)
