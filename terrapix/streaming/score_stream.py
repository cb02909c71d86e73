"""Scoring stream (L5, E6): image-ready events -> the announced patches' pixels
-> features -> saved model -> running confusion, exact AUC and their report.

Both sides grow while the stream runs.  The pixel table is written batch by batch
(``write_pixels``), each leaving a layout record beside the table when it is
complete: its folder and its number of buckets.  The stream reads events and
layout records as one stream, so either wakes it; a patch is scored once its
event *and* its complete pixel batch are there, whichever came first.  An event
names its own folder (``s3_path``), so a batch lists and reads just the folders
and buckets of the patches it scores, never the table, and no pixel is kept as
stream state.

A patch whose pixels are not there, or fewer than its shape says, waits: it is
listed with the reason in ``waiting`` and tried again by every later batch.  After
``patience`` batches it moves to ``missing`` for good.  It is never counted.  A
patch announced again, in this batch or an earlier one, is scored once.

State, all by batch number and replaced when a batch is replayed: waiting patches,
a ledger of scored patch ids and a table of counts per score, both in levelled
runs (``levels``), and the (label, prediction) counts.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from terrapix.operators import features as feat
from terrapix.operators import metrics
from terrapix.operators.monitor import patch_name
from terrapix.plans.patch_production import LAYOUT, layout_path
from terrapix.schema import DEFAULT_BANDS, BandSpec
from terrapix.session import require_checkpoint
from terrapix.streaming.levels import Levels, ledger, unseen

_CONFUSION = "label double, prediction double, count long"
_SCORES = "s double, pos long, neg long"
_PATCH = "task_id long, patch_id string, folder string, n_pixels long, since int"


def announced_patches(ready: DataFrame) -> DataFrame:
    """task_id, patch_id, folder and expected number of pixels of the ready
    events; the folder is null when an event names no path."""
    shape = F.when(F.size("shape") == 3, F.col("shape")[1].cast("bigint") * F.col("shape")[2]) if "shape" in ready.columns else F.lit(None)
    folder = F.regexp_extract("s3_path", r"^(.*[^/])/+[^/]+$", 1) if "s3_path" in ready.columns else F.lit(None)
    return ready.select("task_id", patch_name().alias("patch_id"), F.nullif(folder, F.lit("")).cast("string").alias("folder"), shape.cast("bigint").alias("n_pixels"))


def _wake_ups(ready: DataFrame, pixel_path: str) -> DataFrame:
    """Events and the layout records of complete pixel batches, as one stream."""
    spark = ready.sparkSession
    where = layout_path(pixel_path)
    spark.createDataFrame([], LAYOUT).write.mode("append").json(where)  # the folder must be there
    records = spark.readStream.schema(LAYOUT).option("recursiveFileLookup", "true").json(where)
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("task_id", "bigint"), ("patch_id", "string"), ("folder", "string"), ("n_pixels", "bigint"))]
    return announced_patches(ready).withColumn("event", F.lit(True)).unionByName(records.select(*nothing, F.lit(False).alias("event")))


def complete_batches(spark: SparkSession, pixel_path: str) -> DataFrame:
    """The pixel batches that are completely written, listed now."""
    return (spark.read.schema(LAYOUT).option("recursiveFileLookup", "true").json(layout_path(pixel_path))
            .groupBy("folder").agg(F.max("pixel_batch").alias("pixel_batch"), F.max("buckets").alias("buckets")))


def announced_pixels(ids: DataFrame, pixel_path: str) -> DataFrame | None:
    """Pixels of the patches in ``ids`` (task_id, patch_id, folder), each read from
    the folder that its event names (E6); the folders' own bucket numbers prune.
    None when no folder of theirs is complete."""
    spark = ids.sparkSession
    there = ids.join(complete_batches(spark, pixel_path), "folder")
    # one row for each folder and bucket that the batch needs
    needed = there.select("folder", F.pmod("task_id", F.col("buckets")).cast("int").alias("k")).distinct().collect()
    if not needed:
        return None
    px = (spark.read.option("basePath", pixel_path).parquet(*sorted({r["folder"] for r in needed}))
          .where(F.col("task_bucket").isin(sorted({r["k"] for r in needed}))))
    return px.join(there.select("patch_id", F.col("pixel_batch").cast("int").alias("batch")), ["patch_id", "batch"], "left_semi")


def scored_pixels(pixels: DataFrame, model, bands: BandSpec = DEFAULT_BANDS, features=feat.FEATURES_V1) -> DataFrame:
    """patch_id, label, prediction and score (probability of class 1). ``model`` is
    a pipeline model, or anything with a ``transform`` that adds a prediction and
    a probability or score."""
    idx = tuple(f for f in ("ndvi", "ndwi", "ndmi") if f in features) or ("ndvi",)
    out = model.transform(feat.pixel_features(pixels, bands, indices=idx, keep=("patch_id", "pixel_idx")))
    score = F.col("score") if "score" in out.columns else vector_to_array("probability")[1]
    return out.select("patch_id", F.col("label").cast("double").alias("label"), F.col("prediction").cast("double").alias("prediction"), score.cast("double").alias("s"))


def score_counts(path: str, fan: int = 8) -> Levels:
    """Counts per score of all scored pixels, in levelled runs: merging adds."""
    return Levels(path, _SCORES, lambda df: df.groupBy("s").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")), fan)


def running_auc(scores: Levels, spark: SparkSession, before: int) -> DataFrame:
    """Exact AUC over all batches below ``before`` (one row: auc, n_pos, n_neg)."""
    return metrics.auc_from_counts(scores.merge(scores.read(spark, before)))


def _state(spark: SparkSession, out: str, name: str, schema: str, epoch: int) -> DataFrame:
    """What batch ``epoch - 1`` left; lost state is an error."""
    if epoch == 0:
        return spark.createDataFrame([], schema)
    path = f"{out}/{name}/batch={epoch - 1}"
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as ex:
        raise RuntimeError(f"{name} of batch {epoch - 1} is missing: {path}") from ex


def _kept(df: DataFrame, path: str, schema: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def run_score_stream(ready_stream: DataFrame, pixel_path: str, model, checkpoint: str | None, out_dir: str,
                     available_now: bool = True, processing_time: str | None = None, patience: int | None = None,
                     bands: BandSpec = DEFAULT_BANDS, features=feat.FEATURES_V1, fan: int = 8) -> StreamingQuery:
    """Running confusion and report of all announced patches below ``out_dir``:
    ``confusion``, ``report``, ``waiting`` and ``missing`` by ``batch=<id>``.

    ``pixel_path`` is the table's folder (as given to ``write_pixels``), listed by
    every batch; ``patience`` the batches that a patch may wait, None for ever."""
    require_checkpoint(checkpoint)
    out, table = out_dir.rstrip("/"), pixel_path.rstrip("/")
    done, scores = ledger(f"{out}/scored", "patch_id", "string", fan), score_counts(f"{out}/scores", fan)

    def batch(df: DataFrame, epoch: int) -> None:
        spark = df.sparkSession
        # who is to be scored: new and waiting patches, where the latest event of each says
        new = df.where("event").drop("event").withColumn("since", F.lit(epoch))
        both = new.unionByName(_state(spark, out, "waiting", _PATCH, epoch).select(*new.columns))
        one = both.groupBy("patch_id").agg(F.max(F.struct("since", "folder", "task_id", "n_pixels")).alias("e"), F.min("since").alias("since"))
        ids = one.select("e.task_id", "patch_id", "e.folder", "e.n_pixels", "since")
        ids = _kept(unseen(ids, done, "patch_id", epoch), f"{out}/candidates/batch={epoch}", _PATCH)
        # whose pixels are all there
        px = announced_pixels(ids, table)
        found = (px.groupBy("patch_id").agg(F.count(F.lit(1)).alias("n_found")) if px is not None
                 else spark.createDataFrame([], "patch_id string, n_found long"))
        state = ids.join(found, "patch_id", "left").withColumn("reason", (
            F.when(F.col("folder").isNull(), "the event names no path").when(F.col("n_found").isNull(), "pixels not written")
            .when(F.col("n_found") < F.col("n_pixels"), "fewer pixels than the shape").when(F.col("n_found") > F.col("n_pixels"), "more pixels than the shape")))
        state = _kept(state.select(*ids.columns, "n_found", "reason"), f"{out}/state/batch={epoch}", _PATCH + ", n_found long, reason string")
        ready = state.where(F.col("reason").isNull())
        late = F.lit(False) if patience is None else (F.lit(epoch) - F.col("since") >= patience)
        open_ = state.where(F.col("reason").isNotNull())
        open_.where(~late).write.mode("overwrite").parquet(f"{out}/waiting/batch={epoch}")
        open_.where(late).write.mode("overwrite").parquet(f"{out}/missing/batch={epoch}")
        # one pass over their pixels: counts per score
        pairs = spark.createDataFrame([], "label double, prediction double, s double, n long")
        if px is not None:
            rows = scored_pixels(px.join(ready.select("patch_id"), "patch_id", "left_semi"), model, bands, features)
            pairs = _kept(rows.groupBy("label", "prediction", "s").agg(F.count(F.lit(1)).alias("n")), f"{out}/counted/batch={epoch}", "label double, prediction double, s double, n long")
        pos, neg = F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)), F.sum(F.when(F.col("label") == 1, 0).otherwise(F.col("n")))
        scores.put(pairs.where(F.col("s").isNotNull()).groupBy("s").agg(pos.cast("bigint").alias("pos"), neg.cast("bigint").alias("neg")), epoch)
        conf = pairs.groupBy("label", "prediction").agg(F.sum("n").alias("count")).unionByName(_state(spark, out, "confusion", _CONFUSION, epoch))
        conf = _kept(conf.groupBy("label", "prediction").agg(F.sum("count").alias("count")), f"{out}/confusion/batch={epoch}", _CONFUSION)
        report = metrics.report_from_confusion(conf).crossJoin(running_auc(scores, spark, epoch + 1))  # one row each
        report.withColumns({"n_scored": F.lit(ready.count()), "n_waiting": F.lit(open_.where(~late).count()), "n_missing": F.lit(open_.where(late).count())}) \
            .write.mode("overwrite").parquet(f"{out}/report/batch={epoch}")
        # last: what is in the ledger has been counted; a given-up patch stays given up
        done.put(state.where(F.col("reason").isNull() | late), epoch)

    w = _wake_ups(ready_stream, table).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
