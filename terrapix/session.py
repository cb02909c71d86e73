"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale; they are defaults, a cluster's own
# spark-defaults / submit flags win because we only set what is unset.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    # checkpoint files of unreachable Datasets are removed, so the shared
    # checkpoint folder does not grow with every materialised intermediate
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "terrapix",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with AQE on and the UI off.

    ``master`` is only applied when given (local tests/bench); on a cluster
    the submitter decides.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; a scratch folder is created only
    when nothing is configured (local tests), never overriding the cluster's.
    Sessions without a local SparkContext (Spark Connect) keep the server's
    setting untouched.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session: the server owns the setting
        try:
            return spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # noqa: BLE001
            return None
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d and not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    if not d:
        d = tempfile.mkdtemp(prefix="terrapix-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder (streaming checkpoints,
    materialised intermediates)."""
    base = checkpoint_dir(spark)
    if not base:
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    base = base.rstrip("/")
    return f"{base}/{name}"


def require_checkpoint(path: str | None) -> None:
    """A stream's checkpoint is its memory: it must outlive the process, so
    there is no default."""
    if not path:
        raise ValueError("a stream needs a checkpoint folder of its own, shared and kept between runs")
