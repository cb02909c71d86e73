"""Memory of Python workers.

Spark reuses a Python worker for tasks of many queries.  What an operator keeps
between tasks (models, caches of words) is held here, one thing at a time, and
let go when a task of another operator runs in the worker.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import SparkSession

#: rows in an Arrow batch: texts of some kB make batches of some MB
BATCH_ROWS = 2_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_held: dict[str, object] = {}


def hold(name: str, make: Callable[[], object]):
    """The worker's object of this name, made when it is not there."""
    if name not in _held:
        release()
        _held[name] = make()
    return _held[name]


def release() -> None:
    """Let go of what other operators' tasks have left, and give it back to the
    system: a worker's freed memory counts for its executor all the same."""
    if _held:
        _held.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    if trim is not None:
        trim(0)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_ROWS`` rows in this session; a smaller
    setting stays as it is."""
    rows = int(spark.conf.get(_BATCH, "10000"))
    if rows <= 0 or rows > BATCH_ROWS:
        spark.conf.set(_BATCH, str(BATCH_ROWS))
