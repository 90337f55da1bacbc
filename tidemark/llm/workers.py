"""Python workers and this package."""

from __future__ import annotations

import ctypes
import functools
import gc
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

ARROW_BATCH = "2m"       # bytes of an Arrow batch, where the session has left Spark's 64 MB
BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
FREEING = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "2"}     # workers give memory back
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def reachable(spark: SparkSession) -> SparkSession:
    """Prepare a session for the Arrow functions of this package.

    The folder of this package comes on the import path of Python workers started from now on: the functions are
    shipped by reference to their modules, and a worker knows the driver's `sys.path` only if they share a working
    folder. On a cluster the folder (or an installed package) has to be there on every executor. Batches of texts
    are bounded to a few MB, in executors and workers alike, if the session has not set a bound of its own."""
    if spark.conf.get(BATCH_KEY, None) in (None, "67108864", "67108864b", "64m", "64MB"):
        spark.conf.set(BATCH_KEY, ARROW_BATCH)
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, (ROOT, known)))
    for name, value in FREEING.items():
        environment.setdefault(name, value)
    return spark


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """`run` for mapInArrow; when a task is done, its worker, which Spark keeps for later tasks and stages, gives the
    memory it has freed back to the system."""
    @functools.wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()
    return whole


def release() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc
    if trim:
        trim(0)
