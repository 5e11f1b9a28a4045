"""Session settings and the shared working folder."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every run wants: adaptive plans (runtime broadcast, skew-join splitting,
# partition coalescing), one time zone, Arrow transfer for the few Python operators.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",  # no Python stack capture per call
}

#: Setting for the most bytes of a batch that goes to a Python worker, and what they are within ``small_batches``.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 1 << 20


def build_session(app_name: str = "casewatch", master: str | None = None, **conf: str) -> SparkSession:
    """Return a session with the library's settings; ``conf`` keys use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own; a cluster without the
    setting is an error, because a machine-local path is invisible to other executors.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    own = tempfile.mkdtemp(prefix="casewatch-")
    spark.sparkContext.setCheckpointDir(own)
    return spark.sparkContext.getCheckpointDir()


_SCOPES: list[list[str]] = []


def new_table_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, so that no run overwrites another one's table."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of one's own that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end the intermediate tables that were made within: for work whose results are written elsewhere, or used up by then.

    Frames that still read such tables must not be used afterwards.
    """
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield
    finally:
        _SCOPES.pop()
        discard(spark, made)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables, and let Spark free the shuffle files of plans that nothing refers to any more."""
    for path in paths:
        remove(spark, path)
    gc.collect()
    spark._jvm.System.gc()


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The paths of intermediate tables that are made within; an outer scope knows them as well."""
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield made
    finally:
        _SCOPES.pop()
        if _SCOPES:
            _SCOPES[-1].extend(made)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Frames that are written within send rows to Python workers about ``BATCH_BYTES`` at a time.

    Else a batch has as many rows as Spark's settings allow, however long their texts are, and the executor and the worker each
    hold such batches. If the session has a setting of its own, it stays. Work on batches must not depend on where they end.
    """
    if spark.conf.get(BATCH_SETTING, None) is not None:
        yield
        return
    spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(BATCH_SETTING)
