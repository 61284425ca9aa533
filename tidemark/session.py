"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on.  Skewed join keys are split by AQE.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
# Only possible before the session starts: no call-site capture per column
# expression, which makes wide plans slow to build.
START_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(app_name: str = "tidemark", master: str | None = None,
                  shuffle_partitions: int | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for name, value in {**START_SETTINGS, **RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for name, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(name, None) != value and spark.conf.isModifiable(name):
            spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Where that is unset, a folder in the warehouse is named, which executors
    share as well; a temporary folder of one machine would be lost with it.
    """
    configured = (spark.conf.get("spark.checkpoint.dir", None)
                  or spark.sparkContext.getConf().get("spark.checkpoint.dir", None))
    if not configured:
        configured = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured.rstrip("/")


_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("scratch_scopes", default=())
_SCRATCH = re.compile(r".+-[0-9a-f]{32}")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder path of the shared folder; never reused between runs."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    for made in _SCOPES.get():
        made.append(path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Remove, when the block is left, the scratch folders made inside it; gives their paths.

    Lazy results made inside read those folders, so write or collect them before the block ends.
    Folders made by other threads are not touched.
    """
    made: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), made))
    try:
        yield made
    finally:
        _SCOPES.reset(token)
        for path in made:
            _remove(spark, path)


def sweep_scratch(spark: SparkSession, older_than_hours: float) -> list[str]:
    """Remove scratch folders last changed that long ago, left by drivers that died; returns their names.

    No job that still reads one may be running.  Folders that :func:`scratch_path` did not name stay.
    """
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    oldest = (time.time() - older_than_hours * 3600) * 1000
    old = [s.getPath() for s in (fs.listStatus(root) if fs.exists(root) else [])
           if s.isDirectory() and s.getModificationTime() <= oldest and _SCRATCH.fullmatch(s.getPath().getName())]
    for path in old:
        fs.delete(path, True)
    return sorted(p.getName() for p in old)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: its rows are now fixed.

    Losing executors cannot change or lose them, unlike a cached frame whose
    lineage has parts that depend on the order of rows.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.parquet(path)
    out.stored_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete stored frames that no later step reads; others are left alone."""
    for df in frames:
        path = getattr(df, "stored_at", None)
        if path:
            _remove(df.sparkSession, path)
