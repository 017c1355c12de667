"""Session settings and the shared folder that long plans write to."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock = threading.Lock()
_held: dict[str, list] = {}


def build_session(app: str = "varspark", master: str | None = None, **conf: str) -> SparkSession:
    """Session for tests and benches; a cluster brings its own."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Where it is unset, a folder below the warehouse serves, which Spark's
    writers share as well.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    warehouse = jvm.org.apache.hadoop.fs.Path(spark.conf.get("spark.sql.warehouse.dir"))
    return warehouse.getFileSystem(hadoop).makeQualified(warehouse).toString().rstrip("/") + "/_stages"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``scratch_path`` named."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def stored(df: DataFrame, name: str = "stage") -> DataFrame:
    """The rows as a table in the shared folder, which outlives any executor.

    Unlike a checkpoint of rows it keeps columns apart, so later steps read
    only what they use, and its size tells Spark whether it may be broadcast.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def held(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Within it a setting of the session has this value. The session's own is back afterwards, also if several threads are within."""
    with _lock:
        within = _held.setdefault(key, [0, None])
        if not within[0]:
            within[1] = spark.conf.get(key, None)
            spark.conf.set(key, value)
        within[0] += 1
    try:
        yield
    finally:
        with _lock:
            within[0] -= 1
            if not within[0]:
                spark.conf.unset(key) if within[1] is None else spark.conf.set(key, within[1])


def shuffles_removed(spark: SparkSession):
    """Queries that run within it lose their shuffle files when they end, not only when the driver collects its garbage.

    For writes of tables, whose shuffles nothing reads again.
    """
    return held(spark, _CLEANUP, "true")
