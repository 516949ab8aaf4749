"""Session settings and the shared folder that cuts lineage."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def get_session(app: str = "reelspark", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """A session with the engine's defaults; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (DEFAULT_CONF | (conf or {})).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Where that is unset a local master gets a temporary folder of its own (tests); any other master is an error, for each
    executor would write to its own disk and the driver read an incomplete set. A path without a scheme is taken as it is
    set: it may be a mounted file system.
    """
    sc = spark.sparkContext
    where = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if where:
        return where
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: intermediate results need a folder that all executors share")
    where = "file://" + tempfile.mkdtemp(prefix="reelspark-")
    atexit.register(shutil.rmtree, where.removeprefix("file://"), ignore_errors=True)
    sc.setCheckpointDir(where)
    return where


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session is already gone
        pass


_written: list[tuple[str, str]] = []


def materialize(df: DataFrame, name: str = "part") -> DataFrame:
    """Write ``df`` once as compressed Parquet in the shared folder and read it back.

    Cuts the lineage like ``checkpoint()`` but columnar, so later steps prune columns, and an executor's loss never
    repeats the work before it. The files are removed when the driver ends, or by :func:`release` once their readers are done.
    """
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), "reelspark", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    _written.append((spark.sparkContext.applicationId, path))
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Removes what :func:`materialize` has written for this session so far; for callers whose results are stored. Returns how many parts."""
    mine = [p for app, p in _written if app == spark.sparkContext.applicationId]
    for path in mine:
        _remove(spark, path)
    _written[:] = [w for w in _written if w[1] not in set(mine)]
    return len(mine)
