"""Session helpers: a local session for tests and benches, and the shared folder used
for checkpoints and intermediate tables.

The library never changes the configuration of a session it is handed. It reads the
shared folder from ``spark.checkpoint.dir``; only for a local master with nothing
configured (tests, benches) does it make a temporary one. A machine-local folder would
not survive executor loss, so on a cluster a missing setting is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def local_session(
    cores: str | int = "*",
    shuffle_partitions: int = 8,
    app_name: str = "callsight",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A ``local[cores]`` session configured the way tests and benches expect."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or an already-set checkpoint dir).
    Only when nothing is set and the master is local is a temporary folder created.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext, only the session's configuration
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
        if not conf_dir:
            raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder") from None
        return conf_dir.rstrip("/")
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder (HDFS/S3/...) "
            "that all executors and the driver can reach"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="callsight-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


_scratch: ContextVar[str | None] = ContextVar("callsight-scratch", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder name under the shared folder, or inside :func:`scratch`
    under its folder."""
    return f"{_scratch.get() or shared_dir(spark) + '/work'}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch(spark: SparkSession, name: str = "run") -> Iterator[str]:
    """Gathers the intermediate tables that operators write inside the block below one
    folder, and removes it when the block is left::

        with scratch(spark):
            operator(df).write.parquet(out)

    Results have to be written before that: a frame that reads intermediates can't be
    read any more."""
    folder = scratch_path(spark, name)
    token = _scratch.set(folder)
    try:
        yield folder
    finally:
        _scratch.reset(token)
        remove(spark, folder)


def materialize(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet under the shared folder (or to ``path``) and read it
    back.

    Cuts the lineage (a lost executor re-reads files instead of recomputing the
    plan), computes the input exactly once, and gives the optimizer the real size.
    """
    path = path or scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _located(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder the library itself has written, in whatever store it is."""
    target, store = _located(spark, path)
    store.delete(target, True)


def create_new(spark: SparkSession, path: str) -> bool:
    """Make an empty file, unless there is one: of several callers one gets True (as far
    as the store creates files atomically, as HDFS does)."""
    target, store = _located(spark, path)
    try:
        store.create(target, False).close()
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    return True


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths of files and folders that match a glob pattern; none if nothing does."""
    target, store = _located(spark, pattern)
    found = store.globStatus(target)
    return [] if found is None else [f.getPath().toString() for f in found]


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the session's Python workers (once a session), as
    ``spark-submit --py-files`` does, for operators that run Arrow functions."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    if not os.path.isdir(root):  # already running from a shipped archive
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="callsight-pkg-"), "callsight.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)
