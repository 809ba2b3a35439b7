"""Writers. The ones the streams use are safe to run again with the same input: file
outputs use dynamic partition overwrite on the partitions they own, so a retried job
or a replayed micro-batch replaces its own rows instead of adding them twice.
``append_summary`` appends by default, as the reports always did; with
``replace_dates`` a rerun replaces its days instead."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsight.session import remove
from callsight.sinks.markers import claim, content, expire, mark, newest

FILE_FORMATS = {"parquet", "orc", "json", "csv", "avro", "delta"}
VERSION = T.StructType([T.StructField("folder", T.StringType())])


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    fmt: str = "parquet",
    replace: bool = True,
    rebalance_by: Sequence[str] | None = None,
) -> None:
    """Write partitioned by ``partition_by``. With ``replace`` only the partitions
    present in ``df`` are overwritten (dynamic overwrite); otherwise rows are added.

    Rows are first rebalanced on ``rebalance_by`` (default: the partition columns), so
    each output partition is written by few tasks (not one small file per task per
    partition), while AQE still splits a partition that holds a large share of the
    rows. Columns that are constant in ``df`` should be left out of ``rebalance_by``.
    """
    layout = list(partition_by if rebalance_by is None else rebalance_by)
    if layout:
        df = df.hint("rebalance", *layout)
    w = df.write.format(fmt).partitionBy(*partition_by)
    if replace:
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        w = w.mode("append")
    w.save(path)


def document_id(batch_id: int, keys: Sequence[str]) -> Column:
    """The identity of a batch's row in a document store: the batch, and a hash of the
    row's ``keys`` by name and value (so a null is no empty text, and keys can't run into
    each other). The same row of the same batch always gets the same one."""
    key = F.to_json(F.struct(*keys), {"ignoreNullFields": "true"})
    return F.concat(F.lit(f"{int(batch_id)}-"), F.md5(key))


def write_batch(
    df: DataFrame,
    path: str | None,
    batch_id: int,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    keys: Sequence[str] = (),
) -> None:
    """Replay-safe append of one micro-batch's output, tagged with ``batch_id``.

    Files: partitioned by ``(*partition_by, batch_id)`` with dynamic overwrite, so a
    replay replaces exactly what the first attempt wrote. Other formats (document
    stores) are appended through the connector with ``options``. ``keys``, one row's in the
    batch, give each document an ``_id`` (:func:`document_id`): a store that replaces
    documents of the same ``_id``, as document stores do, has the same documents after a
    replay as before.
    """
    out = df.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
    if fmt in FILE_FORMATS:
        # batch_id is one value per call: lay files out by the other columns only
        write_partitioned(out, path, [*partition_by, "batch_id"], fmt=fmt, replace=True, rebalance_by=partition_by)
        return
    if keys:
        out = out.withColumn("_id", document_id(batch_id, keys))
    w = out.write.format(fmt).mode("append")
    if options:
        w = w.options(**options)
    w.save() if path is None else w.save(path)


def _versions(path: str) -> str:
    return f"{path.rstrip('/')}_versions"


def publish(df: DataFrame, path: str, fmt: str = "parquet", options: dict[str, str] | None = None, keep: int = 2) -> None:
    """Replace the table published at ``path`` without a moment at which it is missing or
    in part: ``df`` is written to a fresh version folder below ``path``, then a marker
    names that folder. Read it with :func:`read_published`. The newest ``keep`` versions and
    their markers stay, for readers that are under way; older ones go. Of writers at the
    same time each has a number of its own, and the largest counts."""
    spark = df.sparkSession
    n = claim(spark, _versions(path))
    folder = f"version={n}-{uuid.uuid4().hex[:12]}"
    df.write.format(fmt).options(**(options or {})).save(f"{path.rstrip('/')}/{folder}")
    mark(spark.range(1).select(F.lit(folder).alias("folder")), _versions(path), n)

    def drop(gone: list[int], kept: list[int]) -> None:
        for old in gone:
            try:
                named = content(spark, _versions(path), old, VERSION).first()
            except FileNotFoundError:  # another writer is removing it
                continue
            remove(spark, f"{path.rstrip('/')}/{named['folder']}")

    expire(spark, _versions(path), keep, drop)


def read_published(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """The newest version of a published table."""
    n = newest(spark, _versions(path))
    if n is None:
        raise FileNotFoundError(f"nothing has been published at {path}")
    folder = content(spark, _versions(path), n, VERSION).first()["folder"]
    reader = spark.read.format(fmt) if schema is None else spark.read.format(fmt).schema(schema)
    return reader.load(f"{path.rstrip('/')}/{folder}")


def overwrite(df: DataFrame, path: str | None, fmt: str = "parquet", options: dict[str, str] | None = None) -> None:
    """Replace the whole target with ``df``: plain files are published as a new version,
    formats that replace in one transaction, or stores named by options, are overwritten."""
    if path is not None and fmt in FILE_FORMATS - {"delta"}:
        publish(df, path, fmt, options)
        return
    w = df.write.format(fmt).mode("overwrite")
    if options:
        w = w.options(**options)
    w.save() if path is None else w.save(path)


def write_if_any(df: DataFrame, write: Callable[[DataFrame], None]) -> bool:
    """Run ``write(df)`` only when ``df`` has a row (a limit-1 probe); report it."""
    if df.isEmpty():
        return False
    write(df)
    return True


def append_summary(df: DataFrame, path: str, fmt: str = "parquet", replace_dates: bool = False) -> None:
    """Add a fee summary to a table partitioned by ``date``. With ``replace_dates`` the
    days in ``df`` replace what was there, so a rerun of a day does not double it. Rows
    are rebalanced by day: as many tasks as their size needs, one for a short summary."""
    write_partitioned(df, path, ["date"], fmt=fmt, replace=replace_dates)
