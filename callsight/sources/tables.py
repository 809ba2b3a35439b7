"""Readers for the feeds and the stored intermediate tables.

The format is an argument everywhere: Parquet is the default and what the tests use;
``delta`` or a document store (``mongodb``) work the same way when their connector is
on the classpath.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsight.schemas import CDR_SCHEMA, HOURLY_SCHEMA, PROFILE_PARTIAL_SCHEMA, TRANSFER_SCHEMA, TRANSFER_TEXT_SCHEMA
from callsight.sinks import read_published

BATCH_ID = T.StructField("batch_id", T.LongType(), True)


def read_table(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Batch read of a folder/table; with ``path=None`` the options name the source
    (e.g. ``{"database": ..., "collection": ...}`` for a document store)."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if options:
        reader = reader.options(**options)
    return reader.load(path) if path is not None else reader.load()


def read_collection(spark: SparkSession, database: str, collection: str, fmt: str = "mongodb") -> DataFrame:
    return read_table(spark, None, fmt, options={"database": database, "collection": collection})


def read_cdr_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = CDR_SCHEMA,
    max_files_per_trigger: int = 1000,
    fmt: str = "parquet",
) -> DataFrame:
    """Streaming read of call-record files as they land, with a fixed schema and at
    most ``max_files_per_trigger`` new files per micro-batch."""
    return (
        spark.readStream.format(fmt)
        .schema(schema)
        .option("maxFilesPerTrigger", int(max_files_per_trigger))
        .load(path)
    )


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Expose a (batch or streaming) frame to SQL under ``name``."""
    df.createOrReplaceTempView(name)
    return df


def read_hourly(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The hourly partial-count table written by the hourly stream (partitioned by
    event_date and batch_id, so date filters prune folders)."""
    schema = T.StructType(list(HOURLY_SCHEMA.fields) + [BATCH_ID])
    return read_table(spark, path, fmt, schema=schema if fmt != "delta" else None)


def read_profile_partials(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Profile partials written per micro-batch; merge them with ``merge_profiles``."""
    schema = T.StructType(list(PROFILE_PARTIAL_SCHEMA.fields) + [BATCH_ID])
    return read_table(spark, path, fmt, schema=schema if fmt != "delta" else None)


def read_files(spark: SparkSession, path: str, column: str = "filename", fmt: str = "parquet") -> DataFrame:
    """File names written by ``files_stream``, each once."""
    return read_table(spark, path, fmt).select(column).distinct()


def read_transfers(spark: SparkSession, path: str, fmt: str = "parquet", codes: str = "int") -> DataFrame:
    """The transfer log with a fixed schema: ``codes`` says whether the feed stores its
    codes as numbers (``int``) or as ``text``. ``infer`` leaves the types to the files."""
    if codes == "infer":
        return read_table(spark, path, fmt)
    return read_table(spark, path, fmt, schema=TRANSFER_SCHEMA if codes == "int" else TRANSFER_TEXT_SCHEMA)


def read_totals(spark: SparkSession, path: str, fmt: str = "parquet", partials: bool = False) -> DataFrame:
    """Running MOC totals written by ``total_stream``: the newest published version, or
    with ``partials`` the per-batch counts, summed (partial aggregate before the shuffle,
    so hot keys are cheap)."""
    if not partials:
        return read_published(spark, path, fmt)
    df = read_table(spark, path, fmt)
    return df.groupBy("msisdn").agg(F.sum("moc_count").cast("bigint").alias("moc_count"))
