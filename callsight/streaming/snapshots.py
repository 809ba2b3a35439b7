"""Folding stored partials (hourly counts, running totals, profiles) into one row per key.

The streams append one set of partials per micro-batch, so merging them on every read
costs work proportional to history. A periodic job folds them: readers then take the
newest committed fold plus only the partials after it (``batch_id`` partition pruning).

A fold is a table in parts (:mod:`callsight.sinks.manifest`): a day of hourly counts, or a
hash bucket of numbers. Folding writes only the parts that the new partials touch, merged
with what the fold before has for them, and opens only those; its marker is numbered by
the last batch folded. What a crashed fold leaves behind, half-written or not, is therefore
never read, never blocks or enters the next fold, and costs space alone.

Readers take whole batches: named a stream's ``checkpoint``, or a batch with ``upto``, they
leave out what lies beyond, such as a batch that is being written or of which one output
is there and the other isn't.

One job folds a table at a time. Folds are Parquet; the partials may be any format.
:func:`expire_folds` and :func:`expire_partials` remove what no reader needs any more;
nothing else here deletes data.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsight.operators.calls import merge_profiles
from callsight.schemas import HOURLY_SCHEMA, PROFILE_PARTIAL_SCHEMA
from callsight.session import matching, materialize, remove, scratch
from callsight.sinks.manifest import Manifest, PartedTable
from callsight.sinks.markers import is_missing, largest_number
from callsight.sources.tables import BATCH_ID, read_table

TOTALS_SCHEMA = T.StructType([T.StructField("msisdn", T.StringType()), T.StructField("moc_count", T.LongType())])
BUCKETS = 64


def _sum_of(value: str, *keys: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.groupBy(*keys).agg(F.sum(value).cast("bigint").alias(value))


@dataclass(frozen=True)
class Partials:
    """A table of partial results: ``merge`` brings any number of them to one row per
    key; ``part`` is the column a fold is divided by, ``part_of`` its value where it is
    not a column of the table."""

    schema: T.StructType
    merge: Callable[[DataFrame], DataFrame]
    part: T.StructField
    part_of: Callable[[], Column] | None = None

    def table(self, spark: SparkSession, path: str) -> PartedTable:
        return PartedTable(spark, path, self.schema, self.part)

    def with_part(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.part.name, self.part_of()) if self.part_of else df


def _bucket() -> Column:
    return F.pmod(F.xxhash64("msisdn"), F.lit(BUCKETS)).cast("int")


_BUCKET = T.StructField("bucket", T.IntegerType())
HOURLY = Partials(HOURLY_SCHEMA, _sum_of("outgoing_calls_count", "event_date", "event_hour", "msisdn"), T.StructField("event_date", T.DateType()))
TOTALS = Partials(TOTALS_SCHEMA, _sum_of("moc_count", "msisdn"), _BUCKET, _bucket)
PROFILES = Partials(PROFILE_PARTIAL_SCHEMA, merge_profiles, _BUCKET, _bucket)


def committed_batch(spark: SparkSession, checkpoint: str) -> int | None:
    """The last batch a stream has committed, from the file names in its checkpoint."""
    return largest_number(spark, f"{checkpoint.rstrip('/')}/commits", r"/commits/([0-9]+)$", "[0-9]*")


def read_partials(
    spark: SparkSession, spec: Partials, path: str | None, fmt: str = "parquet", options: dict[str, str] | None = None
) -> DataFrame:
    """Stored partials; formats with a schema of their own are read with that."""
    schema = T.StructType(list(spec.schema.fields) + [BATCH_ID]) if fmt != "delta" else None
    return read_table(spark, path, fmt, schema=schema, options=options)


def committed_fold(spark: SparkSession, spec: Partials, folded_path: str) -> tuple[DataFrame | None, int | None]:
    """The rows of the newest committed fold (``schema`` and ``part``), and the last
    batch in it; (None, None) if no fold was ever committed there."""
    fold = spec.table(spark, folded_path)
    done = fold.manifest()
    return (None, None) if done is None else (fold.read(done), done.n)


def last_whole_batch(spark: SparkSession, upto: int | None = None, checkpoint: str | None = None) -> int | None:
    """The last batch a reader may take: ``upto``, or the last one that the stream with this
    ``checkpoint`` has committed, with all its outputs (-1 if none yet); None: no bound."""
    if upto is not None or checkpoint is None:
        return upto
    last = committed_batch(spark, checkpoint)
    return -1 if last is None else last


def current_partials(
    spark: SparkSession,
    spec: Partials,
    parts_path: str | None,
    folded_path: str | None = None,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    missing_ok: bool = False,
    upto: int | None = None,
    checkpoint: str | None = None,
) -> DataFrame:
    """Partials still to merge: the newest committed fold plus later ones, up to the batch
    that :func:`last_whole_batch` names (a fold, made of committed batches, is taken whole). A
    ``folded_path`` without any committed fold is an error, since partials that were
    folded may be gone; ``missing_ok`` says that nothing has been folded yet."""
    last = last_whole_batch(spark, upto, checkpoint)
    parts = read_partials(spark, spec, parts_path, fmt, options)
    if last is not None:
        parts = parts.filter(F.col("batch_id") <= F.lit(last))
    if folded_path is None:
        return parts
    folded, done = committed_fold(spark, spec, folded_path)
    if folded is None:
        if missing_ok:
            return parts
        raise FileNotFoundError(f"no committed fold at {folded_path}")
    folded = folded.select(*spec.schema.fieldNames(), F.lit(done).cast("bigint").alias("batch_id"))
    return folded.unionByName(parts.select(*spec.schema.fieldNames(), "batch_id").filter(F.col("batch_id") > F.lit(done)))


def compact_partials(
    spark: SparkSession,
    spec: Partials,
    parts_path: str,
    folded_path: str,
    upto: int | None = None,
    checkpoint: str | None = None,
    fmt: str = "parquet",
    first: bool = False,
) -> int | None:
    """Fold the partials up to batch ``upto``, by default the last one that the stream
    with this ``checkpoint`` has committed, and return the batch the newest fold covers
    (None when there is nothing to fold). ``first`` says that there is no fold yet; if
    none is found without it, that is an error."""
    if upto is None:
        if checkpoint is None:
            raise ValueError("name the last batch to fold, or the stream's checkpoint")
        upto = committed_batch(spark, checkpoint)
        if upto is None:
            return None
    fold = spec.table(spark, folded_path)
    before = fold.manifest()
    if before is None and not first:
        raise FileNotFoundError(f"no committed fold at {folded_path}; the first fold has to be asked for")
    if before is not None and before.n >= upto:
        return before.n
    try:
        parts = read_partials(spark, spec, parts_path, fmt)
    except AnalysisException as e:
        if first and before is None and is_missing(e):  # the stream has not written yet
            return None
        raise
    new = spec.with_part(parts.filter((F.col("batch_id") <= F.lit(upto)) & (F.col("batch_id") > F.lit(-1 if before is None else before.n))))
    part = spec.part.name
    columns = [*spec.schema.fieldNames(), *([part] if spec.part_of else [])]
    with scratch(spark, "fold"):
        touched = materialize(new.select(F.col(part)).distinct(), "touched")
        new = new.select(*columns)
        if before is not None:
            new = new.unionByName(fold.read(before, only=touched).select(*columns))
        fold.replace(spec.with_part(spec.merge(new)), touched, before, int(upto))
    return int(upto)


def expire_folds(spark: SparkSession, spec: Partials, folded_path: str, keep: int = 2) -> int:
    """Remove all folds but the newest ``keep``: their markers, and the parts that none of
    the kept folds holds. Returns how many part folders went."""
    return spec.table(spark, folded_path).expire(keep)


def expire_partials(spark: SparkSession, spec: Partials, parts_path: str, folded_path: str, upto: int) -> int:
    """Remove the files of batches up to ``upto``, which the newest fold has to cover; for
    readers under way take the last batch of the fold before it. Returns how many batch folders
    went."""
    done = spec.table(spark, folded_path).manifest()
    if done is None or done.n < upto:
        raise ValueError(f"batches up to {upto} are not folded at {folded_path}")
    between = "" if spec.part_of else f"/{spec.part.name}=*"
    gone = [p for p in matching(spark, f"{parts_path.rstrip('/')}{between}/batch_id=*") if int(re.search(r"/batch_id=([0-9]+)$", p).group(1)) <= upto]
    for path in gone:
        remove(spark, path)
    return len(gone)


def changed_totals(spark: SparkSession, path: str, buckets: int = BUCKETS) -> PartedTable:
    """The table that ``total_stream(output="update")`` keeps: current totals in hash
    buckets, whose number is fixed when the table is made."""
    return PartedTable(spark, path, TOTALS_SCHEMA, T.StructField(f"bucket_of_{buckets}", T.IntegerType()))


def replace_totals(changed: DataFrame, path: str, buckets: int = BUCKETS, keep: int = 2) -> int | None:
    """Put the ``changed`` totals (one row per number, with its whole total) in place of those
    before, rewriting only the buckets they fall into. A second time with the same rows changes
    nothing. Returns the number of buckets written; None, and no new version, for no rows."""
    spark = changed.sparkSession
    table = changed_totals(spark, path, buckets)
    name = table.part.name
    bucket = F.pmod(F.xxhash64("msisdn"), F.lit(buckets)).cast("int").alias(name)
    with scratch(spark, "totals"):
        changed = materialize(changed.select("msisdn", F.col("moc_count").cast("bigint").alias("moc_count"), bucket), "changed")
        touched = materialize(changed.select(name).distinct(), "touched")
        n_touched = touched.count()
        if not n_touched:
            return None
        before = table.manifest()
        rows = changed
        if before is not None:
            same = F.col("msisdn").eqNullSafe(F.col("__msisdn"))
            others = table.read(before, only=touched).join(changed.select(F.col("msisdn").alias("__msisdn")), same, "left_anti")
            rows = rows.unionByName(others.select(*rows.columns))
        table.replace(rows, touched, before)
    table.expire(keep)
    return n_touched


def read_changed_totals(spark: SparkSession, path: str, buckets: int = BUCKETS) -> DataFrame:
    """Running MOC totals from ``total_stream(output="update")``: the newest version."""
    table = changed_totals(spark, path, buckets)
    now: Manifest | None = table.manifest()
    if now is None:
        raise FileNotFoundError(f"no totals have been published at {path}")
    return table.read(now).select(*TOTALS_SCHEMA.fieldNames())


def current_hourly(spark: SparkSession, hourly_path: str, folded_path: str | None = None, fmt: str = "parquet", missing_ok: bool = False, **bound) -> DataFrame:
    """Hourly partial counts to sum (same columns as ``read_hourly``; ``daily_totals``
    date bounds prune both the fold and the partials). ``bound``: ``upto`` or ``checkpoint``."""
    return current_partials(spark, HOURLY, hourly_path, folded_path, fmt, missing_ok=missing_ok, **bound)


def compact_hourly(spark: SparkSession, hourly_path: str, folded_path: str, **how) -> int | None:
    return compact_partials(spark, HOURLY, hourly_path, folded_path, **how)


def current_totals(spark: SparkSession, totals_path: str, folded_path: str | None = None, fmt: str = "parquet", missing_ok: bool = False, **bound) -> DataFrame:
    """Running MOC totals from ``total_stream(output="partials")``: newest committed
    fold plus later per-batch counts, summed per subscriber."""
    return TOTALS.merge(current_partials(spark, TOTALS, totals_path, folded_path, fmt, missing_ok=missing_ok, **bound))


def compact_totals(spark: SparkSession, totals_path: str, folded_path: str, **how) -> int | None:
    return compact_partials(spark, TOTALS, totals_path, folded_path, **how)


def current_profile_partials(
    spark: SparkSession,
    partials_path: str | None,
    snapshot_path: str | None = None,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    missing_ok: bool = False,
    **bound,
) -> DataFrame:
    """Everything needed to build current profiles: the newest committed snapshot plus
    the partials written after it. Feed to ``merge_profiles`` or ``detections``. With
    ``partials_path=None`` the ``options`` name the store, as for ``read_table``."""
    return current_partials(spark, PROFILES, partials_path, snapshot_path, fmt, options, missing_ok, **bound)


def compact_profiles(spark: SparkSession, partials_path: str, snapshot_path: str, **how) -> int | None:
    return compact_partials(spark, PROFILES, partials_path, snapshot_path, **how)
