"""Structured Streaming jobs over landing call-record files.

* :func:`total_stream` — running outgoing-call total per subscriber key over a
  watermarked view, complete output mode, a new version of the whole result published
  each trigger; with ``output="update"`` only the totals that changed leave the state, and
  only the hash buckets they fall into are rewritten; or, with ``output="partials"``, stateless
  per-batch counts that readers sum (:func:`callsight.sources.tables.read_totals`).
* :func:`hourly_stream` — ``foreachBatch`` fan-out: each micro-batch writes its hourly
  partial counts and its partial subscriber profiles. Both writes are replay-safe
  (dynamic overwrite of partitions tagged with the batch id), so a batch re-run after a
  failure replaces its own output; readers sum / merge partials
  (:func:`callsight.operators.calls.daily_totals`, ``merge_profiles``).

* :func:`hourly_window_stream` — the same hourly counts from an event-time window with a
  watermark that closes hours: each is written once, when no more rows can change it, its
  state is freed, and later rows are dropped.

* :func:`files_stream` — names of the files processed so far, distinct within each
  micro-batch and, by :func:`callsight.sources.tables.read_files`, over all of them.

Filters and projections stand before ``writeStream``: what a ``foreachBatch`` callback
does to its batch is hidden from the scan, which would then read every column and row.

All return the started :class:`StreamingQuery`; waiting on it is the caller's choice.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from callsight.operators.calls import (
    distinct_files,
    hourly_counts,
    is_moc,
    outgoing,
    profile_partials,
    total_by_subscriber,
    total_moc_of_view,
)
from callsight.sinks import overwrite, write_batch
from callsight.sources.tables import register_view
from callsight.streaming.snapshots import BUCKETS, replace_totals

EVENT_TIME = "xdr_start_datetime"


def _start(writer, checkpoint: str, trigger: dict | None, name: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    if name:
        writer = writer.queryName(name)
    return writer.start()


def total_stream(
    source: DataFrame,
    sink_path: str | None,
    checkpoint: str,
    key: str = "served_imsi",
    view: str = "xdr_data",
    watermark: str = "24 hours",
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    trigger: dict | None = None,
    name: str | None = None,
    output: str = "complete",
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Running MOC count per ``key`` (default IMSI).

    ``output="complete"``: the watermarked view's counts, the whole result published
    every trigger (:func:`callsight.sinks.read_published`). The watermark is declared on the event time as the feed defines
    it; because the grouping key is not event time, it neither drops late rows nor
    frees state: the state store holds one count per subscriber, and each trigger
    rewrites all of them.

    ``output="update"``: the same state, but a trigger hands on only the totals that it
    changed, and the table at ``sink_path`` (Parquet, in ``buckets`` hash buckets) gets new files
    for their buckets alone; read it with ``read_changed_totals``. Work per trigger follows
    the buckets touched. A replayed batch puts the same totals in place again.

    ``output="partials"``: no state at all. Each micro-batch writes its own counts per
    key, tagged with the batch id (a replay replaces them); ``read_totals`` sums
    them. Work per trigger is proportional to the batch, not to all subscribers.
    """
    if output == "partials":

        def write_counts(batch: DataFrame, batch_id: int) -> None:
            write_batch(total_by_subscriber(batch, key), sink_path, batch_id, fmt=fmt, options=options, keys=["msisdn"])

        writer = source.filter(is_moc()).select("xdr_type", key).writeStream.outputMode("update").foreachBatch(write_counts)
        return _start(writer, checkpoint, trigger, name)
    if output not in ("complete", "update"):
        raise ValueError(f"output must be 'complete', 'update' or 'partials', not {output!r}")
    spark = source.sparkSession
    register_view(source.withWatermark(EVENT_TIME, watermark), view)
    counts = total_moc_of_view(spark, view=view, key=key)
    if output == "update":
        if sink_path is None or fmt != "parquet":
            raise ValueError("changed buckets are published as Parquet, to a path")

        def replace_changed(batch: DataFrame, batch_id: int) -> None:
            replace_totals(batch, sink_path, buckets)

        return _start(counts.writeStream.outputMode("update").foreachBatch(replace_changed), checkpoint, trigger, name)

    def replace_all(batch: DataFrame, batch_id: int) -> None:
        overwrite(batch, sink_path, fmt=fmt, options=options)

    writer = counts.writeStream.outputMode("complete").foreachBatch(replace_all)
    return _start(writer, checkpoint, trigger, name)


def hourly_rows(cdr: DataFrame, key: str = "served_phone_number") -> DataFrame:
    """What both outputs of the hourly job need of the outgoing calls."""
    return outgoing(cdr, key=key).select("event_date", "event_hour", "msisdn", "event_ts", "served_imsi", "served_imei")


def write_hourly_batch(
    moc: DataFrame,
    batch_id: int,
    hourly_path: str,
    profile_path: str | None,
    fmt: str = "parquet",
    profile_fmt: str | None = None,
    profile_options: dict[str, str] | None = None,
) -> bool:
    """Write the hourly counts and profile partials of one micro-batch of
    :func:`hourly_rows`; skip it if it is empty. Returns whether anything was written."""
    # Two outputs read the batch: keep it instead of re-scanning.
    moc = moc.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if moc.isEmpty():
            return False
        write_batch(hourly_counts(moc), hourly_path, batch_id, partition_by=["event_date"], fmt=fmt)
        if profile_path is not None or profile_options:
            write_batch(
                profile_partials(moc),
                profile_path,
                batch_id,
                fmt=profile_fmt or fmt,
                options=profile_options,
                keys=["msisdn"],
            )
        return True
    finally:
        moc.unpersist()


def process_hourly_batch(batch: DataFrame, batch_id: int, hourly_path: str, profile_path: str | None, key: str = "served_phone_number", **how) -> bool:
    """:func:`write_hourly_batch` of raw call records."""
    return write_hourly_batch(hourly_rows(batch, key), batch_id, hourly_path, profile_path, **how)


def hourly_stream(
    source: DataFrame,
    hourly_path: str,
    profile_path: str | None,
    checkpoint: str,
    fmt: str = "parquet",
    key: str = "served_phone_number",
    profile_fmt: str | None = None,
    profile_options: dict[str, str] | None = None,
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Hourly MOC partials and subscriber-profile partials, one write of each per
    micro-batch (stateless stream, update mode)."""

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        write_hourly_batch(batch, batch_id, hourly_path, profile_path, fmt, profile_fmt, profile_options)

    writer = hourly_rows(source, key).writeStream.outputMode("update").foreachBatch(each_batch)
    return _start(writer, checkpoint, trigger, name)


def hourly_windows(source: DataFrame, delay: str = "24 hours", key: str = "served_phone_number", offset: str | None = None) -> DataFrame:
    """Outgoing calls per hour of event time and subscriber, as a streaming aggregate whose
    hours close ``delay`` after the latest event time seen. Hours begin at full hours UTC;
    ``offset`` moves them, for time zones that differ by parts of an hour."""
    moc = outgoing(source, key=key).select("event_ts", "msisdn").withWatermark("event_ts", delay)
    hour = F.window("event_ts", "1 hour", startTime=offset) if offset else F.window("event_ts", "1 hour")
    counts = moc.groupBy(hour, "msisdn").agg(F.count(F.lit(1)).alias("outgoing_calls_count"))
    return counts.select(F.to_date("window.start").alias("event_date"), F.col("window.start").alias("event_hour"), "msisdn", "outgoing_calls_count")


def hourly_window_stream(
    source: DataFrame,
    hourly_path: str,
    checkpoint: str,
    delay: str = "24 hours",
    key: str = "served_phone_number",
    offset: str | None = None,
    fmt: str = "parquet",
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Final hourly counts, in append mode: an hour is written in the first batch after the
    watermark (latest event time less ``delay``) has passed its end, one row per number, and
    its state is freed; the state holds the hours that are still open. A row for an hour that
    is already closed is dropped (``numRowsDroppedByWatermark`` in the query's progress);
    between two triggers the watermark stands still, so a row may still be taken in the batch
    right after the one that moved it. The table is laid out like that of
    :func:`hourly_stream` and read by ``read_hourly``; a replayed batch replaces its rows."""

    def write_closed(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, hourly_path, batch_id, partition_by=["event_date"], fmt=fmt, keys=["event_hour", "msisdn"])

    writer = hourly_windows(source, delay, key, offset).writeStream.outputMode("append").foreachBatch(write_closed)
    return _start(writer, checkpoint, trigger, name)


def files_stream(
    source: DataFrame,
    sink_path: str,
    checkpoint: str,
    column: str = "filename",
    fmt: str = "parquet",
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Distinct processed file names per micro-batch (stateless, replay-safe). A file is
    read in one batch, so few names repeat between batches;
    :func:`callsight.sources.tables.read_files` gives each name once."""

    def write_new(batch: DataFrame, batch_id: int) -> None:
        write_batch(distinct_files(batch, column), sink_path, batch_id, fmt=fmt, keys=[column])

    writer = source.select(column).writeStream.outputMode("update").foreachBatch(write_new)
    return _start(writer, checkpoint, trigger, name)
