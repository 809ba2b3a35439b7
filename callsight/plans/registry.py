"""The driver-facing queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator group of the survey, and for each an independent DuckDB SQL oracle over the
generated tables.

Transfer queries run over the whole ship-date range except ``transfer_window``, whose
feature is the one-year window. Stream and sink queries really run their job (files
landed under the shared folder, ``availableNow`` trigger, three files per batch) and
return the re-read output, so they share the oracle of their batch twin.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsight.functions.time import epoch_ms
from callsight.operators import calls as C
from callsight.operators import fees as FE
from callsight.plans import fixtures as FX
from callsight.schemas import CDR_HOURLY_SCHEMA, TRANSFER_CODES, TRANSFER_PASSTHROUGH
from callsight.session import scratch_path
from callsight.sinks import append_summary, overwrite, read_published, write_if_any
from callsight.sources.tables import (
    read_cdr_stream,
    read_files,
    read_hourly,
    read_profile_partials,
    read_table,
    read_totals,
    read_transfers,
    register_view,
)
from callsight.streaming.jobs import files_stream, hourly_stream, hourly_window_stream, total_stream
from callsight.streaming.snapshots import compact_hourly, compact_profiles, current_hourly, current_profile_partials, read_changed_totals

# Windows (UTC wall clock). "All" covers every generated ship date.
WINDOW = ("1997-01-01", "1998-01-01")
ALL = ("1970-01-01", "2100-01-01")
WINDOW_MS = (852076800000, 883612800000)
ALL_MS = (0, 4102444800000)
FILES_PER_BATCH = 3


# --------------------------------------------------------------------------- Spark
def _ms(spark, bounds):
    return epoch_ms(spark, bounds[0]), epoch_ms(spark, bounds[1])


def _valid(spark, d, bounds=ALL):
    return FE.valid_transfers(FX.transfers(spark, d), *_ms(spark, bounds))


def transfer_window(spark, d):
    return _valid(spark, d, WINDOW)


def transfer_labels(spark, d):
    return FE.label_transfers(_valid(spark, d))


def fee_classified(spark, d):
    return FE.classify_transfers(transfer_labels(spark, d))


def fee_summary(spark, d):
    return FE.fee_summary(FX.transfers(spark, d), *_ms(spark, ALL))


def fee_exceptions(spark, d):
    return FE.fee_exceptions(FX.transfers(spark, d), *_ms(spark, ALL))


def fee_summary_text_codes(spark, d):
    """The summary of a stored log whose codes are text, read with its fixed schema."""
    path = scratch_path(spark, "text-log")
    log = FX.transfers(spark, d)
    log.withColumns({c: F.col(c).cast("string") for c in TRANSFER_CODES}).write.parquet(path)
    return FE.fee_summary(read_transfers(spark, path, codes="text"), *_ms(spark, ALL))


def total_moc(spark, d):
    register_view(FX.cdr(spark, d), "xdr_data")
    return C.total_moc_of_view(spark, "xdr_data")


def _moc(spark, d):
    return C.outgoing(FX.cdr(spark, d))


def hourly_moc(spark, d):
    return C.hourly_counts(_moc(spark, d))


def subscriber_profile(spark, d):
    return C.subscriber_profile(_moc(spark, d))


def daily_totals(spark, d):
    return C.daily_totals(hourly_moc(spark, d))


def daily_enriched(spark, d):
    return C.enrich(daily_totals(spark, d), subscriber_profile(spark, d))


def top_caller_per_day(spark, d):
    return C.top_caller_per_day(daily_totals(spark, d))


def detections(spark, d):
    return C.detections(daily_totals(spark, d), C.profile_partials(_moc(spark, d)))


def distinct_files_cdr(spark, d):
    register_view(FX.cdr(spark, d), "xdr_data")
    return C.distinct_files_of_view(spark, "xdr_data")


def distinct_files_recharge(spark, d):
    register_view(FX.recharge(spark, d), "recharge_data")
    return C.distinct_files_of_view(spark, "recharge_data")


def _landed(spark, d, name, schema=None):
    base = scratch_path(spark, name)
    cols = None if schema is None else set(schema.fieldNames())
    FX.write_cdr_files(spark, d, f"{base}/in", columns=cols)
    return base


def stream_total_moc(spark, d):
    base = _landed(spark, d, "stream-total")
    src = read_cdr_stream(spark, f"{base}/in", max_files_per_trigger=FILES_PER_BATCH)
    q = total_stream(src, f"{base}/totals", f"{base}/ckpt", view="xdr_stream", trigger={"availableNow": True})
    q.awaitTermination()
    return read_totals(spark, f"{base}/totals")


def stream_total_partials(spark, d):
    base = _landed(spark, d, "stream-total-partials")
    src = read_cdr_stream(spark, f"{base}/in", max_files_per_trigger=FILES_PER_BATCH)
    q = total_stream(src, f"{base}/totals", f"{base}/ckpt", output="partials", trigger={"availableNow": True})
    q.awaitTermination()
    return read_totals(spark, f"{base}/totals", partials=True)


def stream_total_changed(spark, d):
    """Totals of which each trigger rewrites only the buckets that changed."""
    base = _landed(spark, d, "stream-total-changed")
    src = read_cdr_stream(spark, f"{base}/in", max_files_per_trigger=FILES_PER_BATCH)
    q = total_stream(src, f"{base}/totals", f"{base}/ckpt", view="xdr_changed", output="update", trigger={"availableNow": True})
    q.awaitTermination()
    return read_changed_totals(spark, f"{base}/totals")


def stream_hourly_windows(spark, d):
    """Hourly counts from event-time windows. The feed's files are in no order of time, so the
    delay covers all of it; a closing record long after the last call, in a file that lands
    later, then closes every hour before."""
    base = _landed(spark, d, "stream-windows", CDR_HOURLY_SCHEMA)
    delay = "20000 days"

    def run():
        src = read_cdr_stream(spark, f"{base}/in", schema=CDR_HOURLY_SCHEMA, max_files_per_trigger=FILES_PER_BATCH)
        hourly_window_stream(src, f"{base}/hourly", f"{base}/ckpt", delay=delay, trigger={"availableNow": True}).awaitTermination()

    run()
    closing = FX.cdr(spark, d, columns=set(CDR_HOURLY_SCHEMA.fieldNames()))
    latest = closing.agg(F.max("xdr_start_datetime").alias("t")).select((F.col("t") + F.expr("INTERVAL '20001' DAY")).alias("t"))
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in CDR_HOURLY_SCHEMA.fields if f.name not in ("xdr_type", "xdr_start_datetime", "filename")]
    closing = latest.select(F.lit(C.MOC).alias("xdr_type"), F.col("t").alias("xdr_start_datetime"), F.lit("closing").alias("filename"), *nulls)
    closing.write.mode("append").partitionBy("filename").parquet(f"{base}/in")
    run()
    return read_hourly(spark, f"{base}/hourly").drop("batch_id")


def stream_distinct_files(spark, d):
    base = _landed(spark, d, "stream-files")
    src = read_cdr_stream(spark, f"{base}/in", max_files_per_trigger=FILES_PER_BATCH)
    q = files_stream(src, f"{base}/files", f"{base}/ckpt", trigger={"availableNow": True})
    q.awaitTermination()
    return read_files(spark, f"{base}/files")


def _run_hourly(spark, d) -> str:
    base = _landed(spark, d, "stream-hourly", CDR_HOURLY_SCHEMA)
    src = read_cdr_stream(spark, f"{base}/in", schema=CDR_HOURLY_SCHEMA, max_files_per_trigger=FILES_PER_BATCH)
    q = hourly_stream(src, f"{base}/hourly", f"{base}/profile", f"{base}/ckpt", trigger={"availableNow": True})
    q.awaitTermination()
    return base


def stream_hourly_moc(spark, d):
    base = _run_hourly(spark, d)
    return (
        read_hourly(spark, f"{base}/hourly")
        .groupBy("event_date", "event_hour", "msisdn")
        .agg(F.sum("outgoing_calls_count").cast("bigint").alias("outgoing_calls_count"))
    )


def stream_hourly_compacted(spark, d):
    """Hourly counts after folding the first two micro-batches (committed fold plus the
    later partials)."""
    base = _run_hourly(spark, d)
    compact_hourly(spark, f"{base}/hourly", f"{base}/folded", upto=1, first=True)
    return (
        current_hourly(spark, f"{base}/hourly", f"{base}/folded", checkpoint=f"{base}/ckpt")
        .groupBy("event_date", "event_hour", "msisdn")
        .agg(F.sum("outgoing_calls_count").cast("bigint").alias("outgoing_calls_count"))
    )


def stream_profile(spark, d):
    base = _run_hourly(spark, d)
    return C.finish_profile(C.merge_profiles(read_profile_partials(spark, f"{base}/profile")))


def stream_profile_compacted(spark, d):
    """Profiles after folding the first two micro-batches into a snapshot: the reader
    takes the snapshot plus the later partials."""
    base = _run_hourly(spark, d)
    compact_profiles(spark, f"{base}/profile", f"{base}/snapshots", upto=1, first=True)
    parts = current_profile_partials(spark, f"{base}/profile", f"{base}/snapshots", checkpoint=f"{base}/ckpt")
    return C.finish_profile(C.merge_profiles(parts))


def stream_detections(spark, d):
    base = _run_hourly(spark, d)
    daily = C.daily_totals(read_hourly(spark, f"{base}/hourly"))
    return C.detections(daily, read_profile_partials(spark, f"{base}/profile"))


def profile_from_options(spark, d):
    """Profiles read back from a store that is named by its options alone."""
    base = _run_hourly(spark, d)
    parts = current_profile_partials(spark, None, options={"path": f"{base}/profile"})
    return C.finish_profile(C.merge_profiles(parts))


def sink_overwrite(spark, d):
    path = scratch_path(spark, "detections")
    for _ in range(2):  # the rule runs on a schedule; each run replaces the last
        overwrite(detections(spark, d), path)
    return read_published(spark, path)


def sink_guarded(spark, d):
    path = scratch_path(spark, "exceptions")
    write_if_any(fee_exceptions(spark, d), lambda df: df.write.mode("append").parquet(path))
    return read_table(spark, path)


SUMMARY_STORED = T.StructType(
    [
        T.StructField("pay_type", T.StringType()),
        T.StructField("transfer_type", T.StringType()),
        T.StructField("transfer_flow", T.StringType()),
        T.StructField("charge_status", T.StringType()),
        T.StructField("call_count", T.LongType()),
        T.StructField("total_fee_charge", T.DoubleType()),
        T.StructField("date", T.StringType()),
    ]
)


def sink_summary(spark, d):
    path = scratch_path(spark, "summary")
    for _ in range(2):  # a rerun of the same days replaces them
        append_summary(fee_summary(spark, d), path, replace_dates=True)
    return read_table(spark, path, schema=SUMMARY_STORED).select(*FE.SUMMARY_KEYS, "call_count", "total_fee_charge")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "transfer_window": transfer_window,
    "transfer_labels": transfer_labels,
    "fee_classified": fee_classified,
    "fee_summary": fee_summary,
    "fee_exceptions": fee_exceptions,
    "fee_summary_text_codes": fee_summary_text_codes,
    "total_moc": total_moc,
    "hourly_moc": hourly_moc,
    "subscriber_profile": subscriber_profile,
    "daily_totals": daily_totals,
    "daily_enriched": daily_enriched,
    "top_caller_per_day": top_caller_per_day,
    "detections": detections,
    "distinct_files_cdr": distinct_files_cdr,
    "distinct_files_recharge": distinct_files_recharge,
    "stream_total_moc": stream_total_moc,
    "stream_total_partials": stream_total_partials,
    "stream_total_changed": stream_total_changed,
    "stream_distinct_files": stream_distinct_files,
    "stream_hourly_moc": stream_hourly_moc,
    "stream_hourly_windows": stream_hourly_windows,
    "stream_hourly_compacted": stream_hourly_compacted,
    "stream_profile": stream_profile,
    "stream_profile_compacted": stream_profile_compacted,
    "profile_from_options": profile_from_options,
    "stream_detections": stream_detections,
    "sink_overwrite": sink_overwrite,
    "sink_guarded": sink_guarded,
    "sink_summary": sink_summary,
}


# --------------------------------------------------------------------------- oracle
def _valid_sql(bounds_ms) -> str:
    s, e = bounds_ms
    return (
        f"WITH {FX.duck_transfers_cte()}, "
        f"v AS (SELECT * FROM transfers WHERE CUST_LOCAL_ENTRY_DATE >= {s} AND CUST_LOCAL_ENTRY_DATE < {e} "
        "AND ERROR_TYPE = 0 AND TRANSFER_TYPE IN (0, 1))"
    )


_DATE = "strftime(make_timestamp(cast(trunc(CUST_LOCAL_ENTRY_DATE / 1000) AS bigint) * 1000000), '%Y-%m-%d')"
_PAY = "CASE PAY_TYPE WHEN 0 THEN 'prepaid' WHEN 1 THEN 'postpaid' WHEN 2 THEN 'hybrid' END"
_TTYPE = "CASE WHEN EXT_TRANS_ID IS NULL THEN 'international' ELSE 'local' END"
_FLOW = "CASE TRANSFER_TYPE WHEN 0 THEN 'incoming' WHEN 1 THEN 'outgoing' END"


# what a transfer should be charged, and the label by the sign of the difference
_EXPECTED = "expected(kind, flow, due) AS (VALUES ('local', 'outgoing', 0.5), ('local', 'incoming', 0.0), ('international', 'outgoing', 0.0), ('international', 'incoming', 0.0))"


def _status_sql(equal: str, over: str, under: str) -> str:
    """Label of ``fee`` next to the ``due`` of a joined row of ``expected``."""
    return f"list_extract(['{under}', '{equal}', '{over}'], cast(sign(fee - due) AS integer) + 2)"


_LABELS_SQL = (
    _valid_sql(ALL_MS)
    + f", lab AS (SELECT {_DATE} AS date, {_PAY} AS pay_type, HANDLING_CHARGE, {_TTYPE} AS transfer_type, "
    f"{_FLOW} AS transfer_flow FROM v)"
)
_CLASSIFIED_SQL = (
    _LABELS_SQL
    + f", {_EXPECTED}, cls AS (SELECT date, pay_type, HANDLING_CHARGE, transfer_type, transfer_flow, fee AS fee_amount, "
    + _status_sql("Correct applied fee", "Over charged fee", "Under charged fee")
    + " AS charge_status FROM (SELECT *, HANDLING_CHARGE / 10000.0 AS fee FROM lab) AS l "
    "LEFT JOIN expected AS e ON e.kind = l.transfer_type AND e.flow = l.transfer_flow)"
)


def _exceptions_sql() -> str:
    cols = [f"{_status_sql('Correct charge', 'Over charge', 'Under charge')} AS status" if c == "STATUS" else f"x.{c}" for c in TRANSFER_PASSTHROUGH]
    return (
        _valid_sql(ALL_MS)
        + f", {_EXPECTED}, x AS (SELECT *, {_DATE} AS day, {_PAY} AS pay, {_TTYPE} AS kind, {_FLOW} AS flow, "
        "HANDLING_CHARGE / 10000.0 AS fee FROM v) "
        "SELECT x.day AS date, x.pay AS pay_type, x.HANDLING_CHARGE, x.kind AS transfer_type_str, x.flow AS transfer_flow_str, "
        f"{', '.join(cols)} FROM x JOIN expected AS e ON e.kind = x.kind AND e.flow = x.flow WHERE fee <> due"
    )


_MOC = (
    f"WITH {FX.duck_cdr_cte()}, "
    "moc AS (SELECT xdr_start_datetime AS event_ts, date_trunc('hour', xdr_start_datetime) AS event_hour, "
    "cast(xdr_start_datetime AS date) AS event_date, served_phone_number AS msisdn, served_imsi, served_imei "
    "FROM cdr WHERE xdr_type = 'MOC' AND xdr_start_datetime IS NOT NULL), "
    "hourly AS (SELECT event_date, event_hour, msisdn, count(*) AS outgoing_calls_count FROM moc "
    "GROUP BY event_date, event_hour, msisdn), "
    "profile AS (SELECT msisdn, min(event_ts) AS first_seen_on_network, max(event_ts) AS last_seen_on_network, "
    "first(served_imsi ORDER BY event_ts, served_imsi) FILTER (WHERE served_imsi IS NOT NULL) AS imsi, "
    "first(served_imei ORDER BY event_ts, served_imei) FILTER (WHERE served_imei IS NOT NULL) AS imei "
    "FROM moc GROUP BY msisdn), "
    "daily AS (SELECT event_date, msisdn, cast(sum(outgoing_calls_count) AS bigint) AS daily_outgoing_calls "
    "FROM hourly GROUP BY event_date, msisdn), "
    "top AS (SELECT event_date, msisdn, daily_outgoing_calls FROM (SELECT *, row_number() OVER "
    "(PARTITION BY event_date ORDER BY daily_outgoing_calls DESC, msisdn ASC NULLS LAST) AS rn FROM daily) "
    "WHERE rn = 1) "
)

_TOTAL = (
    f"WITH {FX.duck_cdr_cte()} SELECT served_imsi AS msisdn, count(*) AS moc_count FROM cdr "
    "WHERE xdr_type = 'MOC' GROUP BY served_imsi"
)
_DETECTIONS = (
    _MOC
    + "SELECT t.msisdn, t.event_date, t.daily_outgoing_calls, p.first_seen_on_network, p.last_seen_on_network, "
    "p.imsi, p.imei, 'TOP_CALLER_PER_DAY' AS detection_type, 'rule_engine_top_msisdn' AS rule_name "
    "FROM top t LEFT JOIN profile p ON t.msisdn = p.msisdn"
)
_SUMMARY = (
    _CLASSIFIED_SQL
    + " SELECT date, pay_type, transfer_type, transfer_flow, charge_status, count(*) AS call_count, "
    "sum(HANDLING_CHARGE) / 10000.0 AS total_fee_charge FROM cls "
    "GROUP BY date, pay_type, transfer_type, transfer_flow, charge_status"
)
_HOURLY = _MOC + "SELECT * FROM hourly"
_PROFILE = _MOC + "SELECT * FROM profile"

ORACLE: dict[str, str] = {
    "transfer_window": _valid_sql(WINDOW_MS) + " SELECT * FROM v",
    "transfer_labels": _LABELS_SQL + " SELECT * FROM lab",
    "fee_classified": _CLASSIFIED_SQL + " SELECT * FROM cls",
    "fee_summary": _SUMMARY,
    "fee_exceptions": _exceptions_sql(),
    "fee_summary_text_codes": _SUMMARY,
    "total_moc": _TOTAL,
    "hourly_moc": _HOURLY,
    "subscriber_profile": _PROFILE,
    "daily_totals": _MOC + "SELECT * FROM daily",
    "daily_enriched": _MOC
    + "SELECT d.msisdn, d.event_date, d.daily_outgoing_calls, p.first_seen_on_network, "
    "p.last_seen_on_network, p.imsi, p.imei FROM daily d LEFT JOIN profile p ON d.msisdn = p.msisdn",
    "top_caller_per_day": _MOC + "SELECT * FROM top",
    "detections": _DETECTIONS,
    "distinct_files_cdr": f"WITH {FX.duck_cdr_cte()} SELECT DISTINCT filename FROM cdr",
    "distinct_files_recharge": f"WITH {FX.duck_recharge_cte()} SELECT DISTINCT filename FROM recharge",
    "stream_total_moc": _TOTAL,
    "stream_total_partials": _TOTAL,
    "stream_total_changed": _TOTAL,
    "stream_distinct_files": f"WITH {FX.duck_cdr_cte()} SELECT DISTINCT filename FROM cdr",
    "stream_hourly_moc": _HOURLY,
    "stream_hourly_windows": _HOURLY,
    "stream_hourly_compacted": _HOURLY,
    "stream_profile": _PROFILE,
    "stream_profile_compacted": _PROFILE,
    "profile_from_options": _PROFILE,
    "stream_detections": _DETECTIONS,
    "sink_overwrite": _DETECTIONS,
    "sink_guarded": _exceptions_sql(),
    "sink_summary": _SUMMARY,
}
