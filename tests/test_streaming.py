"""Streams equal their batch twins; replays and late files; empty batches."""

import datetime
import os
import re

import pytest
from pyspark.sql import functions as F

from callsight.operators import calls as C
from callsight.plans import fixtures as FX
from callsight.schemas import CDR_HOURLY_SCHEMA, CDR_SCHEMA
from callsight.sources.tables import read_cdr_stream, read_files, read_hourly, read_profile_partials, read_table, read_totals
from callsight.streaming.jobs import files_stream, hourly_stream, process_hourly_batch, total_stream
from callsight.streaming.snapshots import (
    compact_hourly,
    compact_profiles,
    compact_totals,
    current_hourly,
    current_totals,
    current_profile_partials,
    HOURLY,
    PROFILES,
    committed_batch,
    committed_fold,
)
from paths import SF_SMALL

NOW = {"availableNow": True}


def plan_of(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def rows_of(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def summed_hourly(spark, path):
    return (
        read_hourly(spark, path)
        .groupBy("event_date", "event_hour", "msisdn")
        .agg(F.sum("outgoing_calls_count").cast("bigint").alias("outgoing_calls_count"))
    )


def run_hourly(spark, base, inp):
    src = read_cdr_stream(spark, inp, schema=CDR_HOURLY_SCHEMA, max_files_per_trigger=3)
    q = hourly_stream(src, f"{base}/hourly", f"{base}/profile", f"{base}/ckpt", trigger=NOW)
    q.awaitTermination()
    return q


def test_hourly_stream_equals_batch_then_late_file(spark, tmp_dir):
    inp = f"{tmp_dir}/in"
    FX.write_cdr_files(spark, SF_SMALL, inp, columns=set(CDR_HOURLY_SCHEMA.fieldNames()))
    q = run_hourly(spark, tmp_dir, inp)
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) >= 4  # 12 files, 3 per batch

    cdr = FX.cdr(spark, SF_SMALL)
    moc = C.outgoing(cdr)
    assert rows_of(summed_hourly(spark, f"{tmp_dir}/hourly")) == rows_of(C.hourly_counts(moc))
    merged = C.finish_profile(C.merge_profiles(read_profile_partials(spark, f"{tmp_dir}/profile")))
    assert rows_of(merged) == rows_of(C.subscriber_profile(moc))

    # a late file with old event times lands after the first run: it is counted
    late = cdr.filter(F.col("filename") == "cdr_0").withColumn("filename", F.lit("late"))
    late.select(*CDR_HOURLY_SCHEMA.fieldNames()).write.mode("append").partitionBy("filename").parquet(inp)
    run_hourly(spark, tmp_dir, inp)
    both = C.outgoing(cdr.unionByName(late))
    assert rows_of(summed_hourly(spark, f"{tmp_dir}/hourly")) == rows_of(C.hourly_counts(both))


def test_replayed_batch_does_not_double(spark, tmp_dir):
    batch = FX.cdr(spark, SF_SMALL, columns=set(CDR_HOURLY_SCHEMA.fieldNames()))
    for _ in range(2):
        assert process_hourly_batch(batch, 7, f"{tmp_dir}/hourly", f"{tmp_dir}/profile")
    assert rows_of(summed_hourly(spark, f"{tmp_dir}/hourly")) == rows_of(C.hourly_counts(C.outgoing(batch)))
    parts = read_profile_partials(spark, f"{tmp_dir}/profile")
    assert parts.count() == C.profile_partials(C.outgoing(batch)).count()


def test_batch_without_outgoing_calls_writes_nothing(spark, tmp_dir):
    batch = FX.cdr(spark, SF_SMALL).withColumn("xdr_type", F.lit("MTC"))
    assert not process_hourly_batch(batch, 0, f"{tmp_dir}/hourly", f"{tmp_dir}/profile")
    assert not os.path.exists(f"{tmp_dir}/hourly") and not os.path.exists(f"{tmp_dir}/profile")


def test_total_stream_equals_batch(spark, tmp_dir):
    inp = f"{tmp_dir}/in"
    FX.write_cdr_files(spark, SF_SMALL, inp)
    src = read_cdr_stream(spark, inp, schema=CDR_SCHEMA, max_files_per_trigger=3)
    q = total_stream(src, f"{tmp_dir}/totals", f"{tmp_dir}/ckpt", view="xdr_total_test", trigger=NOW)
    q.awaitTermination()
    got = read_totals(spark, f"{tmp_dir}/totals")
    assert rows_of(got) == rows_of(C.total_by_subscriber(FX.cdr(spark, SF_SMALL)))


def test_detections_from_stored_tables(spark, tmp_dir):
    inp = f"{tmp_dir}/in"
    FX.write_cdr_files(spark, SF_SMALL, inp, columns=set(CDR_HOURLY_SCHEMA.fieldNames()))
    run_hourly(spark, tmp_dir, inp)
    daily = C.daily_totals(read_hourly(spark, f"{tmp_dir}/hourly"))
    got = C.detections(daily, read_profile_partials(spark, f"{tmp_dir}/profile"))
    moc = C.outgoing(FX.cdr(spark, SF_SMALL))
    want = C.detections(C.daily_totals(C.hourly_counts(moc)), C.profile_partials(moc), materialize=False)
    assert rows_of(got) == rows_of(want)
    # date bounds prune the stored table's event_date folders
    first = daily.agg(F.min("event_date")).first()[0]
    bounded = C.daily_totals(read_hourly(spark, f"{tmp_dir}/hourly"), start_date=str(first), end_date=str(first))
    assert bounded.count() == 0


def test_total_stream_partials_equal_batch_without_state(spark, tmp_dir):
    inp = f"{tmp_dir}/in"
    FX.write_cdr_files(spark, SF_SMALL, inp)
    src = read_cdr_stream(spark, inp, schema=CDR_SCHEMA, max_files_per_trigger=3)
    q = total_stream(src, f"{tmp_dir}/totals", f"{tmp_dir}/ckpt", output="partials", trigger=NOW)
    q.awaitTermination()
    want = rows_of(C.total_by_subscriber(FX.cdr(spark, SF_SMALL)))
    assert rows_of(read_totals(spark, f"{tmp_dir}/totals", partials=True)) == want
    assert not q.lastProgress["stateOperators"]  # nothing kept between triggers


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Three micro-batches of partials, written as the hourly stream does."""
    base = str(tmp_path_factory.mktemp("stored"))
    cdr = FX.cdr(spark, SF_SMALL, columns=set(CDR_HOURLY_SCHEMA.fieldNames()))
    files = sorted(r.filename for r in cdr.select("filename").distinct().collect())
    for b, group in enumerate([files[0:4], files[4:8], files[8:12]]):
        process_hourly_batch(cdr.filter(F.col("filename").isin(group)), b, f"{base}/hourly", f"{base}/profile")
    moc = C.outgoing(cdr)
    return base, rows_of(C.hourly_counts(moc)), rows_of(C.subscriber_profile(moc))


def hourly_now(spark, hourly, folded, **how):
    return rows_of(HOURLY.merge(current_hourly(spark, hourly, folded, **how)))


def profiles_now(spark, parts, snaps, **how):
    return rows_of(C.finish_profile(C.merge_profiles(current_profile_partials(spark, parts, snaps, **how))))


def test_profile_snapshots_fold_partials_exactly(spark, stored, tmp_dir):
    base, _, want = stored
    parts, snaps = f"{base}/profile", f"{tmp_dir}/snap"
    assert compact_profiles(spark, f"{tmp_dir}/none", snaps, upto=0, first=True) is None  # nothing stored yet
    assert compact_profiles(spark, parts, snaps, upto=0, first=True) == 0
    assert profiles_now(spark, parts, snaps) == want  # snapshot(0) + partials 1, 2
    assert compact_profiles(spark, parts, snaps, upto=2) == 2
    assert compact_profiles(spark, parts, snaps, upto=2) == 2  # nothing new: no new snapshot
    snap, upto = committed_fold(spark, PROFILES, snaps)
    assert upto == 2 and snap.count() == len(want)
    assert profiles_now(spark, parts, snaps) == want  # snapshot(2) only
    assert "(batch_id" in plan_of(current_profile_partials(spark, parts, snaps))


def test_half_written_fold_is_never_read(spark, stored, tmp_dir):
    """What a stopped fold leaves behind, in part or whole, changes nothing, neither for
    readers nor for the folds after it."""
    base, want_hourly, want_profiles = stored
    folded, snaps = f"{tmp_dir}/folded", f"{tmp_dir}/snap"
    assert compact_profiles(spark, f"{base}/profile", snaps, upto=0, first=True) == 0
    assert compact_hourly(spark, f"{base}/hourly", folded, upto=0, first=True) == 0
    half = PROFILES.with_part(read_profile_partials(spark, f"{base}/profile").drop("batch_id").limit(5))
    half.write.partitionBy("bucket").parquet(f"{snaps}/attempt=stopped")
    junk = spark.createDataFrame([(None, "x", 999)], "event_hour timestamp, msisdn string, outgoing_calls_count bigint")
    junk.withColumn("event_date", F.to_date(F.lit("1999-01-01"))).write.partitionBy("event_date").parquet(f"{folded}/attempt=stopped")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for upto in (1, 2):
            assert profiles_now(spark, f"{base}/profile", snaps) == want_profiles
            assert hourly_now(spark, f"{base}/hourly", folded) == want_hourly
            assert compact_profiles(spark, f"{base}/profile", snaps, upto=upto) == upto
            assert compact_hourly(spark, f"{base}/hourly", folded, upto=upto) == upto
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert profiles_now(spark, f"{base}/profile", snaps) == want_profiles
    assert hourly_now(spark, f"{base}/hourly", folded) == want_hourly


def test_missing_folds_are_errors_unless_said_otherwise(spark, stored, tmp_dir):
    base, want_hourly, _ = stored
    hourly, nowhere = f"{base}/hourly", f"{tmp_dir}/mistyped"
    with pytest.raises(FileNotFoundError):
        current_hourly(spark, hourly, nowhere)
    with pytest.raises(FileNotFoundError):
        compact_hourly(spark, hourly, nowhere, upto=1)
    with pytest.raises(FileNotFoundError):
        current_profile_partials(spark, f"{base}/profile", nowhere)
    with pytest.raises(ValueError):
        compact_hourly(spark, hourly, nowhere, first=True)  # neither upto nor checkpoint
    assert hourly_now(spark, hourly, nowhere, missing_ok=True) == want_hourly


def test_fold_rewrites_touched_days_only(spark, tmp_dir):
    hourly, folded = f"{tmp_dir}/h", f"{tmp_dir}/f"
    schema = "event_date date, event_hour timestamp, msisdn string, outgoing_calls_count bigint, batch_id bigint"
    day = datetime.date(2024, 1, 1)
    rows = [(day, None, "a", 1, 0), (day + datetime.timedelta(1), None, "a", 2, 0), (day + datetime.timedelta(1), None, "a", 5, 1)]
    spark.createDataFrame(rows, schema).write.partitionBy("event_date", "batch_id").parquet(hourly)
    assert compact_hourly(spark, hourly, folded, upto=0, first=True) == 0
    before = set(os.listdir(folded))
    assert compact_hourly(spark, hourly, folded, upto=1) == 1
    (new,) = set(os.listdir(folded)) - before
    assert [d for d in os.listdir(f"{folded}/{new}") if d.startswith("event_date")] == ["event_date=2024-01-02"]
    got = {r.event_date: r.outgoing_calls_count for r in HOURLY.merge(current_hourly(spark, hourly, folded)).collect()}
    assert got == {day: 1, day + datetime.timedelta(1): 7}


def test_files_stream_names(spark, tmp_dir):
    inp = f"{tmp_dir}/in"
    FX.write_cdr_files(spark, SF_SMALL, inp)
    src = read_cdr_stream(spark, inp, schema=CDR_SCHEMA, max_files_per_trigger=3)
    q = files_stream(src, f"{tmp_dir}/files", f"{tmp_dir}/ckpt", trigger=NOW)
    q.awaitTermination()
    assert not q.lastProgress["stateOperators"]
    assert read_files(spark, f"{tmp_dir}/files").count() == 12
    stored = read_table(spark, f"{tmp_dir}/files")
    assert stored.count() <= 24  # a name per batch, not a row per record
    assert stored.select("batch_id").distinct().count() >= 4  # names arrive over several batches


def test_streams_read_only_what_they_need(spark, tmp_dir, capsys, request):
    """Filters and projections reach the scan of the running query."""
    whole_plans = "spark.sql.maxMetadataStringLength"  # plans are printed in full
    spark.conf.set(whole_plans, "4000")
    request.addfinalizer(lambda: spark.conf.unset(whole_plans))
    inp = f"{tmp_dir}/in"
    cdr = FX.cdr(spark, SF_SMALL)
    cdr.write.parquet(inp)

    def scan(q):
        q.awaitTermination()
        capsys.readouterr()
        q.explain(True)
        text = capsys.readouterr().out
        return re.search(r"PushedFilters: \[(.*?)\]", text).group(1), re.search(r"ReadSchema: struct<(.*?)>", text).group(1)

    src = read_cdr_stream(spark, inp, schema=CDR_SCHEMA)
    pushed, read = scan(hourly_stream(src, f"{tmp_dir}/h", f"{tmp_dir}/p", f"{tmp_dir}/c1", trigger=NOW))
    assert "EqualTo(xdr_type,MOC)" in pushed
    assert sorted(c.split(":")[0] for c in read.split(",")) == ["served_imei", "served_imsi", "served_phone_number", "xdr_start_datetime", "xdr_type"]
    src = read_cdr_stream(spark, inp, schema=CDR_SCHEMA)
    pushed, read = scan(total_stream(src, f"{tmp_dir}/t", f"{tmp_dir}/c2", output="partials", trigger=NOW))
    assert "EqualTo(xdr_type,MOC)" in pushed and sorted(c.split(":")[0] for c in read.split(",")) == ["served_imsi", "xdr_type"]


def test_total_partials_fold(spark, tmp_dir):
    inp = f"{tmp_dir}/in"
    FX.write_cdr_files(spark, SF_SMALL, inp)
    src = read_cdr_stream(spark, inp, schema=CDR_SCHEMA, max_files_per_trigger=3)
    total_stream(src, f"{tmp_dir}/t", f"{tmp_dir}/ck", output="partials", trigger=NOW).awaitTermination()
    want = rows_of(C.total_by_subscriber(FX.cdr(spark, SF_SMALL)))
    assert compact_totals(spark, f"{tmp_dir}/t", f"{tmp_dir}/f", upto=1, first=True) == 1
    assert rows_of(current_totals(spark, f"{tmp_dir}/t", f"{tmp_dir}/f")) == want
    last = committed_batch(spark, f"{tmp_dir}/ck")
    assert last is not None and last >= 3
    assert compact_totals(spark, f"{tmp_dir}/t", f"{tmp_dir}/f", checkpoint=f"{tmp_dir}/ck") == last
    assert rows_of(current_totals(spark, f"{tmp_dir}/t", f"{tmp_dir}/f")) == want
    assert rows_of(current_totals(spark, f"{tmp_dir}/t")) == want  # no fold: all partials


def test_engine_replay_after_crash_before_commit(spark, tmp_dir):
    """Crash after the sinks wrote batch N but before the engine committed it: the
    restarted query re-runs batch N, and the stored results do not change."""
    import shutil

    inp = f"{tmp_dir}/in"
    FX.write_cdr_files(spark, SF_SMALL, inp, columns=set(CDR_HOURLY_SCHEMA.fieldNames()))
    q = run_hourly(spark, tmp_dir, inp)
    last = max(p["batchId"] for p in q.recentProgress if p["numInputRows"] > 0)
    hourly_before = rows_of(summed_hourly(spark, f"{tmp_dir}/hourly"))
    profile_before = rows_of(C.finish_profile(C.merge_profiles(read_profile_partials(spark, f"{tmp_dir}/profile"))))

    def drop_last_commit(folder, names):
        return [n for n in names if folder.endswith("commits") and n in (str(last), f".{last}.crc")]

    shutil.copytree(f"{tmp_dir}/ckpt", f"{tmp_dir}/ckpt_crashed", ignore=drop_last_commit)
    src = read_cdr_stream(spark, inp, schema=CDR_HOURLY_SCHEMA, max_files_per_trigger=3)
    q2 = hourly_stream(src, f"{tmp_dir}/hourly", f"{tmp_dir}/profile", f"{tmp_dir}/ckpt_crashed", trigger=NOW)
    q2.awaitTermination()
    rerun = [p["batchId"] for p in q2.recentProgress if p["numInputRows"] > 0]
    assert rerun == [last]  # exactly the uncommitted batch ran again
    assert rows_of(summed_hourly(spark, f"{tmp_dir}/hourly")) == hourly_before
    merged = C.finish_profile(C.merge_profiles(read_profile_partials(spark, f"{tmp_dir}/profile")))
    assert rows_of(merged) == profile_before


def test_complete_mode_total_replay_after_crash_before_commit(spark, tmp_dir):
    """Same crash for the stateful total: state is restored, the batch re-runs, the
    rewritten totals are unchanged."""
    import shutil

    inp = f"{tmp_dir}/in"
    FX.write_cdr_files(spark, SF_SMALL, inp)
    src = read_cdr_stream(spark, inp, schema=CDR_SCHEMA, max_files_per_trigger=3)
    q = total_stream(src, f"{tmp_dir}/totals", f"{tmp_dir}/ckpt", view="xdr_replay", trigger=NOW)
    q.awaitTermination()
    last = max(p["batchId"] for p in q.recentProgress if p["numInputRows"] > 0)
    before = rows_of(read_totals(spark, f"{tmp_dir}/totals"))

    def drop_last_commit(folder, names):
        return [n for n in names if folder.endswith("commits") and n in (str(last), f".{last}.crc")]

    shutil.copytree(f"{tmp_dir}/ckpt", f"{tmp_dir}/ckpt_crashed", ignore=drop_last_commit)
    src2 = read_cdr_stream(spark, inp, schema=CDR_SCHEMA, max_files_per_trigger=3)
    q2 = total_stream(src2, f"{tmp_dir}/totals", f"{tmp_dir}/ckpt_crashed", view="xdr_replay2", trigger=NOW)
    q2.awaitTermination()
    assert [p["batchId"] for p in q2.recentProgress if p["numInputRows"] > 0] == [last]
    assert rows_of(read_totals(spark, f"{tmp_dir}/totals")) == before
    assert before == rows_of(C.total_by_subscriber(FX.cdr(spark, SF_SMALL)))
