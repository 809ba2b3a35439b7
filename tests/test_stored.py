"""Stored tables over time: folds read from their manifest, whole batches, retention of
markers and folds, totals by changed buckets, event-time windows, document stores."""

import datetime
import glob
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import docstore
from callsight import jobs
from callsight.operators import calls as C
from callsight.plans import fixtures as FX
from callsight.schemas import CDR_HOURLY_SCHEMA, CDR_SCHEMA, PROFILE_PARTIAL_SCHEMA
from callsight.session import scratch, scratch_path, materialize
from callsight.sinks import document_id, publish, read_published, write_batch
from callsight.sinks.markers import claim, content, mark, newest
from callsight.sources.tables import read_cdr_stream, read_hourly, read_profile_partials, read_table
from callsight.streaming.jobs import hourly_stream, hourly_window_stream, process_hourly_batch, total_stream
from callsight.streaming.snapshots import (
    HOURLY,
    PROFILES,
    changed_totals,
    committed_fold,
    compact_hourly,
    compact_profiles,
    current_hourly,
    current_profile_partials,
    expire_folds,
    expire_partials,
    read_changed_totals,
    replace_totals,
)
from paths import SF_SMALL

NOW = {"availableNow": True}
DAY = datetime.date(2024, 1, 1)
PARTIALS = "event_date date, event_hour timestamp, msisdn string, outgoing_calls_count bigint, batch_id bigint"


def rows_of(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def hourly_batches(spark, path, batches):
    """Batch b adds its number to each of its days."""
    rows = [(DAY + datetime.timedelta(d), None, "a", b + 1, b) for b, days in batches.items() for d in days]
    spark.createDataFrame(rows, PARTIALS).write.mode("append").partitionBy("event_date", "batch_id").parquet(path)


def by_day(df):
    return {(r.event_date - DAY).days: r.outgoing_calls_count for r in HOURLY.merge(df).collect()}


# --- folds -------------------------------------------------------------------------


def test_folds_open_marked_folders_only(spark, tmp_dir):
    hourly, folded = f"{tmp_dir}/h", f"{tmp_dir}/f"
    hourly_batches(spark, hourly, {0: [0, 1, 2], 1: [0, 1], 2: [2]})
    for upto in range(3):
        compact_hourly(spark, hourly, folded, upto=upto, first=upto == 0)
    # older attempts lie there, and what a stopped fold left
    junk = spark.createDataFrame([(None, "x", 999)], "event_hour timestamp, msisdn string, outgoing_calls_count bigint")
    junk.withColumn("event_date", F.lit(DAY)).write.partitionBy("event_date").parquet(f"{folded}/attempt=stopped")
    rows, done = committed_fold(spark, HOURLY, folded)
    opened = {os.path.dirname(f.removeprefix("file://")) for f in rows.inputFiles()}
    marked = {(str(r.event_date), r.attempt) for r in content(spark, f"{folded}_commits", done, HOURLY.table(spark, folded).marker).collect()}
    assert opened == {f"{folded}/attempt={a}/event_date={d}" for d, a in marked} and len(opened) == 3
    assert len(glob.glob(f"{folded}/attempt=*/event_date=*")) == 3 + 2 + 1 + 1
    assert by_day(rows) == {0: 3, 1: 3, 2: 4}
    # the next fold opens the parts it touches
    table = HOURLY.table(spark, folded)
    touched = spark.createDataFrame([(DAY,)], "event_date date")
    assert {os.path.basename(os.path.dirname(f)) for f in table.read(table.manifest(), only=touched).inputFiles()} == {f"event_date={DAY}"}
    none = table.read(table.manifest(), only=touched.limit(0))
    assert none.count() == 0 and none.columns == rows.columns


def test_fold_of_a_null_part(spark, tmp_dir):
    table = HOURLY.table(spark, f"{tmp_dir}/f")
    df = spark.createDataFrame([(None, None, "a", 1), (DAY, None, "a", 2)], "event_date date, event_hour timestamp, msisdn string, outgoing_calls_count bigint")
    table.replace(df, df.select("event_date").distinct(), None)
    table.replace(df.filter("event_date IS NULL").withColumn("outgoing_calls_count", F.lit(5).cast("bigint")), df.select("event_date").filter("event_date IS NULL"), table.manifest())
    got = {r.event_date: r.outgoing_calls_count for r in table.read(table.manifest()).collect()}
    assert got == {None: 5, DAY: 2}


def test_expired_folds_and_partials_go(spark, tmp_dir):
    hourly, folded = f"{tmp_dir}/h", f"{tmp_dir}/f"
    hourly_batches(spark, hourly, {b: [0, b + 1] for b in range(5)})
    for upto in range(5):
        compact_hourly(spark, hourly, folded, upto=upto, first=upto == 0)
    want = by_day(current_hourly(spark, hourly, folded))
    before = by_day(committed_fold(spark, HOURLY, folded)[0])
    # day 0 was rewritten by every fold, the others once: three old copies of day 0 go
    assert expire_folds(spark, HOURLY, folded, keep=2) == 3
    assert expire_folds(spark, HOURLY, folded, keep=2) == 0
    assert by_day(committed_fold(spark, HOURLY, folded)[0]) == before
    table = HOURLY.table(spark, folded)
    assert by_day(table.read(table.manifest(3))) == {0: 10, 1: 1, 2: 2, 3: 3, 4: 4}  # the fold before
    assert len(os.listdir(f"{folded}_commits")) == 2
    with pytest.raises(ValueError):
        expire_partials(spark, HOURLY, hourly, folded, upto=5)
    assert expire_partials(spark, HOURLY, hourly, folded, upto=3) == 8
    assert by_day(current_hourly(spark, hourly, folded)) == want == {0: 15, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5}


def test_two_folds_of_one_batch_count_once(spark, tmp_dir):
    hourly, folded = f"{tmp_dir}/h", f"{tmp_dir}/f"
    hourly_batches(spark, hourly, {0: [0]})
    table = HOURLY.table(spark, folded)
    df = read_hourly(spark, hourly).drop("batch_id")
    for _ in range(2):  # two jobs that saw no fold
        table.replace(df, df.select("event_date"), None, n=0)
    assert by_day(committed_fold(spark, HOURLY, folded)[0]) == {0: 1}


# --- whole batches -----------------------------------------------------------------


def test_half_written_batch_is_not_read(spark, tmp_dir):
    inp = f"{tmp_dir}/in"
    FX.write_cdr_files(spark, SF_SMALL, inp, columns=set(CDR_HOURLY_SCHEMA.fieldNames()))
    src = read_cdr_stream(spark, inp, schema=CDR_HOURLY_SCHEMA, max_files_per_trigger=3)
    hourly_stream(src, f"{tmp_dir}/h", f"{tmp_dir}/p", f"{tmp_dir}/c", trigger=NOW).awaitTermination()
    names = {"checkpoint": f"{tmp_dir}/c"}
    counts = rows_of(HOURLY.merge(current_hourly(spark, f"{tmp_dir}/h", **names)))
    profiles = rows_of(PROFILES.merge(current_profile_partials(spark, f"{tmp_dir}/p", **names)))
    last = max(int(os.path.basename(p)) for p in glob.glob(f"{tmp_dir}/c/commits/[0-9]*"))
    # the next batch has written its counts, not yet its profiles, and is not committed
    batch = FX.cdr(spark, SF_SMALL, columns=set(CDR_HOURLY_SCHEMA.fieldNames())).limit(50)
    assert process_hourly_batch(batch, last + 1, f"{tmp_dir}/h", None)
    assert rows_of(HOURLY.merge(current_hourly(spark, f"{tmp_dir}/h", **names))) == counts
    assert rows_of(HOURLY.merge(current_hourly(spark, f"{tmp_dir}/h"))) != counts
    assert rows_of(PROFILES.merge(current_profile_partials(spark, f"{tmp_dir}/p", **names))) == profiles
    # also behind a fold, and by the job
    compact_hourly(spark, f"{tmp_dir}/h", f"{tmp_dir}/f", upto=1, first=True)
    compact_profiles(spark, f"{tmp_dir}/p", f"{tmp_dir}/s", upto=1, first=True)
    assert rows_of(HOURLY.merge(current_hourly(spark, f"{tmp_dir}/h", f"{tmp_dir}/f", **names))) == counts
    args = ["top-callers", "--hourly", f"{tmp_dir}/h", "--folded", f"{tmp_dir}/f", "--profiles", f"{tmp_dir}/p", "--snapshots", f"{tmp_dir}/s"]
    jobs.main([*args, "--checkpoint", f"{tmp_dir}/c", "--out", f"{tmp_dir}/d"], spark)
    moc = C.outgoing(FX.cdr(spark, SF_SMALL))
    want = C.detections(C.daily_totals(C.hourly_counts(moc)), C.profile_partials(moc), materialize=False)
    assert rows_of(read_published(spark, f"{tmp_dir}/d")) == rows_of(want)
    # a stream that has committed nothing yet
    assert current_hourly(spark, f"{tmp_dir}/h", checkpoint=f"{tmp_dir}/none").count() == 0


# --- publishing --------------------------------------------------------------------


def listed(path):
    return sum(len(files) + len(dirs) for _, dirs, files in os.walk(path))


def test_listing_does_not_grow_with_publishes(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    for n in range(4):
        publish(spark.range(n), path)
    before = listed(f"{path}_versions")
    for n in range(4, 34):
        publish(spark.range(n), path)
    assert listed(f"{path}_versions") == before
    assert read_published(spark, path).count() == 33
    assert sorted(os.listdir(path))[0].startswith("version=32-") and len(os.listdir(path)) == 2


def test_writers_at_the_same_time_have_numbers_of_their_own(spark, tmp_dir):
    base = f"{tmp_dir}/m"
    first, second = claim(spark, base), claim(spark, base)
    assert (first, second) == (0, 1)
    one = lambda v: spark.range(1).select(F.lit(v).alias("v"))
    mark(one("late"), base, second)
    mark(one("early"), base, first)  # finishes last, but was not the last to begin
    assert newest(spark, base) == 1 and claim(spark, base) == 2
    assert content(spark, base, 1, one("").schema).first().v == "late"
    with pytest.raises(FileNotFoundError):
        content(spark, base, 7, one("").schema)


def test_publish_goes_on_where_another_writer_cleans_up(spark, tmp_dir, monkeypatch):
    import callsight.sinks as S

    path = f"{tmp_dir}/t"
    for n in range(3):
        publish(spark.range(n), path)

    def gone(*_):
        raise FileNotFoundError

    monkeypatch.setattr(S, "content", gone)  # old markers vanish between listing and reading
    publish(spark.range(7), path)
    monkeypatch.undo()
    assert read_published(spark, path).count() == 7


def test_scratch_goes_in_one_call(spark):
    with scratch(spark, "test") as folder:
        df = materialize(spark.range(5), "inner")
        with scratch(spark, "nested") as deeper:
            materialize(spark.range(2), "inner")
            assert deeper.startswith(folder)
        assert df.count() == 5 and not os.path.exists(deeper.removeprefix("file:"))
    assert not os.path.exists(folder.removeprefix("file:"))
    assert not scratch_path(spark, "outside").startswith(folder)


# --- totals by changed buckets -----------------------------------------------------


def test_changed_totals_rewrite_their_buckets(spark, tmp_dir):
    path, buckets = f"{tmp_dir}/t", 256
    number = F.when(F.col("id") == 0, F.lit(None).cast("string")).otherwise(F.col("id").cast("string"))
    all_ = spark.range(3000).select(number.alias("msisdn"), (F.col("id") + 1).alias("moc_count"))
    assert replace_totals(all_, path, buckets) == buckets
    table = changed_totals(spark, path, buckets)
    few = spark.range(30).select(number.alias("msisdn"), F.lit(-1).cast("bigint").alias("moc_count"))  # 1 % of the numbers
    n = replace_totals(few, path, buckets)
    assert 0 < n <= 30
    attempts = table.manifest().rows.groupBy("attempt").count().collect()
    assert sorted(r["count"] for r in attempts) == [n, buckets - n]
    assert len(glob.glob(f"{path}/attempt=*/{table.part.name}=*")) == buckets + n  # the version before stays
    want = {**{str(i): i + 1 for i in range(30, 3000)}, **{str(i): -1 for i in range(1, 30)}, None: -1}
    current = lambda: {r.msisdn: r.moc_count for r in read_changed_totals(spark, path, buckets).collect()}
    assert current() == want and read_changed_totals(spark, path, buckets).count() == 3000
    assert replace_totals(few, path, buckets) == n and current() == want  # a replay
    assert replace_totals(few.limit(0), path, buckets) is None and current() == want
    assert len(os.listdir(f"{path}_commits")) <= 4  # two markers, their claims
    with pytest.raises(AnalysisException):
        read_changed_totals(spark, path, 64)  # another number of buckets is another table


def test_update_stream_equals_batch_and_survives_replay(spark, tmp_dir):
    import shutil

    inp = f"{tmp_dir}/in"
    FX.write_cdr_files(spark, SF_SMALL, inp)

    def run(checkpoint, view):
        src = read_cdr_stream(spark, inp, schema=CDR_SCHEMA, max_files_per_trigger=3)
        q = total_stream(src, f"{tmp_dir}/t", checkpoint, view=view, output="update", trigger=NOW)
        q.awaitTermination()
        return [p["batchId"] for p in q.recentProgress if p["numInputRows"] > 0]

    last = max(run(f"{tmp_dir}/c", "xdr_update"))
    want = rows_of(C.total_by_subscriber(FX.cdr(spark, SF_SMALL)))
    assert rows_of(read_changed_totals(spark, f"{tmp_dir}/t")) == want

    def no_commit(folder, names):
        return [n for n in names if folder.endswith("commits") and n in (str(last), f".{last}.crc")]

    shutil.copytree(f"{tmp_dir}/c", f"{tmp_dir}/c2", ignore=no_commit)
    assert run(f"{tmp_dir}/c2", "xdr_update2") == [last]
    assert rows_of(read_changed_totals(spark, f"{tmp_dir}/t")) == want


# --- event-time windows ------------------------------------------------------------


def land(spark, path, name, calls):
    """A file of calls (day, hour, number)."""
    rows = [("MOC", datetime.datetime(2024, 1, day, hour, 30), n) for day, hour, n in calls]
    df = spark.createDataFrame(rows, "xdr_type string, xdr_start_datetime timestamp, served_phone_number string")
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in CDR_HOURLY_SCHEMA.fields if f.name not in (*df.columns, "filename")]
    df.select("*", *nulls, F.lit(name).alias("filename")).coalesce(1).write.mode("append").partitionBy("filename").parquet(path)


def test_windows_close_and_late_calls_are_dropped(spark, tmp_dir):
    inp = f"{tmp_dir}/in"

    def run():
        src = read_cdr_stream(spark, inp, schema=CDR_HOURLY_SCHEMA)
        q = hourly_window_stream(src, f"{tmp_dir}/h", f"{tmp_dir}/c", delay="24 hours", trigger=NOW)
        q.awaitTermination()
        return q.recentProgress

    def found():
        return sorted((r.event_date.day, r.event_hour.hour, r.msisdn, r.outgoing_calls_count) for r in read_hourly(spark, f"{tmp_dir}/h").collect())

    land(spark, inp, "a", [(10, 5, "x"), (10, 5, "x"), (10, 6, "y"), (10, 6, None)])
    run()
    assert not os.path.exists(f"{tmp_dir}/h") or found() == []  # nothing is final yet
    land(spark, inp, "b", [(10, 7, "x"), (12, 0, "x")])  # within the delay; and one that closes the 10th
    run()
    closed = [(10, 5, "x", 2), (10, 6, "None", 1), (10, 6, "y", 1), (10, 7, "x", 1)]
    assert sorted((a, b, str(c), n) for a, b, c, n in [(r.event_date.day, r.event_hour.hour, r.msisdn, r.outgoing_calls_count) for r in read_hourly(spark, f"{tmp_dir}/h").collect()]) == closed
    land(spark, inp, "c", [(7, 5, "late"), (10, 5, "x"), (12, 0, "x"), (20, 0, "x")])  # five days late; a closed hour
    progress = run()
    assert sum(s["numRowsDroppedByWatermark"] for p in progress for s in p["stateOperators"]) == 2
    assert sum(1 for r in read_hourly(spark, f"{tmp_dir}/h").collect()) == 5
    last = [(r.event_date.day, r.event_hour.hour, r.msisdn, r.outgoing_calls_count) for r in read_hourly(spark, f"{tmp_dir}/h").filter("day(event_date) = 12").collect()]
    assert last == [(12, 0, "x", 2)]  # one row, with the call that came in time
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] == 1  # closed hours are freed


def test_window_stream_job(spark, tmp_dir):
    inp = f"{tmp_dir}/in"
    land(spark, inp, "a", [(10, 5, "x"), (12, 0, "x")])
    jobs.main(["hourly-window-stream", "--input", inp, "--hourly", f"{tmp_dir}/h", "--checkpoint", f"{tmp_dir}/c", "--available-now", "--offset", "30 minutes"], spark)
    (row,) = read_hourly(spark, f"{tmp_dir}/h").collect()
    assert row.event_hour == datetime.datetime(2024, 1, 10, 5, 30)  # hours begin half past


# --- document stores ---------------------------------------------------------------


@pytest.fixture(scope="module")
def store(spark):
    return docstore.register(spark)


def test_replayed_batch_leaves_documents_unchanged(spark, store, tmp_dir):
    options = {"database": tmp_dir, "collection": "profiles"}
    batch = FX.cdr(spark, SF_SMALL, columns=set(CDR_HOURLY_SCHEMA.fieldNames()))
    for number in (3, 3, 4, 4):
        assert process_hourly_batch(batch, number, f"{tmp_dir}/h", None, profile_fmt=store, profile_options=options)
    one = C.profile_partials(C.outgoing(batch)).count()
    assert len(os.listdir(f"{tmp_dir}/profiles")) == 2 * one
    stored = read_table(spark, None, store, schema=PROFILE_PARTIAL_SCHEMA, options=options)
    assert rows_of(C.finish_profile(C.merge_profiles(stored))) == rows_of(C.subscriber_profile(C.outgoing(batch)))
    # without keys the store makes its own identities, and a replay doubles
    for _ in range(2):
        write_batch(spark.range(2), None, 0, fmt=store, options={"database": tmp_dir, "collection": "loose"})
    assert len(os.listdir(f"{tmp_dir}/loose")) == 4


def test_document_ids(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None), (None, "a"), ("", "a"), ("a,b", ""), (None, None)], "x string, y string")
    ids = [r[0] for r in df.select(document_id(7, ["x", "y"])).collect()]
    assert len(set(ids)) == len(ids) and all(i.startswith("7-") for i in ids)
    assert ids == [r[0] for r in df.select(document_id(7, ["x", "y"])).collect()]


def test_top_callers_read_profiles_from_documents(spark, store, tmp_dir):
    """The whole chain over a store that is named by options: nested samples and ``_id``."""
    inp = FX.write_cdr_files(spark, SF_SMALL, f"{tmp_dir}/in", columns=set(CDR_HOURLY_SCHEMA.fieldNames()))
    named = ["--profiles", "-", "--profiles-format", store, "--profiles-option", f"database={tmp_dir}", "--profiles-option", "collection=msc"]
    jobs.main(["hourly-stream", "--input", inp, "--files-per-trigger", "3", "--available-now", "--hourly", f"{tmp_dir}/h", *named, "--checkpoint", f"{tmp_dir}/c"], spark)
    documents = os.listdir(f"{tmp_dir}/msc")
    assert documents and all(d.split("-")[0].isdigit() for d in documents)
    out = ["--out", "-", "--out-format", store, "--out-option", f"database={tmp_dir}", "--out-option", "collection=detections"]
    jobs.main(["top-callers", "--hourly", f"{tmp_dir}/h", *named, "--checkpoint", f"{tmp_dir}/c", *out], spark)
    moc = C.outgoing(FX.cdr(spark, SF_SMALL))
    want = C.detections(C.daily_totals(C.hourly_counts(moc)), C.profile_partials(moc), materialize=False)
    got = read_table(spark, None, store, schema=want.schema, options={"database": tmp_dir, "collection": "detections"})
    assert rows_of(got) == rows_of(want)


# --- top-k beyond Spark's own limit ------------------------------------------------


@pytest.mark.parametrize("ties", [False, True])
def test_large_k_equals_plain_rank(spark, ties):
    daily = spark.range(9000).select(
        F.when(F.col("id") % 10 == 0, F.lit(None)).otherwise(F.lit(DAY)).alias("event_date"),
        F.col("id").cast("string").alias("msisdn"),
        (F.col("id") % 700).alias("daily_outgoing_calls"),
    )
    got = C.top_caller_per_day(daily, k=1500, ties=ties)
    daily.createOrReplaceTempView("daily_for_rank")
    order = "daily_outgoing_calls DESC" + ("" if ties else ", msisdn")
    want = spark.sql(
        f"SELECT event_date, msisdn, daily_outgoing_calls FROM (SELECT *, {'rank' if ties else 'row_number'}() OVER "
        f"(PARTITION BY event_date ORDER BY {order}) AS r FROM daily_for_rank) WHERE r <= 1500"
    )
    assert rows_of(got) == rows_of(want)


def test_stored_profiles_keep_their_schema(spark, store, tmp_dir):
    options = {"database": tmp_dir, "collection": "p"}
    partials = C.profile_partials(C.outgoing(FX.cdr(spark, SF_SMALL)))
    write_batch(partials, None, 0, fmt=store, options=options, keys=["msisdn"])
    write_batch(partials, f"{tmp_dir}/q", 0)
    from_store = current_profile_partials(spark, None, fmt=store, options=options)
    assert rows_of(from_store) == rows_of(read_profile_partials(spark, f"{tmp_dir}/q"))
