"""Sinks: guarded write, append vs replace of summary days, overwrite, file layout."""

import glob
import os

import pytest

from pyspark.sql import functions as F

from callsight.functions.time import day_window
from callsight.operators import fees as FE
from callsight.plans import fixtures as FX
from callsight.plans import registry as R
from callsight.sinks import append_summary, overwrite, publish, read_published, write_batch, write_if_any, write_partitioned
from callsight.sources.tables import read_table
from paths import SF_SMALL


def test_guarded_write_skips_empty(spark, tmp_dir):
    empty = FE.fee_exceptions(FX.transfers(spark, SF_SMALL), 0, 1)  # nothing in 1970's first ms
    assert not write_if_any(empty, lambda df: df.write.parquet(f"{tmp_dir}/x"))
    assert not os.path.exists(f"{tmp_dir}/x")
    some = FE.fee_exceptions(FX.transfers(spark, SF_SMALL), *R.WINDOW_MS)
    assert write_if_any(some, lambda df: df.write.parquet(f"{tmp_dir}/y"))
    assert read_table(spark, f"{tmp_dir}/y").count() == some.count()


def test_summary_append_doubles_replace_does_not(spark, tmp_dir):
    summ = FE.fee_summary(FX.transfers(spark, SF_SMALL), *day_window(spark, "1997-03-01", "1997-04-01"))
    n = summ.agg(F.sum("call_count")).first()[0]
    for _ in range(2):
        append_summary(summ, f"{tmp_dir}/append")
        append_summary(summ, f"{tmp_dir}/replace", replace_dates=True)
    total = lambda p: read_table(spark, p).agg(F.sum("call_count")).first()[0]
    assert total(f"{tmp_dir}/append") == 2 * n
    assert total(f"{tmp_dir}/replace") == n
    days = summ.select("date").distinct().count()
    assert len(glob.glob(f"{tmp_dir}/replace/date=*/*.parquet")) == days  # one file per day
    # replacing one day leaves the other days alone
    one_day = summ.filter(F.col("date") == summ.agg(F.min("date")).first()[0])
    assert one_day.count() > 0
    append_summary(one_day, f"{tmp_dir}/replace", replace_dates=True)
    assert total(f"{tmp_dir}/replace") == n


def test_overwrite_replaces_whole_target(spark, tmp_dir):
    df = spark.range(10)
    overwrite(df, f"{tmp_dir}/o")
    overwrite(df.limit(3), f"{tmp_dir}/o")
    assert read_published(spark, f"{tmp_dir}/o").count() == 3


def test_failed_or_unmarked_publish_leaves_the_version_before(spark, tmp_dir):
    path = f"{tmp_dir}/o"
    publish(spark.range(10), path)
    broken = spark.range(5).select(F.raise_error(F.lit("stopped")).cast("long").alias("id"))
    with pytest.raises(Exception):
        publish(broken, path)
    spark.range(2).write.parquet(f"{path}/version=1-abc")  # written, never marked
    assert read_published(spark, path).count() == 10
    for n in (3, 4, 5):
        publish(spark.range(n), path)
    assert read_published(spark, path).count() == 5
    kept = sorted(os.path.basename(p) for p in glob.glob(f"{path}/version=[0-9]-*") if "abc" not in p)
    assert [k.split("-")[0] for k in kept] == ["version=2", "version=3"] or len(kept) <= 3
    with pytest.raises(FileNotFoundError):
        read_published(spark, f"{tmp_dir}/nothing")


def test_short_summary_takes_few_write_tasks(spark, tmp_dir):
    summ = spark.createDataFrame([("1997-03-01", 1), ("1997-03-01", 2)], "date string, call_count int")
    append_summary(summ, f"{tmp_dir}/s")
    assert len(glob.glob(f"{tmp_dir}/s/date=*/*.parquet")) == 1


def test_partitioned_write_one_file_per_partition(spark, tmp_dir):
    df = spark.range(0, 20000, numPartitions=8).withColumn("d", (F.col("id") % 5).cast("string"))
    write_partitioned(df, f"{tmp_dir}/p", ["d"])
    files = glob.glob(f"{tmp_dir}/p/d=*/*.parquet")
    assert len(files) == 5  # not 8 tasks x 5 partitions


def test_write_batch_replay_replaces_only_its_batch(spark, tmp_dir):
    df = spark.range(5).withColumn("d", F.lit("x"))
    write_batch(df, f"{tmp_dir}/b", 0, ["d"])
    write_batch(df, f"{tmp_dir}/b", 1, ["d"])
    write_batch(df.limit(2), f"{tmp_dir}/b", 1, ["d"])  # replay of batch 1 with other content
    got = {r.batch_id: r.n for r in read_table(spark, f"{tmp_dir}/b").groupBy("batch_id").agg(F.count("*").alias("n")).collect()}
    assert got == {0: 5, 1: 2}
