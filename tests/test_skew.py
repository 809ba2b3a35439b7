"""Hot keys: one number with a third of all calls, NULL numbers with another third.
Results must stay exact (checked against DuckDB on the same rows) and the plans must
combine map-side before every shuffle."""

import duckdb
from pyspark.sql import functions as F

from callsight.operators import calls as C
from callsight.plans import fixtures as FX
from paths import SF_SMALL
from test_plans import plan


def skewed_cdr(spark):
    base = FX.cdr(spark, SF_SMALL).withColumn("_id", F.monotonically_increasing_id())
    hot = F.when(F.col("_id") % 3 == 0, F.lit("42")).when(F.col("_id") % 3 == 1, F.lit(None))
    return base.withColumn("served_phone_number", hot.otherwise(F.col("served_phone_number"))).drop("_id")


def test_hot_keys_exact_and_combined_map_side(spark, tmp_dir):
    path = f"{tmp_dir}/cdr"
    skewed_cdr(spark).write.parquet(path)
    cdr = spark.read.parquet(path)
    moc = C.outgoing(cdr)
    daily = C.daily_totals(C.hourly_counts(moc))
    det = C.detections(daily, C.profile_partials(moc))

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute(
        f"CREATE VIEW moc AS SELECT xdr_start_datetime AS ts, CAST(xdr_start_datetime AS DATE) AS d, "
        f"served_phone_number AS n, served_imsi, served_imei FROM read_parquet('{path}/*.parquet') "
        "WHERE xdr_type = 'MOC' AND xdr_start_datetime IS NOT NULL"
    )
    want_daily = con.execute("SELECT d, n, count(*) FROM moc GROUP BY ALL").fetchall()
    got_daily = [(r.event_date, r.msisdn, r.daily_outgoing_calls) for r in daily.collect()]
    assert sorted(got_daily, key=str) == sorted(want_daily, key=str)

    want_top = con.execute(
        "SELECT d, n, c FROM (SELECT d, n, count(*) c, row_number() OVER (PARTITION BY d ORDER BY count(*) DESC, "
        "n ASC NULLS LAST) rn FROM moc GROUP BY d, n) WHERE rn = 1"
    ).fetchall()
    got_top = [(r.event_date, r.msisdn, r.daily_outgoing_calls) for r in det.collect()]
    assert sorted(got_top, key=str) == sorted(want_top, key=str)
    hot = [r for r in det.collect() if r.msisdn == "42"]
    assert hot and all(r.imsi is not None for r in hot)

    # every aggregate combines before its exchange; top-k limits before its exchange
    for df in (C.hourly_counts(moc), C.profile_partials(moc), daily):
        p = plan(df)
        assert "partial_" in p and "Exchange" in p
    assert "row_number(), 1, Partial" in plan(C.top_caller_per_day(daily))
