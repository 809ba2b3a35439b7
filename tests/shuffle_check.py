"""Measure shuffle volume under hot keys from Spark's event log (own process).

    python tests/shuffle_check.py [rows]

Builds outgoing calls where one number holds a third of all rows and NULL another
third, runs the hourly count, the profile partials and the top caller per day, and
sums the shuffle records written per query from the event log (written to a fresh
scratch folder). Also takes the best 5000 numbers of a day that has almost all rows, more than
Spark cuts groups to by itself. Prints one JSON line; exits non-zero if a hot key was not
combined before its shuffle (more shuffle records than map tasks x distinct keys), or if a
task read most of the hot day.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

MAP_TASKS = 8
COLD_KEYS = 1000
FILES = 12
TOP = 5000


def main(argv) -> int:
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from callsight.operators import calls as C

    rows = int(argv[0]) if argv else 2_000_000
    log_dir = tempfile.mkdtemp(prefix="callsight-eventlog-")
    spark = (
        SparkSession.builder.master("local[4]")
        .appName("callsight-shuffle-check")
        .config("spark.ui.enabled", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", log_dir)
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.rolling.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ids = spark.range(0, rows, numPartitions=MAP_TASKS)
    number = (
        F.when(F.col("id") % 3 == 0, F.lit("42"))
        .when(F.col("id") % 3 == 1, F.lit(None).cast("string"))
        .otherwise((F.col("id") % COLD_KEYS).cast("string"))
    )
    moc = ids.select(
        F.to_date(F.lit("2024-01-01")).alias("event_date"),
        F.to_timestamp(F.lit("2024-01-01 10:00:00")).alias("event_hour"),
        (F.to_timestamp(F.lit("2024-01-01 10:00:00")) + F.make_interval(secs=F.col("id") % 3600)).alias("event_ts"),
        number.alias("msisdn"),
        F.concat(F.lit("imsi"), (F.col("id") % 7).cast("string")).alias("served_imsi"),
        F.concat(F.lit("imei"), (F.col("id") % 5).cast("string")).alias("served_imei"),
        F.concat(F.lit("file"), (F.col("id") % FILES).cast("string")).alias("filename"),
    )
    hot_day = ids.select(
        F.when(F.col("id") % 50 == 0, F.to_date(F.lit("2024-01-02"))).otherwise(F.to_date(F.lit("2024-01-01"))).alias("event_date"),
        F.col("id").cast("string").alias("msisdn"),
        F.xxhash64("id").bitwiseAND(F.lit(0xFFFF)).alias("daily_outgoing_calls"),
    )
    jobs = {
        "top_of_hot_day": C.top_caller_per_day(hot_day, k=TOP),
        "hourly_counts": C.hourly_counts(moc),
        "profile_partials": C.profile_partials(moc),
        "distinct_files": C.distinct_files(moc),
        "top_caller_per_day": C.top_caller_per_day(C.daily_totals(C.hourly_counts(moc))),
    }
    for name, df in jobs.items():
        spark.sparkContext.setJobGroup(name, name)
        df.write.format("noop").mode("overwrite").save()
    spark.stop()

    written: dict[str, int] = {}
    largest: dict[str, int] = {}
    group_of_job: dict[int, str] = {}
    job_of_stage: dict[int, int] = {}
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    group_of_job[ev["Job ID"]] = group
                    for sid in ev.get("Stage IDs", []):
                        job_of_stage[sid] = ev["Job ID"]
                elif kind == "SparkListenerTaskEnd":
                    metrics = ev.get("Task Metrics") or {}
                    m, read = metrics.get("Shuffle Write Metrics") or {}, metrics.get("Shuffle Read Metrics") or {}
                    group = group_of_job.get(job_of_stage.get(ev["Stage ID"]))
                    if group:
                        largest[group] = max(largest.get(group, 0), int(read.get("Total Records Read", 0)))
                        written[group] = written.get(group, 0) + int(m.get("Shuffle Records Written", 0))
    # numbers, each with up to 7 IMSIs and 5 IMEIs where the profile keeps them apart
    bound = MAP_TASKS * (COLD_KEYS + 2)  # every map task may emit each distinct key once
    print(json.dumps({"input_rows": rows, "shuffle_records": written, "bound_per_shuffle": bound, "files_bound": MAP_TASKS * FILES, "largest_task_read": largest}))
    # every row crosses the first shuffle, at most the best of each salted part the second
    limits = {"top_of_hot_day": rows + 2 * 32 * TOP, "profile_partials": 36 * bound, "distinct_files": MAP_TASKS * FILES}
    ok = largest["top_of_hot_day"] <= max(rows // 3, 32 * TOP + rows // 50)
    ok = ok and all(v <= limits.get(k, 3 * bound) for k, v in written.items()) and set(written) == set(jobs)
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
