"""Command-line jobs for ``spark-submit``; every setting is an argument.

    spark-submit --py-files callsight.zip callsight/jobs.py fee-summary \\
        --log s3://…/transfers --day 2025-11-26 --out s3://…/fee_summary --replace-dates
    python -m callsight.jobs hourly-stream --input s3://…/cdr --hourly … --profiles … \\
        --checkpoint s3://…/ckpt/hourly

Jobs: ``fee-summary``, ``fee-exceptions``, ``total-stream``, ``hourly-stream``,
``hourly-window-stream``, ``files-stream``, ``top-callers`` (one run of the detection rule;
schedule it externally), ``compact-hourly``, ``compact-totals`` and ``compact-profiles``, each of
which also removes old folds with ``--keep``, and folded partials with ``--expire-partials``. The session comes from ``SparkSession.builder.getOrCreate()``, so
cluster settings are the submitter's.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from callsight.functions.time import day_window
from callsight.operators import calls as C
from callsight.operators import fees as FE
from callsight.schemas import CDR_HOURLY_SCHEMA, CDR_SCHEMA
from callsight.session import scratch
from callsight.sinks import FILE_FORMATS, append_summary, overwrite, write_if_any
from callsight.sources.tables import read_cdr_stream, read_transfers
from callsight.streaming.jobs import files_stream, hourly_stream, hourly_window_stream, total_stream
from callsight.streaming.snapshots import (
    HOURLY,
    PROFILES,
    TOTALS,
    compact_hourly,
    compact_profiles,
    compact_totals,
    current_hourly,
    current_profile_partials,
    expire_folds,
    expire_partials,
    last_whole_batch,
)


def _options(pairs: list[str] | None) -> dict[str, str] | None:
    """``["k=v", ...]`` → ``{"k": "v"}`` (connector options such as database, collection)."""
    if not pairs:
        return None
    return dict(p.split("=", 1) for p in pairs)


def _out(a) -> str | None:
    """Output path; document stores are named by their options instead."""
    return None if a.out in ("", "-") else a.out


def _window(spark, a):
    return day_window(spark, a.day, a.end_day)


def fee_summary_job(spark, a) -> None:
    summary = FE.fee_summary(read_transfers(spark, a.log, a.input_format, a.codes), *_window(spark, a))
    if a.format in FILE_FORMATS:
        append_summary(summary, a.out, fmt=a.format, replace_dates=a.replace_dates)
    else:  # document store: plain append through the connector
        w = summary.write.format(a.format).mode("append").options(**(_options(a.out_option) or {}))
        w.save() if _out(a) is None else w.save(_out(a))


def fee_exceptions_job(spark, a) -> None:
    flagged = FE.fee_exceptions(read_transfers(spark, a.log, a.input_format, a.codes), *_window(spark, a), a.keep_source_status)
    def append(df):
        w = df.write.format(a.format).mode("append").options(**(_options(a.out_option) or {}))
        w.save() if _out(a) is None else w.save(_out(a))

    wrote = write_if_any(flagged, append)
    if not wrote:
        print("no over- or under-charged transfer in the window; nothing written")


def _trigger(a) -> dict | None:
    if a.available_now:
        return {"availableNow": True}
    return {"processingTime": a.every} if a.every else None


def total_stream_job(spark, a) -> None:
    src = read_cdr_stream(spark, a.input, CDR_SCHEMA, a.files_per_trigger)
    q = total_stream(
        src, _out(a), a.checkpoint, key=a.key, fmt=a.format, options=_options(a.out_option),
        output=a.output, trigger=_trigger(a),
    )
    q.awaitTermination()


def hourly_stream_job(spark, a) -> None:
    src = read_cdr_stream(spark, a.input, CDR_HOURLY_SCHEMA, a.files_per_trigger)
    q = hourly_stream(
        src, a.hourly, None if a.profiles in ("", "-") else a.profiles, a.checkpoint, fmt=a.format, key=a.key,
        profile_fmt=a.profiles_format, profile_options=_options(a.profiles_option), trigger=_trigger(a),
    )
    q.awaitTermination()


def hourly_window_stream_job(spark, a) -> None:
    src = read_cdr_stream(spark, a.input, CDR_HOURLY_SCHEMA, a.files_per_trigger)
    q = hourly_window_stream(src, a.hourly, a.checkpoint, delay=a.delay, key=a.key, offset=a.offset, fmt=a.format, trigger=_trigger(a))
    q.awaitTermination()


def files_stream_job(spark, a) -> None:
    src = read_cdr_stream(spark, a.input, CDR_SCHEMA, a.files_per_trigger)
    q = files_stream(src, a.out, a.checkpoint, column=a.key, fmt=a.format, trigger=_trigger(a))
    q.awaitTermination()


def top_callers_job(spark, a) -> None:
    upto = last_whole_batch(spark, checkpoint=a.checkpoint)  # one bound for counts and profiles
    hourly = current_hourly(spark, a.hourly, a.folded, a.format, missing_ok=a.nothing_folded, upto=upto)
    partials = current_profile_partials(
        spark, None if a.profiles in ("", "-") else a.profiles, a.snapshots, a.profiles_format or a.format,
        options=_options(a.profiles_option), missing_ok=a.nothing_folded, upto=upto,
    )
    with scratch(spark, "top-callers"):
        found = C.detections(C.daily_totals(hourly, a.start_date, a.end_date), partials, k=a.k, ties=a.ties)
        overwrite(found, _out(a), fmt=a.out_format, options=_options(a.out_option))


def _fold(compact, spec, source: str, target: str, what: str):
    def job(spark, a) -> None:
        parts, folded = getattr(a, source), getattr(a, target)
        before = spec.table(spark, folded).manifest()
        upto = compact(spark, parts, folded, upto=a.upto, checkpoint=a.checkpoint, fmt=a.format, first=a.first)
        print(f"{what} folded up to batch {upto}")
        if a.keep:
            print(f"{expire_folds(spark, spec, folded, a.keep)} parts of older folds removed")
        if a.expire_partials and before is not None:  # readers of the fold before still need what came after it
            print(f"{expire_partials(spark, spec, parts, folded, before.n)} folders of folded batches removed")

    return job


compact_hourly_job = _fold(compact_hourly, HOURLY, "hourly", "folded", "hourly counts")
compact_totals_job = _fold(compact_totals, TOTALS, "totals", "folded", "running totals")
compact_profiles_job = _fold(compact_profiles, PROFILES, "profiles", "snapshots", "profiles")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="callsight.jobs", description=__doc__.split("\n")[0])
    sub = p.add_subparsers(dest="job", required=True)

    def fee(name, fn, help_):
        s = sub.add_parser(name, help=help_)
        s.add_argument("--log", required=True, help="transfer-log folder")
        s.add_argument("--day", required=True, help="first day (session time zone), e.g. 2025-11-26")
        s.add_argument("--end-day", help="day after the last one; default: day + 1")
        s.add_argument("--out", required=True, help="output path ('-' for a document store)")
        s.add_argument("--format", default="parquet", help="output format")
        s.add_argument("--out-option", action="append", metavar="KEY=VALUE", help="connector option, repeatable")
        s.add_argument("--input-format", default="parquet")
        s.add_argument("--codes", choices=["int", "text", "infer"], default="int", help="how the log stores its codes")
        s.set_defaults(fn=fn)
        return s

    fee("fee-summary", fee_summary_job, "daily handling-fee summary").add_argument(
        "--replace-dates", action="store_true", help="replace the days written, instead of appending"
    )
    fee("fee-exceptions", fee_exceptions_job, "over/under-charged transfers").add_argument(
        "--keep-source-status", action="store_true"
    )

    def stream(name, fn, help_, key):
        s = sub.add_parser(name, help=help_)
        s.add_argument("--input", required=True, help="landing folder of CDR parquet files")
        s.add_argument("--checkpoint", required=True)
        s.add_argument("--files-per-trigger", type=int, default=1000)
        s.add_argument("--key", default=key, help="key column (subscriber, or file name for files-stream)")
        s.add_argument("--format", default="parquet")
        s.add_argument("--available-now", action="store_true", help="process what is there, then stop")
        s.add_argument("--every", help="processing-time trigger, e.g. '1 minute'")
        s.set_defaults(fn=fn)
        return s

    t = stream("total-stream", total_stream_job, "running MOC count per subscriber", "served_imsi")
    t.add_argument("--out", required=True, help="output path ('-' for a document store)")
    t.add_argument("--out-option", action="append", metavar="KEY=VALUE", help="connector option, repeatable")
    t.add_argument("--output", choices=["complete", "update", "partials"], default="partials")
    h = stream("hourly-stream", hourly_stream_job, "hourly MOC partials and profile partials", "served_phone_number")
    h.add_argument("--hourly", required=True)
    h.add_argument("--profiles", required=True, help="profile partials path ('-' for a document store)")
    h.add_argument("--profiles-format", help="format of the profile output; default: --format")
    h.add_argument("--profiles-option", action="append", metavar="KEY=VALUE", help="connector option, repeatable")
    w = stream("hourly-window-stream", hourly_window_stream_job, "final hourly MOC counts, each hour once", "served_phone_number")
    w.add_argument("--hourly", required=True)
    w.add_argument("--delay", default="24 hours", help="how late a record may be")
    w.add_argument("--offset", help="start of hours, for time zones that differ by parts of an hour, e.g. '30 minutes'")
    f = stream("files-stream", files_stream_job, "distinct processed file names", "filename")
    f.add_argument("--out", required=True)

    r = sub.add_parser("top-callers", help="top callers per day with profiles, as detections")
    r.add_argument("--hourly", required=True)
    r.add_argument("--profiles", required=True, help="profile partials path ('-' for a store named by --profiles-option)")
    r.add_argument("--snapshots", help="profile snapshot folder (see compact-profiles)")
    r.add_argument("--folded", help="hourly fold folder (see compact-hourly)")
    r.add_argument("--checkpoint", help="the stream's checkpoint: take batches that it has committed, no others")
    r.add_argument("--nothing-folded", action="store_true", help="accept fold folders without a committed fold")
    r.add_argument("--profiles-format", help="format of the stored profiles; default: --format")
    r.add_argument("--profiles-option", action="append", metavar="KEY=VALUE", help="connector option, repeatable")
    r.add_argument("--out", required=True, help="output path ('-' for a document store)")
    r.add_argument("--out-option", action="append", metavar="KEY=VALUE", help="connector option, repeatable")
    r.add_argument("--start-date")
    r.add_argument("--end-date")
    r.add_argument("--k", type=int, default=1)
    r.add_argument("--ties", action="store_true")
    r.add_argument("--format", default="parquet", help="format of the stored tables")
    r.add_argument("--out-format", default="parquet")
    r.set_defaults(fn=top_callers_job)

    for job, source, target, fn, help_ in (
        ("compact-hourly", "--hourly", "--folded", compact_hourly_job, "fold hourly partial counts"),
        ("compact-totals", "--totals", "--folded", compact_totals_job, "fold per-batch running totals (total-stream --output partials)"),
        ("compact-profiles", "--profiles", "--snapshots", compact_profiles_job, "fold profile partials into a snapshot"),
    ):
        c = sub.add_parser(job, help=help_)
        c.add_argument(source, required=True)
        c.add_argument(target, required=True)
        c.add_argument("--upto", type=int, help="last batch to fold")
        c.add_argument("--checkpoint", help="the stream's checkpoint: fold up to its last committed batch")
        c.add_argument("--first", action="store_true", help="there is no fold yet")
        c.add_argument("--keep", type=int, default=0, help="remove all but the newest so many folds (at least 2 where readers are under way); 0: none")
        c.add_argument("--expire-partials", action="store_true", help="remove batches that the fold before this one has")
        c.add_argument("--format", default="parquet", help="format of the partials")
        c.set_defaults(fn=fn)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    a.fn(spark or SparkSession.builder.getOrCreate(), a)


if __name__ == "__main__":
    main(sys.argv[1:])
