"""Summarise the physical plan of every registered batch query as a Markdown table.

    python tests/plan_summary.py [sf_dir] > PLANS.md

Columns: shuffles (Exchange nodes), broadcasts, map-side partial aggregates, partial
top-k limits, join strategies, scans with their pushed filters. Plans are Spark's
initial adaptive plans (AQE may still coalesce partitions or turn a sort-merge join
into a broadcast at run time).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def explain(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarize(p: str) -> dict[str, str]:
    tree = p.split("\n\n")[0]
    joins = sorted(set(re.findall(r"(\w+Join \w+(?: Build\w+)?)", tree)))
    pushed = [x for x in re.findall(r"^PushedFilters: \[(.*)\]$", p, flags=re.M) if x]
    return {
        "shuffles": str(len(re.findall(r"^\(\d+\) Exchange\b", p, flags=re.M))),
        "broadcasts": str(len(re.findall(r"^\(\d+\) BroadcastExchange\b", p, flags=re.M))),
        "combine before shuffle": combines(tree),
        "partial top-k": str(len(re.findall(r", Partial\n", p))),
        "joins": ", ".join(joins) or "–",
        "scans": str(len(re.findall(r"^\(\d+\) Scan ", p, flags=re.M))),
        "pushed filters": "; ".join(pushed) or "–",
        "python": "yes" if re.search(r"EvalPython|PythonUDF|InPandas", p) else "no",
    }


def combines(tree: str) -> str:
    """Aggregates right below an exchange, by kind: a hash aggregate needs no sort."""
    found = re.findall(r"(?<!Broadcast)Exchange \(\d+\)\n[ :|+-]*(Hash|Sort|ObjectHash)Aggregate", tree)
    return ", ".join(f"{found.count(k)} {k.lower()}" for k in ("Hash", "Sort", "ObjectHash") if k in found) or "0"


def streams(spark, sf_dir: str):
    """(name, scanned columns, pushed filters, exchanges before the callback) of the
    running stream queries."""
    from callsight.plans import fixtures as FX
    from callsight.plans import registry as R
    from callsight.schemas import CDR_HOURLY_SCHEMA, CDR_SCHEMA
    from callsight.session import scratch_path
    from callsight.sources.tables import read_cdr_stream
    from callsight.streaming.jobs import files_stream, hourly_stream, total_stream

    base = scratch_path(spark, "plan-streams")
    FX.cdr(spark, sf_dir).write.parquet(f"{base}/in")
    now = {"availableNow": True}
    src = lambda schema: read_cdr_stream(spark, f"{base}/in", schema=schema, max_files_per_trigger=R.FILES_PER_BATCH)
    started = {
        "hourly_stream": lambda: hourly_stream(src(CDR_HOURLY_SCHEMA), f"{base}/h", f"{base}/p", f"{base}/c1", trigger=now),
        "total_stream (partials)": lambda: total_stream(src(CDR_SCHEMA), f"{base}/t", f"{base}/c2", output="partials", trigger=now),
        "total_stream (complete)": lambda: total_stream(src(CDR_SCHEMA), f"{base}/t2", f"{base}/c3", output="complete", trigger=now),
        "files_stream": lambda: files_stream(src(CDR_SCHEMA), f"{base}/f", f"{base}/c4", trigger=now),
    }
    for name, start in started.items():
        q = start()
        q.awaitTermination()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            q.explain(True)
        p = buf.getvalue().split("== Physical Plan ==")[-1]
        cols = re.search(r"ReadSchema: struct<(.*?)>", p).group(1)
        pushed = re.search(r"PushedFilters: \[(.*?)\]", p).group(1)
        yield name, ", ".join(c.split(":")[0] for c in cols.split(",")), pushed or "–", str(len(re.findall(r"\bExchange\b", p)))


def main(argv) -> None:
    from callsight.plans import registry as R
    from callsight.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session(extra={"spark.sql.maxMetadataStringLength": "4000"})
    cols = ["shuffles", "combine before shuffle", "partial top-k", "broadcasts", "joins", "scans", "pushed filters", "python"]
    print("# Physical plans of the batch queries\n")
    print(f"Generated by `python tests/plan_summary.py {sf_dir}` (Spark {spark.version}, AQE initial plans).\n")
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for name, fn in R.QUERIES.items():
        if name.startswith(("stream_", "sink_")):
            continue
        s = summarize(explain(fn(spark, sf_dir)))
        print(f"| {name} | " + " | ".join(s[c] for c in cols) + " |")
    # the generated feeds are derived columns, which hide pushdown: show stored copies too
    from callsight.operators import calls as C
    from callsight.operators import fees as FE
    from callsight.plans import fixtures as FX
    from callsight.session import materialize

    log = materialize(FX.transfers(spark, sf_dir), "plan-log")
    cdr = materialize(FX.cdr(spark, sf_dir), "plan-cdr")
    stored = {
        "fee_summary (stored log)": FE.fee_summary(log, *R.WINDOW_MS),
        "fee_exceptions (stored log)": FE.fee_exceptions(log, *R.WINDOW_MS),
        "total_moc (stored CDR)": C.total_by_subscriber(cdr),
        "hourly_moc (stored CDR)": C.hourly_counts(C.outgoing(cdr)),
    }
    for name, df in stored.items():
        s = summarize(explain(df))
        print(f"| {name} | " + " | ".join(s[c] for c in cols) + " |")
    print("\n## Running stream queries\n\nPlans of the queries as they ran, up to the `foreachBatch` callback, whose work is that of the batch operators above.\n")
    print("| query | columns scanned | pushed filters | exchanges |\n|---|---|---|---|")
    for row in streams(spark, sf_dir):
        print("| " + " | ".join(row) + " |")


if __name__ == "__main__":
    main(sys.argv[1:])
