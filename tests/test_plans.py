"""Physical-plan checks: pushdown and pruning, shuffle counts, top-k limits, no Python."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from callsight.operators import calls as C
from callsight.operators import fees as FE
from callsight.plans import fixtures as FX
from callsight.plans import registry as R
from callsight.schemas import TRANSFER_CODES
from callsight.sources.tables import read_transfers
from paths import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def shuffles(p: str) -> int:
    return len(re.findall(r"^\(\d+\) Exchange\b", p, flags=re.M))


def nodes(p: str) -> dict[int, str]:
    """Node id -> detail text of a formatted plan (ids count up from the scans)."""
    parts = re.split(r"^\((\d+)\) ", p, flags=re.M)
    return {int(parts[i]): parts[i + 1] for i in range(1, len(parts) - 1, 2)}


@pytest.fixture(scope="module")
def stored_log(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log"))
    FX.transfers(spark, SF_SMALL).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_summary_pushes_filters_prunes_columns_one_shuffle(stored_log):
    p = plan(FE.fee_summary(stored_log, *R.WINDOW_MS))
    pushed = re.search(r"PushedFilters: \[(.*)\]", p).group(1)
    for needle in (
        "GreaterThanOrEqual(CUST_LOCAL_ENTRY_DATE,852076800000)",
        "LessThan(CUST_LOCAL_ENTRY_DATE,883612800000)",
        "EqualTo(ERROR_TYPE,0)",
        "In(TRANSFER_TYPE, [0,1])",
    ):
        assert needle in pushed, pushed
    read = re.search(r"ReadSchema: struct<(.*)>", p).group(1)
    cols = sorted(c.split(":")[0] for c in read.split(","))
    assert cols == sorted(
        ["CUST_LOCAL_ENTRY_DATE", "ERROR_TYPE", "TRANSFER_TYPE", "PAY_TYPE", "HANDLING_CHARGE", "EXT_TRANS_ID"]
    )
    assert shuffles(p) == 1
    assert "partial_count" in p and "partial_sum" in p  # map-side combine before the shuffle


def test_exceptions_have_no_shuffle_and_skip_null_charges(stored_log):
    p = plan(FE.fee_exceptions(stored_log, *R.WINDOW_MS))
    assert shuffles(p) == 0
    assert "IsNotNull(HANDLING_CHARGE)" in re.search(r"PushedFilters: \[(.*)\]", p).group(1)


def test_top_k_cut_before_the_shuffle(spark):
    p = plan(R.top_caller_per_day(spark, SF_SMALL))
    partial = p.index("row_number(), 1, Partial")
    final = p.index("row_number(), 1, Final")
    assert partial > 0 and final > 0
    # the exchange on event_date sits between the partial and final limits
    ex = [m.start() for m in re.finditer(r"hashpartitioning\(event_date#\d+, \d+\)", p)]
    assert any(final < x < partial or partial < x < final for x in ex)


def test_detections_filter_profile_rows_before_merging(spark):
    moc = C.outgoing(FX.cdr(spark, SF_SMALL))
    det = C.detections(C.daily_totals(C.hourly_counts(moc)), C.profile_partials(moc))
    p = plan(det)
    assert "BroadcastHashJoin LeftSemi" in p or "Join type: LeftSemi" in p
    # the semi-join is applied to raw rows, below the partial (map-side) profile merge
    n = nodes(p)
    semi = [i for i, t in n.items() if "Join type: LeftSemi" in t]
    merge = [i for i, t in n.items() if "partial_min(event_ts" in t]
    assert semi and merge and max(semi) < min(merge)


def test_profiles_sort_no_raw_rows(spark, tmp_path_factory):
    """The first aggregate over raw rows is a hash aggregate; only what is left after it
    is sorted for the samples."""
    path = str(tmp_path_factory.mktemp("cdr"))
    FX.cdr(spark, SF_SMALL).write.mode("overwrite").parquet(path)
    n = nodes(plan(C.profile_partials(C.outgoing(spark.read.parquet(path)))))
    raw = [i for i, t in n.items() if "partial_max(event_ts" in t]
    assert raw and all(n[i].startswith("HashAggregate") for i in raw)
    assert min(i for i, t in n.items() if t.startswith("Sort")) > max(raw)


def test_text_codes_are_pushed_to_the_scan(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("text-log"))
    log = FX.transfers(spark, SF_SMALL)
    log.withColumns({c: F.col(c).cast("string") for c in TRANSFER_CODES}).write.mode("overwrite").parquet(path)
    for df in (FE.fee_summary, FE.fee_exceptions):
        pushed = re.search(r"PushedFilters: \[(.*)\]", plan(df(read_transfers(spark, path, codes="text"), *R.WINDOW_MS))).group(1)
        assert "EqualTo(ERROR_TYPE,0)" in pushed and "In(TRANSFER_TYPE, [0,1])" in pushed, pushed


def test_winner_join_is_chosen_by_size(spark):
    moc = C.outgoing(FX.cdr(spark, SF_SMALL))
    det = C.detections(C.daily_totals(C.hourly_counts(moc)), C.profile_partials(moc))
    hints = det._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in hints and "UnresolvedHint" not in hints


BATCH_QUERIES = [n for n in R.QUERIES if not n.startswith(("stream_", "sink_"))]


@pytest.mark.parametrize("name", BATCH_QUERIES)
def test_no_python_in_plans(spark, name):
    p = plan(R.QUERIES[name](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in p
