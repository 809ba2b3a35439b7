"""Fee classifier branch table, window edges, code handling and report consistency."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsight.functions.codes import EXCEPTION_LABELS, SUMMARY_LABELS
from callsight.functions.time import day_label, day_window, epoch_ms
from callsight.operators import fees as FE
from callsight.schemas import TRANSFER_PASSTHROUGH, TRANSFER_SCHEMA

DAY = 852076800000  # 1997-01-01T00:00:00Z
NEXT = DAY + 86_400_000


def log_rows(spark, rows, schema=TRANSFER_SCHEMA):
    """Transfer-log frame from dicts; unspecified columns are NULL."""
    full = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
    return spark.createDataFrame(full, schema)


def tx(charge, ext="x1", flow=1, pay=0, err=0, ms=DAY + 1000, **kw):
    r = {
        "HANDLING_CHARGE": charge,
        "EXT_TRANS_ID": ext,
        "TRANSFER_TYPE": flow,
        "PAY_TYPE": pay,
        "ERROR_TYPE": err,
        "CUST_LOCAL_ENTRY_DATE": ms,
        "STATUS": "S",
    }
    r.update(kw)
    return r


# (charge, ext id, flow) -> expected summary label; covers all nine branches
BRANCHES = [
    (5000, "x", 1, "Correct applied fee"),  # local outgoing, 0.5
    (5001, "x", 1, "Over charged fee"),
    (4999, "x", 1, "Under charged fee"),
    (0, None, 1, "Correct applied fee"),  # international, either flow
    (1, None, 0, "Over charged fee"),
    (-1, None, 1, "Under charged fee"),
    (0, "x", 0, "Correct applied fee"),  # local incoming, 0.0
    (2500, "x", 0, "Over charged fee"),
    (-2500, "x", 0, "Under charged fee"),
]


def test_nine_branches_and_null_charge(spark):
    rows = [tx(c, ext=e, flow=f, TRANSFER_LOG_ID=str(i)) for i, (c, e, f, _) in enumerate(BRANCHES)]
    rows.append(tx(None, TRANSFER_LOG_ID="null"))
    df = FE.classify_transfers(FE.label_transfers(FE.valid_transfers(log_rows(spark, rows), DAY, NEXT)))
    got = [r.charge_status for r in df.collect()]
    assert got == [b[3] for b in BRANCHES] + [None]


def test_exception_labels_and_filter(spark):
    rows = [tx(c, ext=e, flow=f, TRANSFER_LOG_ID=str(i)) for i, (c, e, f, _) in enumerate(BRANCHES)]
    rows.append(tx(None, TRANSFER_LOG_ID="null"))
    out = FE.fee_exceptions(log_rows(spark, rows), DAY, NEXT)
    assert len(out.columns) == 46
    assert out.columns[:5] == ["date", "pay_type", "HANDLING_CHARGE", "transfer_type_str", "transfer_flow_str"]
    # source STATUS replaced in place by the computed status
    idx = 5 + TRANSFER_PASSTHROUGH.index("STATUS")
    assert out.columns[idx] == "status" and "STATUS" not in out.columns
    got = sorted((r.TRANSFER_LOG_ID, r.status) for r in out.collect())
    want = sorted(
        (str(i), b[3].replace(" charged fee", " charge"))
        for i, b in enumerate(BRANCHES)
        if not b[3].startswith("Correct")
    )
    assert got == want


def test_keep_source_status(spark):
    out = FE.fee_exceptions(log_rows(spark, [tx(9999)]), DAY, NEXT, keep_source_status=True)
    r = out.collect()[0]
    assert (r.status, r.source_status) == ("Over charge", "S")
    assert out.columns.index("source_status") == out.columns.index("status") + 1


def test_filters_window_edges_errors_unknown_codes(spark):
    rows = [
        tx(5000, ms=DAY, TRANSFER_LOG_ID="start"),  # kept
        tx(5000, ms=NEXT - 1, TRANSFER_LOG_ID="last"),  # kept
        tx(5000, ms=NEXT, TRANSFER_LOG_ID="end"),  # dropped
        tx(5000, ms=DAY - 1, TRANSFER_LOG_ID="before"),  # dropped
        tx(5000, err=1, TRANSFER_LOG_ID="error"),  # dropped
        tx(5000, flow=2, TRANSFER_LOG_ID="flow2"),  # dropped
        tx(5000, pay=3, TRANSFER_LOG_ID="pay3"),  # kept, pay_type NULL
        tx(5000, pay=None, TRANSFER_LOG_ID="paynull"),  # kept, pay_type NULL
    ]
    v = FE.valid_transfers(log_rows(spark, rows), DAY, NEXT)
    assert sorted(r.TRANSFER_LOG_ID for r in v.collect()) == ["last", "pay3", "paynull", "start"]
    lab = {r.pay_type for r in FE.label_transfers(v).collect()}
    assert lab == {"prepaid", None}


def test_string_codes_bad_values_drop(spark):
    """Text-typed codes are compared as numbers; a malformed code drops out."""
    schema = T.StructType(
        [
            T.StructField(f.name, T.StringType() if f.name in ("ERROR_TYPE", "TRANSFER_TYPE", "PAY_TYPE") else f.dataType)
            for f in TRANSFER_SCHEMA.fields
        ]
    )
    rows = [
        tx(5000, err="0", flow="1", pay="1", TRANSFER_LOG_ID="ok"),
        tx(5000, err="zz", flow="1", pay="1", TRANSFER_LOG_ID="bad_err"),
        tx(5000, err="0", flow="q", pay="1", TRANSFER_LOG_ID="bad_flow"),
        tx(5000, err="0", flow="0", pay="x", TRANSFER_LOG_ID="bad_pay"),
    ]
    out = FE.classify_transfers(FE.label_transfers(FE.valid_transfers(log_rows(spark, rows, schema), DAY, NEXT)))
    got = sorted(((r.pay_type, r.transfer_flow) for r in out.collect()), key=str)
    assert got == sorted([(None, "incoming"), ("postpaid", "outgoing")], key=str)


def test_day_label_truncates_toward_zero(spark):
    df = spark.createDataFrame([(-500,), (0,), (DAY - 1,), (DAY,)], "ms bigint")
    got = [r.d for r in df.select(day_label("ms").alias("d")).collect()]
    assert got == ["1970-01-01", "1970-01-01", "1996-12-31", "1997-01-01"]


def test_window_bounds_follow_session_zone(spark):
    assert day_window(spark, "1997-01-01") == (DAY, NEXT)
    assert epoch_ms(spark, dt.date(1997, 1, 1)) == DAY
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        s, e = day_window(spark, "1997-01-01")
        assert (s, e) == (DAY - 19_800_000, NEXT - 19_800_000)
        # the label of the window start is that same day in that zone
        lab = spark.range(1).select(day_label(F.lit(s)).alias("d")).first().d
        assert lab == "1997-01-01"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_summary_matches_exceptions_and_row_counts(spark):
    rows = []
    for i in range(60):
        rows.append(tx((i % 9 - 4) * 1250, ext=None if i % 4 == 0 else "e", flow=i % 2, pay=i % 4, TRANSFER_LOG_ID=str(i)))
    rows.append(tx(None, TRANSFER_LOG_ID="n"))
    log = log_rows(spark, rows)
    summ = FE.fee_summary(log, DAY, NEXT).collect()
    exc = FE.fee_exceptions(log, DAY, NEXT).count()
    assert sum(r.call_count for r in summ) == FE.valid_transfers(log, DAY, NEXT).count()
    flagged = sum(r.call_count for r in summ if r.charge_status in (SUMMARY_LABELS.over, SUMMARY_LABELS.under))
    assert flagged == exc
    total = sum(r.total_fee_charge or 0 for r in summ)
    assert abs(total - sum((r["HANDLING_CHARGE"] or 0) for r in rows) / 10000.0) < 1e-9


@settings(max_examples=10, deadline=None)
@given(
    st.lists(
        st.tuples(st.integers(-20000, 20000), st.booleans(), st.sampled_from([0, 1])),
        min_size=1,
        max_size=30,
    )
)
def test_label_depends_only_on_sign(spark, cases):
    rows = [tx(c, ext=None if intl else "e", flow=f, TRANSFER_LOG_ID=str(i)) for i, (c, intl, f) in enumerate(cases)]
    out = FE.fee_exceptions(log_rows(spark, rows), DAY, NEXT, keep_source_status=True)
    got = {r.TRANSFER_LOG_ID: r.status for r in out.collect()}
    for i, (c, intl, f) in enumerate(cases):
        expected = 0.0 if intl or f == 0 else 0.5
        fee = c / 10000.0
        want = EXCEPTION_LABELS.over if fee > expected else EXCEPTION_LABELS.under if fee < expected else None
        assert got.get(str(i)) == want



@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(-(10**13), 10**13), min_size=1, max_size=40))
def test_day_date_formats_to_day_label(spark, values):
    from callsight.functions.time import day_date

    df = spark.createDataFrame([(v,) for v in values + [-500, -1000, -1001, 0]], "ms bigint")
    out = df.select(day_label("ms").alias("a"), F.date_format(day_date("ms"), "yyyy-MM-dd").alias("b")).collect()
    assert all(r.a == r.b for r in out)


def test_compact_summary_equals_label_first_summary(spark):
    from callsight.plans import fixtures as FX
    from paths import SF_SMALL

    rows = [tx((i % 9 - 4) * 1250, ext=None if i % 4 == 0 else "e", flow=i % 2, pay=i % 5, TRANSFER_LOG_ID=str(i)) for i in range(40)]
    rows += [tx(None, pay=None, TRANSFER_LOG_ID="n"), tx(5000, pay=7, ms=DAY - 86_400_000 + 5)]
    for log in (log_rows(spark, rows), FX.transfers(spark, SF_SMALL)):
        fast = FE.fee_summary(log, 0, 4102444800000)
        slow = FE.summarize_fees(FE.classify_transfers(FE.label_transfers(FE.valid_transfers(log, 0, 4102444800000))))
        assert fast.columns == slow.columns
        assert sorted(map(str, fast.collect())) == sorted(map(str, slow.collect()))


@settings(max_examples=8, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.one_of(st.none(), st.integers(-3, 3).map(lambda x: x * 2500)),
            st.booleans(),
            st.sampled_from([0, 1, 2, None]),
            st.sampled_from([0, 1, 2, 3, None]),
            st.integers(0, 3 * 86_400_000),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_compact_summary_property(spark, cases):
    rows = [
        tx(c, ext=None if intl else "e", flow=f, pay=p, ms=DAY + off, TRANSFER_LOG_ID=str(i))
        for i, (c, intl, f, p, off) in enumerate(cases)
    ]
    log = log_rows(spark, rows)
    end = DAY + 3 * 86_400_000
    fast = FE.fee_summary(log, DAY, end)
    slow = FE.summarize_fees(FE.classify_transfers(FE.label_transfers(FE.valid_transfers(log, DAY, end))))
    assert sorted(map(str, fast.collect())) == sorted(map(str, slow.collect()))
