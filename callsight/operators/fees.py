"""Balance-transfer handling-fee checks: the daily summary and the exception list.

Plan shape: one Parquet scan with the window / error / type predicates pushed into it
and only the needed columns read; projections and the classifier fuse into the same
whole-stage-codegen span. The summary adds exactly one shuffle, after a map-side
partial aggregate on five low-cardinality keys, so the exchange carries a few rows per
(task, day) whatever the input size. The exception list has no shuffle at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsight.functions.codes import (
    EXCEPTION_LABELS,
    FEE_UNIT,
    INTERNATIONAL,
    LOCAL,
    PAY_TYPES,
    SUMMARY_LABELS,
    TRANSFER_FLOWS,
    FeeLabels,
    as_code,
    classify_fee,
    code_label,
    fee_sign,
    sign_label,
    transfer_type,
)
from callsight.functions.time import day_date, day_label
from callsight.schemas import TRANSFER_PASSTHROUGH

ENTRY_TIME = "CUST_LOCAL_ENTRY_DATE"
SUMMARY_KEYS = ["date", "pay_type", "transfer_type", "transfer_flow", "charge_status"]


def _code(log: DataFrame, name: str) -> Column:
    return as_code(F.col(name), log.schema[name].dataType)


def _code_in(log: DataFrame, name: str, codes: list[int]) -> Column:
    """Whether a code is one of ``codes``, in a form that is pushed to the scan. Codes
    stored as text are compared as the feed spells them; a spelling such as ``00`` is not
    a code."""
    if isinstance(log.schema[name].dataType, T.StringType):
        return F.col(name).isin(*map(str, codes))
    return F.col(name).isin(*codes)


def in_window(df: DataFrame, start_ms: int, end_ms: int, ts_col: str = ENTRY_TIME) -> DataFrame:
    """Half-open ``start_ms <= ts < end_ms`` on an epoch-ms column (pushed to the scan)."""
    ts = F.col(ts_col)
    return df.filter((ts >= F.lit(start_ms)) & (ts < F.lit(end_ms)))


def valid_transfers(log: DataFrame, start_ms: int, end_ms: int) -> DataFrame:
    """Transfers in the window, without error, of a known flow (incoming/outgoing)."""
    return in_window(log, start_ms, end_ms).filter(_code_in(log, "ERROR_TYPE", [0]) & _code_in(log, "TRANSFER_TYPE", list(TRANSFER_FLOWS)))


def _label_columns(log: DataFrame) -> dict[str, Column]:
    return {
        "date": day_label(ENTRY_TIME),
        "pay_type": code_label(_code(log, "PAY_TYPE"), PAY_TYPES),
        "transfer_type": transfer_type(F.col("EXT_TRANS_ID")),
        "transfer_flow": code_label(_code(log, "TRANSFER_TYPE"), TRANSFER_FLOWS),
    }


def fee_amount(charge: str | Column = "HANDLING_CHARGE") -> Column:
    """Charge in currency units (double); NULL stays NULL."""
    c = F.col(charge) if isinstance(charge, str) else charge
    return c / F.lit(FEE_UNIT)


def label_transfers(valid: DataFrame) -> DataFrame:
    """date, pay_type, HANDLING_CHARGE, transfer_type, transfer_flow."""
    lab = _label_columns(valid)
    return valid.select(
        lab["date"].alias("date"),
        lab["pay_type"].alias("pay_type"),
        F.col("HANDLING_CHARGE"),
        lab["transfer_type"].alias("transfer_type"),
        lab["transfer_flow"].alias("transfer_flow"),
    )


def classify_transfers(labeled: DataFrame, labels: FeeLabels = SUMMARY_LABELS) -> DataFrame:
    """Add ``fee_amount`` and ``charge_status`` to labelled transfers."""
    fee = fee_amount()
    return labeled.withColumns(
        {
            "fee_amount": fee,
            "charge_status": classify_fee(F.col("transfer_type"), F.col("transfer_flow"), fee, labels),
        }
    )


def summarize_fees(classified: DataFrame) -> DataFrame:
    """Count and total charge per (date, pay type, type, flow, status); NULL keys kept."""
    return (
        classified.groupBy(*SUMMARY_KEYS)
        .agg(F.count(F.lit(1)).alias("call_count"), F.sum("HANDLING_CHARGE").alias("total_fee_charge_raw"))
        .select(*SUMMARY_KEYS, "call_count", fee_amount("total_fee_charge_raw").alias("total_fee_charge"))
    )


def fee_summary(log: DataFrame, start_ms: int, end_ms: int) -> DataFrame:
    """Daily handling-fee summary of a transfer log for ``[start_ms, end_ms)``.

    Same result as ``summarize_fees(classify_transfers(label_transfers(valid)))``, but
    grouped on compact fixed-width keys — day as a date, the pay code (NULL when
    unknown), the international flag, the flow code and the fee sign, each one-to-one
    with its label — and labelled after the aggregate. Per input row that leaves
    integer work only; date formatting and label strings are built once per group.
    """
    valid = valid_transfers(log, start_ms, end_ms)
    pay, flow = _code(valid, "PAY_TYPE"), _code(valid, "TRANSFER_TYPE")
    international = F.col("EXT_TRANS_ID").isNull()
    sign = fee_sign(transfer_type(F.col("EXT_TRANS_ID")), code_label(flow, TRANSFER_FLOWS), fee_amount())
    keys = valid.select(
        day_date(ENTRY_TIME).alias("day"),
        F.when(pay.isin(*PAY_TYPES), pay).alias("pay_code"),
        international.alias("international"),
        flow.alias("flow_code"),
        sign.alias("fee_sign"),
        "HANDLING_CHARGE",
    )
    groups = keys.groupBy("day", "pay_code", "international", "flow_code", "fee_sign").agg(
        F.count(F.lit(1)).alias("call_count"), F.sum("HANDLING_CHARGE").alias("total_fee_charge_raw")
    )
    return groups.select(
        F.date_format("day", "yyyy-MM-dd").alias("date"),
        code_label(F.col("pay_code"), PAY_TYPES).alias("pay_type"),
        F.when(F.col("international"), F.lit(INTERNATIONAL)).otherwise(F.lit(LOCAL)).alias("transfer_type"),
        code_label(F.col("flow_code"), TRANSFER_FLOWS).alias("transfer_flow"),
        sign_label(F.col("fee_sign"), SUMMARY_LABELS).alias("charge_status"),
        "call_count",
        fee_amount("total_fee_charge_raw").alias("total_fee_charge"),
    )


def fee_exceptions(
    log: DataFrame,
    start_ms: int,
    end_ms: int,
    keep_source_status: bool = False,
    labels: FeeLabels = EXCEPTION_LABELS,
) -> DataFrame:
    """Every over- or under-charged transfer with its full source record.

    Output: date, pay_type, HANDLING_CHARGE, transfer_type_str, transfer_flow_str and the
    41 pass-through columns, where the source ``STATUS`` is replaced in place by the
    computed ``status``. With ``keep_source_status`` the source value follows it as
    ``source_status``.
    """
    valid = valid_transfers(log, start_ms, end_ms)
    lab = _label_columns(valid)
    sign = fee_sign(lab["transfer_type"], lab["transfer_flow"], fee_amount())
    status = sign_label(sign, labels)
    passthrough: list[Column] = []
    for name in TRANSFER_PASSTHROUGH:
        if name == "STATUS":
            passthrough.append(status.alias("status"))
            if keep_source_status:
                passthrough.append(F.col(name).alias("source_status"))
        else:
            passthrough.append(F.col(name))
    # Over or under charged = a non-zero sign (NULL sign drops out). A NULL charge
    # can never be flagged: saying so lets the scan skip it.
    flagged = valid.filter(F.col("HANDLING_CHARGE").isNotNull() & (sign != F.lit(0.0)))
    return flagged.select(
        lab["date"].alias("date"),
        lab["pay_type"].alias("pay_type"),
        F.col("HANDLING_CHARGE"),
        lab["transfer_type"].alias("transfer_type_str"),
        lab["transfer_flow"].alias("transfer_flow_str"),
        *passthrough,
    )
