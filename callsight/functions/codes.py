"""Code maps and the handling-fee classifier, as CASE expressions built from tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: code tables of the transfer log --------------------------------
PAY_TYPES = {0: "prepaid", 1: "postpaid", 2: "hybrid"}
TRANSFER_FLOWS = {0: "incoming", 1: "outgoing"}
LOCAL = "local"
INTERNATIONAL = "international"

# --- fixed values: expected fee in currency units, per (transfer type, flow) --------
# ``None`` as flow means "any flow". Charges are stored in 1/10000 of the unit.
FEE_UNIT = 10000.0
EXPECTED_FEE = [
    (LOCAL, "outgoing", 0.5),
    (INTERNATIONAL, None, 0.0),
    (LOCAL, "incoming", 0.0),
]


@dataclass(frozen=True)
class FeeLabels:
    equal: str
    over: str
    under: str


# --- fixed values: label texts of the two reports ----------------------------------
SUMMARY_LABELS = FeeLabels("Correct applied fee", "Over charged fee", "Under charged fee")
EXCEPTION_LABELS = FeeLabels("Correct charge", "Over charge", "Under charge")


def as_code(c: Column, dtype: T.DataType) -> Column:
    """A code column as bigint. Text codes go through ``try_cast`` so a malformed
    code becomes NULL (and drops out of equality filters) instead of failing."""
    if isinstance(dtype, T.StringType):
        return c.try_cast("bigint")
    return c


def code_label(code: Column, table: dict[int, str]) -> Column:
    """CASE code WHEN k THEN label ... ELSE NULL."""
    out = None
    for k, label in table.items():
        out = F.when(code == F.lit(k), F.lit(label)) if out is None else out.when(code == F.lit(k), F.lit(label))
    return out.otherwise(F.lit(None).cast("string"))


def transfer_type(ext_trans_id: Column) -> Column:
    """No external transaction id means an international transfer."""
    return F.when(ext_trans_id.isNull(), F.lit(INTERNATIONAL)).otherwise(F.lit(LOCAL))


def expected_fee(ttype: Column, flow: Column) -> Column:
    out = None
    for t, f, fee in EXPECTED_FEE:
        cond = ttype == F.lit(t)
        if f is not None:
            cond = cond & (flow == F.lit(f))
        out = F.when(cond, F.lit(fee)) if out is None else out.when(cond, F.lit(fee))
    return out


def fee_sign(ttype: Column, flow: Column, fee: Column) -> Column:
    """``signum(fee - expected)``: -1.0 under, 0.0 exact, 1.0 over; NULL when the fee
    or the expected fee is unknown. For finite doubles the sign of the difference
    is exactly the order of the two values.

    One expression instead of three comparisons keeps the generated code small when
    the type and flow are themselves derived columns that Catalyst inlines.
    """
    return F.signum(fee - expected_fee(ttype, flow))


def sign_label(sign: Column, labels: FeeLabels) -> Column:
    return (
        F.when(sign == F.lit(0.0), F.lit(labels.equal))
        .when(sign > F.lit(0.0), F.lit(labels.over))
        .when(sign < F.lit(0.0), F.lit(labels.under))
        .otherwise(F.lit(None).cast("string"))
    )


def classify_fee(ttype: Column, flow: Column, fee: Column, labels: FeeLabels) -> Column:
    """Label a fee against the expected fee of its (type, flow).

    The label depends only on the sign of ``fee - expected``; a NULL fee or a
    (type, flow) with no expected fee gives NULL.
    """
    return sign_label(fee_sign(ttype, flow, fee), labels)
