from callsight.functions.codes import (
    EXCEPTION_LABELS,
    SUMMARY_LABELS,
    FeeLabels,
    as_code,
    classify_fee,
    code_label,
    expected_fee,
    fee_sign,
    sign_label,
    transfer_type,
)
from callsight.functions.time import day_label, day_window, epoch_ms, event_date, event_hour

__all__ = [
    "EXCEPTION_LABELS",
    "SUMMARY_LABELS",
    "FeeLabels",
    "as_code",
    "classify_fee",
    "code_label",
    "day_label",
    "day_window",
    "epoch_ms",
    "event_date",
    "event_hour",
    "expected_fee",
    "fee_sign",
    "sign_label",
    "transfer_type",
]
