"""Schemas of the two input feeds and of the stored intermediate tables."""

from __future__ import annotations

from pyspark.sql import types as T

_TS = T.TimestampType()
_STR = T.StringType()
_INT = T.IntegerType()
_BOOL = T.BooleanType()
_LONG = T.LongType()

# --- fixed values: the call-record (CDR) layout, 42 columns in file order ---------
CDR_COLUMNS: list[tuple[str, T.DataType]] = [
    ("xdr_start_datetime", _TS),
    ("xdr_end_datetime", _TS),
    ("xdr_type", _STR),
    ("xdr_duration", _INT),
    ("billing_start_datetime", _TS),
    ("billing_end_datetime", _TS),
    ("billing_duration", _INT),
    ("call_destination", _STR),
    ("served_phone_number", _STR),
    ("served_country", _STR),
    ("served_operator", _STR),
    ("served_tos", _STR),
    ("served_full_cellid", _STR),
    ("served_imsi", _STR),
    ("served_imei", _STR),
    ("served_type", _STR),
    ("served_classmark2", _STR),
    ("served_classmark3", _STR),
    ("served_ported", _BOOL),
    ("served_ported_from", _STR),
    ("served_inroamer", _BOOL),
    ("other_phone_number", _STR),
    ("other_country", _STR),
    ("other_operator", _STR),
    ("other_tos", _STR),
    ("other_full_cellid", _STR),
    ("other_imsi", _STR),
    ("other_imei", _STR),
    ("other_classmark2", _STR),
    ("other_classmark3", _STR),
    ("other_ported", _BOOL),
    ("other_ported_from", _STR),
    ("called_phone_number", _STR),
    ("called_imsi", _STR),
    ("called_imei", _STR),
    ("calling_phone_number", _STR),
    ("calling_imsi", _STR),
    ("calling_imei", _STR),
    ("protocol_signature", _STR),
    ("filename", _STR),
    ("filename_aggregate", _STR),
    ("record_insertion_datetime", _TS),
]

# --- fixed values: columns the hourly feed does not carry (its layout has 35) -------
CDR_HOURLY_DROPPED = (
    "served_type",
    "served_ported_from",
    "other_full_cellid",
    "other_classmark2",
    "other_classmark3",
    "other_ported",
    "other_ported_from",
)

# --- fixed values: balance-transfer log columns passed through to the audit output ---
TRANSFER_PASSTHROUGH = [
    "TRANSFER_LOG_ID",
    "ACCT_ID",
    "CUST_ID",
    "SUB_ID",
    "PRI_IDENTITY",
    "BATCH_NO",
    "CHANNEL_ID",
    "REASON_CODE",
    "RESULT_CODE",
    "ERROR_TYPE",
    "REQUEST_ACCT_BALANCE_ID",
    "DEST_ACCT_ID",
    "TRANSFER_TYPE",
    "TRANSFER_AMT",
    "TRANSFER_DATE",
    "CUST_LOCAL_TRANSFER_DATE",
    "TRANSFER_TRANS_ID",
    "EXT_TRANS_TYPE",
    "EXT_TRANS_ID",
    "ACCESS_METHOD",
    "DIAMETER_SESSIONID",
    "REVERSAL_TRANS_ID",
    "REVERSAL_REASON_CODE",
    "REVERSAL_DATE",
    "EXT_REF_ID",
    "STATUS",
    "ENTRY_DATE",
    "CUST_LOCAL_ENTRY_DATE",
    "REMARK",
    "OPER_ID",
    "DEPT_ID",
    "BE_ID",
    "BE_CODE",
    "REGION_ID",
    "REGION_CODE",
    "SRC_ACCT_ID",
    "CHG_SPENDING_LIMIT",
    "CHG_PAY_LIMIT",
    "CHG_BALANCE_LIMIT",
    "CHG_FU_LIMIT",
    "LOAN_INFO",
]

# Our typing of the transfer log (the feed itself is read with an inferred schema):
# codes and amounts in the smallest unit are bigint, entry time is epoch milliseconds,
# everything else is text.
TRANSFER_BIGINT = ("ERROR_TYPE", "TRANSFER_TYPE", "PAY_TYPE", "HANDLING_CHARGE", "CUST_LOCAL_ENTRY_DATE")


def _struct(cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


CDR_SCHEMA = _struct(CDR_COLUMNS)
CDR_HOURLY_SCHEMA = _struct([(n, t) for n, t in CDR_COLUMNS if n not in CDR_HOURLY_DROPPED])

TRANSFER_SCHEMA = _struct(
    [(n, _LONG if n in TRANSFER_BIGINT else _STR) for n in TRANSFER_PASSTHROUGH]
    + [("PAY_TYPE", _LONG), ("HANDLING_CHARGE", _LONG)]
)

# The same log from a feed that stores its codes as text.
TRANSFER_CODES = ("ERROR_TYPE", "TRANSFER_TYPE", "PAY_TYPE")
TRANSFER_TEXT_SCHEMA = _struct([(f.name, _STR if f.name in TRANSFER_CODES else f.dataType) for f in TRANSFER_SCHEMA.fields])

# A profile sample keeps the time it was seen, so partial profiles written by
# different micro-batches can be merged exactly (earliest non-null wins).
SAMPLE_TYPE = T.StructType([T.StructField("ts", _TS, True), T.StructField("value", _STR, True)])

HOURLY_SCHEMA = _struct(
    [
        ("event_date", T.DateType()),
        ("event_hour", _TS),
        ("msisdn", _STR),
        ("outgoing_calls_count", _LONG),
    ]
)

PROFILE_SCHEMA = _struct(
    [
        ("msisdn", _STR),
        ("first_seen_on_network", _TS),
        ("last_seen_on_network", _TS),
        ("imsi", _STR),
        ("imei", _STR),
    ]
)

PROFILE_PARTIAL_SCHEMA = _struct(
    [
        ("msisdn", _STR),
        ("first_seen_on_network", _TS),
        ("last_seen_on_network", _TS),
        ("imsi_sample", SAMPLE_TYPE),
        ("imei_sample", SAMPLE_TYPE),
    ]
)
