"""Test inputs derived from the generated tables.

The telecom feeds are not among the generated tables, so a transfer log is derived
from ``lineitem``, call records from ``events`` and recharge file names from ``orders``.
Each column is one SQL expression template, rendered for Spark (``selectExpr``) and
for DuckDB (the oracle), so both engines see the same input rows. The templates use
``{s}`` for the string type, ``{ms}`` for the ship date as epoch ms and ``{ts}`` for
the event time as an instant.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from callsight.schemas import CDR_COLUMNS, TRANSFER_PASSTHROUGH

SPARK = {"s": "string", "ms": "unix_millis(cast(l_shipdate as timestamp))", "ts": "cast(ts as timestamp)"}
DUCK = {"s": "varchar", "ms": "epoch_ms(l_shipdate)", "ts": "ts"}

# Columns that exercise the fee rules; the others are filler derived from keys.
TRANSFER_EXPRS: dict[str, str] = {
    "CUST_LOCAL_ENTRY_DATE": "cast({ms} as bigint)",
    "ERROR_TYPE": "cast(case when l_quantity > 45 then 1 else 0 end as bigint)",
    "TRANSFER_TYPE": "cast(case when l_linestatus = 'O' then 1 when l_suppkey % 20 = 0 then 2 else 0 end as bigint)",
    "PAY_TYPE": "cast((l_linenumber - 1) % 4 as bigint)",
    "HANDLING_CHARGE": (
        "case when l_orderkey % 101 = 0 then cast(null as bigint) "
        "else (cast(round(l_discount * 100) as bigint) - 3) * 2500 end"
    ),
    "EXT_TRANS_ID": "case when l_returnflag = 'N' then cast(null as {s}) else cast(l_orderkey as {s}) end",
    "STATUS": "'S'",
    "TRANSFER_LOG_ID": "cast(l_orderkey * 10 + l_linenumber as {s})",
    "ACCT_ID": "cast(l_partkey as {s})",
    "CUST_ID": "cast(l_suppkey as {s})",
    "SUB_ID": "cast(l_orderkey as {s})",
    "PRI_IDENTITY": "concat('msisdn', cast(l_partkey % 1000 as {s}))",
    "CHANNEL_ID": "cast(l_linenumber as {s})",
    "RESULT_CODE": "'0'",
    "DEST_ACCT_ID": "cast(l_suppkey * 7 as {s})",
    "TRANSFER_AMT": "cast(cast(round(l_extendedprice * 100) as bigint) as {s})",
    "TRANSFER_TRANS_ID": "concat('t', cast(l_orderkey as {s}), '-', cast(l_linenumber as {s}))",
    "ACCESS_METHOD": "l_linestatus",
    "EXT_REF_ID": "l_returnflag",
    "REGION_ID": "cast(l_suppkey % 5 as {s})",
}
TRANSFER_ORDER = TRANSFER_PASSTHROUGH + ["PAY_TYPE", "HANDLING_CHARGE"]

CDR_EXPRS: dict[str, str] = {
    "xdr_start_datetime": "case when event_id % 97 = 0 then cast(null as timestamp) else {ts} end",
    "xdr_type": "case when event_type in ('purchase', 'click') then 'MOC' else 'MTC' end",
    "served_phone_number": "case when event_id % 50 = 0 then cast(null as {s}) else cast(user_id as {s}) end",
    "served_imsi": "case when user_id % 10 = 0 then cast(null as {s}) else concat('imsi', cast(user_id as {s})) end",
    "served_imei": "case when event_id % 5 = 0 then cast(null as {s}) else concat('imei', cast(event_id % 7 as {s})) end",
    "filename": "concat('cdr_', cast(event_id % 12 as {s}))",
}
RECHARGE_EXPRS = {"filename": "concat('rch_', cast(o_orderkey % 20 as {s}))"}


def _render(exprs: dict[str, str], names, dialect: dict[str, str], nulls: dict[str, str]) -> list[str]:
    out = []
    for n in names:
        e = exprs.get(n)
        out.append(f"{e.format(**dialect)} AS {n}" if e else f"cast(null as {nulls[n]}) AS {n}")
    return out


def _spark_type(t: T.DataType) -> str:
    return t.simpleString()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transfer log (43 columns) derived from lineitem."""
    nulls = {n: "string" for n in TRANSFER_ORDER}
    return table(spark, sf_dir, "lineitem").selectExpr(*_render(TRANSFER_EXPRS, TRANSFER_ORDER, SPARK, nulls))


def cdr(spark: SparkSession, sf_dir: str, columns=None) -> DataFrame:
    """Call records (the 42-column layout, or ``columns``) derived from events."""
    cols = [(n, t) for n, t in CDR_COLUMNS if columns is None or n in columns]
    nulls = {n: _spark_type(t) for n, t in cols}
    return table(spark, sf_dir, "events").selectExpr(*_render(CDR_EXPRS, [n for n, _ in cols], SPARK, nulls))


def recharge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*_render(RECHARGE_EXPRS, ["filename"], SPARK, {}))


def write_cdr_files(spark: SparkSession, sf_dir: str, path: str, columns=None) -> str:
    """Land the call records as one folder per ``filename``, the way a feed drops files,
    for the streaming jobs to pick up. A large file is split."""
    cdr(spark, sf_dir, columns).hint("rebalance", "filename").write.mode("overwrite").partitionBy("filename").parquet(path)
    return path


# --- DuckDB renderings (oracle side) -----------------------------------------------
def duck_transfers_cte() -> str:
    nulls = {n: "varchar" for n in TRANSFER_ORDER}
    return "transfers AS (SELECT " + ", ".join(_render(TRANSFER_EXPRS, TRANSFER_ORDER, DUCK, nulls)) + " FROM lineitem)"


def duck_cdr_cte() -> str:
    return "cdr AS (SELECT " + ", ".join(_render(CDR_EXPRS, list(CDR_EXPRS), DUCK, {})) + " FROM events)"


def duck_recharge_cte() -> str:
    return "recharge AS (SELECT " + ", ".join(_render(RECHARGE_EXPRS, ["filename"], DUCK, {})) + " FROM orders)"
