"""Ranks inside groups without putting a group into one task.

Rows are dealt by a range of (group, order keys), so a hot group spreads over as many
tasks as its share of the rows needs. Each task numbers its own rows; the numbers are
kept in a written table, and a second, small table (one row per task and group) has how
many rows of the group lie in the tasks before. Ranks are the sum of both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callsight.session import materialize

_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def ranked(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str, deal: Sequence[Column] | None = None, forget: Sequence[str] = ()
) -> DataFrame:
    """``df`` with column ``name``: the row's rank (from 0) by ``order`` among the rows
    with the same values, null included, in ``group``. Rows equal in all order keys are
    ranked in any order.

    Spark samples the keys that rows are dealt by and sends the sample to the driver. Where
    an order key may be long, ``deal`` names short ones that never contradict ``order``
    (such as the front of a text); rows equal in them meet in one task. Columns to
    ``forget`` are needed for the order alone and not written."""
    group_keys = [F.col(c) for c in group]
    placed = df.repartitionByRange(*group_keys, *(order if deal is None else deal)).sortWithinPartitions(*group_keys, *order)
    df = df.drop(*forget)
    placed = materialize(placed.drop(*forget).withColumn("__at", F.monotonically_increasing_id()), "ranked")
    task = F.shiftright("__at", _BITS)
    row = F.col("__at").bitwiseAND(F.lit((1 << _BITS) - 1))
    counts = placed.groupBy(task.alias("__task"), *group_keys).agg(F.count(F.lit(1)).alias("__n"), F.min(row).alias("__first"))
    before = Window.partitionBy(*group).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    # written, so that Spark knows its true size when it chooses the join
    starts = materialize(starts.select("__task", "__first", "__before", *[F.col(c).alias(f"__g{i}") for i, c in enumerate(group)]), "starts")
    same = task == F.col("__task")
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"__g{i}"))
    joined = placed.join(starts, same)
    return joined.select(*df.columns, (F.col("__before") + row - F.col("__first")).alias(name))
