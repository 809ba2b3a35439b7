"""Commit markers: a table or fold counts once a marker for it is complete.

A marker is one small Parquet file in a folder of its own, ``<base>/n=<number>/``. A file
appears whole or not at all, so what a crashed writer left behind has no marker, and
readers never look at it. Finding the newest marker lists file names; no data is read.

Writers :func:`claim` a number before they write, so two at once never share one, and
:func:`expire` old markers after they have marked, so a listing stays as short as the
number of markers kept, however often something was published.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsight.session import create_new, matching, remove


def is_missing(e: AnalysisException) -> bool:
    """Whether a read failed because its path doesn't exist (and for no other reason)."""
    return e.getCondition() == "PATH_NOT_FOUND"


def largest_number(spark: SparkSession, path: str, pattern: str, glob: str) -> int | None:
    """The largest number that ``pattern`` finds in the file names below ``path``; None
    if there is no such file or folder."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    except AnalysisException as e:
        if is_missing(e):
            return None
        raise
    number = F.regexp_extract("path", pattern, 1)
    return files.select(F.when(number != "", number).cast("bigint").alias("n")).agg(F.max("n")).first()[0]


def newest(spark: SparkSession, base: str) -> int | None:
    """Number of the newest complete marker."""
    return largest_number(spark, base, r"/n=([0-9]+)/[^/]+$", "*.parquet")


def claim(spark: SparkSession, base: str) -> int:
    """A number above every marker and every claim there is, for the caller alone. What a
    crashed writer has claimed is passed over."""
    last = newest(spark, base)
    n = 0 if last is None else last + 1
    while not create_new(spark, f"{base}/claims/{n}"):
        n += 1
    return n


def mark(rows: DataFrame, base: str, n: int) -> None:
    """Write marker ``n`` with ``rows`` as its content."""
    rows.coalesce(1).write.mode("append").parquet(f"{base}/n={int(n)}")


def content(spark: SparkSession, base: str, n: int, schema: T.StructType) -> DataFrame:
    """Rows of marker ``n``. Should two jobs have marked the same number, the rows of one
    file, the same for every reader."""
    files = sorted(matching(spark, f"{base}/n={int(n)}/*.parquet"))
    if not files:
        raise FileNotFoundError(f"no marker {n} at {base}")
    return spark.read.schema(schema).parquet(files[0])


def expire(spark: SparkSession, base: str, keep: int, drop: Callable[[list[int], list[int]], None]) -> list[int]:
    """Remove all complete markers but the newest ``keep``, and claims as old as those;
    before that, ``drop(gone, kept)`` gets the numbers of both, to remove what only the old
    ones name. A marker that is not complete is left alone unless newer ones are."""
    numbers = {int(m.group(1)) for p in matching(spark, f"{base}/n=*/*.parquet") if (m := re.search(r"/n=([0-9]+)/[^/]+$", p))}
    complete = sorted(numbers, reverse=True)
    kept, gone = complete[: max(1, keep)], complete[max(1, keep) :]
    if gone:
        drop(gone, kept)
        for path in [*matching(spark, f"{base}/n=*"), *matching(spark, f"{base}/claims/*")]:
            m = re.search(r"(?:/n=|/claims/)([0-9]+)$", path)
            if m and int(m.group(1)) <= gone[0]:
                remove(spark, path)
    return gone
