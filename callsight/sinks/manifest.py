"""Tables in parts, where a new version rewrites the parts that change and keeps the others.

A part is a day or a hash bucket. A version's new parts are written below a fresh folder,
``<path>/attempt=<id>/<part>=<value>/``; its marker in ``<path>_commits`` lists every part of
the table with the attempt that holds it. Readers open the folders the newest marker names
and no others, so what they list depends on the table and not on its history, and what a
crashed writer left behind is never looked at.

The folder names of a table's parts pass through the driver, as those of any partitioned
table do when Spark plans a read.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsight.session import remove
from callsight.sinks.markers import claim, content, expire, mark, newest

ATTEMPT = T.StructField("attempt", T.StringType())
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Manifest:
    """What marker ``n`` says: ``rows`` of (part, attempt)."""

    n: int
    rows: DataFrame


class PartedTable:
    """The table at ``path`` with columns ``schema``, divided by ``part`` (which may be one
    of the columns)."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, part: T.StructField) -> None:
        self.spark, self.path, self.part = spark, path.rstrip("/"), part
        self.commits = f"{self.path}_commits"
        fields = [f for f in schema.fields if f.name != part.name]
        self.stored = T.StructType([*fields, part, ATTEMPT])
        self.marker = T.StructType([part, ATTEMPT])

    def manifest(self, n: int | None = None) -> Manifest | None:
        """Of marker ``n`` or the newest one; None if nothing was ever committed."""
        n = newest(self.spark, self.commits) if n is None else n
        return None if n is None else Manifest(n, content(self.spark, self.commits, n, self.marker))

    def _folders(self, rows: DataFrame) -> list[str]:
        value = F.coalesce(F.col(self.part.name).cast("string"), F.lit(_NULL_FOLDER))
        name = F.concat(F.lit(f"{self.path}/attempt="), "attempt", F.lit(f"/{self.part.name}="), value)
        return rows.select(name.alias("name")).agg(F.array_sort(F.collect_set("name"))).first()[0]

    def read(self, manifest: Manifest, only: DataFrame | None = None) -> DataFrame:
        """The rows of all parts, or of those in the one column of ``only``; opens the
        folders of these parts alone."""
        rows = manifest.rows
        if only is not None:
            same = F.col(self.part.name).eqNullSafe(F.col("__part"))
            rows = rows.join(only.toDF("__part"), same, "left_semi")
        folders = self._folders(rows)
        if not folders:
            return self.spark.createDataFrame([], self.stored).drop("attempt")
        return self.spark.read.schema(self.stored).option("basePath", self.path).parquet(*folders).drop("attempt")

    def replace(self, df: DataFrame, touched: DataFrame, before: Manifest | None, n: int | None = None) -> int:
        """Write ``df``, which has all rows of the ``touched`` parts (one column) and no
        others, and commit it together with the other parts of ``before``, as marker ``n`` or
        under the next free number."""
        if n is None:
            n = claim(self.spark, self.commits)
        attempt = uuid.uuid4().hex[:12]
        df.hint("rebalance", self.part.name).write.partitionBy(self.part.name).parquet(f"{self.path}/attempt={attempt}")
        rows = touched.toDF(self.part.name).select(F.col(self.part.name).cast(self.part.dataType), F.lit(attempt).alias("attempt"))
        if before is not None:
            same = F.col(self.part.name).eqNullSafe(F.col("__part"))
            rows = rows.unionByName(before.rows.join(touched.toDF("__part"), same, "left_anti"))
        mark(rows, self.commits, n)
        return n

    def expire(self, keep: int = 2) -> int:
        """Remove all markers but the newest ``keep`` and the part folders that none of the
        kept ones name; returns how many folders went. Readers that began before as many
        commits still find theirs. Attempts that no marker ever named stay: their writer may
        be under way."""
        dropped = 0

        def drop(gone: list[int], kept: list[int]) -> None:
            nonlocal dropped
            live = {f for n in kept for f in self._folders(self.manifest(n).rows)}
            old = {f for n in gone for f in self._folders(self.manifest(n).rows)} - live
            for folder in sorted(old):
                remove(self.spark, folder)
            dropped = len(old)

        expire(self.spark, self.commits, keep, drop)
        return dropped
