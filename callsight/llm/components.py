"""Connected components of a table of links, by alternating large and small stars.

Every step is a pre-aggregated minimum and an equi-join, written to the shared folder, so
links never pass through the driver and a node with very many links is split by the
join's skew handling. The number of steps grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsight.session import materialize


def _state(links: DataFrame) -> tuple:
    """Number of links and a sum over them: equal for equal tables."""
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(``node``, ``component``) for every node that has a link; the component's name is
    its smallest node. Links may be repeated, in either direction or of a node to itself;
    links with a null end are left out."""
    x, y = F.col(a), F.col(b)
    links = links.filter(x.isNotNull() & y.isNotNull()).select(F.greatest(x, y).alias("x"), F.least(x, y).alias("y"))
    links = materialize(links.distinct(), "links")
    state = _state(links)
    while state[0]:
        both = links.select("x", "y").union(links.select("y", "x"))
        low = both.groupBy("x").agg(F.min("y").alias("low")).select(F.col("x").alias("n"), F.least("x", "low").alias("low"))
        # large star: greater neighbours of a node link to the least node around it
        large = both.join(low, F.col("x") == F.col("n")).filter(F.col("y") >= F.col("x"))
        large = large.select(F.col("y").alias("x"), F.col("low").alias("y"))
        # small star: a node and its smaller neighbours link to the least of them
        low = large.groupBy("x").agg(F.min("y").alias("low")).select(F.col("x").alias("n"), "low")
        small = large.join(low, F.col("x") == F.col("n")).select(F.col("y").alias("x"), F.col("low").alias("y"))
        links = materialize(small.union(low).distinct(), "links")
        before, state = state, _state(links)
        if state == before:
            break
    return links.select(F.col("x").alias("node"), F.col("y").alias("component")).groupBy("node").agg(F.min("component").alias("component"))
