"""Mixing sources to target weights by systematic sampling, in DataFrame functions only.

Targets: sources share the size of the whole by weight; a target stops at ``max_copies``
times its source's size, and the excess is reshared by weight among the others until
none is above. That fixed point is computed at once: with sources ordered by cap over
weight, a source is capped exactly if its share of what the ones before leave over is
above its cap.

Sampling: each document of a source has the same expected number of copies, target over
size. Documents are ranked inside their source by descending size (then by a hash of
their id), the prefix sum of expected copies up to rank r is ``r * expected``, one random
offset per source is added, and a document is emitted once per integer boundary its
interval crosses. In that order the copies above and below expectation cancel between
documents of nearly the same size, so what a source takes differs from its target by less
than its largest document, whatever the offset. The offset is the one of ``trials`` seeded
draws from the source's name (rejective sampling) whose taken size, over all of the source's
documents, comes nearest to the target.

A source may hold any share of the rows: ranks come from a range partitioning (see
``ranking``), sizes and trials are aggregated before they are shuffled. Only tables with
one row per source are joined back; there the choice of a broadcast is Spark's, by size.

Defined cases: a null text has size 0; the null source is a source of its own; a source
of size 0 has target 0 and takes nothing; a source without a weight has weight 0 and
takes nothing; repeated rows and ids, and null ids, are sampled as rows of their own; an
empty table gives an empty result; columns named like a result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callsight.llm.ranking import ranked
from callsight.session import materialize

RESULT = ("size", "source_size", "target", "copies", "taken")
WORD = "[^\\x20\\x09-\\x0D]+"


def n_words(text: Column) -> Column:
    """Number of words (runs of other than space and TAB to CR); 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cycle_weights(sources: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), source: str = "source") -> DataFrame:
    """The distinct sources by code point, null last, weighing ``weights`` in turn. One
    row per source: the only tables ordered in a single task."""
    order = Window.orderBy(F.col(source).asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    given = F.array(*[F.lit(float(w)) for w in weights])
    return sources.select(source).distinct().select(source, F.element_at(given, (turn + 1).cast("int")).alias("weight"))


def targets(sizes: DataFrame, max_copies: int) -> DataFrame:
    """``sizes`` (``source_size``, ``weight``) with each source's ``target``."""
    cap, weight = F.col("__cap"), F.col("weight")
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy(F.col("__ratio").asc(), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(everything)
    df = sizes.withColumn("__cap", (F.col("source_size") * max_copies).cast("double"))
    df = df.filter(weight > 0).withColumn("__ratio", cap / weight).withColumn("__total", total)
    left = F.col("__total") - F.coalesce(F.sum(cap).over(before), F.lit(0.0))
    share = F.sum(weight).over(everything) - F.coalesce(F.sum(weight).over(before), F.lit(0.0))
    df = df.withColumn("__capped", left * weight > cap * share)
    kept_cap = F.coalesce(F.sum(F.when(F.col("__capped"), cap)).over(everything), F.lit(0.0))
    open_weight = F.sum(F.when(~F.col("__capped"), weight)).over(everything)
    level = (F.col("__total") - kept_cap) / open_weight
    return df.withColumn("target", F.when(F.col("__capped"), cap).otherwise(F.least(cap, level * weight)))


def draw(source: Column, k: int, seed: int) -> Column:
    """The k-th seeded number in [0, 1) of a source."""
    text = F.concat(F.lit(f"{seed}:{k}:"), F.coalesce(F.concat(F.lit("s"), source), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def mix(
    docs: DataFrame,
    weights: DataFrame,
    size: Column | None = None,
    source: str = "source",
    id_col: str = "doc_id",
    text: str = "text",
    max_copies: int = 3,
    seed: int = 0,
    trials: int = 16,
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``copies`` and ``taken``
    (copies times size). ``weights`` has one row per source: ``source``, ``weight``."""
    keep = [c for c in docs.columns if c not in RESULT]
    sized = docs.select(*keep, (n_words(F.col(text)) if size is None else size).cast("long").alias("size"))
    sized = sized.withColumn("__key", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")))))
    rows = ranked(sized, [source], [F.col("size").desc(), F.col("__key"), F.col(id_col)], "__rank")
    sizes = rows.groupBy(F.col(source).alias("source")).agg(F.sum("size").alias("source_size"))
    given = weights.select(F.col(weights.columns[0]).alias("__source"), F.col("weight").cast("double").alias("weight"))
    sizes = sizes.join(given, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    plan = targets(sizes, max_copies)
    plan = plan.withColumn("__expected", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    # drawn once per source, not again for each of its rows
    plan = plan.withColumn("__draws", F.array(*[draw(F.col("source"), k, seed) for k in range(trials)]))
    plan = materialize(plan.select(F.col("source").alias("__source"), "source_size", "target", "__expected", "__draws"), "targets")
    rows = rows.join(plan, F.col(source).eqNullSafe(F.col("__source")))

    def copies(offset: Column) -> Column:
        return F.floor((F.col("__rank") + 1) * F.col("__expected") + offset) - F.floor(F.col("__rank") * F.col("__expected") + offset)

    tried = rows.groupBy("__source").agg(*[F.sum(copies(F.col("__draws")[k]) * F.col("size")).alias(f"__t{k}") for k in range(trials)])
    tried = tried.withColumnRenamed("__source", "__tried").join(plan, F.col("__tried").eqNullSafe(F.col("__source")))
    nearest = F.array_min(F.array(*[F.struct(F.abs(F.col(f"__t{k}") - F.col("target")).alias("off"), F.lit(k).alias("k"), F.col("__draws")[k].alias("u")) for k in range(trials)]))
    chosen = materialize(tried.select(F.col("__source").alias("__chosen"), nearest["u"].alias("__offset")), "offsets")
    rows = rows.join(chosen, F.col("__source").eqNullSafe(F.col("__chosen")))
    # the order of the columns is that of docs, then the result columns
    out = rows.withColumn("copies", copies(F.col("__offset")).cast("long"))
    return out.select(*keep, "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def emit(mixed: DataFrame) -> DataFrame:
    """One row per copy; ``copy`` counts from 1."""
    return mixed.filter(F.col("copies") > 0).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
