"""Exact top-k inner products: norm-sorted blocks, SVD-rotated partial sums and
Cauchy-Schwarz residual bounds.

Vectors become integer vectors ``floor(scale * x)``; scores are their exact inner
products. Candidates are dealt by ranges of descending length and packed into blocks.
The rotation comes from the singular vectors of all vectors (the eigenvectors of their
second moments, which are summed in the tasks), so the first rotated components hold most
of a vector's length. A block is rotated once; what travels with it are the first rotated
components and the lengths of the others.

1. Every query meets the block of the longest candidates; its k-th best score there is a
   first threshold.
2. Queries are packed anew by threshold over length, the least such ratio being the block's
   need. Candidate blocks whose longest vector cannot reach it aren't sent to it: by distributed
   ranks of needs among lengths, a query block knows how many of the candidate blocks, the
   longest first, it has to meet, and is joined to those numbers.
3. Inside a pair of blocks candidates are taken by descending length. A pair of vectors
   is dropped once the partial sum over the first rotated components, plus the product
   of both residual lengths, stays below the query's threshold; the others get their
   exact integer score, and thresholds rise as they do.

Rounding in the bounds is covered by a margin; scores are computed in integers, or in
doubles where these are exact. A task holds one candidate block and up to ``PART`` query
blocks of bounded bytes. Ties go to the smaller id, so equal vectors in any number are
no special case.

Defined cases: vectors that are null or hold null or non-finite components and rows
without an id take no part; vectors with components beyond 31 bits are kept as doubles, in
blocks of their own; components beyond 500 bits count as 2**500, and a score beyond 63 bits
is given as the nearest such integer;
vectors meet those of their own length only; rows with an id in common are one candidate
with the best of their scores, and never candidates of their own id; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsight.llm.ranking import ranked
from callsight.session import materialize

#: components in a packed candidate block and query block (4 bytes each, 8 in wide vectors)
BLOCK, QUERY_BLOCK = 1 << 19, 1 << 16
#: query blocks that meet a candidate block in one group
PART = 64
#: candidates between two updates of the thresholds
STEP = 512
MARGIN = 1e-9
#: the largest component, and the largest score
LARGEST, MOST = 2.0**500, 2**63 - 1

VECTOR = T.StructType([T.StructField("id", T.LongType()), T.StructField("dim", T.IntegerType()), T.StructField("ints", T.BinaryType()), T.StructField("norm", T.DoubleType())])
MOMENT = T.StructType([T.StructField("dim", T.IntegerType()), T.StructField("moment", T.BinaryType())])
PACKED = T.StructType(
    [
        T.StructField("block", T.LongType()),
        T.StructField("dim", T.IntegerType()),
        T.StructField("rows", T.LongType()),
        T.StructField("longest", T.DoubleType()),
        T.StructField("need", T.DoubleType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("ints", T.BinaryType()),
        T.StructField("thresholds", T.BinaryType()),
    ]
)
ROTATED = T.StructType([*PACKED.fields, T.StructField("head", T.BinaryType()), T.StructField("residual", T.BinaryType())])
SCORED = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.LongType())])


# --- vectors and their rotation ----------------------------------------------------


def _vector_task(scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, col = batch.column(0).to_pylist(), batch.column(1)
            flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null: nan
            sizes = np.array([-1 if n is None else n for n in pc.list_value_length(col).to_pylist()], dtype=np.int64)
            at = np.concatenate([[0], np.cumsum(np.maximum(sizes, 0))])
            with np.errstate(over="ignore"):
                whole = np.floor(flat * scale)
            out: list[tuple] = []
            for i, n in enumerate(sizes):
                if n < 0 or ids[i] is None:
                    continue
                x = whole[at[i] : at[i + 1]]
                if not np.all(np.isfinite(flat[at[i] : at[i + 1]])):
                    continue
                x = np.clip(x, -LARGEST, LARGEST)
                ints = x.astype("<i4" if np.all(np.abs(x) < 2**31) else "<f8")
                out.append((ids[i], int(n), ints.tobytes(), float(np.sqrt(x @ x))))
            cols = list(zip(*out)) if out else [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.binary(), pa.float64()))], names=VECTOR.names)

    return run


def _ints(blob: bytes, rows: int, dim: int) -> np.ndarray:
    return np.frombuffer(blob, "<i4" if len(blob) == 4 * rows * dim else "<f8").reshape(rows, dim)


def _moment_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        dims = batch.column(0).to_numpy()
        for dim in np.unique(dims):
            # wide vectors would drown the others; any rotation is right for them
            blobs = [b for b, d in zip(batch.column(1).to_pylist(), dims) if d == dim and len(b) == 4 * dim]
            x = np.frombuffer(b"".join(blobs), "<i4").reshape(len(blobs), dim).astype(np.float64)
            total[int(dim)] = total.get(int(dim), 0) + x.T @ x
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([m.tobytes() for m in total.values()], pa.binary())], names=MOMENT.names)


def _sum_task(rotate: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                m = np.frombuffer(blob, np.float64).reshape(dim, dim)
                total[dim] = total.get(dim, 0) + m
        if rotate:  # columns by descending singular value
            total = {d: np.ascontiguousarray(np.linalg.eigh(m)[1][:, ::-1]) if d else m for d, m in total.items()}
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([m.tobytes() for m in total.values()], pa.binary())], names=MOMENT.names)

    return run


def rotations(vectors: DataFrame) -> DataFrame:
    """(``dim``, ``moment``): per dimension the singular vectors of all vectors, as
    columns. Sums go through about the square root of the number of tasks first."""
    sums = materialize(vectors.select("dim", "ints").mapInArrow(_moment_task, MOMENT), "moments")
    middle = int(np.ceil(np.sqrt(max(1, sums.count()))))
    return sums.repartition(middle).mapInArrow(_sum_task(False), MOMENT).repartition("dim").mapInArrow(_sum_task(True), MOMENT)


# --- blocks ------------------------------------------------------------------------


def _pack_task(most: int):
    """Rows in order, (id, dim, ints, norm, threshold), to blocks of one dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 32, 0
        held: list[tuple] = []

        def block() -> pa.RecordBatch:
            nonlocal made, held
            dim = held[0][1]
            norms = np.array([r[3] for r in held])
            thr = np.array([-np.inf if r[4] is None else r[4] for r in held])
            with np.errstate(divide="ignore", invalid="ignore"):
                need = np.where(norms > 0, thr / norms, -np.inf)
            row = (base + made, dim, len(held), float(norms.max()), float(need.min()), np.array([r[0] for r in held], "<i8").tobytes(), b"".join(r[2] for r in held), thr.tobytes())
            made, held = made + 1, []
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, (pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.binary(), pa.binary()))], names=PACKED.names)

        for batch in batches:
            for r in zip(*[c.to_pylist() for c in batch.columns]):
                if held and (held[0][1] != r[1] or len(held[0][2]) != len(r[2]) or (len(held) + 1) * max(r[1], 1) > most):
                    yield block()
                held.append(r)
        if held:
            yield block()

    return run


def _turn_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with their dimension's rotation, to blocks with what the bounds need."""
    for batch in batches:
        for row in range(batch.num_rows):
            one = batch.slice(row, 1)
            r = {n: one.column(n)[0].as_py() for n in ("dim", "rows", "ints", "moment")}
            turned = _ints(r["ints"], r["rows"], r["dim"]).astype(np.float64) @ np.frombuffer(r["moment"], np.float64).reshape(r["dim"], r["dim"])
            head, residual = parted(turned)
            cols = [one.column(n) for n in PACKED.names] + [pa.array([head.tobytes()], pa.binary()), pa.array([residual.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=ROTATED.names)


def parted(rotated: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first rotated components, a quarter of them, and the length of the others."""
    h = max(1, rotated.shape[1] // 4)
    return np.ascontiguousarray(rotated[:, :h]), np.sqrt((rotated[:, h:] ** 2).sum(axis=1))


def pack(rows: DataFrame, by: Column, most: int, turn: DataFrame) -> DataFrame:
    """Blocks of at most ``most`` components, in ranges of descending ``by``, rotated by
    ``turn`` (:func:`rotations`)."""
    size = rows.agg(F.sum(F.greatest("dim", F.lit(1)))).first()[0] or 0
    order = [F.col("dim"), by.desc(), F.col("id")]
    rows = rows.repartitionByRange(max(1, -(-size // most)), *order).sortWithinPartitions(*order)
    # written before the join: block numbers hang on the partitions
    blocks = materialize(rows.select("id", "dim", "ints", "norm", "threshold").mapInArrow(_pack_task(most), PACKED), "blocks")
    return materialize(blocks.join(turn, "dim").select(*PACKED.names, "moment").mapInArrow(_turn_task, ROTATED), "rotated")


# --- pairs of blocks ---------------------------------------------------------------


class Block:
    """A packed block: ids, integers, lengths, and of the rotated coordinates the first
    ones and the length of the others (from ``rotation`` where they aren't given)."""

    def __init__(self, ids: bytes, ints: bytes, dim: int, rotation: np.ndarray | None = None, head: bytes = b"", residual: bytes = b"") -> None:
        self.ids = np.frombuffer(ids, "<i8")
        n = len(self.ids)
        self.ints = _ints(ints, n, dim).astype(np.float64)
        self.norm = np.sqrt((self.ints**2).sum(axis=1))
        if rotation is not None:
            self.head, self.residual = parted(self.ints @ rotation)
        else:
            self.head, self.residual = np.frombuffer(head, np.float64).reshape(n, -1 if head else 0), np.frombuffer(residual, np.float64)

    def largest(self) -> float:
        return float(np.abs(self.ints).max()) if self.ints.size else 0.0


def exact(a: np.ndarray, b: np.ndarray, small: bool) -> np.ndarray:
    """Row-wise inner products as integers; ``small``: doubles hold every partial sum."""
    if small:
        return np.einsum("ij,ij->i", a, b).astype(np.int64)
    large = np.einsum("ij,ij->i", np.abs(a), np.abs(b)) >= 2.0**62
    out = np.zeros(len(a), dtype=np.int64)
    # beyond 64 bits is only what meets a zero
    with np.errstate(invalid="ignore"):
        out[~large] = (a[~large].astype(np.int64) * b[~large].astype(np.int64)).sum(axis=1)
    for i in np.flatnonzero(large):
        score = sum(int(x) * int(y) for x, y in zip(a[i], b[i]))
        out[i] = max(-MOST, min(MOST, score))
    return out


def search(query: Block, threshold: np.ndarray, cand: Block, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query ids, candidate ids, scores): of each query the k best candidates of the
    block, without those that are surely below its threshold."""
    threshold = threshold.copy()
    best: dict[int, list[tuple[int, int]]] = {}  # query row: (-score, id), ascending
    dim = query.ints.shape[1]
    small = query.largest() * cand.largest() * max(dim, 1) < 2**53
    for lo in range(0, len(cand.ids), STEP):
        part = slice(lo, lo + STEP)
        longest = cand.norm[lo]
        low = np.where(threshold > -float(MOST), threshold - MARGIN * (query.norm * longest + 1), -np.inf)
        active = np.flatnonzero(query.norm * longest >= low)
        if not len(active):
            break  # all that follow are shorter
        bound = query.head[active] @ cand.head[part].T + np.outer(query.residual[active], cand.residual[part])
        qi, ci = np.nonzero(bound >= low[active][:, None])
        qi, ci = active[qi], ci + lo
        other = query.ids[qi] != cand.ids[ci]
        qi, ci = qi[other], ci[other]
        for at in range(0, len(qi), 1 << 16):
            q, c = qi[at : at + (1 << 16)], ci[at : at + (1 << 16)]
            score = exact(query.ints[q], cand.ints[c], small)
            order = np.lexsort((cand.ids[c], -score, q))
            q, c, score = q[order], c[order], score[order]
            cut = np.concatenate([[0], 1 + np.flatnonzero(np.diff(q)), [len(q)]])
            for a, b in zip(cut[:-1], cut[1:]):
                if a == b:
                    continue
                row = int(q[a])
                have = best.get(row, [])
                ids, seen = list(zip((-score[a:b]).tolist(), cand.ids[c[a:b]].tolist())), set()
                merged = []
                for s, i in sorted(have + ids) if have else ids:
                    if i not in seen:
                        seen.add(i)
                        merged.append((s, i))
                        if len(merged) == k:
                            break
                best[row] = merged
                if len(merged) == k:
                    threshold[row] = max(threshold[row], float(-merged[-1][0]))
    for row, found in best.items():
        yield np.full(len(found), query.ids[row]), np.array([i for _, i in found], np.int64), np.array([-s for s, _ in found], np.int64)


def _search_task(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cand = None
        for batch in batches:
            for row in range(batch.num_rows):
                r = {n: batch.column(i)[row].as_py() for i, n in enumerate(batch.schema.names)}
                block = Block(r["ids"], r["ints"], r["dim"], head=r["head"], residual=r["residual"])
                if not r["is_query"]:
                    cand = block
                    continue
                found = list(search(block, np.frombuffer(r["thresholds"], np.float64), cand, k))
                if found:
                    cols = [np.concatenate(c) for c in zip(*found)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=SCORED.names)

    return run


def meet(pairs: DataFrame, queries: DataFrame, cands: DataFrame, k: int) -> DataFrame:
    """Scores of the block ``pairs`` (``cand``, ``query``). A candidate block and its
    query blocks, in parts, are dealt to one task and read one after another."""
    parts = max(1, -(-queries.count() // PART))
    pairs = pairs.select("cand", "query", F.pmod(F.xxhash64("query"), F.lit(parts)).alias("part"))
    cols = ["dim", "ids", "ints", "head", "residual"]
    asked = pairs.join(queries, F.col("query") == F.col("block")).select("cand", "part", F.lit(True).alias("is_query"), "query", *cols, "thresholds")
    given = pairs.select("cand", "part").distinct().join(cands, F.col("cand") == F.col("block"))
    given = given.select("cand", "part", F.lit(False).alias("is_query"), F.lit(0).cast("long").alias("query"), *cols, F.lit(None).cast("binary").alias("thresholds"))
    rows = asked.unionByName(given).repartition("cand", "part").sortWithinPartitions("cand", "part", "is_query", "query")
    return rows.mapInArrow(_search_task(k), SCORED)


def reached(queries: DataFrame, cands: DataFrame) -> DataFrame:
    """(``query``, ``cand``): the candidate blocks that hold a vector long enough for some
    vector of a query block. Needs and lengths are ranked together, the greatest first and
    lengths before equal needs; a need's rank, less the needs before it, is the number of
    candidate blocks to meet."""
    need = F.when(F.isnan("need"), F.lit(float("-inf"))).otherwise(F.col("need") - MARGIN * (F.abs("need") + 1))
    asked = queries.select("dim", F.col("block").alias("query"), need.alias("at"))
    given = cands.select("dim", F.col("block").alias("cand"), F.col("longest").alias("at"))
    none = F.lit(None).cast("long")
    both = asked.withColumn("cand", none).unionByName(given.withColumn("query", none))
    both = ranked(both, ["dim"], [F.col("at").desc(), F.col("cand").asc_nulls_last(), F.col("query")], "place")
    asked = ranked(both.filter("query IS NOT NULL"), ["dim"], [F.col("place")], "before")
    given = ranked(both.filter("cand IS NOT NULL"), ["dim"], [F.col("place")], "number")
    upto = F.col("place") - F.col("before")
    wanted = asked.filter(upto > 0).select("dim", "query", F.explode(F.sequence(F.lit(0).cast("long"), upto - 1)).alias("number"))
    return wanted.join(given.select("dim", "number", "cand"), ["dim", "number"]).select("query", "cand")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(``query_id``, ``rank`` from 1, ``vec_id``, ``score``): the k candidates with the
    highest score for each row that fulfils ``is_query`` (a condition on the id)."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    ints = materialize(rows.mapInArrow(_vector_task(scale), VECTOR), "vectors")
    asked = ints.withColumn(id_col, F.col("id")).filter(is_query).drop(id_col)
    turn = materialize(rotations(ints), "rotations")
    none = F.lit(None).cast("double")
    cands = pack(ints.withColumn("threshold", none), F.col("norm"), BLOCK, turn)
    first = cands.groupBy("dim").agg(F.min("block").alias("cand"))

    queries = pack(asked.withColumn("threshold", none), F.col("norm"), QUERY_BLOCK, turn)
    pairs = queries.select("dim", F.col("block").alias("query")).join(first, "dim")
    seeds = materialize(meet(pairs, queries, cands, k), "seeds")

    kth = seeds.groupBy("query_id").agg(F.min("score").cast("double").alias("threshold"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= k)
    asked = asked.join(kth.select(F.col("query_id").alias("id"), "threshold"), "id", "left").select("id", "dim", "ints", "norm", "threshold")
    queries = pack(asked, F.when(F.col("norm") > 0, F.col("threshold") / F.col("norm")), QUERY_BLOCK, turn)
    more = meet(reached(queries, cands.join(first, F.col("block") == F.col("cand"), "left_anti")), queries, cands, k)

    scored = seeds.unionByName(more).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    best = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
