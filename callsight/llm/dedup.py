"""MinHash near-duplicates by an LSH forest, confirmed on full shingle sets.

1. *Sketch.* One Arrow pass makes each text's set of word shingles, its size, a 128-bit
   fingerprint of the set and ``TREES * DEPTH`` min-hashes. Texts with equal sets form a
   class under its smallest id; only one row per class goes on.
2. *Forest.* A tree is an order of the classes by ``DEPTH`` min-hashes, one after
   another. Classes are dealt by ranges of that order and sorted; classes with equal
   labels are never dealt to different ranges. A region is a run that shares a prefix, and
   its depth is adapted: where a shallow prefix is shared by few classes it is taken as it
   is, where by many it is refined one min-hash at a time, down to ``DEPTH``. Regions of
   that depth are compared whole, whatever their size.
3. *Families.* Inside a region sketches are compared, and classes that may be alike are
   joined to the smallest id among them: one edge per class, never all pairs. The
   connected components of these edges, over all trees, are families. Classes of
   different families are not alike.
4. *Links.* A family's texts meet in one task if they are few. A larger family is cut into
   chunks of bounded rows and shingles, and each chunk meets the family's pivots. A task
   compares full sets, exactly: ``100 * intersection >= percent * union``; it returns a
   spanning forest of the links it finds.
5. Where a cut family is still in several components, the classes outside its largest
   one, its strays, meet all others, chunk by chunk, if they fill few chunks. A large
   group of near copies hangs together by its pivots, so it costs its strays alone.
6. *Loose families*, with more strays than that (texts off one template, say), are split
   first, by their rare shingles, those of at most ``RARE`` classes of the family. Two
   classes either share rare shingles; then they are a pair that is looked at one by one.
   Or they don't; then all their rare shingles lie outside the intersection, and a class
   with many can't be linked with another one that has many. What the sizes and the rare
   shingles allow, and no more, is compared on full sets.
7. *Components* of the links give every row its class id.

No bucket, partner or candidate is capped. What can be missed is what the trees and the
sketch margin miss. Classes with equal labels in some tree are always compared, in however
crowded a region: a pair of similarity 0.8 has equal labels in none of 32 trees with a
probability of ``(1 - 0.8**4)**32``, 5e-8, and too few equal sketch bytes with one of 5e-6.

Defined cases: texts without words (null, empty or blank) are empty sets, linked with
nothing; a text with fewer words than a shingle has its whole sequence as one; rows with
equal ids are rows of one document; a row with a null id is linked with nothing, has a
null component and is kept; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsight.llm.components import components
from callsight.llm.text import U64, by_bytes, give_back, mix, shingle_sets
from callsight.session import materialize

#: trees are many and shallow, as only a shared label of full depth is sure to be compared
TREES, DEPTH, MIN_DEPTH = 32, 4, 2
#: regions up to this size are compared as they are, larger ones in full depth
REGION = 256
#: of ``SKETCH`` sketch bytes so many must agree; at similarity 0.8, 51 do, with a deviation of 3.2
SKETCH, POSSIBLE = 64, 36
#: classes, and shingles, in a chunk of a family; pivots that every chunk of one meets
CHUNK, CHUNK_SHINGLES, PIVOTS = 1024, 1 << 20, 32
#: a family is loose if its strays fill more chunks than this; below, comparing them outright
#: takes less than splitting them, with the same result
LOOSE = 4
#: a shingle of at most so many classes of a loose family is rare there
RARE = 16
#: bands of classes by the share of their shingles that isn't rare
BANDS = 4
TEXT_PART = 2 << 20
#: rows of one tree held at once, unless one region has more
HELD = 50_000

_rng = np.random.Generator(np.random.PCG64(7))
_MUL = _rng.integers(1, 2**63, TREES * DEPTH, dtype=np.uint64) * U64(2) + U64(1)
_ADD = _rng.integers(0, 2**63, TREES * DEPTH, dtype=np.uint64) * U64(2)
#: the min-hashes whose low byte is in the sketch: the first of every tree
_SKETCHED = np.arange(TREES * DEPTH).reshape(TREES, DEPTH)[:, : SKETCH // TREES].ravel()

SKETCHED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("fp1", T.LongType()),
        T.StructField("fp2", T.LongType()),
        T.StructField("labels", T.BinaryType()),
        T.StructField("sketch", T.BinaryType()),
    ]
)
PAIR = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
GRAM = T.StructType([T.StructField("family", T.LongType()), T.StructField("id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("gram", T.LongType())])


# --- sketches ----------------------------------------------------------------------


def min_hashes(shingles: np.ndarray) -> np.ndarray:
    """Low 16 bits of each min-hash (32-bit values) of a non-empty set."""
    low = np.full(len(_MUL), 2**32, dtype=np.uint64)
    for at in range(0, len(shingles), 1024):
        part = shingles[at : at + 1024]
        low = np.minimum(low, (part[:, None] * _MUL + _ADD >> U64(32)).min(axis=0))
    return (low & U64(0xFFFF)).astype(">u2")


def _sketch_task(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in by_bytes(batch.column(1), TEXT_PART):
                part = batch.slice(lo, hi - lo)
                n, fp, labels, sketches = [], [], [], []
                for s in shingle_sets(part.column(1), k):
                    n.append(len(s))
                    fp.append((int(mix(s).sum()), int(mix(s ^ U64(0xA5A5A5A5A5A5A5A5)).sum())))
                    mh = min_hashes(s) if len(s) else None
                    labels.append(None if mh is None else mh.tobytes())
                    sketches.append(None if mh is None else mh.astype(np.uint8)[_SKETCHED].tobytes())
                prints = np.array(fp, dtype=np.uint64).reshape(-1, 2).view(np.int64)
                cols = [part.column(0), pa.array(n, pa.int64()), pa.array(prints[:, 0]), pa.array(prints[:, 1]), pa.array(labels, pa.binary()), pa.array(sketches, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names=SKETCHED.names)
            give_back()

    return run


# --- families ----------------------------------------------------------------------


class Forest:
    """Sorted rows of a partition: tree, label, id and sketch."""

    def __init__(self, batch: pa.Table) -> None:
        def flat(name: str, width: int, kind: str) -> np.ndarray:
            return np.frombuffer(b"".join(batch[name].to_pylist()), dtype=kind).reshape(len(batch), width)

        self.ids = batch["id"].to_numpy()
        self.sketch = flat("sketch", SKETCH, "u1")
        tree, label = batch["tree"].to_numpy(), flat("label", DEPTH, ">u2")
        same = (label[1:] == label[:-1]) & (tree[1:] == tree[:-1])[:, None]
        #: length of the prefix shared with the row before
        self.shared = np.concatenate([[0], np.cumprod(same, axis=1).sum(axis=1)]) if len(batch) else np.empty(0, np.int64)

    def runs(self, lo: int, hi: int, depth: int) -> Iterator[tuple[int, int]]:
        """Runs of at least two rows of [lo, hi) that share a prefix of ``depth``."""
        cut = np.concatenate([[lo], lo + 1 + np.flatnonzero(self.shared[lo + 1 : hi] < depth), [hi]])
        for i in np.flatnonzero(np.diff(cut) > 1):
            yield int(cut[i]), int(cut[i + 1])

    def alike(self, row: int, rows: np.ndarray) -> np.ndarray:
        return (self.sketch[rows] == self.sketch[row]).sum(axis=1) >= POSSIBLE

    def edges(self, lo: int, hi: int, depth: int = MIN_DEPTH) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(smallest ids, others) of what may be alike in [lo, hi)."""
        for lo, hi in list(self.runs(lo, hi, depth)):
            if hi - lo > REGION and depth < DEPTH:
                yield from self.edges(lo, hi, depth + 1)
                # neighbours that the deeper prefixes part
                for i in lo + 1 + np.flatnonzero(self.shared[lo + 1 : hi] == depth):
                    if self.alike(i, np.array([i - 1]))[0]:
                        pair = np.sort(self.ids[i - 1 : i + 1])
                        yield pair[:1], pair[1:]
                continue
            rest = lo + np.argsort(self.ids[lo:hi], kind="stable")
            while len(rest) > 1:
                first, todo, rest = self.ids[rest[0]], [rest[0]], rest[1:]
                while todo and len(rest):
                    like = self.alike(todo.pop(), rest)
                    if like.any():
                        found, rest = rest[like], rest[~like]
                        yield np.full(len(found), first), self.ids[found]
                        todo.extend(found)


def _edge_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def edges(table: pa.Table) -> pa.RecordBatch:
        found = list(Forest(table).edges(0, len(table))) if len(table) > 1 else []
        both = np.unique(np.stack([np.concatenate(x) for x in zip(*found)]), axis=1) if found else np.empty((2, 0), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(both[0], pa.int64()), pa.array(both[1], pa.int64())], names=["a", "b"])

    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        if len(held) < HELD:
            continue
        # all but the last region, which may go on in the next batch
        key = pc.binary_slice(held["label"], 0, 2 * MIN_DEPTH)
        last = pc.and_(pc.equal(key, key[-1]), pc.equal(held["tree"], held["tree"][-1]))
        cut = len(held) - pc.sum(last).as_py()
        if cut:
            yield edges(held.slice(0, cut))
            held = held.slice(cut).combine_chunks()
    if held is not None:
        yield edges(held)
        give_back()


def family_edges(classes: DataFrame) -> DataFrame:
    """Edges ``a < b`` among rows (``id``, ``labels``, ``sketch``) whose components are the
    families."""
    width = 2 * DEPTH
    rows = classes.select("id", "sketch", "labels", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    rows = rows.select("tree", F.expr(f"substring(labels, tree * {width} + 1, {width})").alias("label"), "id", "sketch")
    # without the id: a range must not end between equal labels
    rows = rows.repartitionByRange("tree", "label").sortWithinPartitions("tree", "label", "id")
    return rows.mapInArrow(_edge_task, PAIR)


# --- links -------------------------------------------------------------------------


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of sorted distinct arrays. Values in few sets are
    counted pair by pair, those in many as products of 0/1 matrices."""
    n = len(sets)
    out = np.zeros((n, n), dtype=np.float32)  # exact up to 2**24
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    degree = counts[column]
    few = (degree > 1) & (degree <= 16)
    row, col = owner[few], column[few]
    for k in range(1, 16):
        at = np.flatnonzero(col[k:] == col[:-k])
        np.add.at(out, (row[at], row[at + k]), 1)
    out += out.T
    many = degree > 16
    row, col = owner[many], np.unique(column[many], return_inverse=True)[1]
    width = max(1, (4 << 20) // n)
    for lo in range(0, int(col[-1]) + 1 if len(col) else 0, width):
        a, b = np.searchsorted(col, [lo, lo + width])
        part = np.zeros((n, width), dtype=np.float32)
        part[row[a:b], col[a:b] - lo] = 1
        out += part @ part.T
    return out


def links(sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """A spanning forest of the pairs with ``100 * intersection >= percent * union``."""
    size = np.array([len(s) for s in sets], dtype=np.float64)
    both = intersections(sets).astype(np.float64)
    alike = 100 * both >= percent * (size[:, None] + size[None, :] - both)
    alike &= (size > 0)[:, None]
    rest = np.arange(len(sets))
    while len(rest) > 1:
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            p = todo.pop()
            like = alike[p, rest]
            found, rest = rest[like], rest[~like]
            for q in found:
                yield int(p), int(q)
            todo.extend(found)


def _link_task(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, sets = None, [], []

        def found() -> Iterator[tuple[int, int]]:
            if len(ids) > 1:
                yield from ((ids[p], ids[q]) for p, q in links(sets, percent))

        for batch in batches:
            for lo, hi in by_bytes(batch.column(3), TEXT_PART):
                piece = batch.slice(lo, hi - lo)
                pairs = []
                keys = zip(*(piece.column(i).to_pylist() for i in range(3)))
                for (family, part, doc), own in zip(keys, shingle_sets(piece.column(3), k)):
                    if block != (family, part):
                        pairs.extend(found())
                        block, ids, sets = (family, part), [], []
                    ids.append(doc)
                    sets.append(own)
                yield _pairs(pairs)
            give_back()
        yield _pairs(list(found()))

    return run


def _pairs(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*pairs) if pairs else ([], [])
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def find_links(dealt: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Links inside the blocks of ``dealt`` (``family``, ``part``, ``id``; a row per block
    that a class takes part in), from the full texts in ``docs``."""
    rows = dealt.join(docs, F.col("id") == F.col("doc_id")).select("family", "part", "id", "text")
    return rows.repartition("family", "part").sortWithinPartitions("family", "part", "id").mapInArrow(_link_task(k, percent), PAIR)


def chunks(count: str, shingles: str) -> Column:
    """Number of chunks for so many classes and shingles."""
    return F.greatest(F.ceil(F.col(count) / CHUNK), F.ceil(F.col(shingles) / CHUNK_SHINGLES), F.lit(1))


def first_blocks(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """Every class in its chunk of its family; in families of several chunks, pivots
    (about ``PIVOTS`` of them, by a hash) in each."""
    rows = members.join(sizes, "family")
    own = rows.select("family", F.pmod(F.xxhash64("id"), "chunks").alias("part"), "id")
    pivots = rows.filter((F.col("chunks") > 1) & (F.pmod(F.xxhash64("id", F.lit(1)), "classes") < PIVOTS))
    return own.union(pivots.select("family", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("part"), "id"))


def second_blocks(members: DataFrame, sizes: DataFrame, found: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Blocks for families of several chunks that are still in several components: the
    classes outside the largest one with each other and with chunks of it; in loose
    families only where :func:`loose_blocks` finds that a link is possible."""
    rows = members.join(sizes.filter("chunks > 1").select("family"), "family").join(found, F.col("id") == F.col("node"), "left")
    rows = materialize(rows.select("family", "id", "n_shingles", F.coalesce("component", "id").alias("component")), "cut")
    parts = rows.groupBy("family", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("s"))
    main = F.max(F.struct("n", (-F.col("component")).alias("c"), "s")).alias("main")
    of = parts.groupBy("family").agg(F.count(F.lit(1)).alias("components"), main, F.sum("n").alias("n"), F.sum("s").alias("s")).filter("components > 1")
    of = of.select("family", (-F.col("main.c")).alias("main"), F.col("main.n").alias("mn"), F.col("main.s").alias("ms"), (F.col("n") - F.col("main.n")).alias("sn"), (F.col("s") - F.col("main.s")).alias("ss"))
    of = materialize(of.select("family", "main", chunks("mn", "ms").alias("mains"), chunks("sn", "ss").alias("strays")), "strays")
    loose = rows.join(of.filter(F.col("strays") > LOOSE).select("family", "main"), "family")
    blocks = stray_blocks(rows.join(of.filter(F.col("strays") <= LOOSE), "family"))
    return blocks if loose.isEmpty() else blocks.union(loose_blocks(loose, docs, k, percent))


def stray_blocks(rows: DataFrame) -> DataFrame:
    """The strays of a family, ``LOOSE`` chunks at most, with each other and with each chunk
    of its largest component: so many rows a class at most, however large the family."""
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    m, s = F.pmod(F.xxhash64("id"), "mains"), F.pmod(F.xxhash64("id"), "strays")
    in_main = F.col("component") == F.col("main")
    main = rows.filter(in_main).select("family", "id", "mains", m.alias("m"), F.explode(upto("strays")).alias("s"))
    stray = rows.filter(~in_main).select("family", "id", "mains", "strays", s.alias("s"))
    met = stray.select("family", "id", "mains", F.explode(upto("mains")).alias("m"), "s").union(main)
    # parts are numbered: strays with chunks of the largest component, below 0 with strays
    met = met.select("family", (F.col("s") * F.col("mains") + F.col("m")).alias("part"), "id")
    other = stray.select("family", "id", "strays", "s", F.explode(upto("strays")).alias("o"))
    return met.union(other.select("family", (-1 - F.least("s", "o") * F.col("strays") - F.greatest("s", "o")).alias("part"), "id"))


# --- loose families ----------------------------------------------------------------


def _gram_task(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in by_bytes(batch.column(2), TEXT_PART):
                part = batch.slice(lo, hi - lo)
                sets = list(shingle_sets(part.column(2), k))
                size = np.array([len(x) for x in sets], dtype=np.int64)
                owner = pa.array(np.repeat(np.arange(len(sets)), size))
                grams = np.concatenate(sets).view(np.int64) if sets else np.empty(0, np.int64)
                cols = [part.column(0).take(owner), part.column(1).take(owner), pa.array(np.repeat(size, size)), pa.array(grams)]
                yield pa.RecordBatch.from_arrays(cols, names=GRAM.names)
            give_back()

    return run


def loose_blocks(rows: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Blocks that hold every pair of ``rows`` (``family``, ``id``, ``component``,
    ``main``) that may be a link between components of a family.

    For a class of ``n`` shingles of which ``rest`` aren't rare, and another one that
    shares ``c`` rare shingles with it, the intersection is at most ``rest + c`` on either
    side, and has to reach ``percent / (100 + percent)`` of both sizes together. So without
    a common rare shingle ``n / rest`` of both may add up to ``(100 + percent) / percent``
    at most: a linked pair has a class with few rare shingles in it. Pairs with common
    ones come out of the rare shingles' short lists, each with its ``c``.

    A common shingle reaches the lists' tasks cut to ``RARE + 1`` classes per task already
    (the window's group limit). An id with several texts is taken to have no rare ones."""
    texts = rows.select("family", "id").join(docs.hint("merge"), F.col("id") == F.col("doc_id")).select("family", "id", "text")
    grams = materialize(texts.mapInArrow(_gram_task(k), GRAM), "grams")
    place = F.row_number().over(Window.partitionBy("family", "gram").orderBy("id"))
    lists = grams.select("family", "gram", "id", place.alias("place")).filter(F.col("place") <= RARE + 1)
    lists = lists.groupBy("family", "gram").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_set("id")).alias("ids")).filter(F.col("n") <= RARE)
    lists = materialize(lists.select("family", "ids"), "rare")

    rare = lists.select("family", F.explode("ids").alias("id")).groupBy("family", "id").agg(F.count(F.lit(1)).alias("rare"))
    own = grams.groupBy("family", "id").agg(F.count(F.lit(1)).alias("grams"), F.min("n").alias("n"), F.max("n").alias("most"))
    own = rows.select("family", "id", "component", "main").distinct().join(own, ["family", "id"]).join(rare, ["family", "id"], "left")
    rest = F.when(F.col("grams") == F.col("n"), F.col("n") - F.coalesce("rare", F.lit(0))).otherwise(F.col("most"))
    own = materialize(own.select("family", "id", "component", (F.col("component") == F.col("main")).alias("in_main"), "n", rest.alias("rest")), "rests")

    # without common rare shingles
    own = own.withColumn("x", F.when(F.col("rest") > 0, F.greatest(F.col("n") / F.col("rest"), F.lit(1.0))))
    apart = own.filter("x is not null").select("family", "id", "n", "in_main", "x")
    blocks = meeting_blocks(apart, (100 + percent) / percent, 0)

    # with some
    pairs = lists.select("family", "ids", F.explode("ids").alias("a")).select("family", "a", F.explode(F.filter("ids", lambda b: b > F.col("a"))).alias("b"))
    pairs = pairs.groupBy("family", "a", "b").agg(F.count(F.lit(1)).alias("c"))
    side = lambda v: own.select("family", F.col("id").alias(v), F.col("component").alias(f"{v}_component"), F.col("n").alias(f"{v}_n"), F.col("rest").alias(f"{v}_rest"))
    pairs = pairs.join(side("a"), ["family", "a"]).join(side("b"), ["family", "b"]).filter("a_component <> b_component")
    most = F.least("a_rest", "b_rest") + F.col("c")
    pairs = pairs.filter(most * (100 + percent) >= percent * (F.col("a_n") + F.col("b_n"))).select("a", "b")
    groups = own.select("id", "n").join(components(pairs), F.col("id") == F.col("node")).select(F.col("component").alias("family"), "id", "n", F.lit(False).alias("in_main"), F.lit(1.0).alias("x"))
    return blocks.union(meeting_blocks(groups, 2.0, 1))


def meeting_blocks(rows: DataFrame, limit: float, salt: int) -> DataFrame:
    """Blocks in which all of ``rows`` (``family``, ``id``, ``n``, ``in_main``, ``x`` >= 1)
    meet whose ``x`` add up to ``limit`` at most, but for two of the largest component.

    Rows are cut into cells of a chunk's size by the band of their ``x``; a block is a pair
    of cells whose smallest ``x`` are small enough."""
    rows = rows.filter(F.col("x") <= limit - 1 + 1e-9)
    band = F.floor((F.col("x") - 1) / (limit - 2) * BANDS) if limit > 2 else F.lit(0).cast("long")
    rows = rows.withColumn("band", band)
    sizes = rows.groupBy("family", "in_main", "band").agg(F.count(F.lit(1)).alias("classes"), F.sum("n").alias("s"))
    sizes = sizes.select("family", "in_main", "band", chunks("classes", "s").alias("chunks"))
    chunk = F.pmod(F.xxhash64("id"), "chunks")
    cell = (chunk * (BANDS + 1) + F.col("band")) * 2 + F.col("in_main").cast("long")
    rows = materialize(rows.join(sizes, ["family", "in_main", "band"]).select("family", "id", "in_main", "x", cell.alias("cell")), "cells")
    cells = rows.groupBy("family", "cell", "in_main").agg(F.min("x").alias("x"))
    one, two = (cells.select("family", F.col("cell").alias(f"cell{i}"), F.col("in_main").alias(f"main{i}"), F.col("x").alias(f"x{i}")) for i in (1, 2))
    met = one.join(two, "family").filter((F.col("cell1") <= F.col("cell2")) & ~(F.col("main1") & F.col("main2")) & (F.col("x1") + F.col("x2") <= limit + 1e-9))
    part = F.xxhash64(F.lit(salt), "cell1", "cell2").alias("part")
    met = met.select("family", part, F.explode(F.array_distinct(F.array("cell1", "cell2"))).alias("cell"))
    return rows.join(met, ["family", "cell"]).select("family", "part", "id")


# --- operator ----------------------------------------------------------------------


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(``doc_id``, ``n_shingles``, ``component_id``, ``kept``) for every row of ``docs``;
    ``component_id`` is the smallest id reachable over links, ``kept`` whether it is the
    row's own."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = materialize(docs.mapInArrow(_sketch_task(k), SKETCHED), "sketches")
    key = ["fp1", "fp2", "n_shingles"]
    linked = rows.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = linked.groupBy(*key).agg(F.min(F.struct("doc_id", "labels", "sketch")).alias("first"), F.count(F.lit(1)).alias("members"))
    classes = materialize(classes.select(*key, "members", F.col("first.doc_id").alias("id"), "first.labels", "first.sketch"), "classes")

    families = components(family_edges(classes))
    members = classes.select("id", "n_shingles").join(families, F.col("id") == F.col("node"))
    members = materialize(members.select(F.col("component").alias("family"), "id", "n_shingles"), "families")
    sizes = members.groupBy("family").agg(F.count(F.lit(1)).alias("classes"), F.sum("n_shingles").alias("s"))
    sizes = materialize(sizes.select("family", "classes", chunks("classes", "s").alias("chunks")), "sizes")

    # a good part of all texts is in some family: a merge join, whatever the size
    dealt = first_blocks(members, sizes).distinct().hint("merge")
    link = materialize(find_links(dealt, docs, k, percent), "links")
    found = materialize(components(link), "components")
    blocks = materialize(second_blocks(members, sizes, found, docs, k, percent), "blocks")
    if not blocks.isEmpty():
        more = find_links(blocks.distinct(), docs, k, percent)
        found = materialize(components(more.union(found.select("component", "node"))), "components")

    joined = classes.join(found, F.col("id") == F.col("node"), "left").withColumn("component_id", F.coalesce("component", "id"))
    # only rows that aren't alone need a look-up
    names = materialize(joined.filter((F.col("members") > 1) | (F.col("component_id") != F.col("id"))).select(*key, "component_id"), "names")
    out = rows.select("doc_id", *key).join(names, key, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
