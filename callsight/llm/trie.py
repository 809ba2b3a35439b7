"""The trie of conversation prefixes, by truncation peeling.

A node is a distinct sequence of the first d turns of at least one conversation. Nodes are
peeled off from the deepest level up: conversations that end at a depth meet the nodes that
survived from below, with their last turn stripped; what then has the same turns is one
node, whose members, children, leaves and savings are sums over what it was made of. So
nodes are discovered and aggregated in one pass.

1. *Paths.* A turn at depth i is 128 bits of hash over (i, role, text) and its words. A
   conversation's turns are gathered in *bands* of ``BAND`` depths, so a row holds at most
   that many turns, however long the conversation is. A prefix is named by the XOR of its
   turns' hashes and its depth.
2. *Copies fold.* Equal paths of a band become one row with their number and smallest id.
3. *Ranges.* The paths are dealt by range and sorted, so a subtree lies in neighbouring
   rows: a hot first turn is spread over as many tasks as its share of the rows needs. Each
   task is also told the last path before its own rows and the first one behind them.
4. *Peeling*, in array operations, a piece of at most ``PIECE`` turns at a time. A node whose
   rows all lie in the piece is complete. One that reaches into the next piece is left
   *open*: every piece hands on its part, and the piece with the node's first row counts
   it as a node (its words, its place among its parent's children), so that parts add up.
5. *Open nodes* are summed by Spark, a few per piece and depth. Bands deeper than the
   first hand their top nodes to the band above, where they take part like conversations.

The ids of conversations ending in a node are hashed in ascending order by streams: sorted
ranges write them out in blocks, and a node's blocks are hashed one after another, so no
list of ids is ever held.

Defined cases: null roles and texts count as empty; rows with a null conversation are left
out, a null turn comes first; rows of equal turn are taken by role, then text (a repeated row is
a turn like any other); a conversation without turns is a member of the root; a very long text
is read once, for its hash and words; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callsight.llm.ranking import _BITS, ranked
from callsight.llm.text import give_back
from callsight.session import materialize

#: depths of a path that are held in one row
BAND = 256
#: turns that are peeled at once
PIECE = 1 << 20
#: bytes of a block of ids
BLOCK = 1 << 16
#: characters of a text that rows of equal turn and role are dealt by
FRONT = 32
_WORD = r"[^\x20\x09-\x0D]+"

_PEELED = (
    "node boolean, depth long, conv_id long, k1 long, k2 long, parent_conv_id long, p1 long, p2 long, "
    "known boolean, open boolean, n_convs long, n_children long, n_leaves long, saved_tokens long"
)
_NAMES = [f.split()[0] for f in _PEELED.split(", ")]


# --- paths -------------------------------------------------------------------------


def ordered(messages: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", keep_text: bool = True) -> DataFrame:
    """(``conv_id``, ``at``, ``role``, ``text``): the turns of every conversation, numbered
    from 0. Without ``keep_text``, ``role`` and ``text`` give way to ``h1``, ``h2`` (hashes of both) and ``words``."""
    turns = messages.select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    ).filter(F.col("conv_id").isNotNull())
    first = F.col("turn").asc_nulls_first()
    forget = ["turn"]
    if not keep_text:
        turns = turns.withColumns({"h1": F.xxhash64("role", "text"), "h2": F.xxhash64(F.lit("turn"), "role", "text"), "words": F.size(F.regexp_extract_all("text", F.lit(_WORD), F.lit(0))).cast("long")})
        forget += ["role", "text"]
    return ranked(turns, ["conv_id"], [first, F.col("role"), F.col("text")], "at", deal=[first, F.left("role", F.lit(FRONT)), F.left("text", F.lit(FRONT))], forget=forget)


def _bands(turns: DataFrame) -> DataFrame:
    """A row per conversation and band: ``seg`` has (hash, hash, words) of every depth,
    one after another; ``k1``, ``k2`` name the prefix in front of the band, ``e1``, ``e2`` the one
    at its end; ``last`` tells the band in which the conversation ends. ``turns``: ``conv_id``,
    ``at`` (from 0), ``h1``, ``h2``, ``words``."""
    depth = F.col("at") + 1
    turns = turns.select("conv_id", depth.alias("depth"), F.floor(F.col("at") / BAND).alias("band"), F.xxhash64(depth, "h1", "h2").alias("c1"), F.xxhash64(depth, "h2", "h1").alias("c2"), "words")
    gathered = turns.groupBy("conv_id", "band").agg(
        F.array_sort(F.collect_list(F.struct("depth", "c1", "c2", "words"))).alias("turns"), F.bit_xor("c1").alias("x1"), F.bit_xor("c2").alias("x2"), F.max("depth").alias("end")
    )
    seg = F.flatten(F.transform("turns", lambda t: F.array(t["c1"], t["c2"], t["words"])))
    upto = Window.partitionBy("conv_id").orderBy("band").rowsBetween(Window.unboundedPreceding, 0)
    longer = Window.partitionBy("conv_id")
    out = gathered.select("conv_id", "band", seg.alias("seg"), "end", "x1", "x2", F.bit_xor("x1").over(upto).alias("e1"), F.bit_xor("x2").over(upto).alias("e2"), (F.max("band").over(longer) == F.col("band")).alias("last"))
    return out.select("conv_id", "band", "seg", "end", "last", "e1", "e2", F.col("e1").bitwiseXOR(F.col("x1")).alias("k1"), F.col("e2").bitwiseXOR(F.col("x2")).alias("k2"))


# --- peeling -----------------------------------------------------------------------


class Piece:
    """Sorted paths of neighbouring rows, peeled level by level. ``before`` and ``behind``
    are the paths next to them, or None."""

    def __init__(self, table: pa.Table, before: pa.Table | None, behind: pa.Table | None) -> None:
        whole = pa.concat_tables([t for t in (before, table, behind) if t is not None])
        seg = whole.column("seg").combine_chunks()
        offs = seg.offsets.to_numpy().astype(np.int64)
        values = seg.values.to_numpy()[offs[0] : offs[-1]].reshape(-1, 3)
        offs = (offs - offs[0]) // 3
        key = np.stack([whole.column(c).to_numpy() for c in ("k1", "k2")])
        n = table.num_rows
        lo = 0 if before is None else 1
        common = self._common(values, offs, key)
        #: depths that each row shares with the one before it (-1: not even the top)
        self.shared = np.full(n + 1, -1, dtype=np.int64)
        self.shared[1 - lo : 1 - lo + len(common)] = common
        self.start, self.length = offs[lo : lo + n], np.diff(offs)[lo : lo + n]
        self.values = values
        self.key = key[:, lo : lo + n]
        self.rows = [table.column(c).to_numpy().astype(np.int64) for c in ("n", "conv_id", "n_children", "n_leaves", "saved_tokens")]
        self.n = n

    @staticmethod
    def _common(values: np.ndarray, offs: np.ndarray, key: np.ndarray) -> np.ndarray:
        size = np.diff(offs)
        least = np.minimum(size[1:], size[:-1])
        at = np.zeros(len(least) + 1, dtype=np.int64)
        np.cumsum(least, out=at[1:])
        own = np.arange(at[-1]) - np.repeat(at[:-1], least)
        x, y = own + np.repeat(offs[:-2], least), own + np.repeat(offs[1:-1], least)
        other = np.flatnonzero((values[x, 0] != values[y, 0]) | (values[x, 1] != values[y, 1]))
        first = np.searchsorted(other, at[:-1])  # the row's first difference, if it is inside
        where = np.append(other, at[-1])[first]
        common = np.minimum(where - at[:-1], least)
        common[(key[:, 1:] != key[:, :-1]).any(axis=0)] = -1
        return common

    def peel(self, base: int) -> Iterator[dict[str, np.ndarray]]:
        """The nodes of every depth, the deepest first, and last the tops at ``base``."""
        none = np.empty(0, dtype=np.int64)
        deepest = int(self.length.max(initial=0))
        hashes = self._prefixes()
        by_length = np.argsort(self.length, kind="stable")
        cut = np.searchsorted(self.length[by_length], np.arange(deepest + 2))
        # survivors: first and last row, members, smallest id, leaves, savings, counted here
        first, last, members, least, leaves, saved, counted = (none,) * 7
        below: dict[str, np.ndarray] | None = None
        for d in range(deepest, -1, -1):
            ended = by_length[cut[d] : cut[d + 1]]
            n, conv, children, own_leaves, own_saved = (c[ended] for c in self.rows)
            a = np.concatenate([first, ended])
            turn = np.argsort(a, kind="stable")
            a, b = a[turn], np.concatenate([last, ended])[turn]
            members = np.concatenate([members, n])[turn]
            least = np.concatenate([least, conv])[turn]
            child = np.concatenate([counted, children])[turn]
            leaves = np.concatenate([leaves, own_leaves])[turn]
            saved = np.concatenate([saved, own_saved])[turn]
            survivor = np.concatenate([np.ones(len(first), dtype=np.int64), np.zeros(len(ended), dtype=np.int64)])[turn]
            # the same node: neighbouring rows that share the first d turns
            new = np.ones(len(a), dtype=bool)
            new[1:] = (a[1:] != b[:-1] + 1) | (self.shared[a[1:]] < d)
            at = np.flatnonzero(new)
            if below is not None:  # parents of the level below, in its order
                mine = np.cumsum(new) - 1
                below["parent"] = mine[survivor == 1]
            first, last = a[at], b[np.append(at[1:], len(a)) - 1] if len(at) else none
            members, child, leaves, saved = (np.add.reduceat(c, at) if len(at) else none for c in (members, child, leaves, saved))
            least = np.minimum.reduceat(least, at) if len(at) else none
            stripped = np.add.reduceat(survivor, at) if len(at) else none
            from_before = (first == 0) & (self.shared[0] >= d)
            goes_on = (last == self.n - 1) & (self.shared[self.n] >= d)
            counted = (~from_before).astype(np.int64)
            leaf = (stripped == 0) & (child == 0) & ~goes_on
            leaves = leaves + leaf
            if d:
                words = self.values[self.start[first] + d - 1, 2]
                saved = saved + (members - counted) * words
                k = hashes[:, self.start[first] + d - 1]
            else:
                k = self.key[:, first]
            level = {
                "depth": np.full(len(first), base + d), "conv_id": least, "k1": k[0], "k2": k[1], "open": from_before | goes_on,
                "n_convs": members, "n_children": child, "n_leaves": leaves, "saved_tokens": saved,
            }
            if below is not None:
                yield self._with_parent(below, level)
            below = level
        if below is not None:
            yield below

    def _prefixes(self) -> np.ndarray:
        """Names of all prefixes: XOR of the hashes up to each turn, from the band's key."""
        out = np.empty((2, len(self.values)), dtype=np.int64)
        for c in (0, 1):
            run = np.concatenate([[0], np.bitwise_xor.accumulate(self.values[:, c])]) if len(self.values) else np.zeros(1, np.int64)
            front = run[self.start] ^ self.key[c]
            place = np.arange(self.length.sum()) - np.repeat(np.cumsum(self.length) - self.length, self.length) + np.repeat(self.start, self.length)
            out[c, place] = run[place + 1] ^ np.repeat(front, self.length)
        return out

    @staticmethod
    def _with_parent(level: dict[str, np.ndarray], above: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        parent = level.pop("parent")
        level |= {"parent_conv_id": above["conv_id"][parent], "p1": above["k1"][parent], "p2": above["k2"][parent], "known": ~above["open"][parent]}
        return level


def _batch(level: dict[str, np.ndarray], base: int) -> pa.RecordBatch:
    n = len(level["conv_id"])
    top = "known" not in level
    if top:  # the root of all, or a node of the band above
        level |= {"parent_conv_id": np.zeros(n, np.int64), "p1": np.zeros(n, np.int64), "p2": np.zeros(n, np.int64), "known": np.zeros(n, dtype=bool)}
    elif base:  # the band above may know a smaller member of the top
        level["known"] = level["known"] & (level["depth"] > base + 1)
    level["node"] = np.full(n, not top or not base)
    return pa.record_batch([pa.array(level[c]) for c in _NAMES], names=_NAMES)


def _peel(base: int, piece: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows by task and place in it; the first and last may be fences (``n`` = 0)."""
        held: list[pa.Table] = []
        before: pa.Table | None = None
        size, task = 0, None

        def work(table: pa.Table, behind: pa.Table | None) -> Iterator[pa.RecordBatch]:
            nonlocal before
            fenced = table.num_rows and table.column("n")[0].as_py() == 0
            if fenced:
                before, table = table.slice(0, 1), table.slice(1)
            if table.num_rows and table.column("n")[-1].as_py() == 0:
                behind, table = table.slice(table.num_rows - 1), table.slice(0, table.num_rows - 1)
            if table.num_rows:
                for level in Piece(table, before, behind).peel(base):
                    if len(level["conv_id"]):
                        yield _batch(level, base)
                before = table.slice(table.num_rows - 1)
            give_back()

        def flush(end: bool) -> Iterator[pa.RecordBatch]:
            """All rows held, or all but the last, which may be what lies behind them."""
            nonlocal held, size
            table = pa.concat_tables(held) if held else None
            held, size = [], 0
            if table is None or not table.num_rows:
                return
            if end:
                yield from work(table, None)
                return
            rest = table.slice(table.num_rows - 1)
            held = [rest]
            yield from work(table.slice(0, table.num_rows - 1), rest)

        for batch in batches:
            table = pa.Table.from_batches([batch])
            tasks = table.column("task").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(tasks)) + 1).tolist(), table.num_rows]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if lo == hi:
                    continue
                if task is not None and tasks[lo] != task:
                    yield from flush(True)
                    before = None
                task = tasks[lo]
                part = table.slice(lo, hi - lo)
                held.append(part)
                seg = part.column("seg").combine_chunks()
                size += len(seg) + (seg.offsets[-1].as_py() - seg.offsets[0].as_py()) // 3
                if size >= piece:
                    yield from flush(False)
        yield from flush(True)

    return run


def _peel_band(paths: DataFrame, base: int) -> DataFrame:
    """Nodes, and parts of open nodes, of the paths of one band."""
    order = ["k1", "k2", "seg"]
    sums = [F.sum(c).alias(c) for c in ("n", "n_children", "n_leaves", "saved_tokens")]
    folded = paths.groupBy(*order).agg(F.min("conv_id").alias("conv_id"), *sums)
    placed = folded.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(placed.withColumn("__at", F.monotonically_increasing_id()), "paths")
    placed = placed.withColumns({"task": F.shiftright("__at", _BITS), "place": F.col("__at").bitwiseAND(F.lit((1 << _BITS) - 1))}).drop("__at")
    # the outermost paths of the neighbouring tasks, a row each
    ends = placed.groupBy("task").agg(F.min("place").alias("__lo"), F.max("place").alias("__hi"))
    in_order = Window.orderBy("task")  # one row per task
    ends = materialize(ends.select("task", "__lo", "__hi", F.lag("task").over(in_order).alias("__previous"), F.lead("task").over(in_order).alias("__next")), "ends")
    edge = placed.join(ends, "task")
    columns = placed.columns
    fence = edge.filter(F.col("place") == F.col("__hi")).filter(F.col("__next").isNotNull()).withColumns({"task": F.col("__next"), "place": F.lit(-1).cast("long"), "n": F.lit(0).cast("long")})
    behind = edge.filter(F.col("place") == F.col("__lo")).filter(F.col("__previous").isNotNull()).withColumns({"task": F.col("__previous"), "place": F.lit(1 << 62), "n": F.lit(0).cast("long")})
    rows = placed.unionByName(fence.select(*columns)).unionByName(behind.select(*columns))
    rows = rows.repartition("task").sortWithinPartitions("task", "place")
    return materialize(rows.mapInArrow(_peel(base, PIECE), _PEELED), "peeled")


def _merged(parts: DataFrame) -> DataFrame:
    """Open nodes, put together from their parts."""
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    return parts.groupBy("depth", "k1", "k2").agg(F.min("conv_id").alias("conv_id"), F.min("p1").alias("p1"), F.min("p2").alias("p2"), *sums)


# --- ids of ended conversations ------------------------------------------------------


def _blocks(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted (node, id) rows to blocks of comma-joined ids of one node."""
        key, first, ids = None, 0, bytearray()
        schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("first", pa.int64()), ("ids", pa.binary())])
        for batch in batches:
            for k1, k2, conv in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "conv_id"))):
                if (k1, k2) != key or len(ids) >= size:
                    if key is not None:
                        yield pa.record_batch([[key[0]], [key[1]], [first], [bytes(ids)]], schema=schema)
                    key, first, ids = (k1, k2), conv, bytearray()
                ids += b"%d" % conv if not ids else b",%d" % conv
        if key is not None:
            yield pa.record_batch([[key[0]], [key[1]], [first], [bytes(ids)]], schema=schema)

    return run


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, sha = None, None
    done: list[tuple[int, int, str]] = []

    def rows() -> pa.RecordBatch:
        return pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*done), (pa.int64(), pa.int64(), pa.string()))], names=["k1", "k2", "ends_sha256"])

    for batch in batches:
        for k1, k2, ids in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "ids"))):
            if (k1, k2) == key:
                sha.update(b",")
            else:
                if key is not None:
                    done.append((*key, sha.hexdigest()))
                key, sha = (k1, k2), hashlib.sha256()
            sha.update(ids)
        if len(done) >= 1 << 14:
            yield rows()
            done = []
    if key is not None:
        done.append((*key, sha.hexdigest()))
    if done:
        yield rows()


def end_hashes(ends: DataFrame) -> DataFrame:
    """(``k1``, ``k2``, ``ends_sha256``) of (``k1``, ``k2``, ``conv_id``) rows: the SHA-256 of a
    node's ids, ascending and comma-joined."""
    key = ["k1", "k2", "conv_id"]
    blocks = ends.select(*key).repartitionByRange(*key).sortWithinPartitions(*key).mapInArrow(_blocks(BLOCK), "k1 long, k2 long, first long, ids binary")
    blocks = blocks.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first")
    return blocks.mapInArrow(_hashed, "k1 long, k2 long, ends_sha256 string")


# --- the trie ----------------------------------------------------------------------


def prefix_trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes of its subtree),
    ``saved_tokens`` (words that need not be read again if every prefix is read once, over
    its subtree) and ``ends_sha256``. ``turns``: ``conv_id``, ``at`` (0, 1, ... in each
    conversation), ``h1``, ``h2``, ``words``; ``members``: the ``conv_id`` of every conversation, those
    without turns too."""
    zero = F.lit(0).cast("long")
    bands = materialize(_bands(turns), "bands")
    silent = members.select("conv_id").distinct().join(bands.select("conv_id").distinct(), "conv_id", "left_anti")
    silent = materialize(silent, "silent")
    none = {"n_children": zero, "n_leaves": zero, "saved_tokens": zero}
    path = ["conv_id", "k1", "k2", "seg", "n", "n_children", "n_leaves", "saved_tokens"]
    top = bands.agg(F.max("band")).first()[0]
    nodes: DataFrame | None = None
    tops: DataFrame | None = None
    for band in range(top or 0, -1, -1):
        here = bands.filter(F.col("band") == band)
        paths = here.filter("last").withColumns({"n": F.lit(1).cast("long")} | none).select(*path)
        if not band:
            empty = F.array().cast("array<bigint>")
            paths = paths.unionByName(silent.withColumns({"k1": zero, "k2": zero, "seg": empty, "n": F.lit(1).cast("long")} | none).select(*path))
        if tops is not None:  # nodes at the end of this band that go on below
            on = tops.select("conv_id", F.col("n_convs").alias("n"), "n_children", "n_leaves", "saved_tokens")
            paths = paths.unionByName(on.join(here.select("conv_id", "k1", "k2", "seg"), "conv_id").select(*path))
        peeled = _peel_band(paths, band * BAND)
        found = peeled.filter("node")
        nodes = found if nodes is None else nodes.unionByName(found)
        tops = _merged(peeled.filter(~F.col("node")))
    columns = ["depth", "conv_id", "k1", "k2", "parent_conv_id", "p1", "p2", "known", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    put = _merged(nodes.filter("open")).withColumns({"parent_conv_id": zero, "known": F.lit(False)})
    nodes = materialize(nodes.filter(~F.col("open")).select(*columns).unionByName(put.select(*columns)), "nodes")
    # parents that were open, or belong to the band above
    wanted = nodes.filter(~F.col("known") & (F.col("depth") > 0))
    parents = wanted.select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).distinct()
    parents = nodes.join(parents, ["depth", "k1", "k2"], "left_semi").select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("__parent"))
    late = wanted.join(parents, ["depth", "p1", "p2"]).withColumn("parent_conv_id", F.col("__parent"))
    root = nodes.filter(F.col("depth") == 0).withColumn("parent_conv_id", F.lit(None).cast("long"))
    nodes = nodes.filter("known").select(*columns).unionByName(late.select(*columns)).unionByName(root.select(*columns))
    ends = bands.filter("last").select(F.col("e1").alias("k1"), F.col("e2").alias("k2"), "conv_id").unionByName(silent.select(zero.alias("k1"), zero.alias("k2"), "conv_id"))
    nodes = nodes.join(materialize(end_hashes(ends), "end-hashes"), ["k1", "k2"], "left")
    return nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")
    )


def rebuilt(turns: DataFrame, base: Column, head: Column) -> tuple[DataFrame, DataFrame]:
    """Conversations (``turns`` as from :func:`ordered`) with their first ``head`` turns
    (an expression of ``conv_id``, at most ``HEADS``) taken from conversation ``base``, as far as
    it has them, and the ids of all conversations."""
    turns = turns.withColumns({"__base": base, "__head": head})
    convs = turns.filter(F.col("at") == 0).select(F.col("conv_id").alias("__conv"), F.col("__base"), F.col("__head"))
    fronts = turns.filter(F.col("at") < F.lit(HEADS)).drop("__base", "__head").withColumnRenamed("conv_id", "__base")
    fronts = fronts.join(convs.filter(F.col("__head") > 0), "__base").filter(F.col("at") < F.col("__head"))
    rest = turns.filter(F.col("at") >= F.col("__head"))
    # a base shorter than the head leaves a gap: own turns move up
    taken = fronts.groupBy("__conv").agg(F.count(F.lit(1)).alias("__taken"))
    rest = rest.join(taken, F.col("conv_id") == F.col("__conv"), "left")
    at = F.col("at") - F.col("__head") + F.coalesce("__taken", F.lit(0))
    columns = [c for c in turns.columns if c not in ("__base", "__head", "conv_id", "at")]
    rest = rest.select("conv_id", at.cast("long").alias("at"), *columns)
    fronts = fronts.select(F.col("__conv").alias("conv_id"), F.col("at").cast("long").alias("at"), *columns)
    return fronts.unionByName(rest), convs.select(F.col("__conv").alias("conv_id"))


#: turns that a conversation may take over from its base
HEADS = 3
