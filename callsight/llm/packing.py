"""Packing: bounded-space online packing of tokenised documents into fixed windows.

Each partition keeps a fixed number of open windows. A document is its token ids plus an
end id; whole windows are cut off its front, and what remains goes *best-fit* into the
open window it leaves the least room in. When none fits, the fullest window is emitted
and a new one opened in its place. When the partition ends, its open windows are left
over: at most ``windows`` of them, whatever the partition's size. *Finally* the pieces
of all leftover windows are merged: best-fit by descending length, and windows still not
full are filled up with cut pieces, so each merge task pads one sequence at most.

Leftovers are spread over merge tasks by their number of tokens, so no task gets more
than a fixed amount. The first pass is written to the shared folder, and both its
finished pieces and the leftovers are read from there: a lost executor re-runs its own
task only, and never re-deals pieces that others have placed already.

Defined cases: a null text is packed like an empty one (its end id alone); a repeated row
or id is packed each time; an empty table gives no rows; a document longer than a window
spans several; other columns of the input are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsight.llm.text import by_bytes, give_back
from callsight.llm.tokens import PART_BYTES, Tokenizer
from callsight.session import materialize

#: tokens that one merge task gets (4 bytes each)
MERGE_TOKENS = 2_000_000
#: sequences of merge tasks are numbered from here, those of partition p from p * 2**32
MERGED = 1 << 62

PIECE = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)
_ARROW = pa.schema([pa.field(f.name, pa.binary() if f.name == "ids" else pa.int64()) for f in PIECE.fields])

#: (document id, start in the document, ids as bytes, the document's tokens)
Piece = tuple[int, int, bytes, int]


class Rows:
    """Collects piece rows for one output batch."""

    def __init__(self, keep_ids: bool) -> None:
        self.cols: list[list] = [[] for _ in PIECE.fields]
        self.keep_ids = keep_ids

    def add(self, sequence: int | None, pieces: list[Piece]) -> None:
        at = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            kept = ids if self.keep_ids or sequence is None else None
            for col, v in zip(self.cols, (doc, start, n, zlib.crc32(ids), total, sequence, at, kept)):
                col.append(v)
            at += n

    def take(self) -> pa.RecordBatch:
        out = pa.record_batch([pa.array(c, f.type) for c, f in zip(self.cols, _ARROW)], schema=_ARROW)
        self.cols = [[] for _ in PIECE.fields]
        return out


class OpenWindows:
    """At most ``most`` windows of ``size`` tokens, ordered by the room they have left."""

    def __init__(self, size: int, most: int) -> None:
        self.size, self.most = size, most
        self.rooms: list[tuple[int, int]] = []  # (room, window), ascending
        self.content: dict[int, list[Piece]] = {}
        self.opened = 0

    def put(self, piece: Piece) -> Iterator[list[Piece]]:
        """Places a piece no longer than a window; yields windows that are done."""
        n = len(piece[2]) // 4
        at = bisect_left(self.rooms, (n, -1))  # the least room that is enough
        if at < len(self.rooms):
            room, window = self.rooms.pop(at)
        else:
            if len(self.rooms) >= self.most:
                yield self.content.pop(self.rooms.pop(0)[1])  # the fullest
            room, window = self.size, self.opened
            self.opened += 1
            self.content[window] = []
        self.content[window].append(piece)
        if room == n:
            yield self.content.pop(window)
        else:
            insort(self.rooms, (room - n, window))

    def rest(self) -> Iterator[list[Piece]]:
        """The open windows, fullest first."""
        for _, window in self.rooms:
            yield self.content[window]


def cut(piece: Piece, n: int) -> tuple[Piece, Piece]:
    doc, start, ids, total = piece
    return (doc, start, ids[: 4 * n], total), (doc, start + n, ids[4 * n :], total)


def _first_pass(tokenizer: Tokenizer, size: int, windows: int, end_id: int, keep_ids: bool):
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer.encoder()
        base = TaskContext.get().partitionId() << 32
        space, done, rows = OpenWindows(size, windows), 0, Rows(keep_ids)
        for batch in batches:
            ids, col = batch.column(0).to_pylist(), batch.column(1)
            row = 0
            for lo, hi in by_bytes(col, PART_BYTES):
                for tokens in encoder.ids(col.slice(lo, hi - lo)):
                    tokens += end
                    total, start = len(tokens) // 4, 0
                    while total - start >= size:
                        rows.add(base + done, [(ids[row], start, tokens[4 * start : 4 * (start + size)], total)])
                        done, start = done + 1, start + size
                    if start < total:
                        for full in space.put((ids[row], start, tokens[4 * start :], total)):
                            rows.add(base + done, full)
                            done += 1
                    row += 1
                yield rows.take()
            give_back()
        for left in space.rest():
            rows.add(None, left)
        yield rows.take()

    return run


def fill_up(pieces: list[Piece], size: int) -> Iterator[list[Piece]]:
    """All pieces in windows: best-fit by descending length, then windows that are not
    full get the heads of pieces cut from the emptiest ones. At most one is not full."""
    pieces.sort(key=lambda p: (-len(p[2]), p[0] is None, p[0] or 0, p[1], p[2]))
    space = OpenWindows(size, len(pieces))
    for p in pieces:
        yield from space.put(p)
    rest = list(space.rest())  # fullest first
    while rest:
        window = rest.pop(0)
        room = size - sum(len(p[2]) // 4 for p in window)
        while room and rest:
            donor = rest[-1]
            p = donor.pop()
            if len(p[2]) // 4 > room:
                head, tail = cut(p, room)
                donor.append(tail)
                p = head
            if not donor:
                rest.pop()
            window.append(p)
            room -= len(p[2]) // 4
        yield window


def _merge(size: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: list[Piece] = []
        for b in batches:
            d = b.to_pydict()
            pieces.extend(zip(d["doc_id"], d["start"], d["ids"], d["doc_tokens"]))
        base = MERGED + (TaskContext.get().partitionId() << 32)
        rows = Rows(keep_ids)
        for k, window in enumerate(fill_up(pieces, size)):
            rows.add(base + k, window)
        yield rows.take()

    return run


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    size: int = 1024,
    windows: int = 64,
    end_id: int = 0,
    id_col: str = "doc_id",
    text: str = "text",
    keep_ids: bool = True,
) -> DataFrame:
    """One row per piece: ``doc_id``, ``start`` (ids of its document before it),
    ``length``, ``ids_crc32``, ``doc_tokens`` (with the end id), ``sequence_id``,
    ``offset`` in the sequence (from 0, without gaps) and, with ``keep_ids``, ``ids``
    (unsigned little-endian 32-bit numbers). ``windows`` bounds a partition's open
    windows, and so its memory, to ``windows * size`` ids."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    tokenizer = Tokenizer(tokenizer_path)
    first = materialize(rows.mapInArrow(_first_pass(tokenizer, size, windows, end_id, keep_ids), PIECE), "packing")
    left = first.filter(F.col("sequence_id").isNull())
    tokens = left.agg(F.sum("length")).first()[0] or 0
    merged = left.select("doc_id", "start", "doc_tokens", "ids").repartition(-(-tokens // MERGE_TOKENS) or 1)
    out = first.filter(F.col("sequence_id").isNotNull()).unionByName(merged.mapInArrow(_merge(size, keep_ids), PIECE))
    return out if keep_ids else out.drop("ids")
