"""Stupid-backoff language-model scores, computed relationally.

Counts of all 1- to ``order``-grams over the whole corpus are a table dealt by n-gram
hash; the n-grams of the documents are exploded, joined to it by hash, and summed per
document. To keep both sides small, documents are dealt into blocks of bounded bytes,
and a block is what asks and is answered:

* A block explodes its documents into n-grams and sends each *distinct* one, as a sorted
  64-bit hash with its count in the block, to the table's range for that hash.
* A range adds up the counts and answers every block with the totals, in the order asked.
* Orders go from short to long. An n-gram is asked for only if both of its (n-1)-grams
  reached ``min_count``: no other can.

A very frequent n-gram is sent once per block, however often it occurs. Blocks are
dealt by a hash of the row, ranges by the n-gram's hash, so neither gets hot. What is
sent grows with the corpus; nothing is collected, sampled or cut.

Score of a word after its context: count(n-gram) / count(context) for the longest n-gram
that occurs at least ``min_count`` times in the corpus, times ``backoff`` for each order
given up on the way; in the end count(word) / words in the corpus. A document's
``score`` is the mean log10 of its words' scores.

Defined cases: words are runs of other than space and TAB to CR, lower-cased in A-Z; a
document without words (null, empty or blank) has ``n_words`` 0 and a null score; the
first words of a document have shorter contexts, without a penalty; repeated rows count
in the corpus and are scored each; null ids are kept; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2, log10

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsight.llm.text import U64, give_back, ngrams, string_buffers, words
from callsight.session import materialize

#: bytes of text in a block, and of the corpus per range of the count tables
BLOCK_BYTES, RANGE_BYTES = 4 << 20, 24 << 20

ASKED = T.StructType([T.StructField("range", T.LongType()), T.StructField("block", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("grams", T.BinaryType()), T.StructField("counts", T.BinaryType())])
ANSWER = T.StructType([T.StructField("block", T.LongType()), T.StructField("range", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("counts", T.BinaryType())])
SCORE = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("score", T.DoubleType())])


def packed(x: np.ndarray) -> bytes:
    """64-bit numbers by byte place: high bytes that are zero lie together, so Spark's
    block compression takes them away."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def deltas(x: np.ndarray) -> bytes:
    """Ascending numbers as their differences, packed."""
    return packed(np.diff(x, prepend=U64(0)))


def undeltas(b: bytes) -> np.ndarray:
    return np.cumsum(unpacked(b), dtype=np.uint64)


class Block:
    """The n-grams of a block's documents, order by order, with the totals known so far."""

    def __init__(self, text: pa.ChunkedArray, answers: pa.Table, min_count: int, bits: int) -> None:
        data, offs = string_buffers(text)
        self.word, _, _, self.first = words(data, offs)
        self.min_count, self.bits = min_count, bits
        self.answers: dict[int, list[tuple[int, bytes]]] = {}
        for n, r, counts in zip(*[answers[c].to_pylist() for c in ("n", "range", "counts")]):
            self.answers.setdefault(n, []).append((r, counts))
        #: by word: total of the n-gram that ends there, 0 if it wasn't asked for
        self.total = np.zeros(len(self.word), np.int64)
        self.previous: np.ndarray | None = None

    def ends(self, n: int) -> np.ndarray:
        """Index of the last word of every n-gram inside a document."""
        count = np.maximum(np.diff(self.first) - (n - 1), 0)
        at = np.concatenate([[0], np.cumsum(count)])
        return np.arange(at[-1]) + np.repeat(self.first[:-1] + (n - 1) - at[:-1], count)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, last words) of the n-grams to ask for, given the totals of n - 1."""
        gram, _ = ngrams(self.word, self.first, n)
        end = self.ends(n)
        if n > 1:
            often = (self.total[end] >= self.min_count) & (self.total[end - 1] >= self.min_count)
            gram, end = gram[often], end[often]
        return gram, end

    def answered(self, n: int) -> None:
        """Takes over the totals of order n: ``total`` by last word, 0 where not asked."""
        gram, end = self.grams(n)
        distinct, inverse = np.unique(gram, return_inverse=True)
        counts = [unpacked(c) for _, c in sorted(self.answers.get(n, []))]
        known = np.concatenate(counts).astype(np.int64) if counts else np.empty(0, np.int64)
        assert len(known) == len(distinct), "a block's n-grams are the same whenever it is read"
        self.previous, self.total = self.total, np.zeros(len(self.word), np.int64)
        self.total[end] = known[inverse]

    def ask(self, n: int, block: int) -> Iterator[pa.RecordBatch]:
        for m in range(1, n):
            self.answered(m)
        gram, _ = self.grams(n)
        distinct, counts = np.unique(gram, return_counts=True)
        part = (distinct >> U64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(distinct), np.int64)
        cut = np.concatenate([[0], 1 + np.flatnonzero(np.diff(part)), [len(part)]]) if len(part) else [0]
        rows = [(int(part[a]), block, n, deltas(distinct[a:b]), packed(counts[a:b])) for a, b in zip(cut[:-1], cut[1:])]
        cols = list(zip(*rows)) if rows else [[] for _ in ASKED.names]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()))], names=ASKED.names)

    def scores(self, order: int, backoff: float, corpus_words: int) -> tuple[np.ndarray, list[float | None]]:
        """Words and mean log10 score of every document."""
        place = np.arange(len(self.word)) - np.repeat(self.first[:-1], np.diff(self.first))
        log = np.zeros(len(self.word))
        found = np.zeros(len(self.word), np.int64)  # the order that each word was scored by
        for n in range(1, order + 1):
            self.answered(n)
            if n == 1:
                log = np.log10(self.total / max(corpus_words, 1))
                found[:] = 1
                continue
            hit = np.flatnonzero(self.total >= self.min_count)
            log[hit] = np.log10(self.total[hit] / self.previous[hit - 1])
            found[hit] = n
        log += (np.minimum(place + 1, order) - found) * log10(backoff)
        n_words = np.diff(self.first)
        return n_words, [float(np.sum(log[a : a + n]) / n) if n else None for a, n in zip(self.first[:-1], n_words)]


def _count_task(table: pa.Table) -> pa.Table:
    """Adds up one range: every block is answered in the order it asked in."""
    asked = [undeltas(b) for b in table["grams"].to_pylist()]
    counts = [unpacked(b) for b in table["counts"].to_pylist()]
    distinct, inverse = np.unique(np.concatenate(asked), return_inverse=True)
    total = np.zeros(len(distinct), np.uint64)
    np.add.at(total, inverse, np.concatenate(counts))
    answer = total[inverse]
    cut = np.cumsum([0] + [len(a) for a in asked])
    out = [packed(answer[a:b]) for a, b in zip(cut[:-1], cut[1:])]
    return pa.table([table["block"], table["range"], table["n"], pa.array(out, pa.binary())], names=ANSWER.names)


def score(docs: DataFrame, order: int = 3, min_count: int = 2, backoff: float = 0.4, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(``doc_id``, ``n_words``, ``score``) for every row of ``docs``, under counts over
    all of ``docs``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    n_words = F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+"))
    size, corpus_words = (x or 0 for x in rows.agg(F.sum(F.octet_length("text")), F.sum(n_words)).first())
    blocks = max(1, ceil(size / BLOCK_BYTES))
    bits = max(0, ceil(log2(max(1, size / RANGE_BYTES))))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))
    answers = docs.sparkSession.createDataFrame([], ANSWER)

    def ask(n: int):
        def run(key: tuple, mine: pa.Table, known: pa.Table) -> pa.Table:
            asked = pa.Table.from_batches(Block(mine["text"], known, min_count, bits).ask(n, key[0].as_py()))
            give_back()
            return asked

        return run

    for n in range(1, order + 1):
        asked = rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(ask(n), ASKED)
        answer = materialize(asked.groupBy("range").applyInArrow(_count_task, ANSWER), f"counts{n}")
        answers = answer if n == 1 else answers.unionByName(answer)
    def finish(key: tuple, mine: pa.Table, known: pa.Table) -> pa.Table:
        n_words, mean = Block(mine["text"], known, min_count, bits).scores(order, backoff, corpus_words)
        return pa.table([mine["doc_id"], pa.array(n_words, pa.int64()), pa.array(mean, pa.float64())], names=SCORE.names)

    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(finish, SCORE)
