"""Divergence between the sources of a language, from count-level bitmaps.

1. *Count.* Arrow tasks count terms per (language, source): occurrences and documents.
   A task's counts are held for at most ``HELD`` (group, term) entries, then handed on; so
   what is shuffled is counts, and a hot source is combined before it moves.
2. *Number.* A language keeps the terms of at least ``min_docs`` of its documents. They
   get dense numbers, the most frequent first, by distributed ranks.
3. *Bitmaps.* For every 64 numbers (a word) and every source and count, a 64-bit set has
   the terms that occur that often there.
4. *Joint cells.* AND and popcount of two sources' sets of a word count the terms with
   count a here and b there; the cell counts times f(a, b). Sources meet in blocks of
   ``BLOCK``, so a task holds the sets of a word for two blocks at most.
5. *Zeros by complement.* Only terms that both sources have meet in bitmaps. With counts of
   terms by level, f(0, 0) stands for all terms, f(a, 0) - f(0, 0) is added per term with
   count a here, f(0, b) - f(0, 0) per term with count b there, and a joint cell adds
   f(a, b) - f(a, 0) - f(0, b) + f(0, 0).

With p = 1 + floor(scale * (count + 1) / (N + V)) for a term (N: the group's occurrences of
kept terms, V: their number), f(p, q) = floor((p - q)^2 / q). All of it is integer
arithmetic: 64 bits where the scale bounds it, decimals where counts enter.

Defined cases: null texts, languages and sources count as empty strings; a group without
terms takes part with all counts zero; a language without kept terms has values of 0 and no
term rows; documents repeated count each; ties go to the smaller item in UTF-8 order; a
very long text is counted match by match, a very long term is a term like any other; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callsight.llm.ranking import ranked
from callsight.llm.text import give_back
from callsight.session import materialize

#: a term: ASCII letters and everything beyond ASCII; the same on UTF-8 bytes
TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
#: (group, term) entries that a task holds before it hands them on
HELD = 400_000
#: a text above this many bytes is counted without a list of its terms
LONG = 4 << 20
#: rows of an Arrow batch handed on
ROWS = 1 << 16
#: sources whose bitmaps meet in one task
BLOCK = 32
SCALE = 1_000_000_000

_DOCS = 1 << 44  # a count's lower bits are occurrences, its upper bits documents
_COUNTED = "lang string, source string, term string, n long, docs long"
_JOINT = "lang string, a long, b long, value long"


# --- counting ----------------------------------------------------------------------


def terms_of(data: bytes) -> Counter:
    """Occurrences of every term, A-Z lower-cased."""
    data = data.lower()  # bytes: ASCII letters only
    if len(data) <= LONG:
        return Counter(TERM.findall(data))
    return Counter(m.group() for m in TERM.finditer(data))


def _handed(held: dict[tuple[str, str], dict[bytes, int]]) -> Iterator[pa.RecordBatch]:
    for (lang, source), counts in held.items():
        terms, packed = list(counts), np.fromiter(counts.values(), np.int64, len(counts))
        for lo in range(0, len(terms), ROWS):
            part = packed[lo : lo + ROWS]
            text = pa.array(terms[lo : lo + ROWS], pa.binary()).view(pa.string())
            same = [pa.array([v], pa.string()).take(pa.array(np.zeros(len(part), np.int8))) for v in (lang, source)]
            yield pa.record_batch([*same, text, pa.array(part % _DOCS), pa.array(part // _DOCS)], names=["lang", "source", "term", "n", "docs"])


def _count(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], dict[bytes, int]] = {}
        entries = 0
        for batch in batches:
            langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
            texts = batch.column("text").cast(pa.large_binary())
            for k, group in enumerate(zip(langs, sources)):
                counts = held.setdefault(group, {})
                before = len(counts)
                for term, n in terms_of(texts[k].as_py()).items():
                    counts[term] = counts.get(term, 0) + n + _DOCS
                entries += len(counts) - before
                if entries >= most:
                    yield from _handed(held)
                    held, entries = {}, 0
        yield from _handed(held)
        give_back()

    return run


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(``lang``, ``source``, ``term``, ``n``, ``docs``): occurrences of every term in
    every group, and documents of the group that have it."""
    read = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    counted = read.mapInArrow(_count(HELD), _COUNTED)
    # tasks have combined their own counts: another combination pays behind the shuffle only
    key = ("lang", "source", "term")
    return counted.repartition(*key).groupBy(*key).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


# --- joint cells -------------------------------------------------------------------


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // q


class _Words:
    """Sums of joint cells, word by word of one pair of blocks."""

    def __init__(self, first: int, second: int) -> None:
        self.first, self.second = first, second
        self.total: dict[tuple[int, int], int] = {}

    def add(self, no: np.ndarray, block: np.ndarray, p: np.ndarray, zero: np.ndarray, bits: np.ndarray) -> None:
        """``no``, ``p``, ``zero``: a set's source and its p for the set's count and for
        none. Within one block every two sets meet once."""
        x, y = (np.flatnonzero(block == b) for b in (self.first, self.second))
        if not len(x) or not len(y):
            return
        cells = np.bitwise_count(bits[x][:, None] & bits[y][None, :])
        if self.first == self.second:
            cells = np.triu(cells, 1)  # sets of one source have no term in common
        at = np.nonzero(cells)
        if not len(at[0]):
            return
        n = cells[at].astype(np.int64)
        low, span = int(no.min()), int(no.max() - no.min()) + 1
        i, j = x[at[0]], y[at[1]]
        for a, b in ((i, j), (j, i)):
            value = n * (_f(p[a], p[b]) - _f(p[a], zero[b]) - _f(zero[a], p[b]) + _f(zero[a], zero[b]))
            pair = (no[a] - low) * span + no[b] - low
            order = np.argsort(pair, kind="stable")
            pair, value = pair[order], value[order]
            at = np.flatnonzero(np.diff(pair, prepend=-1))
            for g, h, v in zip((pair[at] // span + low).tolist(), (pair[at] % span + low).tolist(), np.add.reduceat(value, at).tolist()):
                self.total[g, h] = self.total.get((g, h), 0) + v


def _joint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (lang, blocks, word); a word's rows may go on in the next batch."""
    words, current, rest = None, None, None

    def emitted() -> Iterator[pa.RecordBatch]:
        if words is not None and words.total:
            a, b = zip(*words.total)
            yield pa.record_batch([pa.array([current[0]] * len(a), pa.string()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(list(words.total.values()), pa.int64())], names=["lang", "a", "b", "value"])

    def work(table: pa.Table) -> None:
        no, block, p, zero, bits = (table.column(c).to_numpy().astype(np.int64) for c in ("no", "block", "p", "zero", "bits"))
        words.add(no, block, p, zero, bits.view(np.uint64))

    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        rest = None
        if not table.num_rows:
            continue
        keys = [table.column(c) for c in ("lang", "first", "second", "word")]
        change = np.zeros(table.num_rows - 1, dtype=bool)
        for k in keys:
            k = k.combine_chunks()
            change |= pc.not_equal(k[1:], k[:-1]).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), table.num_rows]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            key = tuple(k[lo].as_py() for k in keys[:3])
            if key != current:
                yield from emitted()
                words, current = _Words(*key[1:]), key
            if hi == table.num_rows:  # perhaps not all of the word
                rest = table.slice(lo)
            else:
                work(table.slice(lo, hi - lo))
    if rest is not None:
        work(rest)
    yield from emitted()
    give_back()


def _p(n: Column, total: Column, v: Column, scale: int) -> Column:
    """1 + floor(scale * (n + 1) / (total + v)), exactly; null where there are no terms."""
    top = F.lit(scale).cast("decimal(10,0)") * (n.cast("decimal(20,0)") + F.lit(1))
    return F.when(v > 0, F.lit(1).cast("long") + F.call_function("div", top.cast("decimal(38,0)"), (total + v).cast("decimal(20,0)")))


def _f_column(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


class Audit:
    """The tables of one corpus, each written once."""

    def __init__(self, docs: DataFrame, min_docs: int = 3, scale: int = SCALE, lang: str = "lang", source: str = "source", text: str = "text") -> None:
        if not 0 < scale <= SCALE:
            raise ValueError(f"the scale must be from 1 to {SCALE}, so that squares fit into 64 bits")
        counts = materialize(term_counts(docs, lang, source, text), "term-counts")
        kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("in_lang"))
        kept = kept.filter(F.col("docs") >= F.lit(min_docs)).drop("docs")
        #: lang, term, its occurrences in the language and its number
        self.terms = materialize(ranked(kept, ["lang"], [F.col("in_lang").desc(), F.xxhash64("term")], "id"), "terms")
        self.cells = materialize(counts.select("lang", "source", "term", "n").join(self.terms, ["lang", "term"]), "cells")
        langs = self.terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("in_lang").alias("lang_total"))
        sums = self.cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        groups = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source")).distinct()
        groups = groups.join(sums, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["total", "v", "lang_total"])
        groups = ranked(groups, ["lang"], [F.xxhash64("source")], "no")
        none = F.lit(0).cast("long")
        #: lang, source, its number, N, V, the language's N, and p of a term that it lacks
        self.groups = materialize(groups.withColumn("zero", _p(none, F.col("total"), F.col("v"), scale)), "groups")
        self.scale = scale

    def bitmaps(self) -> DataFrame:
        """A 64-bit set of terms per (lang, word, source, count), the count as its p."""
        bit = F.expr("shiftleft(1L, cast(id & 63 AS int))")
        cells = self.cells.join(self.groups.select("lang", "source", "no", "total", "v", "zero"), ["lang", "source"])
        p = _p(F.col("n"), F.col("total"), F.col("v"), self.scale)
        return cells.groupBy("lang", F.shiftright("id", 6).alias("word"), "no", "n", p.alias("p"), "zero").agg(F.bit_or(bit).alias("bits"))

    def pairs(self) -> DataFrame:
        """(``lang``, ``source``, ``item``, ``value``): f summed over all kept terms, for
        every two sources of a language, in both orders."""
        sets = materialize(self.bitmaps(), "bitmaps")
        blocks = self.groups.groupBy("lang").agg(F.floor(F.max("no") / BLOCK).alias("last"))
        own = F.floor(F.col("no") / BLOCK)
        spread = sets.join(blocks, "lang").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))))
        spread = spread.select("lang", F.least(own, "other").alias("first"), F.greatest(own, "other").alias("second"), "word", "no", own.alias("block"), "p", "zero", "bits")
        key = ["lang", "first", "second", "word"]
        joint = spread.repartition(*key).sortWithinPartitions(*key).mapInArrow(_joint, _JOINT)

        levels = materialize(sets.groupBy("lang", "no", "p", "zero").agg(F.sum(F.bit_count("bits")).alias("n")), "levels")
        groups = self.groups.select("lang", F.col("no").alias("h"), F.col("zero").alias("h_zero"), "v")
        met = levels.join(groups, "lang").filter(F.col("no") != F.col("h"))
        both = _f_column(F.col("zero"), F.col("h_zero"))
        first = met.select("lang", F.col("no").alias("a"), F.col("h").alias("b"), (F.col("n") * (_f_column(F.col("p"), F.col("h_zero")) - both)).alias("value"))
        back = _f_column(F.col("h_zero"), F.col("zero"))
        second = met.select("lang", F.col("h").alias("a"), F.col("no").alias("b"), (F.col("n") * (_f_column(F.col("h_zero"), F.col("p")) - back)).alias("value"))
        two = self.groups.select("lang", "no", "zero").join(groups, "lang").filter(F.col("no") != F.col("h"))
        nothing = two.select("lang", F.col("no").alias("a"), F.col("h").alias("b"), F.when(F.col("v") > 0, F.col("v") * both).otherwise(F.lit(0)).cast("long").alias("value"))
        summed = nothing.unionByName(first).unionByName(second).unionByName(joint)
        summed = summed.groupBy("lang", "a", "b").agg(F.sum(F.col("value").cast("decimal(38,0)")).cast("long").alias("value"))
        names = self.groups.select("lang", "no", "source")
        summed = summed.join(names.withColumnRenamed("no", "a"), ["lang", "a"])
        return summed.join(names.withColumnsRenamed({"no": "b", "source": "item"}), ["lang", "b"]).select("lang", "source", "item", "value")

    def term_values(self) -> DataFrame:
        """(``lang``, ``source``, ``item``, ``value``): f of every term that a source has
        more often than its language has it."""
        cells = self.cells.join(self.groups.drop("no", "zero"), ["lang", "source"])
        p = _p(F.col("n"), F.col("total"), F.col("v"), self.scale)
        q = _p(F.col("in_lang"), F.col("lang_total"), F.col("v"), self.scale)
        cells = cells.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).filter(F.col("p") > F.col("q"))
        return cells.select("lang", "source", "item", _f_column(F.col("p"), F.col("q")).alias("value"))


def audit(docs: DataFrame, min_docs: int = 3, top: int = 200, scale: int = SCALE, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``. Part ``pair``: every
    other source of the language; part ``term``: the ``top`` terms that set the source apart
    from its language."""
    tables = Audit(docs, min_docs, scale, lang, source, text)
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pair = tables.pairs().withColumn("rank", F.row_number().over(order))
    term = tables.term_values().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= F.lit(top))
    columns = ("lang", "source", "part", "item", "value", "rank")
    return pair.withColumn("part", F.lit("pair")).select(*columns).unionByName(term.withColumn("part", F.lit("term")).select(*columns))
