"""Secrets in texts: fixed patterns, and random strings found by character Markov models.

*Patterns* (base kinds, in this order), leftmost and without overlaps within a kind; a
match that fails its test is dropped and not tried again in part. ``assign``: a password,
secret, token or API-key name, a separator and a value of 8 characters or more (the span is
the whole match); ``access``: ``AKIA`` and capitals or digits, 16 characters or more;
``hex``: 32 lower-case hexadecimal digits or more.

*Models.* Two second-order Markov models over the characters of a run, one of random
strings, one of ordinary identifiers; a run is a longest stretch of ``[A-Za-z0-9+/_=-]``.
They are trained from labelled samples: a run inside a value that the patterns found, and
generated strings over the alphabets that keys are written in, are random; every other run
of ``TRAIN_RUN`` characters or more, and the public names of common libraries, alone, joined
and numbered, are ordinary. Transitions are counted over all texts, in arrays of a fixed
size, and the counts of tasks are summed. Of each model's samples, those from the texts and
the given ones have fixed shares, however many texts there are.

A run of ``MIN_RUN`` characters or more, with a digit and a letter, that overlaps no base
span is a span of kind ``random`` if the log-likelihood ratio (natural, over the whole run)
is at least ``THRESHOLD`` and its mean per character at least ``PER_CHARACTER``.

Positions are code points, ends exclusive. Runs are found and scored in array operations
on the texts' bytes, so the work is linear in a text's length; texts are never cut.

Defined cases: a null text counts as empty (no spans; ``max_llr`` null, as for every text
without a run to score; ``redact`` keeps it null); repeated rows are searched each; without
any text the models know the given samples alone; an empty table gives an empty result;
result columns replace columns of the same name.
"""

from __future__ import annotations

import errno
import hashlib
import http
import os
import re
import signal
import socket
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pyspark.sql
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsight.llm.text import by_bytes, give_back, string_buffers
from callsight.session import materialize

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "random")

# --- fixed values: alphabets of keys; characters of a run ---------------------------
ALPHABETS = (
    "0123456789abcdef",
    "0123456789ABCDEF",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
    "abcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
)
RUN = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"

SYMBOL = np.zeros(256, dtype=np.uint8)  # 0: not in a run, and in front of one
for _k, _c in enumerate(RUN):
    SYMBOL[ord(_c)] = _k + 1
SIZE = len(RUN) + 1
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[list(b"0123456789")] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[list(RUN[:52].encode())] = True

TRAIN_RUN, MIN_RUN = 6, 16
THRESHOLD, PER_CHARACTER = 14.0, 0.7
#: generated strings of each alphabet, and their lengths
GENERATED, LENGTHS = 400, (16, 20, 24, 32, 40, 44, 64)
#: modules whose names are samples of identifiers
NAMED = (errno, http, http.HTTPStatus, os, re, signal, socket, string, np, np.ndarray, pa, pyarrow.compute, pyspark.sql.functions, pyspark.sql.types, pyspark.sql.DataFrame)
#: transitions of a model, and the share of them that the texts decide
MASS, RANDOM_SHARE, ORDINARY_SHARE = 2_000_000, 0.2, 0.5
PART_BYTES = 1 << 20

_ASSIGN = re.compile(r"""((?:password|passwd|secret|token|api_?key))["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")

Span = tuple[int, int, int]  # start, index of kind, end


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the secret itself), by start, then kind. The runs of
    ``access`` and ``hex`` are as long as they can be, so asking for the shortest length in
    the pattern finds the same ones as dropping the shorter matches."""
    found = []
    low = text.lower()
    if any(name in low for name in _NAMES):
        found += [(m.start(), 0, m.end(), m.start(2)) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.start()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m.start()) for m in _HEX.finditer(text)]
    return sorted(found)


def _runs(data: np.ndarray, offs: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all bytes, and first and last byte (exclusive) of the runs of ``least``
    characters or more; a run ends where its text does."""
    symbol = SYMBOL[data]
    inside = symbol > 0
    fresh = np.ones(len(data) + 1, dtype=bool)
    fresh[1:-1] = ~inside[:-1]
    fresh[offs] = True
    begin = np.flatnonzero(inside & fresh[:-1])
    last = fresh[1:].copy()
    last[:-1] |= ~inside[1:]
    end = np.flatnonzero(inside & last) + 1
    # a byte behind a run that ends with its text starts afresh; one inside a run doesn't
    long = end - begin >= least
    return symbol, begin[long], end[long]


def _places(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every byte of the runs, and where each run's first byte stands among them."""
    size = end - begin
    at = np.zeros(len(size) + 1, dtype=np.int64)
    np.cumsum(size, out=at[1:])
    return np.arange(at[-1]) + np.repeat(begin - at[:-1], size), at


def _transitions(symbol: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every character of the runs, the number of (two before, one before, itself);
    in front of a run stands symbol 0. Also where each run starts among them."""
    place, at = _places(begin, end)
    own = symbol[place].astype(np.int64)
    before, two = np.zeros_like(own), np.zeros_like(own)
    before[1:], two[2:] = own[:-1], own[:-2]
    first = at[:-1]
    before[first] = 0
    two[first] = 0
    second = first[end - begin > 1] + 1
    two[second] = 0
    return (two * SIZE + before) * SIZE + own, at


# --- training ----------------------------------------------------------------------


def generated(seed: int = 20240229) -> Iterator[str]:
    """Random strings of every alphabet, the same ones each time."""
    rng = np.random.Generator(np.random.PCG64(seed))
    for alphabet in ALPHABETS:
        letters = np.array(list(alphabet))
        for k in range(GENERATED):
            yield "".join(letters[rng.integers(0, len(letters), LENGTHS[k % len(LENGTHS)])])


def identifiers(seed: int = 20240229) -> Iterator[str]:
    """Repeated characters; public names of libraries, alone, two of them joined, and with
    a number or date, the same ones each time."""
    yield from (c * 24 for c in RUN)
    names = sorted({n.strip("_") for m in NAMED for n in dir(m)} - {""})
    rng = np.random.Generator(np.random.PCG64(seed))
    for name in names:
        yield name
        other = names[rng.integers(len(names))]
        number = str(rng.integers(10 ** int(rng.integers(1, 5))))
        joint = "_-/"[rng.integers(3)]
        yield name + joint + other
        yield name + other[0].upper() + other[1:]
        yield name + ("", joint)[rng.integers(2)] + number
        yield f"{name}{joint}{2000 + rng.integers(30)}-{1 + rng.integers(12):02}-{1 + rng.integers(28):02}"


def counted(col: pa.Array, least: int = TRAIN_RUN) -> tuple[np.ndarray, np.ndarray]:
    """Transition counts of the runs in texts: of those in values the patterns found, and
    of all others."""
    random, ordinary = np.zeros(SIZE**3, dtype=np.int64), np.zeros(SIZE**3, dtype=np.int64)
    for lo, hi in by_bytes(col, PART_BYTES):
        part = col.slice(lo, hi - lo)
        data, offs = string_buffers(part)
        if not len(data):
            continue
        symbol, begin, end = _runs(data, offs, least)
        if not len(begin):
            continue
        # values of base spans, as byte ranges
        values = []
        for k, text in enumerate(part.to_pylist()):
            if text:
                spans = base_spans(text)
                if spans:
                    byte = np.flatnonzero((data[offs[k] : offs[k + 1]] & 0xC0) != 0x80) + offs[k]
                    byte = np.append(byte, offs[k + 1])
                    values += [(byte[s[3]], byte[s[2]]) for s in spans]
        secret = _overlaps(begin, end, values)
        for chosen, total in ((secret, random), (~secret, ordinary)):
            if chosen.any():
                total += np.bincount(_transitions(symbol, begin[chosen], end[chosen])[0], minlength=SIZE**3)
    return random, ordinary


def _overlaps(begin: np.ndarray, end: np.ndarray, ranges: list[tuple[int, int]]) -> np.ndarray:
    """Which runs overlap one of the ranges."""
    if not ranges:
        return np.zeros(len(begin), dtype=bool)
    lo, hi = np.array(sorted(ranges)).T
    hi = np.maximum.accumulate(hi)  # the furthest end of the ranges so far
    upto = np.searchsorted(lo, end, side="left")  # ranges that begin before the run's end
    return (upto > 0) & (hi[np.maximum(upto - 1, 0)] > begin)


def _train_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = [np.zeros(SIZE**3, dtype=np.int64) for _ in range(2)]
    for batch in batches:
        for t, n in zip(total, counted(batch.column(0))):
            t += n
    for kind, t in enumerate(total):
        at = np.flatnonzero(t)
        yield pa.record_batch([pa.array(np.full(len(at), kind, dtype=np.int32)), pa.array(at.astype(np.int32)), pa.array(t[at])], names=["kind", "gram", "n"])
    give_back()


def blend(found: np.ndarray, given: np.ndarray, share: float) -> np.ndarray:
    """``MASS`` transitions, of which ``share`` are as in the texts."""
    n = found.sum()
    if not n:
        return given * (MASS / given.sum())
    return found * (share * MASS / n) + given * ((1 - share) * MASS / given.sum())


def _ratio(random: np.ndarray, ordinary: np.ndarray) -> np.ndarray:
    """log P(random) - log P(ordinary) of every transition. Second order is smoothed by
    first order, that by the single characters."""

    def logs(counts: np.ndarray) -> np.ndarray:
        c3 = counts.reshape(SIZE, SIZE, SIZE)
        c2, c1 = c3.sum(axis=0), c3.sum(axis=(0, 1))
        p1 = (c1 + 1.0) / (c1.sum() + SIZE)
        p2 = (c2 + 20.0 * p1) / (c2.sum(axis=1, keepdims=True) + 20.0)
        p3 = (c3 + 50.0 * p2[None, :, :]) / (c3.sum(axis=2, keepdims=True) + 50.0)
        return np.log(p3).ravel()

    return (logs(random) - logs(ordinary)).astype(np.float32)


@dataclass(frozen=True)
class Model:
    """The log-likelihood ratio of every transition."""

    ratio: np.ndarray

    def scores(self, symbol: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The ratio of every run."""
        if not len(begin):
            return np.empty(0)
        gram, at = _transitions(symbol, begin, end)
        total = np.concatenate([[0.0], np.cumsum(self.ratio[gram], dtype=np.float64)])
        return total[at[1:]] - total[at[:-1]]


def train(docs: DataFrame, text: str = "text") -> Model:
    """Models of the runs of all ``docs``. To the driver come sums: at most ``2 * SIZE**3``
    numbers, whatever the size of the table."""
    given = [sum(counted(pa.array(list(samples()), pa.string()), least=1)) for samples in (generated, identifiers)]
    found = [np.zeros(SIZE**3, dtype=np.int64) for _ in given]
    counts = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(_train_task, "kind int, gram int, n long")
    sums = materialize(counts.groupBy("kind", "gram").agg(F.sum("n").alias("n")), "transitions")
    sums = sums.groupBy("kind").agg(F.array_sort(F.collect_list(F.struct("gram", "n"))).alias("grams"))
    for kind, total in enumerate(found):
        row = sums.filter(F.col("kind") == kind).first()
        if row is not None:
            grams = np.array([(g["gram"], g["n"]) for g in row["grams"]], dtype=np.int64)
            total[grams[:, 0]] = grams[:, 1]
    random, ordinary = (blend(f, g, share) for f, g, share in zip(found, given, (RANDOM_SHARE, ORDINARY_SHARE)))
    return Model(_ratio(random, ordinary))


# --- search ------------------------------------------------------------------------


def find(col: pa.Array, model: Model) -> Iterator[tuple[list[Span], float | None]]:
    """For every text the spans (start, kind, end) and the largest ratio of a scored run."""
    for lo, hi in by_bytes(col, PART_BYTES):
        part = col.slice(lo, hi - lo)
        data, offs = string_buffers(part)
        symbol, begin, end = _runs(data, offs, MIN_RUN) if len(data) else (np.empty(0, np.uint8), *(np.empty(0, np.int64),) * 2)
        if len(begin):
            digits = np.concatenate([[0], np.cumsum(_DIGIT[data])])
            letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
            mixed = (digits[end] > digits[begin]) & (letters[end] > letters[begin])
            begin, end = begin[mixed], end[mixed]
        score = model.scores(symbol, begin, end)
        chosen = (score >= THRESHOLD) & (score >= PER_CHARACTER * (end - begin))
        first = np.searchsorted(begin, offs)
        for k, text in enumerate(part.to_pylist()):
            spans = [(a, kind, b) for a, kind, b, _ in base_spans(text)] if text else []
            a, b = first[k], first[k + 1]
            top = float(score[a:b].max()) if b > a else None
            if chosen[a:b].any():
                # code point of every byte of the text
                point = np.cumsum((data[offs[k] : offs[k + 1]] & 0xC0) != 0x80) - 1
                r = [(int(point[x - offs[k]]), int(point[y - 1 - offs[k]]) + 1) for x, y in zip(begin[a:b][chosen[a:b]], end[a:b][chosen[a:b]])]
                taken = _overlaps(np.array([x for x, _ in r]), np.array([y for _, y in r]), [(x, y) for x, _, y in spans])
                spans = sorted(spans + [(x, len(BASE), y) for (x, y), t in zip(r, taken) if not t])
            yield spans, top


def joined(spans: list[Span], base_only: bool = False) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans if not base_only or k < len(BASE))


FOUND = T.StructType(
    [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
    + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()), T.StructField("max_llr", T.DoubleType())]
)
_TYPES = [pa.int64()] * len(KINDS) + [pa.string(), pa.string(), pa.float64()]


def find_secrets(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with a count per kind, ``spans`` (kind:start:end of all, by start, then
    kind), ``base_sha256`` (of the same list over the base kinds) and ``max_llr``."""

    @F.arrow_udf(FOUND)
    def run(col: pa.Array) -> pa.Array:
        cols: list[list] = [[] for _ in _TYPES]
        for spans, top in find(col, model):
            counts = [0] * len(KINDS)
            for _, k, _ in spans:
                counts[k] += 1
            base = hashlib.sha256(joined(spans, base_only=True).encode()).hexdigest()
            for c, v in zip(cols, (*counts, base, joined(spans), top)):
                c.append(v)
        give_back()
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(cols, _TYPES)], names=[f.name for f in FOUND.fields])

    names = [f.name for f in FOUND.fields]
    keep = [F.col(c) for c in docs.columns if c not in names]
    found = docs.select(*keep, run(F.col(text)).alias("__found"))
    return found.select(*keep, *[F.col("__found")[n].alias(n) for n in names])


def redact(text: Column, model: Model) -> Column:
    """``text`` with every span replaced by its kind in brackets; of overlapping spans the
    union goes, under the kind that begins first. Null stays null."""

    @F.arrow_udf(T.StringType())
    def run(col: pa.Array) -> pa.Array:
        out = []
        for t, (spans, _) in zip(col.to_pylist(), find(col, model)):
            kept, at = [], 0
            for a, k, b in spans:
                if a >= at:
                    kept += [t[at:a], f"[{KINDS[k].upper()}]"]
                at = max(at, b)
            out.append("".join([*kept, (t or "")[at:]]))
        give_back()
        return pa.array(out, pa.string())

    return F.when(text.isNotNull(), run(text))
