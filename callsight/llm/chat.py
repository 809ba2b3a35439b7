"""Quotation linking: chat messages without their quotes, in reply order.

1. *Parse.* Lines of a message have a quote level, the number of ``>`` in front of them;
   neighbouring lines of one level are a passage, blank lines separate passages. Level 0
   is the message's own text; a line that ends in ``wrote:`` right in front of a quote
   belongs to the quote.
2. *Hash.* A passage is normalised (NFKC, case folded, white space collapsed) and hashed,
   as a whole and by sentence, and so is each of its lines, so re-wrapped and partial
   quotes are found again. A quote's longest match inside its level counts.
3. *Link.* Hashes of quoted passages are joined to those of own text: to the first
   message of the same conversation that has the passage, if that is earlier, else, from
   ``AWAY`` characters on, to the first message (by conversation and turn) of another one:
   thanks and rules of dashes stand in many conversations. A message replies to the
   original of its least deep linked quote. Originals are cut to hashes that are quoted
   and reduced to one row per hash (and conversation) before the join, so a passage that
   very many messages have or quote makes no pairs between them.
4. *Order.* A reply follows its original: links inside a conversation are followed to the
   thread's first message by pointer doubling, and messages are ordered by that message's
   turn, then their own. Positions are computed by ``ranking``, so a conversation may
   hold any share of the rows.

Defined cases: a null text counts as empty; rows with a null conversation or turn are
neither linked nor linked to, and are kept; repeated rows are kept and linked each; a very
long text is parsed whole, line by line, in one task, and travels with its row only; a
quote without an original leaves its message unlinked; white space at the ends of the own
text goes; an empty table gives an empty result; of other columns, those that aren't
result columns are kept.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsight.llm.ranking import ranked
from callsight.llm.tokens import texts_of
from callsight.session import materialize

_MARKS = re.compile(r"[ \t]*(?:>[ \t]?)+")
_WROTE = re.compile(r"\bwrote:\s*$", re.I)
_SENTENCE = re.compile(r"(?<=[.!?…。])\s+")
QUOTE = T.StructType([T.StructField("level", T.IntegerType()), T.StructField("hash", T.LongType()), T.StructField("size", T.IntegerType())])

PARSED = T.StructType(
    [
        T.StructField("body", T.StringType()),
        T.StructField("quotes", T.ArrayType(QUOTE)),
        T.StructField("own", T.ArrayType(T.LongType())),
        T.StructField("lines", T.ArrayType(QUOTE)),
    ]
)
_QUOTES = pa.list_(pa.struct([("level", pa.int32()), ("hash", pa.int64()), ("size", pa.int32())]))
_ARROW = [
    pa.field("body", pa.string()),
    pa.field("quotes", _QUOTES),
    pa.field("own", pa.list_(pa.int64())),
    pa.field("lines", _QUOTES),
]
#: characters of normalised text that a quote needs for a link to another conversation
AWAY = 24
#: characters of a text that rows of equal turn are dealt by
FRONT = 32
RESULT = ("quoted_conv_id", "quoted_turn", "thread_turn", "depth", "n_quotes", "position")


def split_levels(text: str) -> list[tuple[int, str]]:
    """The lines as (quote level, text behind the marks)."""
    lines = []
    for line in text.split("\n"):
        line = line.rstrip("\r")
        m = _MARKS.match(line)
        lines.append((m.group().count(">"), line[m.end() :]) if m else (0, line))
    for i in range(len(lines) - 1):
        if lines[i][0] < lines[i + 1][0] and _WROTE.search(lines[i][1]):
            lines[i] = lines[i + 1][0], ""
    return lines


def passages(lines: list[tuple[int, str]]) -> Iterator[tuple[int, str]]:
    """(level, text) of every passage."""
    level, held = 0, []
    for at, line in [*lines, (-1, "")]:
        if at != level or not line.strip():
            if held:
                yield level, " ".join(held)
            level, held = at, []
        if line.strip():
            held.append(line)


def normal(text: str) -> str:
    return " ".join(unicodedata.normalize("NFKC", text).casefold().split())


def digest(s: str) -> int:
    return int.from_bytes(hashlib.blake2b(s.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def hashes(passage: str) -> Iterator[tuple[int, int]]:
    """(hash, characters) of a passage and of its sentences."""
    whole = normal(passage)
    for s in sorted({whole, *_SENTENCE.split(whole)} - {""}):
        yield digest(s), len(s)


def line_hashes(lines: list[tuple[int, str]]) -> set[tuple[int, int, int]]:
    """(level, hash, characters) of every line that isn't blank."""
    return {(level, digest(s), len(s)) for level, line in lines if (s := normal(line))}


def parse(text: str) -> tuple[str, list[dict], list[int]]:
    lines = split_levels(text)
    quotes, own = {}, set()
    for level, passage in passages(lines):
        for h, size in hashes(passage):
            if level:
                quotes[level, h] = size
            else:
                own.add(h)
    own.update(h for level, h, _ in line_hashes(lines) if not level)
    body = re.sub(r"\n{3,}", "\n\n", "\n".join(t for level, t in lines if not level)).strip()
    return body, [{"level": level, "hash": h, "size": n} for (level, h), n in sorted(quotes.items())], sorted(own)


def quoted_lines(text: str) -> list[dict]:
    """The lines of quotes, like the quotes of :func:`parse`."""
    return [{"level": level, "hash": h, "size": n} for level, h, n in sorted(line_hashes(split_levels(text))) if level]


@F.arrow_udf(PARSED)
def _parse(col: pa.Array) -> pa.Array:
    rows = [(*parse(t), quoted_lines(t)) for part in texts_of(col) for t in part]
    cols = list(zip(*rows)) if rows else [[], [], [], []]
    return pa.StructArray.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, _ARROW)], fields=_ARROW)


def quotation_links(parsed: DataFrame) -> DataFrame:
    """(``conv_id``, ``turn``, ``quoted_conv_id``, ``quoted_turn``): the message each
    message replies to, for those with a linked quote."""
    known = parsed.filter(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    quotes = known.select("conv_id", "turn", F.explode("quotes").alias("q")).select("conv_id", "turn", "q.level", "q.hash", "q.size").distinct()
    quotes = materialize(quotes, "quotes")
    wanted = quotes.select("hash").distinct()
    own = known.select("conv_id", "turn", F.explode("own").alias("hash")).join(wanted, "hash", "left_semi")
    here = materialize(own.groupBy("conv_id", "hash").agg(F.min("turn").alias("here")), "originals")
    # of every hash the first message, and the first one of another conversation
    first = here.groupBy("hash").agg(F.min(F.struct("conv_id", "here")).alias("first"))
    other = here.join(first, "hash").filter(F.col("conv_id") != F.col("first.conv_id")).groupBy("hash").agg(F.min(F.struct("conv_id", "here")).alias("second"))
    anywhere = first.join(other, "hash", "left")
    found = quotes.join(here, ["conv_id", "hash"], "left").join(anywhere, "hash", "left")
    inside = F.col("here") < F.col("turn")
    away = F.when(F.col("first.conv_id") != F.col("conv_id"), F.col("first")).otherwise(F.col("second"))
    target = F.when(inside, F.struct(F.col("conv_id"), F.col("here"))).when(F.col("size") >= F.lit(AWAY), away)
    found = found.withColumn("__to", target).filter(F.col("__to.here").isNotNull())
    best = F.min(F.struct("level", F.coalesce(~inside, F.lit(True)).alias("away"), (-F.col("size")).alias("size"), F.col("__to.conv_id").alias("c"), F.col("__to.here").alias("t")))
    picked = found.groupBy("conv_id", "turn").agg(best.alias("best"))
    return picked.select("conv_id", "turn", F.col("best.c").alias("quoted_conv_id"), F.col("best.t").alias("quoted_turn"))


def threads(links: DataFrame) -> DataFrame:
    """(``conv_id``, ``turn``, ``thread_turn``, ``depth``) of every message that replies
    inside its conversation, by pointer doubling: each step halves the way to the top."""
    up = links.filter(F.col("conv_id") == F.col("quoted_conv_id")).select("conv_id", "turn", F.col("quoted_turn").alias("thread_turn"), F.lit(1).cast("long").alias("depth"))
    up = materialize(up, "threads")
    while True:
        above = up.select("conv_id", F.col("turn").alias("thread_turn"), F.col("thread_turn").alias("__top"), F.col("depth").alias("__more"))
        joined = up.join(above, ["conv_id", "thread_turn"], "left")
        step = joined.select(
            "conv_id",
            "turn",
            F.coalesce("__top", "thread_turn").alias("thread_turn"),
            (F.col("depth") + F.coalesce("__more", F.lit(0))).alias("depth"),
            F.col("__top").isNotNull().alias("__moved"),
        )
        step = materialize(step, "threads")
        moved = not step.filter("__moved").isEmpty()
        up = step.drop("__moved")
        if not moved:
            return up


def link_quotes(messages: DataFrame, text: str = "text") -> DataFrame:
    """``messages`` (``conv_id``, ``turn``, text and more) with the text's quotes taken
    out, the message it replies to (``quoted_conv_id``, ``quoted_turn``), the thread's
    first turn, ``depth`` in the thread, ``n_quotes`` (quoted passages and sentences), and
    ``position`` in the conversation's reply order, from 0."""
    keep = [c for c in messages.columns if c not in RESULT]
    parsed = messages.select(*keep, _parse(F.col(text)).alias("__parsed"))
    without = [F.col("__parsed.body").alias(c) if c == text else F.col(c) for c in keep]
    parsed = materialize(parsed.select(*without, F.col("__parsed.quotes").alias("__quotes"), F.col("__parsed.own").alias("__own"), F.col("__parsed.lines").alias("__lines")), "parsed")
    links = materialize(quotation_links(parsed.select("conv_id", "turn", F.concat("__quotes", "__lines").alias("quotes"), F.col("__own").alias("own"))), "links")
    out = parsed.select(*keep, F.size("__quotes").cast("long").alias("n_quotes"))
    out = out.join(links, ["conv_id", "turn"], "left").join(threads(links), ["conv_id", "turn"], "left")
    out = out.withColumn("thread_turn", F.coalesce("thread_turn", "turn")).withColumn("depth", F.coalesce("depth", F.lit(0).cast("long")))
    place = [F.col("thread_turn").asc_nulls_last(), F.col("turn").asc_nulls_last()]
    # rows of equal turn are ordered by text, but dealt by its front: what they are dealt by goes to the driver
    out = ranked(out, ["conv_id"], [*place, F.col(text)], "position", deal=[*place, F.left(F.col(text).cast("string"), F.lit(FRONT))])
    return out.select(*keep, *RESULT)
