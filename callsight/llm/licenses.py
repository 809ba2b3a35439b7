"""Licence scans: an Aho-Corasick automaton finds notice phrases and identifier tags, a
shunting-yard parser evaluates the licence expression behind each tag.

A text is lower-cased in A-Z and cut into words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.
The automaton runs once over the words joined by single spaces, so a phrase is found
wherever its words stand consecutively, whatever punctuation or line breaks separate
them; overlapping places all count. Where the tag ``SPDX-License-Identifier:`` stands, hyphens
and colon included, the raw text behind it is parsed, up to the end of the line, or further while
a parenthesis or an operator is open: identifiers, ``AND``, ``OR``, ``WITH`` and parentheses
(``WITH`` binds most, ``OR`` least). Identifiers are those of the public list, by their stems
with any version, ``LicenseRef-`` and ``DocumentRef-`` names, and exceptions behind ``WITH``;
another word is prose and ends the expression. Of a malformed expression the front part counts,
without operators and parentheses left open at its end, and with those around it closed. An
expression is turned to postfix order and evaluated twice: for the labels it names, and
for whether some choice of it uses permissive licences only.

Defined cases: a null text counts as empty (no words, no places, null positions, empty
label strings, score 0); an expression without a front part gives no labels; repeated rows
are scanned each; an empty table gives an empty result; result columns replace columns
of the same name. Texts are scanned whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsight.llm.text import give_back
from callsight.llm.tokens import texts_of

# --- fixed values: phrases that count as base places, and their labels ---------------
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
# --- fixed values: further notice phrases, their labels and weights ------------------
NOTICE_PHRASES = {
    "permission is hereby granted free of charge to any person obtaining a copy": ("mit", 0.9),
    "redistribution and use in source and binary forms": ("bsd", 0.9),
    "bsd license": ("bsd", 0.6),
    "mozilla public license": ("mpl", 0.6),
    "eclipse public license": ("epl", 0.6),
    "lesser general public license": ("lgpl", 0.6),
    "affero general public license": ("agpl", 0.6),
    "licensed under cc by": ("cc", 0.6),
    "licensed under cc0": ("cc", 0.6),
    "creative commons attribution": ("cc", 0.6),
    "released into the public domain": ("public-domain", 0.6),
    "this is free and unencumbered software": ("unlicense", 0.9),
    "boost software license": ("bsl", 0.6),
    "all rights reserved": ("all-rights-reserved", 0.3),
}
# --- fixed values: stems of the licence identifiers on the public list ---------------
STEMS = (
    "0BSD AAL AFL AGPL Apache APSL Artistic Beerware BitTorrent BlueOak BSD BSL BUSL bzip2 CAL CC CC0 CDDL CDLA CECILL "
    "CERN-OHL ClArtistic CNRI CPAL CPL curl ECL EFL EPL EUDatagrid EUPL Fair FSFAP FTL GFDL GPL HPND ICU IJG IPL ISC JSON "
    "LAL Latex2e LGPL Libpng libtiff LPL LPPL MirOS MIT MPL MS-PL MS-RL MulanPSL NASA NCSA NGPL NIST NLPL NPL NTP OCLC "
    "ODbL ODC-By OFL OGL OLDAP OpenSSL OSET-PL OSL PDDL PHP PostgreSQL PSF Python QPL Ruby SGI-B SISSL Sleepycat SPL SSPL "
    "TCL Unicode Unlicense UPL Vim VSL W3C WTFPL X11 Xnet Zend Zlib ZPL"
).split()
TAG = "spdx license identifier"
BASE_WEIGHT, TAG_WEIGHT = 0.6, 0.95
PERMISSIVE = {"mit", "apache", "bsd", "isc", "zlib", "bsl", "unlicense", "cc0", "0bsd", "public-domain"}

_KEEP = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
_TOKEN = re.compile(r"\(|\)|[A-Za-z0-9][A-Za-z0-9.+:-]*")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_TAG_COLON = re.compile(r"[ \t]*:")
#: a stem, perhaps with parts behind hyphens and a plus; or a reference
_IDENTIFIER = re.compile(rf"(?:{'|'.join(map(re.escape, STEMS))})(?:-[a-z0-9.]+)*\+?|(?:licenseref|documentref)-[a-z0-9.:-]+", re.I)
_EXCEPTION = re.compile(r"[a-z0-9.-]*(?:exception|syscall-note|linking)[a-z0-9.-]*", re.I)
_STRENGTH = {"or": 1, "and": 2, "with": 3}

RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_base", T.LongType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
        T.StructField("base_labels", T.StringType()),
        T.StructField("labels", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("expressions", T.ArrayType(T.StringType())),
        T.StructField("permissive", T.BooleanType()),
    ]
)
_ARROW = pa.struct(
    [(f.name, pa.list_(pa.string()) if f.name == "expressions" else {"long": pa.int64(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_()}[f.dataType.typeName()]) for f in RESULT.fields]
)


# --- expressions -------------------------------------------------------------------


def is_operand(token: str, before: str) -> bool:
    """Whether a token is a licence, or behind ``WITH`` an exception."""
    return bool((_EXCEPTION if before.lower() == "with" else _IDENTIFIER).fullmatch(token.rstrip(".:")))


def to_postfix(expression: str) -> list[tuple[str, str]] | None:
    """Shunting-yard: the tokens in postfix order as ("id"|"op", text), or None if the
    expression is malformed. Stops in front of what can't belong to an expression."""
    out: list[tuple[str, str]] = []
    ops: list[str] = []
    operand = False  # whether the last token ended an operand
    for t in _TOKEN.findall(expression):
        low = t.lower()
        if low in _STRENGTH:
            if not operand:
                return None
            while ops and ops[-1] != "(" and _STRENGTH[ops[-1]] >= _STRENGTH[low]:
                out.append(("op", ops.pop()))
            ops.append(low)
            operand = False
        elif t == "(":
            if operand:
                break
            ops.append(t)
        elif t == ")":
            if not operand or "(" not in ops:
                break
            while ops[-1] != "(":
                out.append(("op", ops.pop()))
            ops.pop()
        else:
            if operand:  # two identifiers in a row: prose has begun
                break
            out.append(("id", low.rstrip(".:")))
            operand = True
    if not operand or "(" in ops:
        return None
    while ops:
        out.append(("op", ops.pop()))
    return out


def front(text: str, at: int) -> list[tuple[str, str]] | None:
    """The longest front part of an expression that starts at this place, in postfix order;
    None if there is none. A line's end ends it where nothing is open."""
    taken: list[str] = []
    deep, operand = 0, False
    for m in _TOKEN.finditer(text, at):
        if "\n" in text[at : m.start()] and (operand and not deep or not taken):
            break
        t, at = m.group(), m.end()
        if t.lower() in _STRENGTH or t == ")":
            if not operand or t == ")" and not deep:
                break
            operand = t == ")"
            deep -= operand
        elif operand or t != "(" and not is_operand(t, taken[-1] if taken else ""):
            break
        else:
            operand = t != "("
            deep += not operand
        taken.append(t)
    while taken and (taken[-1] == "(" or taken[-1].lower() in _STRENGTH):
        deep -= taken.pop() == "("
    return to_postfix(" ".join(taken + [")"] * deep))


def family(identifier: str) -> str:
    """Label of a licence identifier: the part before its version (``gpl-3.0-only``: gpl)."""
    return identifier if identifier in PERMISSIVE else identifier.split("-")[0].rstrip("+")


def evaluate(postfix: list[tuple[str, str]]) -> tuple[set[str], bool, str]:
    """(labels named, whether a choice with permissive licences only exists, the
    expression in full parentheses). What follows WITH is an exception, not a licence."""
    stack: list[tuple[set[str], bool, str]] = []
    for kind, text in postfix:
        if kind == "id":
            label = family(text)
            stack.append(({label}, label in PERMISSIVE, text))
            continue
        right, left = stack.pop(), stack.pop()
        shown = f"({left[2]} {text} {right[2]})"
        if text == "with":
            stack.append((left[0], left[1], shown))
        elif text == "and":
            stack.append((left[0] | right[0], left[1] and right[1], shown))
        else:
            stack.append((left[0] | right[0], left[1] or right[1], shown))
    return stack.pop()


# --- scan --------------------------------------------------------------------------


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    """Phrases with a space at either end, so that only whole words match."""
    a = ahocorasick.Automaton()
    for phrase, label in BASE_PHRASES.items():
        a.add_word(f" {phrase} ", ("base", phrase, label, BASE_WEIGHT))
    for phrase, (label, weight) in NOTICE_PHRASES.items():
        a.add_word(f" {phrase} ", ("notice", phrase, label, weight))
    a.add_word(f" {TAG} ", ("tag", TAG, "", 0.0))
    a.make_automaton()
    return a


def expressions_at(text: str, word_ends: set[int]) -> Iterator[list[tuple[str, str]]]:
    """Parsed expressions behind the tags that end with the words of these numbers."""
    raw = TAG.replace(" ", "-")
    for k, m in enumerate(_WORD.finditer(text)):
        if k in word_ends and text[max(0, m.end() - len(raw)) : m.end()].lower() == raw:
            if (colon := _TAG_COLON.match(text, m.end())) and (postfix := front(text, colon.end())) is not None:
                yield postfix


def scan(text: str) -> tuple:
    words = text.encode("utf-8", "surrogatepass").translate(_KEEP).split(b" ")
    words = [w for w in words if w]
    # one character per byte: places are the same, and matching needs no decoding
    joined = (b" " + b" ".join(words) + b" ").decode("latin-1")
    spaces: np.ndarray | None = None
    starts: list[int] = []
    base, found, miss, tags = set(), set(), 1.0, set()
    for end, (kind, phrase, label, weight) in automaton().iter(joined):
        if spaces is None:
            spaces = np.flatnonzero(np.frombuffer(joined.encode("latin-1"), np.uint8) == 0x20)
        at = int(np.searchsorted(spaces, end - len(phrase) - 1))  # words before the phrase
        if kind == "base":
            miss *= 1.0 - weight
            starts.append(at)
            base.add(label)
        elif kind == "notice":
            miss *= 1.0 - weight
            found.add(label)
        else:
            tags.add(at + TAG.count(" "))
    shown, permissive = [], None
    if tags:
        for postfix in expressions_at(text, tags):
            labels, ok, text_form = evaluate(postfix)
            found |= labels
            miss *= 1.0 - TAG_WEIGHT
            shown.append(text_form)
            permissive = ok if permissive is None else permissive and ok
    return (
        len(words),
        len(starts),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(base | found)),
        min(1.0, max(0.0, 1.0 - miss)),
        shown,
        permissive,
    )


@F.arrow_udf(RESULT)
def _scan(col: pa.Array) -> pa.Array:
    rows = [scan(t) for part in texts_of(col) for t in part]
    give_back()
    cols = zip(*rows) if rows else [[] for _ in _ARROW]
    return pa.StructArray.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, _ARROW)], fields=list(_ARROW))


def scan_licenses(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``n_base`` (all base places), ``first_word`` and
    ``last_word`` (smallest and largest start of a base place), ``base_labels`` and
    ``labels`` (sorted, comma-joined), ``score`` (0 to 1: how sure some licence is
    named), ``expressions`` and ``permissive`` (null without an expression)."""
    names = [f.name for f in RESULT.fields]
    keep = [F.col(c) for c in docs.columns if c not in names]
    scanned = docs.select(*keep, _scan(F.col(text)).alias("__scan"))
    return scanned.select(*keep, *[F.col("__scan")[n].alias(n) for n in names])
