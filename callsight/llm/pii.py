"""Personal data by anchor expansion.

One Aho-Corasick pass over each whole text finds *anchors*: at-signs, plus signs, digits,
``://`` and identifier cues (IBAN, account, ...). Around an anchor a deterministic local
parser finds the span's boundaries and validates it. A parser looks at the run of
characters its kind allows only, and no run is parsed twice, so the work is linear in
the text.

Base kinds, in this order: ``email``, ``ip`` (four parts, at most 255 each), ``card`` (12
to 19 digits passing the Luhn test), ``phone`` (+ and 9 to 15 digits). Within a kind the
spans are leftmost and don't overlap; a candidate that fails its test is dropped and not
tried again in part. Added kinds, after them: ``url`` (scheme and host with optional user,
port and path) and ``account`` (an IBAN passing its mod-97 test, or a number behind an
account cue). Positions are code points, ends exclusive.

Defined cases: a null text counts as empty (no spans; ``redact`` keeps it null); repeated rows are searched
each; an empty table gives an empty result; result columns replace columns of the same
name.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsight.llm.text import give_back
from callsight.llm.tokens import texts_of

KINDS = ("email", "ip", "card", "phone", "url", "account")
BASE = KINDS[:4]

Span = tuple[int, int, int]  # start, index of kind, end

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9.]+")
_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])*")
_PHONE_RUN = re.compile(r"[ ().0-9-]*")
_SCHEME_BEFORE = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*\Z")
_URL_REST = re.compile(r"(?:[^\s/?#@<>\"'`\\]++@)?(\[[0-9A-Fa-f:.]+\]|[^\s/?#@:<>\"'`\\()\[\]{}|,;]+)(?::[0-9]{1,5})?(?:[/?#][^\s<>\"'`\\{}|]*)?")
_ACCOUNT = re.compile(r"(?:\s{0,3}(?:no|nr|number|num|id|#|is)\b\.?)?[\s.:#=-]{1,4}([A-Z]{0,4}[0-9](?:[ -]?[0-9]){5,29})(?![A-Za-z0-9])", re.I)
_IBAN = re.compile(r"[\s.:#=-]{0,4}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
_SCHEMES = frozenset(("http", "https", "ftp", "ftps", "ws", "wss", "ssh", "git", "sftp", "ldap", "ldaps"))
# --- fixed values: words in front of account numbers --------------------------------
CUES = ("account", "acct", "customer", "passport", "routing")


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for c in "0123456789":
        a.add_word(c, "digit")
    a.add_word("@", "at")
    a.add_word("+", "plus")
    a.add_word("://", "scheme")
    for cue in CUES:
        for form in {cue, cue.title(), cue.upper()}:
            a.add_word(form, "cue")
    for form in ("iban", "IBAN", "Iban"):
        a.add_word(form, "iban")
    a.make_automaton()
    return a


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        if k % 2:
            v = v * 2 - 9 * (v > 4)
        total += v
    return total % 10 == 0


def iban_ok(s: str) -> bool:
    s = s.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


class Finder:
    """The spans of one text."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.spans: list[Span] = []
        #: per parser: where its last match or parsed run ended
        self.email_end = self.dotted_end = self.chain_end = self.phone_end = self.url_end = self.account_end = 0

    def find(self) -> list[Span]:
        parse = {"digit": self.digit, "at": self.at, "plus": self.plus, "scheme": self.scheme, "cue": self.cue, "iban": self.iban}
        for end, kind in automaton().iter(self.text):
            parse[kind](end)
        return sorted(self.spans)

    def add(self, kind: str, start: int, end: int) -> None:
        self.spans.append((start, KINDS.index(kind), end))

    def at(self, at: int) -> None:
        """Email: the domain behind the sign, then the local part in front of it, which
        may not reach into the email before."""
        domain = _DOMAIN.match(self.text, at + 1)
        if domain is None:
            return
        start, text = at, self.text
        while start > self.email_end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            self.add("email", start, domain.end())
            self.email_end = domain.end()

    def digit(self, at: int) -> None:
        if at >= self.dotted_end:
            self.dotted(at)
        if at >= self.chain_end:
            self.chain(at)

    def dotted(self, at: int) -> None:
        """Every four numbers in a row of a run of digits and dots, from its front."""
        run = _DOTTED.match(self.text, at)
        self.dotted_end = run.end()
        start, parts = at, []
        for part in run.group().split("."):
            if part:
                parts.append((start, part))
            else:
                parts = []
            start += len(part) + 1
            if len(parts) == 4:
                if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for _, p in parts):
                    self.add("ip", parts[0][0], parts[3][0] + len(parts[3][1]))
                parts = []

    def chain(self, at: int) -> None:
        """Card: digits with single spaces or hyphens between them."""
        run = _CHAIN.match(self.text, at)
        self.chain_end = run.end()
        if run.end() - at >= 12:
            digits = run.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                self.add("card", at, run.end())

    def plus(self, at: int) -> None:
        """Phone: from the plus to the last digit of the run behind it."""
        text = self.text
        if not text[at + 1 : at + 2] or text[at + 1] not in "0123456789":
            return
        end = _PHONE_RUN.match(text, at + 2).end()
        while end > at + 3 and text[end - 1] not in "0123456789":
            end -= 1
        if end <= at + 3:  # nothing between the first digit and the last
            return
        if 9 <= sum(c in "0123456789" for c in text[at + 1 : end]) <= 15:
            self.add("phone", at, end)

    def scheme(self, end: int) -> None:
        """URL: a known scheme in front of ``://``, host and path behind it."""
        colon = end - 2
        if colon < self.url_end:
            return
        before = _SCHEME_BEFORE.search(self.text, max(self.url_end, colon - 8), colon)
        rest = _URL_REST.match(self.text, end + 1)
        if before is None or rest is None or before.group().lower() not in _SCHEMES:
            return
        host = rest.group(1)
        if not re.search(r"[^\W_]", host):
            return
        stop = rest.end()
        while self.text[stop - 1] in ".,;:!?)":
            stop -= 1
        if stop > end + 1:
            self.add("url", before.start(), stop)
            self.url_end = stop

    def cue(self, end: int) -> None:
        number = _ACCOUNT.match(self.text, end + 1)
        if number and number.start(1) >= self.account_end:
            self.add("account", number.start(1), number.end(1))
            self.account_end = number.end(1)

    def iban(self, end: int) -> None:
        number = _IBAN.match(self.text, end + 1)
        if number and number.start(1) >= self.account_end and iban_ok(number.group(1)):
            self.add("account", number.start(1), number.end(1))
            self.account_end = number.end(1)


def find_spans(text: str) -> list[Span]:
    return Finder(text).find()


def joined(spans: list[Span], base_only: bool = False) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans if not base_only or k < len(BASE))


def redacted(text: str, spans: list[Span]) -> str:
    """Each span replaced by its kind in brackets; of overlapping spans the union goes,
    under the kind that begins first."""
    out, at = [], 0
    for a, k, b in spans:
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


FOUND = T.StructType([T.StructField(f"n_{k}", T.LongType()) for k in KINDS] + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])
_ARROW = [pa.field(f.name, pa.int64() if f.name.startswith("n_") else pa.string()) for f in FOUND.fields]


@F.arrow_udf(FOUND)
def _find(col: pa.Array) -> pa.Array:
    cols: list[list] = [[] for _ in _ARROW]
    for part in texts_of(col):
        for text in part:
            spans = find_spans(text)
            counts = [0] * len(KINDS)
            for _, k, _ in spans:
                counts[k] += 1
            base = joined(spans, base_only=True)
            for c, v in zip(cols, (*counts, hashlib.sha256(base.encode()).hexdigest(), joined(spans))):
                c.append(v)
    give_back()
    return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _ARROW)], fields=_ARROW)


@F.arrow_udf(T.StringType())
def _redact(col: pa.Array) -> pa.Array:
    out = [redacted(t, find_spans(t)) for part in texts_of(col) for t in part]
    give_back()
    return pa.array(out, pa.string())


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a count per kind, ``spans`` (kind:start:end of all, by start, then
    kind) and ``base_sha256`` (of the same list over the base kinds)."""
    names = [f.name for f in FOUND.fields]
    keep = [F.col(c) for c in docs.columns if c not in names]
    return docs.select(*keep, _find(F.col(text)).alias("__found")).select(*keep, *[F.col("__found")[n].alias(n) for n in names])


def redact(text: Column) -> Column:
    """``text`` with every span replaced by its kind in brackets; null stays null."""
    return F.when(text.isNotNull(), _redact(text))
