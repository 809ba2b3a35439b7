"""Token counts: batch encoding in Arrow functions that return lengths only.

A batch of an Arrow function is worked through in parts of about ``PART_BYTES`` bytes of
text (not a number of rows), and inside a part each text is cut at *safe boundaries* into
fragments. For a byte-level BPE tokenizer every place where a white space follows a
non-space character is safe: its pre-tokenizer starts a new piece there, whatever
comes before or after, so the tokens of a text are those of its fragments, one after
another. Fragments are found and counted in array operations on the texts' bytes;
distinct ones that the worker has not met before are encoded in one batch call, and
lengths are summed per text. Tokenizers of other kinds are given whole texts, in the same
byte-balanced parts.

Only lengths go back to the JVM. A text is never cut short, and a very long text only
makes a part of its own.

Defined cases: a null text counts as empty and has 0 tokens; special strings inside a
text are treated as the library does by default; repeated rows each get their count; an
empty table gives an empty result; columns named like a result column are replaced.
"""

from __future__ import annotations

import os
import re
import struct
import sys
from array import array
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsight.llm.text import IS_SPACE, PLACE, by_bytes, give_back, mix, string_buffers, strings, words

#: bytes of text encoded at once
PART_BYTES = 2 << 20
#: fragments that a worker remembers (beyond, it starts anew); about 50 bytes each
MEMORY = 500_000

_SAFE = re.compile(r"(?<=\S)(?=[ \n])")
#: punctuation behind a letter starts a new piece as well (see ``words``)
_PIECE = re.compile(r"(?<=[A-Za-z])(?=[.,;:!?])")
_encoders: dict[tuple[str, int], "Encoder"] = {}


class Tokenizer:
    """A tokenizer file, read where the job is built and sent along with the function, so
    executors need no file of their own."""

    def __init__(self, path: str) -> None:
        self.kind = "sentencepiece" if path.endswith(".model") else "tokenizers"
        with open(path, "rb") as f:
            self.blob = f.read()

    def encoder(self) -> Encoder:
        """The worker's encoder for this file; its memory lasts as long as the worker."""
        key = (self.kind, hash(self.blob))
        if key not in _encoders:
            _encoders[key] = Encoder(self.kind, self.blob)
        return _encoders[key]


class Encoder:
    def __init__(self, kind: str, blob: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker per core
        self.kind = kind
        self.memory = Memory()
        if kind == "sentencepiece":
            import sentencepiece

            self.model = sentencepiece.SentencePieceProcessor(model_proto=blob)
            self.cuts = False
            return
        import json

        import tokenizers

        self.model = tokenizers.Tokenizer.from_str(blob.decode())
        self.model.no_truncation()
        self.model.no_padding()
        spec = json.loads(blob)
        pre = spec.get("pre_tokenizer") or {}
        #: byte-level splitting with nothing around it that looks across a boundary
        self.cuts = (
            pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True)
            and not pre.get("add_prefix_space", True)
            and spec.get("normalizer") is None
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) or _PIECE.search(t["content"]) for t in spec["added_tokens"])
        )

    def encode(self, texts: Sequence[str]) -> list[Sequence[int]]:
        """Token ids without any added special token."""
        if self.kind == "sentencepiece":
            return self.model.encode(list(texts), num_threads=1)
        return [e.ids for e in self.model.encode_batch_fast(list(texts), add_special_tokens=False)]

    def _fragments(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All texts as fragments of one word each (or a word up to its punctuation, and
        that), with the white space before it: (index of each text's first fragment, each
        fragment's slot in the memory, whether a text is made of such fragments). A text
        with two spaces in a row, or one at its end, is not."""
        word, begin, end, first = words(data, offs, lower=False, at_stops=True)
        text = np.repeat(np.arange(len(offs) - 1), np.diff(first))
        before = np.where(begin == offs[text], 0, data[np.maximum(begin - 1, 0)]) if len(begin) else np.empty(0, np.uint8)
        spaced = IS_SPACE[before]
        key = mix(word ^ (np.where(spaced, before, 0).astype(np.uint64) * PLACE[62]))
        distinct, at, number = np.unique(key, return_index=True, return_inverse=True)
        if len(self.memory.keys) > MEMORY:
            self.memory.clear()
        slot = self.memory.find(distinct)
        new = np.flatnonzero(slot < 0)
        if len(new):
            texts = strings(data, begin[at[new]] - spaced[at[new]], end[at[new]])
            self.memory.add(distinct[new], self.encode(texts), [t[-1].isspace() for t in texts])
            slot = self.memory.find(distinct)
        slot = slot[number]
        plain = np.diff(first) > 0
        gap = begin - np.where(np.arange(len(begin)) == first[text], offs[text], np.concatenate([[0], end[:-1]])) if len(begin) else begin
        plain[text[(gap > 1) | self.memory.odd[slot]]] = False
        last = first[1:][plain] - 1
        plain[np.flatnonzero(plain)[end[last] != offs[1:][plain]]] = False
        return first, slot, plain

    def count(self, texts: pa.Array) -> list[int]:
        """Number of ids of each text."""
        if not self.cuts:
            return [len(x) for x in self.encode([t or "" for t in texts.to_pylist()])]
        first, slot, plain = self._fragments(*string_buffers(texts))
        run = np.concatenate([[0], np.cumsum(self.memory.length[slot], dtype=np.int64)])
        out = (run[first[1:]] - run[first[:-1]]).tolist()
        for i, ids in self._other(texts, plain):
            out[i] = len(ids) // 4
        return out

    def ids(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text as unsigned little-endian 32-bit numbers."""
        if not self.cuts:
            return [_as_bytes(x) for x in self.encode([t or "" for t in texts.to_pylist()])]
        first, slot, plain = self._fragments(*string_buffers(texts))
        each = self.memory.length[slot]
        run = np.concatenate([[0], np.cumsum(each, dtype=np.int64)])
        token = self.memory.ids[np.arange(run[-1]) + np.repeat(self.memory.start[slot] - run[:-1], each)]
        cut = run[first]
        out = [token[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])]
        for i, ids in self._other(texts, plain):
            out[i] = ids
        return out

    def _other(self, texts: pa.Array, plain: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """(index, ids) of the texts that are not plain."""
        other = [(int(i), texts[int(i)].as_py()) for i in np.flatnonzero(~plain)]
        other = [(i, fragments(t)) for i, t in other if t]
        distinct = list(set().union(*[p for _, p in other]))
        known = dict(zip(distinct, map(_as_bytes, self.encode(distinct))))
        for i, p in other:
            yield i, b"".join([known[f] for f in p])


class Memory:
    """Fragments met before, as sorted arrays: the hash, where the ids stand in ``ids``,
    how many they are, and whether the fragment ends in a white space of a kind that the
    next space would join (then texts with it are not plain)."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.keys = np.empty(0, np.uint64)
        self.start = np.empty(0, np.int32)
        self.length = np.empty(0, np.int32)
        self.odd = np.empty(0, bool)
        self.ids = np.empty(0, "<u4")

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slots of the keys, -1 for those not here."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)

    def add(self, keys: np.ndarray, ids: list[Sequence[int]], odd: list[bool]) -> None:
        """Adds ascending keys that are not here."""
        length = np.array([len(x) for x in ids], dtype=np.int64)
        flat = np.frombuffer(_as_bytes([i for x in ids for i in x]), "<u4")
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.start = np.insert(self.start, at, len(self.ids) + np.cumsum(length) - length)
        self.length = np.insert(self.length, at, length)
        self.odd = np.insert(self.odd, at, odd)
        self.ids = np.concatenate([self.ids, flat])


def _as_bytes(ids: Sequence[int]) -> bytes:
    return array("I", ids).tobytes() if sys.byteorder == "little" else struct.pack(f"<{len(ids)}I", *ids)


def fragments(text: str) -> list[str]:
    """``text`` cut wherever a space or line feed follows a non-space character; joined,
    they give the text again."""
    return _SAFE.split(text)


def texts_of(col: pa.Array) -> Iterable[list[str]]:
    """The texts of an Arrow column in parts of about ``PART_BYTES``; null as empty."""
    for lo, hi in by_bytes(col, PART_BYTES):
        yield [t or "" for t in col.slice(lo, hi - lo).to_pylist()]


def token_count(text: Column, tokenizer: Tokenizer) -> Column:
    """Number of tokens of a text column."""

    @F.arrow_udf(T.LongType())
    def lengths(col: pa.Array) -> pa.Array:
        encoder = tokenizer.encoder()
        out: list[int] = []
        for lo, hi in by_bytes(col, PART_BYTES):
            out.extend(encoder.count(col.slice(lo, hi - lo)))
        give_back()
        return pa.array(out, pa.int64())

    return lengths(text)


def count_tokens(docs: DataFrame, tokenizer_path: str, text: str = "text", limit: int = 1024) -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than
    ``limit`` tokens)."""
    tokenizer = Tokenizer(tokenizer_path)
    return (
        docs.withColumn("n_bytes", F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long"))
        .withColumn("n_tokens", token_count(F.col(text), tokenizer))
        .withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
    )
