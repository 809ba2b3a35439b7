"""Quality rules with a hashed n-gram classifier.

Rules: word and symbol counts, repeated lines and repeated five-word windows, from whole
texts. Classifier: logistic regression over hashed word n-grams (1 and 2 words) and
character n-grams (3 and 4 bytes), each family as relative frequencies, so scoring a text
is one gather and one sum per family, done in Arrow batches. It is fitted on labelled
quality rows and calibrated (Platt) on labelled rows kept apart, so its score is a
probability, which is held against a fixed threshold.

Fitting takes a bounded sample of the labelled rows whose texts have at most
``SAMPLE_TEXT`` bytes: ``SAMPLE_ROWS`` rows, the first by a hash of their id, and of those
as many as fit into ``SAMPLE_BYTES``. As longer texts are left out, none of them can take
the place of the others. Sizes are summed before any text moves. One task fits the weights,
which have a fixed size; everything else covers all rows.

Defined cases: a null text has no words (and fails the rules); without labelled rows of
both classes there is no classifier, and the rules alone decide; null labels are not
used, repeated labels of an id count each; a null id gets a verdict like any other; an
empty table gives an empty result; result columns replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsight.llm.text import CHUNK, IS_SPACE, U64, by_bytes, give_back, ngrams, string_buffers, words

#: labelled rows, and bytes of their texts, that the classifier is fitted on at most
SAMPLE_ROWS, SAMPLE_BYTES = 4000, 24 << 20
#: bytes of a text that may be in the sample
SAMPLE_TEXT = 256 << 10
BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
PART_BYTES = 2 << 20
#: a row is kept from this probability of good quality on
THRESHOLD = 0.3
MIN_WORDS, WINDOW, MAX_REPEAT_PERCENT = 10, 5, 20
SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True

# (unit, length): four families of hashed features
FAMILIES = (("word", 1), ("word", 2), ("char", 3), ("char", 4))
_SALT = (0xD6E8FEB86659FD93, 0xCA5A826395121157, 0x7FEB352D9F9A3B1B, 0x94D049BB133111EB)


def bucket(h: np.ndarray, family: int) -> np.ndarray:
    """Feature number of a 64-bit value; families share the buckets and differ by salt."""
    return ((h ^ U64(_SALT[family])) * U64(0x9E3779B97F4A7C15) >> U64(64 - BUCKET_BITS)).astype(np.int64)


def feature_runs(data: np.ndarray, offs: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(family, features, index of each text's first feature), in pieces that together
    hold every feature of every text once."""
    word, _, _, first = words(data, offs, lower=False)
    yield 0, bucket(word, 0), first
    gram, at = ngrams(word, first, 2)
    yield 1, bucket(gram, 1), at
    for family, (unit, n) in enumerate(FAMILIES):
        if unit != "char":
            continue
        ends = np.maximum(offs[1:] - (n - 1), offs[:-1])  # past the last start of a run
        for lo in range(0, len(data), CHUNK):
            hi = min(len(data), lo + CHUNK)
            part = data[lo : min(len(data), hi + n - 1)].astype(np.uint64)
            m = len(part) - n + 1
            if m <= 0:
                continue
            h = part[:m].copy()
            for i in range(1, n):
                h |= part[i : i + m] << U64(8 * i)
            begin, stop = np.clip(offs[:-1], lo, lo + m), np.clip(ends, lo, lo + m)
            size = stop - begin
            if size.sum() != m:  # leave out runs that reach into the next text
                at = np.zeros(len(offs), dtype=np.int64)
                np.cumsum(size, out=at[1:])
                h = h[np.arange(at[-1]) + np.repeat(begin - lo - at[:-1], size)]
            else:
                at = np.concatenate([begin, stop[-1:]]) - lo
            yield family, bucket(h, family), at




@dataclass(frozen=True)
class Model:
    """Weights by feature; ``a`` and ``b`` calibrate the sum to a log-odds."""

    weights: np.ndarray
    a: float
    b: float

    def raw(self, col: pa.Array) -> np.ndarray:
        """Mean weight of a text's features in each family, summed over families."""
        out = np.empty(len(col))
        for lo, hi in by_bytes(col, PART_BYTES):
            data, offs = string_buffers(col.slice(lo, hi - lo))
            total = np.zeros((hi - lo, len(FAMILIES)))
            counts = np.zeros((hi - lo, len(FAMILIES)))
            for family, features, at in feature_runs(data, offs):
                run = np.concatenate([[0.0], np.cumsum(self.weights[features], dtype=np.float64)])
                total[:, family] += run[at[1:]] - run[at[:-1]]
                counts[:, family] += np.diff(at)
            out[lo:hi] = (total / np.maximum(counts, 1)).sum(axis=1)
        return out

    def probability(self, col: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.a * self.raw(col) + self.b, -500, 500)))


def matrix(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows (row, feature, value) of the relative frequencies."""
    rows, cols, vals = [], [], []
    for k, t in enumerate(texts):
        data, offs = string_buffers(pa.array([t], pa.string()))
        sums = np.zeros(BUCKETS)
        by_family: dict[int, list[np.ndarray]] = {}
        for family, features, _ in feature_runs(data, offs):
            by_family.setdefault(family, []).append(features)
        for parts in by_family.values():
            features = np.concatenate(parts)
            if len(features):
                sums += np.bincount(features, minlength=BUCKETS) / len(features)
        at = np.flatnonzero(sums)
        rows.append(np.full(len(at), k, dtype=np.int32))
        cols.append(at.astype(np.int32))
        vals.append(sums[at].astype(np.float32))
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(vals)


def fit(texts: list[str], labels: np.ndarray, epochs: int = 120, rate: float = 0.3, ridge: float = 1e-4) -> Model | None:
    """Adagrad on the mean log loss of four fifths of the rows; Platt calibration by
    Newton steps on the others. The intercept stays at the log-odds of the labels, so that
    n-grams nobody has labelled speak neither for nor against a text. None without rows of
    both classes in both parts."""
    held = np.arange(len(texts)) % 5 == 4
    y = labels.astype(np.float64)
    if any(len(set(y[part])) < 2 for part in (held, ~held)):
        return None
    own = y[~held]
    r, c, v = matrix([t for t, h in zip(texts, held) if not h])
    w, grad2 = np.zeros(BUCKETS), np.full(BUCKETS, 1e-12)
    n, good = len(own), own.mean()
    prior = float(np.log(good / (1 - good)))
    for _ in range(epochs):
        z = np.bincount(r, weights=w[c] * v, minlength=n) + prior
        err = (1 / (1 + np.exp(-z)) - own) / n
        g = np.bincount(c, weights=err[r] * v, minlength=BUCKETS) + ridge * w
        grad2 += g * g
        w -= rate * g / np.sqrt(grad2)
    del r, c, v
    weights = w.astype(np.float32)
    z, y = Model(weights, 1.0, 0.0).raw(pa.array([t for t, h in zip(texts, held) if h], pa.large_string())), y[held]
    # Platt's targets are drawn in from 0 and 1, so that the fit stays finite
    pos, neg = float(y.sum()), float((1 - y).sum())
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, prior
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        d, s = p - target, p * (1 - p) + 1e-9
        ga, gb = (d * z).sum(), d.sum()
        haa, hab, hbb = (s * z * z).sum() + 1e-9, (s * z).sum(), s.sum()
        det = haa * hbb - hab * hab
        if abs(det) < 1e-12:
            break
        step_a, step_b = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        scale = min(1.0, 10.0 / max(abs(step_a), abs(step_b), 1e-9))
        a, b = a - scale * step_a, b - scale * step_b
    return Model(weights, float(a), float(b))


FITTED = T.StructType([T.StructField("weights", T.BinaryType()), T.StructField("a", T.DoubleType()), T.StructField("b", T.DoubleType())])


def _fit_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [tuple(r.values()) for b in batches for r in b.to_pylist()]
    rows = sorted((place, label, text) for place, text, label in rows)
    texts, labels = [t for _, _, t in rows], [y for _, y, _ in rows]
    model = fit(texts, np.array(labels)) if texts else None
    give_back()
    if model is not None:
        yield pa.record_batch([[model.weights.tobytes()], [model.a], [model.b]], names=["weights", "a", "b"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality") -> Model | None:
    """Fits the classifier on a bounded sample of the labelled rows of ``docs``."""
    labelled = labels.select(F.col(id_col), F.col(label).cast("int").alias("__label")).filter(F.col(id_col).isNotNull() & F.col("__label").isin(0, 1))
    texts = docs.select(F.col(id_col), F.col(text).alias("__text")).filter(F.octet_length("__text") <= SAMPLE_TEXT)
    sizes = texts.select(id_col, F.octet_length("__text").cast("long").alias("__size")).join(labelled.select(id_col), id_col, "left_semi")
    sizes = sizes.groupBy(id_col).agg(F.sum("__size").alias("__size"))
    order = [F.xxhash64(id_col), F.col(id_col), F.col("__label")]
    sample = labelled.join(sizes, id_col).orderBy(*order).limit(SAMPLE_ROWS)
    upto = F.sum("__size").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    sample = sample.withColumn("__upto", upto).filter(F.col("__upto") <= SAMPLE_BYTES).select(id_col, "__label")
    rows = texts.join(sample, id_col)
    rows = rows.select(F.xxhash64(id_col).alias("place"), F.col("__text").alias("text"), F.col("__label").alias("label"))
    row = rows.repartition(1).mapInArrow(_fit_task, FITTED).first()
    return None if row is None else Model(np.frombuffer(row["weights"], np.float32), row["a"], row["b"])


# --- rules -------------------------------------------------------------------------


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def repeated_words(grams: np.ndarray, window: int) -> int:
    """Words that stand in a window found twice or more; ``grams`` are a text's windows."""
    if len(grams) < 2:
        return 0
    _, inverse, counts = np.unique(grams, return_inverse=True, return_counts=True)
    again = np.flatnonzero(counts[inverse] > 1)
    if not len(again):
        return 0
    return int(window + np.minimum(np.diff(again), window).sum())


def measures(col: pa.Array) -> dict[str, np.ndarray]:
    """The rules' counts for every text."""
    parts: dict[str, list[np.ndarray]] = {k: [] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
    for lo, hi in by_bytes(col, PART_BYTES):
        piece = col.slice(lo, hi - lo)
        data, offs = string_buffers(piece)
        word, _, _, first = words(data, offs, lower=False)
        gram, at = ngrams(word, first, WINDOW)

        def per_text(hit: np.ndarray) -> np.ndarray:
            run = np.concatenate([[0], np.cumsum(hit)])
            return run[offs[1:]] - run[offs[:-1]]

        parts["n_words"].append(np.diff(first))
        # code points: bytes that don't continue a character
        parts["word_chars"].append(per_text(((data & 0xC0) != 0x80) & ~IS_SPACE[data]))
        parts["n_symbols"].append(per_text(SYMBOLS[data]))
        parts["n_dup_lines"].append(np.array([duplicate_lines(t) if t else 0 for t in piece.to_pylist()]))
        parts["n_repeat_words"].append(np.array([repeated_words(gram[a:b], WINDOW) for a, b in zip(at[:-1], at[1:])]))
    return {k: np.concatenate(v) if v else np.empty(0, np.int64) for k, v in parts.items()}


RESULT = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField("base_failed", T.BooleanType()), T.StructField("probability", T.DoubleType()), T.StructField("kept", T.BooleanType())]
)


def verdict(text: Column, model: Model | None, threshold: float = THRESHOLD) -> Column:
    """The rules' counts, ``base_failed``, the calibrated ``probability`` of good quality
    (null without a model) and ``kept``, as a struct."""

    @F.arrow_udf(RESULT)
    def run(col: pa.Array) -> pa.Array:
        m = measures(col)
        failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])
        if model is None:
            probability, good = pa.nulls(len(col), pa.float64()), np.ones(len(col), dtype=bool)
        else:
            p = model.probability(col)
            probability, good = pa.array(p), p >= threshold
        give_back()
        cols = [pa.array(m[f.name], pa.int64()) for f in RESULT.fields[:5]] + [pa.array(failed, pa.bool_()), probability, pa.array(good & ~failed, pa.bool_())]
        return pa.StructArray.from_arrays(cols, names=[f.name for f in RESULT.fields])

    return run(text)


def judge(docs: DataFrame, model: Model | None, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the fields of :func:`verdict` as columns."""
    names = [f.name for f in RESULT.fields]
    keep = [F.col(c) for c in docs.columns if c not in names]
    judged = docs.select(*keep, verdict(F.col(text), model, threshold).alias("__verdict"))
    return judged.select(*keep, *[F.col("__verdict")[n].alias(n) for n in names])
