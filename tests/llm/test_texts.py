"""Licence scans, personal data, token counts, packing and quality rules against plain
versions: odd texts, random texts and the whole smallest table."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import brute
from callsight.llm import licenses, packing, pii, quality, queries, tokens
from callsight.llm.text import string_buffers, words

SF = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(llm):
    return [tuple(r) for r in llm.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# --- words -------------------------------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab \n\t\x0b\x1c\x85é🙂.A"), max_size=30), max_size=6))
def test_word_hashes_follow_words(texts):
    data, offs = string_buffers(pa.array(texts, pa.string()))
    h, begin, end, first = words(data, offs)
    want = [brute.words(brute.lower(t)) for t in texts]
    assert [len(w) for w in want] == np.diff(first).tolist()
    flat = [x for w in want for x in w]
    assert [bytes(data[a:b]).decode().replace("A", "a") for a, b in zip(begin, end)] == flat
    assert len(set(h.tolist())) == len(set(flat))
    assert len({(x, y) for x, y in zip(h.tolist(), flat)}) == len(set(flat))


# --- licences ----------------------------------------------------------------------


def test_expressions():
    def ev(text):
        postfix = licenses.to_postfix(text)
        return None if postfix is None else licenses.evaluate(postfix)

    assert ev("MIT")[:2] == ({"mit"}, True)
    assert ev("MIT OR GPL-2.0-only")[:2] == ({"mit", "gpl"}, True)
    assert ev("MIT AND GPL-2.0-only")[:2] == ({"mit", "gpl"}, False)
    assert ev("GPL-2.0 WITH Classpath-exception-2.0 OR MIT AND Apache-2.0")[2] == "((gpl-2.0 with classpath-exception-2.0) or (mit and apache-2.0))"
    assert ev("(MIT OR GPL-2.0) AND BSD-3-Clause")[1] and not ev("MIT OR GPL-2.0 AND X")[0] == set()
    assert licenses.evaluate(licenses.front("MIT and then prose follows", 0))[0] == {"mit"}
    for bad in ("", "AND MIT", "(MIT", "MIT OR", "OR"):
        assert ev(bad) is None


@pytest.mark.parametrize(
    "text, shown, permissive",
    [
        ("# SPDX-License-Identifier: (MIT OR\n# Apache-2.0)\nimport os", "(mit or apache-2.0)", True),
        ("SPDX-License-Identifier: MIT AND\n  GPL-2.0-only\nMore", "(mit and gpl-2.0-only)", False),
        ("SPDX-License-Identifier: MIT and", "mit", True),
        ("SPDX-License-Identifier: (MIT OR Apache-2.0", "(mit or apache-2.0)", True),
        ("SPDX-License-Identifier: MIT AND (GPL-2.0 OR", "(mit and gpl-2.0)", False),
        ("SPDX-License-Identifier: MIT\nOR else", "mit", True),
        ("SPDX-License-Identifier:\nMIT", None, None),
        ("SPDX-License-Identifier: AND MIT", None, None),
        ("SPDX-License-Identifier: see the LICENSE file", None, None),
        ("The SPDX license identifier must be given", None, None),
        ("SPDX license identifier: MIT", None, None),
        ("SPDX-License-Identifier: MIT AND\nThis file is free", "mit", True),
        ("SPDX-License-Identifier: LicenseRef-Acme-1.0 OR GPL-2.0+ WITH Classpath-exception-2.0", "(licenseref-acme-1.0 or (gpl-2.0+ with classpath-exception-2.0))", False),
        ("spdx-license-identifier : BSD-3-Clause.", "bsd-3-clause", True),
    ],
)
def test_open_expressions(text, shown, permissive):
    assert licenses.scan(text)[7:] == ([] if shown is None else [shown], permissive)


def test_prose_names_no_licence():
    for text in ("SPDX-License-Identifier: see the LICENSE file", "The SPDX license identifier must be MIT"):
        *_, base, labels, score, shown, permissive = licenses.scan(text)
        assert (base, labels, score, shown, permissive) == ("", "", 0.0, [], None)


def best_of(run, times=3):
    import time

    took = []
    for _ in range(times):
        t = time.perf_counter()
        run()
        took.append(time.perf_counter() - t)
    return min(took)


def test_many_phrases_take_linear_time():
    once = "MIT license, words in between and more. "
    few, many = (once * n for n in (20_000, 40_000))
    assert licenses.scan(many)[1:4] == (40_000, 0, 7 * 39_999)
    assert best_of(lambda: licenses.scan(many)) < 2.5 * best_of(lambda: licenses.scan(few)) + 0.05


def test_license_base_random():
    r = random.Random(5)
    parts = ["MIT", "mit", "license", "License", "apache", "general", "public", " ", "_", "-", "é", "1", "\x80", "\x7f", "gpl", "{", "\n"]
    for _ in range(5000):
        t = "".join(r.choice(parts) for _ in range(r.randint(0, 25)))
        assert licenses.scan(t)[:5] == brute.license_base(t, licenses.BASE_PHRASES), t


def test_license_scan(llm, docs, odd_docs):
    df = llm.createDataFrame([(*r, "x") for r in odd_docs], DOCS + ", labels string")
    got = licenses.scan_licenses(df)
    assert got.count() == len(odd_docs)
    rows = sorted(map(str, (tuple(r)[2:7] for r in got.collect())))
    assert rows == sorted(str(brute.license_base(t, licenses.BASE_PHRASES)) for _, t in odd_docs)
    tagged = [(1, "// SPDX-License-Identifier: (MIT OR GPL-2.0-only)\ncode"), (2, "spdx license identifier nothing")]
    (a, b) = licenses.scan_licenses(llm.createDataFrame(tagged, DOCS)).orderBy("doc_id").collect()
    assert a["labels"] == "gpl,mit" and a["expressions"] == ["(mit or gpl-2.0-only)"] and a["permissive"] and 0 < a["score"] <= 1
    assert b["base_labels"] == "" and 0 <= b["score"] <= 1
    assert licenses.scan_licenses(llm.createDataFrame([], DOCS)).count() == 0
    got = by_id(queries.op5_licenses(llm, SF))
    for i, t in docs:
        assert tuple(got[i])[1:6] == brute.license_base(t, licenses.BASE_PHRASES)
        assert set(filter(None, got[i]["base_labels"].split(","))) <= set(got[i]["labels"].split(","))


# --- personal data -----------------------------------------------------------------


def test_pii_base_random():
    r = random.Random(3)
    parts = list("a.b@@+-_%1234567890..  --()") + ["é", "𝟙", "٣", "\n", "12.34.56.78", "4111 1111 1111 1111", "+49 170 1234567", "x@y.zz", "256.1.1.1", "http://a.b/c?d", "IBAN DE89370400440532013000"]
    for _ in range(20000):
        t = "".join(r.choice(parts) for _ in range(r.randint(0, 25)))
        spans = pii.find_spans(t)
        assert pii.joined(spans, base_only=True) == brute.pii_base(t)[2], t


def test_pii_added_kinds_and_redaction():
    t = "see https://user:pw@host.example:80/path?x=1). account number: 1234 5678 90, IBAN DE89 3704 0044 0532 0130 00 end; iban DE00 3704 0044 0532 0130 00"
    shown = pii.redacted(t, pii.find_spans(t))
    assert shown.startswith("see [URL]). account number: [ACCOUNT], IBAN [ACCOUNT] end; iban DE00")
    assert pii.redacted("mail a@b.cc now", pii.find_spans("mail a@b.cc now")) == "mail [EMAIL] now"
    assert pii.find_spans("no data here: 3.14 and 2024-01-01") == []


def test_pii_linear_on_hostile_texts():
    import time

    began = time.perf_counter()
    for t in ("1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1" * 100_000, "@a." * 70_000, "://" * 70_000, "account " * 25_000, "a@" * 100_000):
        pii.find_spans(t)
    assert time.perf_counter() - began < 30


def test_pii_query(llm, docs, odd_docs):
    df = llm.createDataFrame([(*r, 7) for r in odd_docs], DOCS + ", n_email int")
    assert pii.find_pii(df).count() == len(odd_docs)
    assert pii.find_pii(llm.createDataFrame([], DOCS)).count() == 0
    clean = llm.createDataFrame(odd_docs, DOCS).select("text", pii.redact(F.col("text")).alias("c")).collect()
    assert all(r["c"] == r["text"] for r in clean)  # nothing personal there; null stays null
    got = by_id(queries.op8_pii(llm, SF))
    for i, t in docs:
        counts, digest, _ = brute.pii_base(t)
        r = got[i]
        assert [r[f"n_{k}"] for k in pii.BASE] == counts and r["base_sha256"] == digest


# --- token counts and packing -------------------------------------------------------


def library(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(TOKENIZER)
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def random_texts(n, seed=1):
    r = random.Random(seed)
    parts = ["a", "b", "don't", "'s", " ", "  ", "\n", "\n\n", "\t", "\r\n", "é", "…", "!", "a.", "b,", "123", "½", "\x1c", "\x85", "\xa0", "　", "<|endoftext|>", "<|end", "東京", "\x00", "🙂", "A's", "'ll", "x: y"]
    return ["".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(n)]


def test_ids_equal_the_librarys():
    encoder = tokens.Tokenizer(TOKENIZER).encoder()
    assert encoder.cuts
    texts = random_texts(6000) + [None, "", " ", "x " * 5000]
    want = library(texts)
    for lo in range(0, len(texts), 400):
        col = pa.array(texts[lo : lo + 400], pa.string())
        assert encoder.count(col) == [len(x) for x in want[lo : lo + 400]]
        assert [np.frombuffer(b, "<u4").tolist() for b in encoder.ids(col)] == want[lo : lo + 400]


def test_ids_with_a_small_memory(monkeypatch):
    monkeypatch.setattr(tokens, "MEMORY", 20)
    encoder = tokens.Encoder("tokenizers", open(TOKENIZER, "rb").read())
    texts = [f"w{i % 50} w{i % 30}, w{i}" for i in range(300)]
    want = library(texts)
    for lo in range(0, 300, 30):
        assert encoder.count(pa.array(texts[lo : lo + 30])) == [len(x) for x in want[lo : lo + 30]]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers(llm, odd_docs, name):
    path = public_tokenizers.path(name)
    rows = [(i, t) for i, t in odd_docs if t is None or len(t) < 1000]
    got = tokens.count_tokens(llm.createDataFrame(rows, DOCS), path).collect()
    if name.endswith(".model"):
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_file=path)
        want = [len(p.encode(t or "")) for _, t in rows]
    else:
        from tokenizers import Tokenizer

        p = Tokenizer.from_file(path)
        want = [len(p.encode(t or "", add_special_tokens=False).ids) for _, t in rows]
    assert sorted(r["n_tokens"] for r in got) == sorted(want)


def test_token_counts(llm, docs, odd_docs):
    df = llm.createDataFrame([(*r, True) for r in odd_docs], DOCS + ", over_limit boolean")
    got = tokens.count_tokens(df, TOKENIZER).collect()
    assert sorted((r["n_bytes"], r["n_tokens"]) for r in got) == sorted((len((t or "").encode()), len(x)) for (_, t), x in zip(odd_docs, library([t for _, t in odd_docs])))
    assert tokens.count_tokens(llm.createDataFrame([], DOCS), TOKENIZER).count() == 0
    got = by_id(queries.op7_token_counts(llm, SF))
    for (i, t), x in zip(docs, library([t for _, t in docs])):
        assert tuple(got[i]) == (i, len(t.encode()), len(x), len(x) > 1024)


def check_pieces(pieces, rows, size):
    """Every id of every row lies in one piece, sequences have no gaps."""
    want = {}
    for (i, _), x in zip(rows, library([t for _, t in rows])):
        want.setdefault(i, []).append(x + [0])
    sequences, found = {}, {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        found.setdefault((p["doc_id"], p["doc_tokens"]), []).append(p)
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at <= size
    covered = 0
    for (i, total), ps in found.items():
        docs_of_id = [x for x in want[i] if len(x) == total]
        assert sum(p["length"] for p in ps) == total * len(docs_of_id)
        covered += sum(p["length"] for p in ps)
        if len(docs_of_id) == 1:
            at = 0
            for p in sorted(ps, key=lambda p: p["start"]):
                ids = docs_of_id[0][p["start"] : p["start"] + p["length"]]
                assert p["start"] == at and p["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
                at += p["length"]
    assert covered == sum(len(x) for xs in want.values() for x in xs)
    return len(sequences), covered


def test_packing(llm, docs, odd_docs):
    rows = [r for r in odd_docs if r[1] is None or len(r[1]) < 1000]
    many = [(i + 100, "w " * (i * 7 % 90)) for i in range(300)]
    for part in ([], rows, rows + many):
        df = llm.createDataFrame(part, DOCS).repartition(5) if part else llm.createDataFrame([], DOCS)
        pieces = packing.pack(df, TOKENIZER, size=64, windows=3).collect()
        n, covered = check_pieces(pieces, part, 64)
        assert all(len(p["ids"]) == 4 * p["length"] for p in pieces)
    assert n * 64 - covered < 0.06 * n * 64
    long = odd_docs[12]
    check_pieces(packing.pack(llm.createDataFrame([long, long], DOCS), TOKENIZER, keep_ids=False).collect(), [long, long], 1024)
    pieces = queries.op4_packing(llm, SF).collect()
    n, covered = check_pieces(pieces, docs, 1024)
    assert n - 1 <= covered / 1024 * 1.02


def test_merge_fills_all_windows_but_one():
    r = random.Random(2)
    pieces = [(i, 0, b"\1\0\0\0" * r.randint(1, 63), 0) for i in range(200)]
    total = sum(len(p[2]) // 4 for p in pieces)
    windows = list(packing.fill_up(pieces, 64))
    sizes = [sum(len(p[2]) // 4 for p in w) for w in windows]
    assert sum(sizes) == total and max(sizes) <= 64 and sum(s < 64 for s in sizes) <= 1


# --- quality -----------------------------------------------------------------------


def test_rules_random(monkeypatch):
    monkeypatch.setattr(quality, "PART_BYTES", 500)
    r = random.Random(2)
    parts = ["a", "b", " ", "\n", " a b c d e", "é", "🙂", "\x0b", "#", "%%", "\x85"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 60))) for _ in range(1500)] + [None, ""]
    m = quality.measures(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert tuple(int(m[k][i]) for k in m) == brute.quality_base(t)[:5], t


def test_classifier_held_out(llm):
    d = "/root/testdata/sf0.1"
    rows = llm.read.parquet(f"{d}/documents.parquet").join(llm.read.parquet(f"{d}/labels.parquet"), "doc_id").select("doc_id", "text", "quality").orderBy("doc_id").collect()
    rows = [r for r in rows if not brute.quality_base(r["text"])[5]]
    random.Random(1).shuffle(rows)
    fit, held = rows[:1200], rows[1200:]
    model = quality.fit([r["text"] for r in fit], np.array([r["quality"] for r in fit]))
    p = model.probability(pa.array([r["text"] for r in held]))
    y = np.array([r["quality"] for r in held])
    kept = p >= quality.THRESHOLD
    assert kept[y == 1].mean() > 0.99 and (~kept)[y == 0].mean() > 0.9
    assert abs(p.mean() - y.mean()) < 0.03  # calibrated
    # the score of a text does not depend on the batch around it
    one = [model.probability(pa.array([r["text"]]))[0] for r in held[:20]]
    assert np.allclose(one, p[:20], atol=1e-9)


def test_one_long_text_leaves_the_classifier_on(llm, tmp_dir):
    """A labelled text of more than the whole sample may have, first in the sample's order."""
    first = llm.range(80).orderBy(F.xxhash64("id")).first()[0]
    short = ("a calm and useful text about rivers", "buy buy now cheap pills")
    texts = ["long " * (quality.SAMPLE_BYTES // 5 + 1) if i == first else short[i % 2] for i in range(80)]
    pq.write_table(pa.table({"doc_id": range(80), "text": texts}), f"{tmp_dir}/docs.parquet")
    labels = llm.createDataFrame([(i, 1 - i % 2) for i in range(80)], "doc_id long, quality int")
    model = quality.train(llm.read.parquet(f"{tmp_dir}/docs.parquet"), labels)
    assert model is not None
    good, bad = model.raw(pa.array(short))
    assert good > bad


def test_quality_query(llm, docs, odd_docs):
    labels = "doc_id long, quality int"
    df = llm.createDataFrame([(*r, 1) for r in odd_docs], DOCS + ", kept int")
    for rows in ([], [(1, None), (None, 1)], [(4, 1)]):  # no classifier: the rules decide
        model = quality.train(df, llm.createDataFrame(rows, labels))
        assert model is None
    got = quality.judge(df, None)
    assert sorted(tuple(r)[2:8] for r in got.collect()) == sorted(brute.quality_base(t) for _, t in odd_docs)
    assert all(r["kept"] != r["base_failed"] for r in got.collect())
    assert quality.judge(llm.createDataFrame([], DOCS), None).count() == 0
    got = by_id(queries.op9_quality(llm, SF))
    for i, t in docs:
        assert tuple(got[i])[1:7] == brute.quality_base(t)
        assert not (got[i]["kept"] and got[i]["base_failed"])


def test_many_windows_take_linear_time(llm, monkeypatch):
    """A document of very many windows is cut by offsets, not by copying what is left."""

    class Context:
        @staticmethod
        def get():
            return Context

        @staticmethod
        def partitionId():
            return 0

    class Ids:
        def __init__(self, n):
            self.n = n

        def encoder(self):
            return self

        def ids(self, col):
            yield bytes(4 * self.n)

    monkeypatch.setattr(packing, "TaskContext", Context)
    batch = pa.record_batch([pa.array([1]), pa.array(["x"])], names=["doc_id", "text"])

    def run(n):
        out = [b for b in packing._first_pass(Ids(n), 64, 64, 0, False)(iter([batch]))]
        assert sum(b.num_rows for b in out) == -(-(n + 1) // 64)

    few, many = best_of(lambda: run(2_500_000), 2), best_of(lambda: run(5_000_000), 2)
    assert many < 2.5 * few + 0.05


def test_url_with_a_very_long_user():
    text = f"see https://{'u' * 300}@host.example/path, end"
    spans = [(a, pii.KINDS[k], b) for a, k, b in pii.find_spans(text) if pii.KINDS[k] == "url"]
    assert spans == [(4, "url", text.index(", end"))]
    assert pii.redacted(text, pii.find_spans(text)) == "see [URL], end"
