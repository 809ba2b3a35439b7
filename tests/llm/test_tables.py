"""Mixing, near-duplicates, language-model scores, top-k, quotation links and the
pipeline against plain versions, on the smallest tables and on odd rows."""

import os
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from callsight.llm import chat, components, dedup, lm, mixing, queries, ranking, topk

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(llm):
    return [tuple(r) for r in llm.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


# --- ranks and mixing --------------------------------------------------------------


def test_ranked(llm):
    rows = [("h", i % 7) for i in range(500)] + [(None, 1), ("a", None), ("a", 3)]
    df = llm.createDataFrame(rows, "g string, v int")
    got = ranking.ranked(df, ["g"], [F.col("v")], "r").collect()
    for g in ("h", None, "a"):
        own = sorted((r["r"], -1 if r["v"] is None else r["v"]) for r in got if r["g"] == g)
        assert [r for r, _ in own] == list(range(len(own)))
        assert [v for _, v in own] == sorted(v for _, v in own)


def mixed(llm, rows, weights=(5.0, 2.0, 1.0)):
    df = llm.createDataFrame(rows, "doc_id long, source string, text string, target int")
    return mixing.mix(df, mixing.cycle_weights(df, weights))


def check_mix(rows, sizes, weights):
    """``rows``: result rows with source; sizes by source."""
    want = brute.targets(sizes, weights)
    taken, largest = Counter(), Counter()
    for r in rows:
        s = r["source"]
        assert r["source_size"] == sizes[s] and abs(r["target"] - want[s]) <= 1e-6 * max(1, want[s])
        assert 0 <= r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
        taken[s] += r["taken"]
        largest[s] = max(largest[s], r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s]


def test_mix(llm):
    r = random.Random(4)
    rows = [(i, r.choice(["hot", "hot", "hot", "b", "c", "d", None]), " ".join(["w"] * r.randint(0, 40)), 1) for i in range(600)]
    rows += [(None, "b", "null id", 1), (5, "b", "twice", 1), (5, "b", "twice", 1), (700, "empty", None, 1), (701, "long", "w " * 50_000, 1)]
    got = mixed(llm, rows).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, s, t, _ in rows:
        sizes[s] += len(brute.words(t))
    order = sorted((s for s in sizes if s is not None)) + [None]
    check_mix(got, sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)})
    again = {(r["doc_id"], r["source"], r["size"], r["taken"]) for r in mixed(llm, list(reversed(rows))).collect()}
    assert again == {(r["doc_id"], r["source"], r["size"], r["taken"]) for r in got}
    assert mixed(llm, []).count() == 0
    only_empty = mixed(llm, [(1, "a", None, 1), (2, "b", "", 1)]).collect()
    assert [r["taken"] for r in only_empty] == [0, 0]


def test_mix_takes_the_nearest_of_all_draws(llm):
    r = random.Random(6)
    sources = [f"s{k}" for k in range(12)] + [None]
    rows = [(i, r.choice(sources), "w " * int(5 * r.paretovariate(1.1)), 1) for i in range(160)]
    rows += [(5, "s3", "twice " * 70, 1), (5, "s3", "twice " * 70, 1), (None, "s4", "null id", 1), (500, "s5", None, 1), (501, "none", None, 1)]
    own, taken, target = {}, Counter(), {}
    for x in mixed(llm, rows).collect():
        own.setdefault(x["source"], []).append(x["size"])
        taken[x["source"]] += x["taken"]
        target[x["source"]] = x["target"]
    assert sum(map(len, own.values())) == len(rows) and set(own) == {*sources, "none"}
    for s, sizes in own.items():
        draws = brute.taken_by_draw(s, sizes, target[s])
        assert taken[s] == min(draws, key=lambda t: abs(t - target[s])), s


def test_mix_query_and_emit(llm, docs):
    got = queries.op3_mixing(llm, SF).collect()
    texts = dict(docs)
    sizes = Counter()
    for r in got:
        assert r["size"] == len(brute.words(texts[r["doc_id"]]))
        sizes[r["source"]] += r["size"]
    check_mix(got, sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(sizes))})
    df = llm.createDataFrame([(1, 0), (2, 3), (3, 1)], "doc_id long, copies long")
    assert Counter(r["doc_id"] for r in mixing.emit(df).collect()) == {2: 3, 3: 1}


# --- components and near-duplicates ------------------------------------------------


def test_components(llm):
    r = random.Random(8)
    links = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1060)] + [(7, 7), (None, 3)]
    links += [(2000, 2000 + i) for i in range(1, 400)]  # one node with very many links
    parent = {}

    def top(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None:
            x, y = sorted((top(a), top(b)))
            parent[y] = x
    got = {x["node"]: x["component"] for x in components.components(llm.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: top(x) for x in parent}
    assert components.components(llm.createDataFrame([], "a long, b long")).count() == 0


def copies(seed=3):
    """Families of exact and near copies around the threshold, chains, and strays."""
    r = random.Random(seed)
    fresh = lambda n: [f"w{r.randint(0, 10**6)}" for _ in range(n)]
    rows, base = [], fresh(120)
    for _ in range(150):  # one large group of near copies
        w = list(base)
        w[r.randint(0, 119)] = fresh(1)[0]
        rows.append(w)
    rows += [base] * 40  # and of exact ones
    for n in (5, 8, 30, 300):
        w = fresh(n)
        for _ in range(12):  # each one edit further away
            rows.append(list(w))
            w[r.randint(0, n - 1)] = fresh(1)[0]
    rows += [fresh(r.randint(1, 60)) for _ in range(150)]
    r.shuffle(rows)
    return [(i, " ".join(w)) for i, w in enumerate(rows)]


@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates(llm, k):
    rows = copies()
    got = {r["doc_id"]: r for r in dedup.near_duplicates(llm.createDataFrame(rows, DOCS).repartition(6), k=k).collect()}
    want = brute.near_duplicates(rows, k, 80)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (r["component_id"] == i) for i, r in got.items())


def test_near_duplicates_in_cut_families(llm, monkeypatch):
    """Families of several chunks: pivots, then strays against all others."""
    for name, value in (("CHUNK", 12), ("CHUNK_SHINGLES", 4000), ("PIVOTS", 1)):
        monkeypatch.setattr(dedup, name, value)
    r = random.Random(9)
    fresh = lambda n: [f"w{r.randint(0, 10**6)}" for _ in range(n)]
    base, rows = fresh(150), copies()
    for i in range(120):  # a loose family: similarity of 0.55 to 0.85 to each other
        w = list(base)
        for _ in range(r.randint(2, 6)):
            w[r.randint(0, 149)] = fresh(1)[0]
        rows.append((10_000 + i, " ".join(w)))
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in dedup.near_duplicates(llm.createDataFrame(rows, DOCS).repartition(6), k=4).collect()}
    assert got == brute.near_duplicates(rows, 4, 80)


def loose(groups, of, seed=5):
    """Texts off one template of 200 words, 9 of them changed: in each group one such text
    and copies of it with one more word changed. Texts of different groups aren't linked."""
    r = random.Random(seed)
    template, rows = [f"t{i}" for i in range(200)], []
    for _ in range(groups):
        w = list(template)
        for at in r.sample(range(200), 9):
            w[at] = f"c{r.randint(0, 999)}"
        for _ in range(of):
            copy = list(w)
            copy[r.randint(0, 199)] = f"d{r.randint(0, 10**6)}"
            rows.append((len(rows), " ".join(copy)))
    return rows


def block_rows(llm, monkeypatch, rows):
    """Rows of the second pass, and the operator's result."""
    seen, write = {}, dedup.materialize

    def watched(df, name, path=None):
        df = write(df, name, path)
        seen[name] = df
        return df

    monkeypatch.setattr(dedup, "materialize", watched)
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in dedup.near_duplicates(llm.createDataFrame(rows, DOCS).repartition(6), k=4).collect()}
    monkeypatch.setattr(dedup, "materialize", write)
    return seen["blocks"].count(), "grams" in seen, got


@pytest.mark.parametrize("of", [1, 3])
def test_loose_families_keep_their_links_and_their_size(llm, monkeypatch, of):
    """Second-pass rows a class don't grow with a loose family."""
    for name, value in (("CHUNK", 24), ("PIVOTS", 2)):
        monkeypatch.setattr(dedup, name, value)
    each = []
    for groups in (150, 1200):
        rows = loose(groups // of, of)
        n, split, got = block_rows(llm, monkeypatch, rows)
        assert split and got == brute.near_duplicates(rows, 4, 80)
        each.append(n / len(rows))
    assert each[1] < 1.5 * each[0] + 0.5 and each[1] < 4


def test_loose_family_with_repeated_ids(llm, monkeypatch):
    """Rows of one id with other texts are one document: links of either stay."""
    for name, value in (("CHUNK", 12), ("PIVOTS", 1)):
        monkeypatch.setattr(dedup, name, value)
    rows = loose(60, 2)
    joined = rows + [(7, rows[50][1]), (7, rows[7][1])]  # the group of 7 and that of 50 become one
    got = {x["doc_id"]: x["component_id"] for x in dedup.near_duplicates(llm.createDataFrame(joined, DOCS), k=4).collect()}
    want = {i: c for i, (_, c) in brute.near_duplicates(rows, 4, 80).items()}
    assert {i for i, c in got.items() if c == got[7]} >= {i for i, c in want.items() if c == want[7]}
    assert all(got[i] == c for i, c in want.items() if want[50] != c != want[7])


def crowded(pairs, seed=6):
    """Classes that take their shingles from one passage, little more than half of it each.
    They come in pairs of a similarity of little more than 0.8; strangers have about 0.38."""
    r = np.random.default_rng(seed)
    passage, sets = r.integers(0, 2**63, 240, dtype=np.uint64), []
    for _ in range(pairs):
        own = r.permutation(passage)[:132]
        sets += [own[:120], np.concatenate([own[:107], own[120:]])]
    assert all(100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b)) for a, b in zip(sets[::2], sets[1::2]))
    hashes = [dedup.min_hashes(s) for s in sets]
    rows = [(i, h.tobytes(), h.astype(np.uint8)[dedup._SKETCHED].tobytes()) for i, h in enumerate(hashes)]
    return rows, [(i, i + 1) for i in range(0, len(sets), 2)]


def parted(edges, linked):
    """Pairs whose ends are in different components of the edges."""
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((top(int(a)), top(int(b))))
        parent[y] = x
    return [(a, b) for a, b in linked if top(a) != top(b)]


def test_crowded_regions_keep_their_links(monkeypatch):
    monkeypatch.setattr(dedup, "REGION", 8)
    rows, linked = crowded(1500)
    width = 2 * dedup.DEPTH
    dealt = sorted((t, labels[t * width : (t + 1) * width], i, sketch) for i, labels, sketch in rows for t in range(dedup.TREES))
    forest = dedup.Forest(pa.table(dict(zip(("tree", "label", "id", "sketch"), map(list, zip(*dealt))))))
    edges = [e for a, b in forest.edges(0, len(dealt)) for e in zip(a, b)]
    assert parted(edges, linked) == []


def test_ranges_keep_equal_labels_together(llm):
    """More ranges than rows: only equal labels are together."""
    rows, linked = crowded(4)
    had = {k: llm.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        llm.conf.set("spark.sql.shuffle.partitions", "300")
        llm.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        edges = dedup.family_edges(llm.createDataFrame(rows, "id long, labels binary, sketch binary")).collect()
    finally:
        for k, v in had.items():
            llm.conf.set(k, v)
    assert parted(edges, linked) == []


def test_intersections():
    r = random.Random(1)
    sets = [np.unique(np.array([r.randint(0, 60) for _ in range(r.randint(0, 40))], dtype=np.uint64)) for _ in range(60)]
    both = dedup.intersections(sets)
    for i in range(60):
        for j in range(60):
            assert i == j or both[i, j] == len(set(sets[i].tolist()) & set(sets[j].tolist()))


def test_near_duplicates_odd_rows(llm, odd_docs):
    df = llm.createDataFrame([(*r, 1, 2) for r in odd_docs], DOCS + ", component_id int, kept int")
    got = dedup.near_duplicates(df, k=4).collect()
    assert len(got) == len(odd_docs)
    for r in got:
        assert (r["component_id"] == r["doc_id"]) if r["doc_id"] is not None else (r["component_id"] is None and r["kept"])
    assert {r["doc_id"]: r["n_shingles"] for r in got if r["doc_id"] is not None} == {i: len(brute.shingles(t, 4)) for i, t in odd_docs if i is not None}
    assert dedup.near_duplicates(llm.createDataFrame([], DOCS)).count() == 0


def test_near_duplicates_query(llm, docs):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.op10_near_duplicates(llm, SF).collect()}
    assert got == brute.near_duplicates(docs, 4, 80)


# --- language model ----------------------------------------------------------------


def close(got, want):
    for (n, s), (m, t) in zip(got, want, strict=True):
        assert n == m and ((s is None and t is None) or abs(s - t) < 1e-6)


def test_lm_scores(llm, docs, odd_docs, monkeypatch):
    key = lambda x: (x[0], -99.0 if x[1] is None else round(x[1], 6))
    got = lm.score(llm.createDataFrame([(*r, 5) for r in odd_docs], DOCS + ", score int")).collect()
    close(sorted(((r["n_words"], r["score"]) for r in got), key=key), sorted(brute.lm_scores(odd_docs), key=key))
    assert lm.score(llm.createDataFrame([], DOCS)).count() == 0
    monkeypatch.setattr(lm, "BLOCK_BYTES", 60_000)
    monkeypatch.setattr(lm, "RANGE_BYTES", 100_000)
    got = {r["doc_id"]: (r["n_words"], r["score"]) for r in queries.op6_lm_scores(llm, SF).collect()}
    close([got[i] for i, _ in docs], brute.lm_scores(docs))
    rows = [(1, "a b a b c"), (2, "a b")]
    for order, low in ((1, 1), (2, 1), (4, 3)):
        got = {r["doc_id"]: (r["n_words"], r["score"]) for r in lm.score(llm.createDataFrame(rows, DOCS), order=order, min_count=low).collect()}
        close([got[1], got[2]], brute.lm_scores(rows, order, low))


def test_packed_numbers():
    x = np.sort(np.random.default_rng(1).integers(0, 2**63, 1000, dtype=np.uint64) * np.uint64(2))
    assert (lm.undeltas(lm.deltas(x)) == x).all() and (lm.unpacked(lm.packed(x)) == x).all()
    assert len(lm.unpacked(lm.packed(x[:0]))) == 0


# --- top-k -------------------------------------------------------------------------

VEC = "vec_id long, embedding array<float>, label int"


def test_topk_odd_rows(llm, monkeypatch):
    r = random.Random(6)
    rows = [(i, [r.gauss(0, 1) * (1 + i % 5) for _ in range(8)], 0) for i in range(400)]
    rows += [(i, [0.5] * 8, 0) for i in range(500, 560)]  # ties
    rows += [(600, None, 0), (601, [None] + [1.0] * 7, 0), (602, [float("nan")] * 8, 0), (603, [float("inf")] * 8, 0), (None, [1.0] * 8, 0), (650, [0.0] * 8, 0), (700, [1.0, 2.0], 0), (701, [3.0, 4.0], 0)]
    as_float = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v, _ in rows]
    want = brute.top_k(as_float, lambda i: i % 50 == 0)
    for small in (False, True):
        if small:  # many blocks, several query blocks
            for name, value in (("BLOCK", 400), ("QUERY_BLOCK", 40), ("PART", 2), ("STEP", 16)):
                monkeypatch.setattr(topk, name, value)
        got = topk.top_k(llm.createDataFrame(rows, VEC).repartition(5), F.col("vec_id") % 50 == 0)
        assert sorted(tuple(x) for x in got.collect()) == want
    assert topk.top_k(llm.createDataFrame([], VEC), F.col("vec_id") % 50 == 0).count() == 0
    few = topk.top_k(llm.createDataFrame(rows[:3], VEC), F.col("vec_id") % 50 == 0).collect()
    assert [tuple(x) for x in sorted(few)] == brute.top_k(as_float[:3], lambda i: i % 50 == 0)


def test_topk_keeps_wide_vectors(llm, monkeypatch):
    """Components beyond 31 bits, as queries and as candidates, and scores beyond 63 bits."""
    r = random.Random(7)
    rows = [(i, [r.gauss(0, 1) for _ in range(8)]) for i in range(300)]
    for i, (at, x) in {50: (0, 1e7), 51: (0, 9e6), 52: (0, -9e6), 100: (1, 1e12), 101: (2, 8388608.0)}.items():
        rows[i][1][at] = x
    want = brute.top_k([(i, [float(np.float32(x)) for x in v]) for i, v in rows], lambda i: i % 50 == 0)
    assert {50, 51, 52, 100, 101} & {c for _, _, c, _ in want} and {q for q, *_ in want} >= {50, 100}
    for name, value in (("BLOCK", 400), ("QUERY_BLOCK", 40)):
        monkeypatch.setattr(topk, name, value)
    got = topk.top_k(llm.createDataFrame([(*x, 0) for x in rows], VEC).repartition(5), F.col("vec_id") % 50 == 0)
    assert sorted(tuple(x) for x in got.collect()) == want
    top = 2**63 - 1
    a, b = np.array([[2.0**100, 1.0], [0.0, 2.0**70], [2.0**62, 2.0**62]]), np.array([[2.0**30, 0.0], [2.0**90, 0.0], [-2.0, -2.0]])
    assert topk.exact(a, b, False).tolist() == [top, 0, -top]


def test_search_prunes_and_stays_exact():
    """Scores too large for doubles are computed in integers."""
    eye = np.eye(2)
    big = np.array([[2**30 + 1, 2**30 - 1], [2**30, 3]], "<i4")
    block = topk.Block(np.array([1, 2], "<i8").tobytes(), big.tobytes(), 2, eye)
    found = list(topk.search(block, np.full(2, -np.inf), block, 1))
    a, b = big.astype(object)
    assert sorted((int(q[0]), int(c[0]), int(s[0])) for q, c, s in found) == [(1, 2, int(a @ b)), (2, 1, int(a @ b))]


def test_topk_query(llm):
    rows = [(r["vec_id"], r["embedding"]) for r in llm.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in queries.op2_topk(llm, SF).collect()) == brute.top_k(rows, lambda i: i % 50 == 0)


# --- quotation links ---------------------------------------------------------------

CHAT = "conv_id long, turn long, role string, text string"


def test_quote_levels_and_hashes():
    lines = chat.split_levels("hi\nOn Monday X wrote:\n> > deep one\n>shallow\n\n  > x\nbye")
    assert [level for level, _ in lines] == [0, 2, 2, 1, 0, 1, 0]
    body, quotes, own = chat.parse("> Hello   THERE,\n> this is wrapped.\nmine")
    assert body == "mine" and {q["hash"] for q in quotes} == {h for h, _ in chat.hashes("hello there, this is wrapped.")}
    assert chat.parse("") == ("", [], [])


def test_links_and_order(llm):
    rows = [
        (1, 0, "u", "Hello there, this is the first message. It has two sentences.\n\nAnd a second paragraph here."),
        (1, 1, "a", "Unrelated start of another topic."),
        (1, 2, "u", "On Monday X wrote:\n> Hello there, this is\n> the first message.\nI agree with you."),
        (1, 3, "a", "> > Hello there, this is the first message.\n> I agree with you.\nMe too"),
        (1, 4, "u", ">Unrelated  START of another topic.\nok"),
        (1, 5, "a", "> nobody ever said this\nhm"),
        (2, 0, "u", "> And a second paragraph here.\nhm"),
        (2, 0, "u", "> And a second paragraph here.\nhm"),
        (2, 1, "a", None),
        (None, 5, "a", "> I agree with you."),
        (3, None, "a", "I agree with you."),
    ]
    df = llm.createDataFrame([(*r, 9) for r in rows], CHAT + ", position int")
    got = {}
    for r in chat.link_quotes(df).collect():
        got.setdefault((r["conv_id"], r["turn"]), []).append(r)
    assert sum(map(len, got.values())) == len(rows)

    def one(c, t):
        r = got[c, t][0]
        return r["quoted_conv_id"], r["quoted_turn"], r["thread_turn"], r["depth"], r["position"], r["text"]

    assert one(1, 2) == (1, 0, 0, 1, 1, "I agree with you.")
    assert one(1, 3) == (1, 2, 0, 2, 2, "Me too")
    assert one(1, 1)[4] == 3 and one(1, 4) == (1, 1, 1, 1, 4, "ok")
    assert one(1, 5)[:4] == (None, None, 5, 0)
    assert [r["quoted_conv_id"] for r in got[2, 0]] == [1, 1] and got[2, 0][0]["quoted_turn"] == 0
    assert one(None, 5)[:2] == (None, None)
    assert chat.link_quotes(llm.createDataFrame([], CHAT)).count() == 0


def test_short_and_partial_quotes(llm):
    """Against a brute-force linker: a reply quotes a short sentence, some lines of a
    wrapped paragraph, a whole passage, or what nobody wrote."""
    r, rows, want = random.Random(4), [], {}
    word = lambda: f"w{r.randint(0, 10**9)}"
    for conv in range(30):
        said = []
        for turn in range(0, 12, 2):
            short, lines = f"{word()[:9]}.", [" ".join(word() for _ in range(6)) for _ in range(4)]
            said.append((short, lines))
            rows.append((conv, turn, "user", f"{short} Then more was said here.\n\n" + "\n".join(lines)))
            to = r.randrange(len(said))
            kind = r.randrange(4)
            quote = ([said[to][0]], said[to][1][1:3], said[to][1], [word()])[kind]
            rows.append((conv, turn + 1, "bot", "\n".join(f"> {x}" for x in quote) + f"\n{word()}"))
            # the first message of the conversation whose own text holds all quoted lines
            have = [t for c, t, _, text in rows if c == conv and t <= turn and all(x in text for x in quote) and t % 2 == 0]
            want[conv, turn + 1] = min(have, default=None)
    got = {(x["conv_id"], x["turn"]): x["quoted_turn"] for x in chat.link_quotes(llm.createDataFrame(rows, CHAT).repartition(4)).collect()}
    assert {k: got[k] for k in want} == want and sum(t is not None for t in want.values()) > 100


def test_links_between_conversations(llm):
    """Whole passages link to another conversation; thanks, rules and short lines don't,
    though they link inside their own."""
    said = "This is the passage that somebody else quotes later on.\nThanks!\n---"
    rows = [
        (1, 0, "user", said),
        (2, 0, "user", "> Thanks!\nwelcome"),
        (2, 1, "user", "> ---\nyes"),
        (2, 2, "user", "> This is the passage that somebody else quotes later on.\nso it is"),
        (2, 3, "user", "> welcome\nshort, but of this conversation"),
        (3, 0, "user", "> " + said.replace("\n", "\n> ") + "\nall of it"),
    ]
    got = {(r["conv_id"], r["turn"]): (r["quoted_conv_id"], r["quoted_turn"]) for r in chat.link_quotes(llm.createDataFrame(rows, CHAT)).collect()}
    none = (None, None)
    assert got == {(1, 0): none, (2, 0): none, (2, 1): none, (2, 2): (1, 0), (2, 3): (2, 0), (3, 0): (1, 0)}


def test_texts_stay_off_the_driver(tmp_path):
    """Long messages in a session whose driver takes few bytes."""
    import subprocess
    import sys

    code = """
import sys
sys.path.insert(0, sys.argv[1])
from callsight.session import local_session, ship_package
from callsight.llm import chat, trie
spark = local_session(4, extra={"spark.driver.maxResultSize": "4m"})
ship_package(spark)
rows = spark.range(60, numPartitions=6).selectExpr("id DIV 4 AS conv_id", "id % 4 AS turn", "'user' AS role", "repeat(concat('word', id, ' '), 60000) AS text")
rows.write.parquet(sys.argv[2])
rows = spark.read.parquet(sys.argv[2])
assert chat.link_quotes(rows).selectExpr("max(position) AS p", "count(*) AS n").first() == (3, 60)
assert trie.ordered(rows, keep_text=False).selectExpr("max(at)", "count(*)").first() == (3, 60)
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    done = subprocess.run([sys.executable, "-c", code, root, str(tmp_path / "messages")], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]


def test_hot_passage_makes_no_pairs(llm):
    rows = [(1, t, "u", "the same words again and again" if t % 2 else "> the same words again and again\nyes") for t in range(1000)]
    got = chat.link_quotes(llm.createDataFrame(rows, CHAT)).collect()
    assert len(got) == 1000
    assert {r["quoted_turn"] for r in got if r["turn"] % 2 == 0 and r["turn"] > 1} == {1}
    assert sorted(r["position"] for r in got) == list(range(1000))


def test_chat_query_keeps_all_rows(llm):
    table = llm.read.parquet(f"{SF}/conversations.parquet")
    got = queries.op1_quotation_linking(llm, SF)
    assert got.count() == table.count()
    assert got.filter(F.col("position") != F.col("turn")).count() == 0  # no quotes there: as spoken


# --- pipeline ----------------------------------------------------------------------


def test_pipeline(llm, docs):
    import corpus_pipeline as P

    table = llm.read.parquet(f"{SF}/documents.parquet")
    steps = {}
    frame = table
    for name, stage in P.STAGES:
        frame = P.materialize(stage(llm, frame, SF), name)
        steps[name] = frame
        if name != P.STAGES[-1][0]:
            assert frame.columns == table.columns
    texts = dict(docs)
    kept = {r["doc_id"] for r in steps["quality_rules"].collect()}
    assert kept <= set(texts) and all(not brute.quality_base(texts[i])[5] for i in kept)
    labels = {r["doc_id"]: r["quality"] for r in llm.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [i for i, q in labels.items() if q == 1 and not brute.quality_base(texts[i])[5]]
    assert sum(i in kept for i in good) >= 0.97 * len(good)
    alone = {i for i, (_, c) in brute.near_duplicates([(i, texts[i]) for i in sorted(kept)], 5, 80).items() if c == i}
    assert {r["doc_id"] for r in steps["near_duplicates"].collect()} == alone
    for r in steps["personal_data"].collect():
        assert sum(brute.pii_base(r["text"])[0]) == 0 and r["n_chars"] == len(r["text"])
    before = {r["doc_id"]: r["text"] for r in steps["personal_data"].collect()}
    copies = Counter(r["doc_id"] for r in steps["source_mix"].collect())
    assert set(copies) <= alone and max(copies.values()) <= 3
    pieces = steps["packed"].collect()
    total = {}
    for p in pieces:
        total[p["doc_id"]] = total.get(p["doc_id"], 0) + p["length"]
    assert set(total) == set(copies)
    from test_texts import library

    ids = list(copies)
    for i, x in zip(ids, library([before[i] for i in ids])):
        assert total[i] == copies[i] * (len(x) + 1)


ODD = "doc_id long, text string, lang string, source string, n_chars long, size long, target string, copies int, taken long, source_size long, copy int, kept boolean, family long, __n long"


def test_stages_on_odd_rows(llm):
    """Clashing columns, nulls, repeated rows and ids, empty tables: every stage."""
    import corpus_pipeline

    def prose(seed, n=60):
        rng = random.Random(seed)
        return " ".join("".join(rng.choices("abcdefghij", k=5)) for _ in range(n))

    rest = (99, "t", 7, 8, 9, 10, True, 11, 12)
    rows = [
        (1, prose(1), "en", "a", 5, *rest),
        (1, prose(1), "en", "a", 5, *rest),  # a repeated row
        (2, prose(1), "en", "a", 5, *rest),  # a copy under another id
        (3, prose(2), "en", "b", 5, *rest),
        (3, prose(1), "en", "b", 5, *rest),  # an id with two texts, of which one goes
        (None, prose(3), None, None, None, *rest),
        (None, prose(1), None, None, None, *rest),
        (4, None, "en", "b", None, *rest),
        (5, "", "en", "b", 0, *rest),
        (6, "mail me@host.example " + prose(4), "en", None, 5, *rest),
    ]
    df = llm.createDataFrame(rows, ODD)
    plain = lambda out: Counter((r["doc_id"], r["text"], r["source"]) for r in out.collect())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(llm, df, SF)
        assert out.columns == df.columns, name
        assert {tuple(r)[5:] for r in out.collect()} <= {rest}, name  # columns handed on
        none = stage(llm, df.limit(0), SF)
        assert none.columns == df.columns and none.count() == 0, name
    got = plain(corpus_pipeline.near_duplicates(llm, df, SF))
    assert got == Counter([(1, prose(1), "a"), (3, prose(2), "b"), (None, prose(3), None), (4, None, "b"), (5, "", "b"), (6, rows[-1][1], None)])
    good = plain(corpus_pipeline.quality_rules(llm, df, SF))
    assert all(t and len(t.split()) >= 10 for _, t, _ in good)
    hidden = corpus_pipeline.personal_data(llm, df, SF).collect()
    assert sum("[EMAIL]" in (r["text"] or "") for r in hidden) == 1 and sum(r["text"] is None for r in hidden) == 1
    mixed = corpus_pipeline.source_mix(llm, df, SF)
    assert {r["source"] for r in mixed.collect()} <= {"a", "b", None} and max(plain(mixed).values()) <= 6
    pieces = corpus_pipeline.packed(llm, df, SF).collect()
    assert Counter(r["doc_id"] for r in pieces if r["start"] == 0) == Counter(r[0] for r in rows)
    assert corpus_pipeline.packed(llm, df.limit(0), SF).count() == 0
