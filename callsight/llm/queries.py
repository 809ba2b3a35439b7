"""The registered queries of this subpackage: each applies one operator, with production
parameters, to its whole table and derives the columns its contract names. ``ORACLE`` has
DuckDB SQL where SQL can express the result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callsight.llm import chat, dedup, divergence, licenses, lm, mixing, packing, pii, quality, secrets, tokens, topk, trie
from callsight.session import materialize, ship_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.link_quotes(_table(spark, sf_dir, "conversations"))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256.0)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    # written: the words are counted once, not again for the ranges of the order
    docs = materialize(docs.select("doc_id", "source", mixing.n_words(F.col("text")).alias("n_words")), "sizes")
    weights = mixing.cycle_weights(docs)
    mixed = mixing.mix(docs, weights, size=F.col("n_words"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), size=1024, keep_ids=False)


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan_licenses(docs).drop("text")


def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm.score(_table(spark, sf_dir, "documents"), order=3, min_count=2, backoff=0.4)
    return scored.withColumn("score", F.round("score", 6))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = tokens.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), limit=1024)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_pii(docs)
    return found.select("doc_id", *[f"n_{k}" for k in pii.KINDS], "base_sha256", "spans")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, _table(spark, sf_dir, "labels"))
    return quality.judge(docs, model).drop("text")


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.near_duplicates(_table(spark, sf_dir, "documents"), k=4, percent=80)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = trie.ordered(_table(spark, sf_dir, "conversations"), keep_text=False)
    conv = F.col("conv_id")
    turns, members = trie.rebuilt(turns, conv - conv % 20, F.crc32(conv.cast("string")) % 4)
    return trie.prefix_trie(turns, members)


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.find_secrets(docs, secrets.train(docs)).drop("text")


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"), min_docs=3, top=200)


QUERIES = {
    "op1_quotation_linking": op1_quotation_linking,
    "op2_topk": op2_topk,
    "op3_mixing": op3_mixing,
    "op4_packing": op4_packing,
    "op5_licenses": op5_licenses,
    "op6_lm_scores": op6_lm_scores,
    "op7_token_counts": op7_token_counts,
    "op8_pii": op8_pii,
    "op9_quality": op9_quality,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_secrets": op12_secrets,
    "op13_divergence": op13_divergence,
}

# --------------------------------------------------------------------------- oracle
_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM documents)"

_TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256.0::DOUBLE * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v AS q JOIN v AS c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""

_MIX = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::BIGINT AS size,
    md5('0:' || coalesce(doc_id::VARCHAR, 'null')) AS k FROM documents
), r AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY size DESC, k, doc_id) - 1 AS place FROM d
), w AS (
  SELECT source, sum(size)::BIGINT AS source_size, 3.0::DOUBLE * sum(size)::DOUBLE AS cap,
    [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER]::DOUBLE AS weight
  FROM d GROUP BY source
), o AS (
  SELECT *, sum(source_size) OVER ()::DOUBLE AS total,
    coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before,
    sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open
  FROM w
), c AS (SELECT *, (total - cap_before) * weight > cap * open AS capped FROM o
), t AS (
  SELECT *, CASE WHEN capped THEN cap ELSE least(cap, (total - coalesce(sum(cap) FILTER (capped) OVER (), 0)) / sum(weight) FILTER (NOT capped) OVER () * weight) END AS target FROM c
), e AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS expected FROM t
), draws AS (
  SELECT source, j, ('0x' || substr(md5('0:' || j || ':' || coalesce('s' || source, 'null')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM e, (SELECT unnest(range(16)) AS j)
), tried AS (
  SELECT r.source, j, u, any_value(target) AS target, sum((floor((place + 1) * expected + u) - floor(place * expected + u)) * size) AS taken
  FROM r JOIN e ON r.source IS NOT DISTINCT FROM e.source JOIN draws ON r.source IS NOT DISTINCT FROM draws.source GROUP BY r.source, j, u
), chosen AS (
  SELECT source, u FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY abs(taken - target), j) AS n FROM tried) WHERE n = 1
), f AS (
  SELECT doc_id, size, source_size, target, r.source, (floor((place + 1) * expected + u) - floor(place * expected + u))::BIGINT AS copies
  FROM r JOIN e ON r.source IS NOT DISTINCT FROM e.source JOIN chosen ON r.source IS NOT DISTINCT FROM chosen.source
)
SELECT doc_id, size, source_size, target, copies * size AS taken, source, copies FROM f
"""

_LM = f"""
WITH {_WORDS}, p AS (
  SELECT doc_id, i, w[i] AS a, CASE WHEN i > 1 THEN w[i - 1] END AS b, CASE WHEN i > 2 THEN w[i - 2] END AS c
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)
), n1 AS (SELECT a, count(*) AS n FROM p GROUP BY a),
n2 AS (SELECT b, a, count(*) AS n FROM p WHERE b IS NOT NULL GROUP BY b, a),
n3 AS (SELECT c, b, a, count(*) AS n FROM p WHERE c IS NOT NULL GROUP BY c, b, a),
s AS (
  SELECT doc_id, CASE
    WHEN n3.n >= 2 THEN log10(n3.n / pair.n)
    WHEN n2.n >= 2 THEN log10(n2.n / word.n) + (least(i, 3) - 2) * log10(0.4)
    ELSE log10(n1.n / (SELECT count(*) FROM p)) + (least(i, 3) - 1) * log10(0.4) END AS score
  FROM p JOIN n1 ON p.a = n1.a LEFT JOIN n2 ON p.b = n2.b AND p.a = n2.a LEFT JOIN n3 ON p.c = n3.c AND p.b = n3.b AND p.a = n3.a
    LEFT JOIN n1 AS word ON p.b = word.a LEFT JOIN n2 AS pair ON p.c = pair.b AND p.b = pair.a
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, m.score FROM d
LEFT JOIN (SELECT doc_id, round(avg(score), 6) AS score FROM s GROUP BY doc_id) AS m ON d.doc_id = m.doc_id
"""

_NEAR = f"""
WITH RECURSIVE {_WORDS}, g AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) >= 4 THEN array_to_string(w[i:i + 3], ' ') ELSE array_to_string(w, ' ') END AS gram
  FROM (SELECT doc_id, w, unnest(CASE WHEN len(w) >= 4 THEN range(1, len(w) - 2) WHEN len(w) > 0 THEN range(1, 2) ELSE [] END) AS i FROM d)
), n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS x, y.doc_id AS y, count(*) AS c FROM g AS x JOIN g AS y ON x.gram = y.gram AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM pairs JOIN n AS nx ON x = nx.doc_id JOIN n AS ny ON y = ny.doc_id WHERE 100 * c >= 80 * (nx.n + ny.n - c)
), both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.y FROM reach AS r JOIN both_ways AS l ON r.b = l.x),
component AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN component ON d.doc_id = a LEFT JOIN n ON d.doc_id = n.doc_id
"""

_TRIE = r"""
WITH RECURSIVE steps(i, k, v) AS (
  SELECT range, 0, range::BIGINT FROM range(256) UNION ALL
  SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END FROM steps WHERE k < 8
), lookup AS (SELECT i, v FROM steps WHERE k = 8
), crc(c, k, v) AS (
  SELECT DISTINCT conv_id, 0, 4294967295::BIGINT FROM conversations WHERE conv_id IS NOT NULL UNION ALL
  SELECT c, k + 1, xor(crc.v >> 8, lookup.v) FROM crc JOIN lookup ON lookup.i = xor(crc.v, ascii(substr(c::VARCHAR, k + 1, 1))::BIGINT) & 255
  WHERE k < length(c::VARCHAR)
), head AS (SELECT c, xor(v, 4294967295::BIGINT) % 4 AS h FROM crc WHERE k = length(c::VARCHAR)
), original AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL
), rebuilt AS (
  SELECT c, place, role, text FROM head JOIN original ON conv_id = c - c % 20 AND place < h UNION ALL
  SELECT c, place, role, text FROM head JOIN original ON conv_id = c AND place >= h
), prefix AS (
  SELECT c, row_number() OVER w AS d, list({'r': role, 't': text}) OVER w AS turns, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
  FROM rebuilt WINDOW w AS (PARTITION BY c ORDER BY place) UNION ALL
  SELECT c, 0, [], 0 FROM head
), member AS (
  SELECT c, d, words, min(c) OVER n AS m, count(*) OVER n AS n_convs, max(d) OVER (PARTITION BY c) AS length
  FROM prefix WINDOW n AS (PARTITION BY d, turns)
), node AS (
  SELECT *, lag(m) OVER (PARTITION BY c ORDER BY d) AS parent FROM member
), own AS (SELECT m, d, n_convs, words, parent FROM node WHERE c = m
), child AS (SELECT parent AS m, d - 1 AS d, count(*) AS n_children FROM own WHERE d > 0 GROUP BY ALL
), below AS (
  SELECT a.m, a.d, sum(CASE WHEN y.n_children IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_leaves, sum((o.n_convs - 1) * o.words)::BIGINT AS saved_tokens
  FROM own AS o LEFT JOIN child AS y ON o.m = y.m AND o.d = y.d JOIN member AS a ON a.c = o.m AND a.d <= o.d GROUP BY a.m, a.d
), ends AS (SELECT m, d, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids FROM member WHERE d = length GROUP BY m, d)
SELECT o.m AS conv_id, o.d AS depth, parent AS parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens,
  sha256(coalesce(ids, '')) AS ends_sha256
FROM own AS o LEFT JOIN child AS y ON o.m = y.m AND o.d = y.d JOIN below AS b ON o.m = b.m AND o.d = b.d
  LEFT JOIN ends AS e ON o.m = e.m AND o.d = e.d
"""

_DIVERGENCE = """
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), kept AS (
  SELECT lang, term, count(*)::HUGEINT AS n FROM d GROUP BY lang, term HAVING count(DISTINCT doc) >= 3
), cell AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM d SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), grp AS (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents
), whole AS (SELECT lang, sum(n)::HUGEINT AS total, count(*)::HUGEINT AS v FROM kept GROUP BY lang
), own AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM cell GROUP BY lang, source
), every AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000 * (coalesce(c.n, 0) + 1)) // (coalesce(o.total, 0) + w.v) AS p,
    1 + (1000000000 * (k.n + 1)) // (w.total + w.v) AS q
  FROM grp AS g JOIN kept AS k ON g.lang = k.lang JOIN whole AS w ON g.lang = w.lang
    LEFT JOIN own AS o ON g.lang = o.lang AND g.source = o.source
    LEFT JOIN cell AS c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), summed AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p)::BIGINT AS value
  FROM every AS a JOIN every AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
), pair AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(s.value, 0) AS value
  FROM grp AS g JOIN grp AS h ON g.lang = h.lang AND g.source <> h.source
    LEFT JOIN summed AS s ON s.lang = g.lang AND s.source = g.source AND s.item = h.source
), apart AS (
  SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value FROM every WHERE n > 0 AND p > q
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM apart)
)
SELECT lang, source, part, item, value, rank FROM placed WHERE part = 'pair' OR rank <= 200
"""

ORACLE: dict[str, str] = {
    "op2_topk": _TOP_K,
    "op3_mixing": _MIX,
    "op6_lm_scores": _LM,
    "op10_near_duplicates": _NEAR,
    "op11_prefix_trie": _TRIE,
    "op13_divergence": _DIVERGENCE,
}
