"""A training corpus from ``documents`` in five stages: quality rules, near-duplicate
removal, personal data, mixing of sources, packing. Each stage takes and (but for the
last) returns the columns of ``documents``; :func:`run` applies them in turn.

Every stage takes further columns, whatever their names, and hands them on unchanged (the last
returns its own columns). An empty table gives an empty result of the same columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callsight.llm import dedup, mixing, packing, pii, quality
from callsight.llm.ranking import ranked
from callsight.session import materialize, ship_package

TOKENIZER = "byte_bpe_50k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules or the classifier (fitted on the labelled ones) go. A null
    text has no words and goes; null ids and repeated rows are judged like any other row."""
    ship_package(spark)
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    keep = quality.verdict(F.col("text"), model)
    return docs.filter(keep["kept"])


def _deduplicated(docs: DataFrame) -> DataFrame:
    found = dedup.near_duplicates(docs, k=5, percent=80)
    # written: Spark sees how many ids go when it chooses the join
    gone = materialize(found.filter(~F.col("kept")).select("doc_id").distinct(), "gone")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest id.
    Texts without words are alike to nothing. Rows of one id, or without an id, are documents
    of their own: of equal ones one row stays, and of two texts under one id each stays or goes
    by itself (null ids come last)."""
    ship_package(spark)
    repeated = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | F.col("doc_id").isNull())
    if repeated.isEmpty():
        return _deduplicated(docs)
    # ids of their own, in the order of the given ones: one per id and text
    names = [f"__{i}" for i in range(len(docs.columns))]
    text, given = (F.col(names[docs.columns.index(c)]) for c in ("text", "doc_id"))
    rows = docs.toDF(*names).withColumns({"__given": given, "__h1": F.xxhash64(text), "__h2": F.xxhash64(F.lit(1), text)})
    keys = ranked(rows.select("__given", "__h1", "__h2").distinct(), [], [F.col("__given").asc_nulls_last(), F.col("__h1"), F.col("__h2")], "doc_id")
    keys = materialize(keys.toDF("__g", "__a", "__b", "doc_id"), "row-ids")
    same = F.col("__given").eqNullSafe(F.col("__g")) & (F.col("__h1") == F.col("__a")) & (F.col("__h2") == F.col("__b"))
    rows = materialize(rows.join(keys, same).select("doc_id", text.alias("text"), *names), "rows")
    kept = _deduplicated(rows).dropDuplicates(["doc_id"])
    return kept.select(*names).toDF(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data is replaced by its kind; ``n_chars`` follows. Null texts
    stay null, repeated rows are redacted each."""
    ship_package(spark)
    clean = docs.withColumn("text", pii.redact(F.col("text")))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares: a document appears once per copy drawn. The null source
    is one of its own, null texts have no size; repeated rows and ids are drawn each."""
    # under other names, so that no column clashes with those of the mix
    names = [f"__{i}" for i in range(len(docs.columns))]
    source, doc_id, text = (names[docs.columns.index(c)] for c in ("source", "doc_id", "text"))
    rows = docs.toDF(*names)
    mixed = mixing.mix(rows, mixing.cycle_weights(rows, source=source), source=source, id_col=doc_id, text=text)
    return mixing.emit(mixed).select(*names).toDF(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of 1024, one row per piece with its token ids. A null text is an empty
    document: its end id alone. Repeated rows and null ids are packed like any other."""
    ship_package(spark)
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), size=1024)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("packed", packed),
]

#: the classifier, MinHash and the tokenizer are beyond SQL; tests hold the rows against
#: a brute-force version instead
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder
    and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    name, stage = STAGES[-1]
    return stage(spark, docs, sf_dir)
