"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; all but the last
return the columns of ``docs``.  Null texts and languages, empty texts, repeated rows, empty tables and
further columns are handled as the operators' docstrings say; column names that begin with ``__`` are
not free.  Where a stage changes a text, ``n_chars`` follows it if there is such a column.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallywright.llm import near_dup, packing, pii, quality, queries, substrings
from tallywright.llm.common import saved

_RESULT = "__result"
#: The session's setting that holds the key of the pseudonyms.
KEY_SETTING = "tallywright.pseudonyms.key"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.judge_quality(docs, result=_RESULT).where(f"{_RESULT}.kept").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, similarity 0.8), the one with the
    smallest id.  Repeated rows stay once; rows without an id stay."""
    found = saved(near_dup.near_duplicates(docs, shingle=5, percent=80).select("doc_id", "kept").where("doc_id IS NOT NULL"), "kept")
    # Ids that occur once, nearly all, need no comparison of texts.
    ids = found.groupBy("doc_id").agg(F.bool_or("kept").alias("kept"), F.count("*").alias("times")).where("kept")
    once = docs.join(ids.where("times = 1"), "doc_id", "left_semi")
    repeated = docs.join(ids.where("times > 1"), "doc_id", "left_semi").withColumn(_RESULT, F.sha2("text", 256)).dropDuplicates(["doc_id", _RESULT])
    known = once.select(docs.columns).unionByName(repeated.select(docs.columns))
    return known.unionByName(docs.where("doc_id IS NULL"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 13 words and more that a document with a smaller id has."""
    cut = substrings.remove_repeats(docs, length=13, layout="text", result=_RESULT)
    text = F.when(F.col("text").isNotNull(), F.col(f"{_RESULT}.kept"))
    return _with_text(cut.withColumn("text", text), docs)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str, key: str | None = None) -> DataFrame:
    """Texts with pseudonyms for personal data.  ``key`` is the secret of whoever runs the pipeline, or else what the
    session names in KEY_SETTING; without either it is a known one that hides nothing from who knows it."""
    key = key or spark.conf.get(KEY_SETTING, queries.KEY)
    return _with_text(pii.pseudonymise(docs, key, result=_RESULT), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    return queries.packed_rows(packing.pack(docs, public_tokenizers.path(queries.BYTE_BPE), length=2048, end_id=1))


def _with_text(changed: DataFrame, docs: DataFrame) -> DataFrame:
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        size = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text"))
        changed = changed.withColumn("n_chars", size.cast(kind))
    return changed.select(docs.columns)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("pseudonyms", pseudonyms),
    ("packing", packed),
]

#: Sketches, keyed permutations and tokens are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
