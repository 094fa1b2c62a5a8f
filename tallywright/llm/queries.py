"""The dealt operators as named queries over the given tables, with SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallywright.llm import ann, license_scan, near_dup, packing, pieces, pii, prefix_trie, quality, substrings, token_counts, toxicity, url_filter, variants
from tallywright.llm.common import documents

BYTE_BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
#: Stands for the secret that a user of pii.pseudonymise keeps.
KEY = "a secret of the caller"


def op1_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    return ann.search(spark.read.parquet(f"{folder}/embeddings.parquet"), F.col("vec_id") % 100 == 0, k=10)


def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge_urls(spark.read.parquet(f"{folder}/pages.parquet"), url_filter.rule_table(spark))


def op3_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.pseudonymise(documents(spark, folder).select("doc_id", "text"), KEY)
    return found.select("doc_id", "text", F.size("private").alias("n_found"), "private")


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, folder), public_tokenizers.path(BYTE_BPE), limit=512)


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    found = substrings.remove_repeats(docs, length=13)
    return found.select("doc_id", "repeats.n_words", "repeats.n_removed", F.sha2("repeats.kept", 256).alias("kept_sha256"))


def op10_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.near_duplicates(documents(spark, folder), shingle=4, percent=80)


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.judge_quality(documents(spark, folder), carry=["doc_id", "lang", "source"])
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return found.select("doc_id", *[f"quality.{name}" for name in names])


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    scored = toxicity.score(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(documents(spark, folder), public_tokenizers.path(BYTE_BPE), length=2048, end_id=1)
    return packed_rows(pieces)


def packed_rows(pieces: DataFrame) -> DataFrame:
    """Pieces with a checksum in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document, and whether decoding them gives the document back."""
    model = public_tokenizers.path(PIECES)
    both = pieces.decode(pieces.encode(documents(spark, folder), model), model)
    return both.select(
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        (F.octet_length("ids") / 4).cast("long").alias("n_ids"),
        F.crc32("ids").alias("ids_crc32"),
        (F.col("text") == F.col("decoded")).alias("round_trip"),
    )


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants.spelling_variants(documents(spark, folder), noise=199)


def op12_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = license_scan.scan(documents(spark, folder).select("doc_id", "text"))
    matches = F.col("licenses.matches")
    base = F.filter(matches, lambda m: m["base"])
    starts = F.transform(base, lambda m: m["first_word"])
    return found.select(
        "doc_id",
        "licenses.n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        license_scan.labels(base).alias("base_labels"),
        license_scan.labels(matches).alias("labels"),
        license_scan.best(matches).alias("score"),
    )


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(spark.read.parquet(f"{folder}/conversations.parquet"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_multi_index,
        op2_url_filter,
        op3_pseudonyms,
        op4_token_counts,
        op5_substring_dedup,
        op6_quality_rules,
        op7_toxicity,
        op8_packing,
        op9_sentencepiece,
        op10_near_duplicates,
        op11_spelling_variants,
        op12_license_scan,
        op13_prefix_trie,
    )
}
SQL = {
    "op2_url_filter": url_filter.SQL,
    "op5_substring_dedup": substrings.SQL,
    "op10_near_duplicates": near_dup.SQL,
    "op11_spelling_variants": variants.SQL,
    "op13_prefix_trie": prefix_trie.SQL,
}
