"""The operators as registered queries over whole tables, with SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.llm import (
    collocations, embedding_dedup, license_scan, mixing, packing, quality, secret_scan, simhash, sql, suffix_dedup, token_counts, toxicity,
    vector_codes, warc,
)
from docflow.llm.common import prepare, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(prepare(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def tokenizer(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query("op1_suffix_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_mixing", sql.MIXING)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "source", "mix_block", "mix_slot", "mix_offset")


@query("op4_tier_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


@query("op5_warc", sql.WARC)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(table(spark, sf_dir, "pages"))
    checked = F.when(F.col("error").isNotNull(), F.raise_error(F.col("error"))).otherwise(F.col("payload_bytes"))
    return records.select(
        warc.page_of(F.col("record_id")).alias("page_id"), checked.alias("payload_bytes"), "payload_digest", "record_type",
        warc.page_of(F.col("refers_to")).alias("refers_to"))


@query("op6_embedding_cells", sql.EMBEDDINGS)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op7_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


@query("op8_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality.NUMBERS, "base_failed", "kept", "quality_score")


@query("op9_secret_ledger")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < 3)
    of = [secret_scan.count_of(F.col("spans"), kind).alias(f"n_{kind}") for kind in secret_scan.KINDS[:3]]
    return found.select(
        "doc_id", *of, F.sha2(secret_scan.described(base), 256).alias("base_sha256"),
        secret_scan.described(F.col("spans")).alias("spans"))


@query("op10_simhash")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op11_collocations", sql.COLLOCATIONS)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op12_licenses", sql.LICENSES)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.find_licenses(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score")


@query("op13_vector_codes", sql.CODES)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings")).drop("label")
