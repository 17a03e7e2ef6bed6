"""The corpus pipeline: documents are judged, deduplicated, cleaned of secrets, mixed and packed.

Every stage takes ``(spark, docs, sf_dir)`` and returns all rows that it keeps;
its result is written and read again as the next stage's documents. All stages but
the last return the columns they were given. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.llm import mixing, packing, quality, secret_scan, simhash
from docflow.llm.common import prepare, table, when_small, with_key, written
from docflow.llm.queries import tokenizer

TOKENIZER = "byte_bpe_50k.json"
RUN_SLOTS = 4  # of 64 KB; packing orders by length inside a run of slots only
MIXED = ["mix_slot", "mix_offset", "doc_id"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the likelihood ratio reject go; null texts have no words and go."""
    judged = quality.judge(docs, table(prepare(spark), sf_dir, "labels"))
    return judged.where("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints link (four words, four bits), the least id stays; of repeated rows, and of rows without id, one stays."""
    prepare(spark)
    rows = with_key(docs, "doc_id", "text", key="_key")
    groups = simhash.near_duplicates(rows, id_col="_key")
    gone = written(groups.where("doc_id != component_id").select(F.col("doc_id").alias("_key")), "duplicates")
    return rows.join(when_small(gone), "_key", "left_anti").select(*docs.columns)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kind; all documents stay, those without findings as they are."""
    prepare(spark)
    found = secret_scan.find_secrets(docs, spans_col="_spans").withColumn("_text", secret_scan.redact(F.col("text"), F.col("_spans")))
    length = F.when(F.size("_spans") > 0, F.length("_text").cast("bigint")).otherwise(F.col("n_chars"))
    return found.withColumns({"text": F.col("_text"), "n_chars": length}).select(*docs.columns)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, sorted in the order of the mixture; readers of several files find it again by ``mixing.mix``."""
    prepare(spark)
    return mixing.mix(docs).repartitionByRange(*MIXED).sortWithinPartitions(*MIXED).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences, numbered in the order of the mixture: files are read in any order, so slots are made again."""
    prepare(spark)
    mixed = mixing.mix(docs).repartitionByRange(*MIXED).sortWithinPartitions(*MIXED)
    return packing.pack(mixed.withColumn("_run", F.expr(f"mix_slot div {RUN_SLOTS}")), tokenizer(TOKENIZER), run_col="_run")


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("secret scans", secret_scans),
    ("mixing sources", mixing_sources),
    ("packing", packed),
]

# fingerprints, ratios and tokens are beyond SQL; tests compare every stage with a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs, name.replace(" ", "-"))
    return docs
