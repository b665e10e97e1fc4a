"""From raw documents to token ids: quality rules, near duplicates, secrets, source mixture, encoding.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which ``run`` writes as Parquet to the
shared folder and reads again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.llm import mixing, neardup, pieces, quality, secrets
from tickloom.llm.queries import WEIGHTS, table, tokenizer_path
from tickloom.llm.storage import placed, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood-ratio threshold."""
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.judge_quality(docs.select(COLUMNS), model).where("quality_kept").select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id. Rows that repeat a
    doc_id share its verdict; a null doc_id stays."""
    gone = neardup.near_duplicates(docs).where("not kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(COLUMNS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mask; n_chars follows the new text."""
    return secrets.redact_secrets(docs.select(COLUMNS)).withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mixture to the target weights, within and across the files written."""
    return mixing.mix_sources(docs.select(COLUMNS), WEIGHTS).orderBy("mix_position").select(COLUMNS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, position, n_tokens, ids, decoded_sha256``: position (0, 1, ... over all rows) is the place in the mixture,
    that is in the files of ``docs``. The rows themselves come in any order."""
    path = tokenizer_path()
    coded = pieces.encode_and_decode(placed(docs, "position"), path, ("position",))
    return coded.select("doc_id", "position", "n_tokens", "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_rules),
    ("near-dedup", near_dedup),
    ("secret scan", secret_scan),
    ("source mixture", source_mixture),
    ("token ids", token_ids),
]

#: SentencePiece encoding and hashed ratios have no SQL form; tests/llm compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
