"""The thin queries over the driver's tables, and the SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import ann, chat, checks, classifier, lexical, mixing, neardup, negatives, pieces, pii, quality, secrets, sharding, spans, substring_dedup

TOKENIZER = "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_vector_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_by_vector_packing(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "tokens")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.drop_repeated_passages(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_pii_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    counts = [spans.of_kind(F.col("base"), k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS[: pii.BASE_KINDS])]
    return found.select("doc_id", *counts, F.sha2(spans.joined(F.col("base"), pii.KINDS), 256).alias("base_sha256"), spans.joined(F.col("spans"), pii.KINDS).alias("spans"), F.size("spans").cast("long").alias("n_spans"))


#: Target shares of the mixture that op4 shows; the other sources divide the rest.
WEIGHTS = {"src0": 0.24, "src1": 0.12, "src2": 0.06}


def op4_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"), WEIGHTS, carry=["doc_id", "source"])
    return mixed.select("doc_id", "source", *(F.col(f"mix_{c}").alias(c) for c in ("position", "block", "slot", "time", "release", "deadline", "weight")))


def op5_quality_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    judged = quality.judge_quality(docs, quality.fit_quality(docs, table(spark, sf_dir, "labels")), ["doc_id"])
    return judged.select("doc_id", *(F.col(f"quality_{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")))


def op6_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate_perspectives(table(spark, sf_dir, "conversations"))


def op7_tensored_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, percent=80)


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path()
    coded = pieces.decode(pieces.encode(table(spark, sf_dir, "documents"), path), path)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op9_secret_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    counts = [spans.of_kind(F.col("base"), k).alias(f"n_{name}") for k, name in enumerate(secrets.KINDS[:3])]
    return found.select("doc_id", *counts, F.sha2(spans.joined(F.col("base"), secrets.KINDS), 256).alias("base_sha256"), spans.joined(F.col("spans"), secrets.KINDS).alias("spans"), F.size("spans").cast("long").alias("n_spans"))


def op10_rotated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return ann.nearest_by_codes(vectors, F.col("vec_id") % 50 == 0)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", noisy.alias("label"), F.col("embedding").alias("vector"))
    return negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    classed = classifier.classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out)
    return classed.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_vector_sharding, op2_substring_dedup, op3_pii_weak_supervision, op4_pfair_mixing, op5_quality_ratio, op6_perspective_rotation, op7_tensored_minhash, op8_sentencepiece, op9_secret_entropy, op10_rotated_codes, op11_hard_negatives, op12_ranked_search, op13_quality_classifier)}


def oracle_sql() -> dict[str, str]:
    return {"op2_substring_dedup": checks.REPEATED_PASSAGES, "op6_perspective_rotation": chat.ORACLE_SQL, "op7_tensored_minhash": checks.near_duplicates(4, 80), "op10_rotated_codes": ann.ORACLE_SQL, "op11_hard_negatives": negatives.ORACLE_SQL, "op12_ranked_search": lexical.ORACLE_SQL}
