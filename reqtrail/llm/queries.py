"""The queries of this subpackage: each applies one operator to its whole table."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reqtrail.llm import alignment, bpe, cosine_groups, divergence, language_id, lm_scoring, mixing, quality, scaled_sketch, secret_scan, simhash, token_files, wrappers
from reqtrail.llm.common import documents, remainder


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.encode_corpus(spark, documents(spark, sf_dir), tokenizer_path(), end_id=2)


def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op3_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = wrappers.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir), width=3, distance=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 7) == 2
    scored = lm_scoring.lm_scores(documents(spark, sf_dir), held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = scaled_sketch.fingerprints_with_edits(documents(spark, sf_dir))
    return made.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       scaled_sketch.fingerprint(F.col("sketch")).alias("fingerprint"),
                       scaled_sketch.fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
                       "near_edited", "near_next", "jaccard_edited", "jaccard_next")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality(documents(spark, sf_dir))
    return judged.select("doc_id", *quality.RULES, "base_failed", "kept", "perplexity")


def op8_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 4) == 2
    found = language_id.languages(documents(spark, sf_dir), held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["number"] < 3)
    count = lambda n: F.size(F.filter("spans", lambda s: s["number"] == n)).cast("long")
    return found.select("doc_id", *(count(n).alias(f"n_{kind[0]}") for n, kind in enumerate(secret_scan.PATTERNS)),
                        F.sha2(secret_scan.written(base), 256).alias("base_sha256"), secret_scan.written(F.col("spans")).alias("spans"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(documents(spark, sf_dir), tokenizer_path(), decoded=True)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


def op13_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cosine_groups.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_token_files, op2_mix, op3_wrappers, op4_simhash, op5_lm_scores, op6_scaled_sketch, op7_quality, op8_languages, op9_secrets, op10_bpe, op11_alignment, op12_divergence, op13_embeddings)
}
ORACLE_SQL: dict[str, str] = {"op12_divergence": divergence.ORACLE_SQL, "op13_embeddings": cosine_groups.ORACLE_SQL}
