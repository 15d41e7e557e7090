"""A training-data pipeline over ``documents``: quality, near-duplicates, secrets, mixture, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read back
as the next one's ``docs``. All but the last return the columns of ``docs``. What the operators define for nulls,
empty and very long texts, repeated rows and empty tables holds for the stages as well.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reqtrail.llm import bpe, mixing, quality, queries, secret_scan, simhash
from reqtrail.llm.common import documents, materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or their language's perplexity band reject go."""
    return quality.quality(docs, carry=True).where("kept").select("_carried.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays, the one with the smallest id."""
    return simhash.one_of_each(docs, width=3, distance=3)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret's span is replaced by a mark; no document goes. ``n_chars`` is that of the new text."""
    found = secret_scan.scan(docs, carry=True)
    text = secret_scan.redacted(F.col("_carried.text"), F.col("spans"))
    new = {"text": F.col("_text"), "n_chars": F.coalesce(F.length("_text").cast("long"), F.col("_carried.n_chars"))}
    found = found.withColumn("_text", text)
    return found.select(*(new.get(c, F.col(f"_carried.`{c}`")).alias(c) for c in docs.columns))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them: not at all, once, or twice."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256): the token ids of every text, and what they decode to as a digest."""
    coded = bpe.encode(docs, queries.tokenizer_path(), decoded=True)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("secret scans", secrets),
    ("mixing sources", mixture),
    ("BPE encoding", tokens),
]

#: Perplexity bands, the trie join, the test battery, budget fitting and BPE are beyond SQL; tests hold brute force against them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
