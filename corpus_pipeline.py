"""The corpus pipeline: language ID, near-duplicates, benchmark decontamination, secrets, SentencePiece.

Each stage takes what its predecessor kept, written as Parquet and read again; then all that was written before it goes. All
but the last return the columns of ``documents``; the last gives the encoded corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.llm import op02_sentencepiece, op03_minhash, op07_language, op08_secrets, op09_decontaminate
from loomwright.llm.common import alone


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or with no language of probability 0.5 or more, go. The model learns from the labelled
    documents among its own input."""
    return op07_language.keep_identified(docs, op07_language.train(docs), least=0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays (five-word shingles, similarity of 0.8 or more)."""
    return op03_minhash.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return op09_decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced; no document goes. ``n_chars`` follows the text."""
    model = op08_secrets.train(op08_secrets.labelled_findings(spark), op08_secrets.learn_vocabulary(docs))
    clean = op08_secrets.redact(docs, model)
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and their number, and the decoded text of every document."""
    import public_tokenizers

    out = op02_sentencepiece.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("secrets", secrets), ("sentencepiece", sentencepiece)]
#: No SQL: the stages learn models, compare signatures and merge symbols. tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = alone(spark, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), last=docs)
    return STAGES[-1][1](spark, docs, sf_dir)
