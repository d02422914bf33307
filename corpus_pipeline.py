"""The corpus pipeline: stages that filter and rewrite ``documents``, each written and read again.

Every stage but the last returns the columns of ``documents``; the last returns the tokens of what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paylens.llm import bpe, decontaminate, jaccard, line_dedup, toxicity
from paylens.session import stage_table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: documents that the factorization machine scores 0.3 or more go."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: lines that repeat an earlier one, up to two edits, go; so do documents that lose every line."""
    return line_dedup.dedup(docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: one document stays of each group linked by a similarity of 0.8 of five-word shingles."""
    return jaccard.one_of_each(docs, n=5, num=80, den=100, null_ids=True)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents of which a twentieth repeats benchmark windows go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), null_ids=True)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE: the ids of every document, and the digest of the text that they decode to."""
    import public_tokenizers

    return bpe.digests(docs, bpe.Bpe.load(public_tokenizers.path("word_bpe_49k.json")), ids=True)


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_repeated_lines),
    ("n-gram Jaccard join", without_near_duplicates),
    ("benchmark decontamination", without_benchmark),
    ("BPE encoding and decoding", tokenized),
]

#: Fitted, edit-distance, set-similarity and tokenizer stages have no SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
