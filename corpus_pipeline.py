"""A training-data pipeline of five stages; each is written as Parquet and read again as the input of the next.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns of
``documents``. ``run`` applies them to the documents of ``sf_dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clanweave.llm import decontaminate, line_dedup, quality, simhash, spm
from clanweave.llm.common import table
from clanweave.llm.queries import tokenizer
from clanweave.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go: each row by its text, so that null texts go, and null or repeated doc_ids are rows like others."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share go from all but one; n_chars follows the new text (rows that keep all lines keep theirs).

    Null texts stay null, rows without a doc_id keep all lines, repeated rows are treated alike; columns of any other name are returned as they are.
    """
    kept = line_dedup.dedup_lines(docs, min_chars=40, min_docs=5)
    (dropped,) = [c for c in kept.columns if c not in docs.columns and c.endswith("n_dropped")]
    changed = F.when(F.col(dropped) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", changed).select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by 0.8 of their five-word shingles the one with the smallest doc_id stays.

    Rows are told apart by their texts: of repeated rows one stays, rows of one doc_id with unlike texts all do; rows without a doc_id come last in
    their group; null and empty texts are one group.
    """
    return simhash.keep_one(docs, distance=4, share=0.8)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, whatever their doc_id; null and empty texts hold none."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), width=5, threshold=0.8)


def sentencepiece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, with digests of the ids and of the decoded text; a null text is encoded as an empty one, row for row."""
    return spm.encode_documents(docs, tokenizer("piece_bpe_32k.model"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_stage),
    ("simhash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("sentencepiece encoding", sentencepiece_ids),
]

#: The hashed log-likelihood ratio and the fingerprints can't be expressed in SQL; tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
