"""From raw documents to token ids: quality, near duplicates, benchmark passages, personal data, byte-pair encoding.

Each stage works on all that the one before it kept, is written as Parquet to the shared folder and read again, so a
lost executor or a failed stage never goes back further than one table. All but the last return the columns of
``documents``. Each stage shows how it treats nulls, ties and repeated rows in the docstring of its operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracity_prep.llm import bpe, decontaminate, near_dedup, pii, quality
from veracity_prep.llm.queries import table, vocabulary
from veracity_prep.llm.shared import cut, fresh


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"), fresh(docs, "quality_score"))


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates (five-word shingles, similarity of 0.8 or more)."""
    return near_dedup.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind; n_chars is that of the new text."""
    out = pii.redacted(docs, fresh(docs, "personal_spans"))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, token_ids (little-endian unsigned 32-bit integers), and digests of ids and decoded text."""
    return bpe.round_trip(docs, vocabulary(), keep_ids=True)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_near_duplicates),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("encoding", token_ids),
]

#: Encoding and latent retrieval can't be stated in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs
