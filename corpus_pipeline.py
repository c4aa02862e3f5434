"""From raw documents to balanced training shards: five stages, each a job of its own over the whole of its input."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

from rowmill.llm.common import table, written  # noqa: E402
from rowmill.llm.decontaminate import overlaps  # noqa: E402
from rowmill.llm.importance import resample  # noqa: E402
from rowmill.llm.mixing import mix, token_estimate  # noqa: E402
from rowmill.llm.plans import MIX_SEED, MIX_WEIGHTS, SHARDS, good_labels, mix_levels  # noqa: E402
from rowmill.llm.sharding import row_bytes, shard_by_bytes  # noqa: E402
from rowmill.llm.simhash import without_near_duplicates  # noqa: E402

#: Tokens that the mix keeps of those that reach it; no document is given twice.
MIX_SHARE, MIX_EPOCHS = 0.9, 1


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that importance resampling rejects: those that good text does not explain.

    Null and empty texts stay, repeated rows share one fate. No other column of ``docs`` is looked at or changed.
    """
    whole = docs.select(F.struct("*").alias("document"), "doc_id", "text")
    return resample(whole, good_labels(spark, sf_dir)).where("kept").select("document.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group whose fingerprints link (three-word shingles, three bits), the smallest id.

    Of repeated rows one stays; documents without words are one group; a null id is kept only where no other is.
    """
    return without_near_duplicates(docs, words=3, threshold=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a passage of the benchmark; null and empty texts hold none."""
    return docs.where(F.size(overlaps(docs, table(spark, sf_dir, "benchmark"))) == 0)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the part of each source that brings domains, languages and sources closest to their target weights.

    Null languages and sources are leaves of their own, texts without bytes cost nothing and stay where their leaf
    gives anything; rows of one id follow one another. No column of ``docs`` is changed.
    """
    whole = docs.select(F.struct("*").alias("document"))
    tokens, key = token_estimate(F.col("document.text")), F.col("document.doc_id")
    mixed = mix(whole, mix_levels("document."), MIX_WEIGHTS, tokens, key, MIX_SHARE, MIX_EPOCHS, MIX_SEED)
    return mixed.select("document.*")


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut the documents, by id, into shards of nearly equal bytes: columns ``shard`` and ``slot``."""
    text = F.col("text")
    return shard_by_bytes(docs, SHARDS, row_bytes(text), [F.col("doc_id"), F.xxhash64(text)])


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: SQL expresses neither the n-gram models nor the fingerprints and the overlaps; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what one stage returns is written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
