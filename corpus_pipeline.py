"""A corpus pipeline from the training-data operators: filter, deduplicate, decontaminate, mix, shard.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept. Its result is
written as Parquet and read again as the next stage's docs. All but the last return the
columns of docs; the last adds the shard of each row and its slot there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import decontamination, jaccard, mixing, quality, sharding
from tidemart.llm.common import held_out, read
from tidemart.session import write_shared

SHARDS = 24
_SCORE = "_quality_score_"


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    labels = read(spark, sf_dir, "labels", "doc_id", "quality")
    model = quality.train(docs, labels, ~held_out(F.col("doc_id"), 3, 1))
    return quality.score(docs, model, _SCORE).filter(F.col(_SCORE) >= 0.5).drop(_SCORE)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles, similarity 0.8 or more."""
    return jaccard.keep_one_of_each(docs, k=5, percent=80)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.clean_documents(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for."""
    return mixing.mix_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with shard and slot."""
    return sharding.shard_documents(docs, SHARDS)


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_distinct),
    ("benchmark decontamination", keep_uncontaminated),
    ("mixing sources to target weights", mix_sources),
    ("sharding", shard),
]

# Trained scores and exact near-duplicate groups are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = write_shared(docs, "pipeline-stage")
    return docs
