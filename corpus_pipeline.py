"""A training-corpus pipeline: five stages over ``documents``, each stored as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linewise.llm.decontaminate import without_contaminated
from linewise.llm.fair_mix import mixed_documents
from linewise.llm.jaccard_join import keep_one_per_component
from linewise.llm.recompression import without_repeats
from linewise.llm.tables import stored
from linewise.llm.weak_quality import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier rejects go."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, Jaccard 0.8) stays."""
    return keep_one_per_component(docs, n_words=5, threshold=(4, 5))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages (13 words or more) that an earlier document holds go."""
    return without_repeats(docs, width=13)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, and how often (``copies``)."""
    return mixed_documents(docs)


STAGES = [
    ("quality classifier", quality),
    ("n-gram jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", decontamination),
    ("mixing sources", mixing),
]

#: The classifier, the alignment and the hashed passages have no SQL form.  The
#: stages' operators are tested one by one, the pipeline as a whole is not.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage{k}")
    return docs
