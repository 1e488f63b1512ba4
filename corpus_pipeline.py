"""The corpus pipeline: quality rules, near-duplicates, benchmark passages, personal data, token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scoreflow.llm.common import stored, table
from scoreflow.llm.decontaminate import drop_contaminated
from scoreflow.llm.pii import mask_personal_data
from scoreflow.llm.quality import keep_good
from scoreflow.llm.simhash import keep_one_per_component
from scoreflow.llm.wordbpe import tokenized, word_vocabulary_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_per_component(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mask_personal_data(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokenized(docs, word_vocabulary_path())


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("token_ids", token_ids),
]

#: The stages score, hash and train; SQL cannot express them. tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
