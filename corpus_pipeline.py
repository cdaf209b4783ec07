"""From raw documents to packed sequences, in stages that each write a table and read it back.

Each stage is judged on its own input and passes on the columns of documents, but the last. Texts may be null or of any length, rows
may repeat, tables may be empty; what a stage does with them stands in the docstring of its operator's module.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from stratus.llm import decontaminate, neardup, packing, pii, quality
from stratus.llm.common import shared_folder, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted to the labels among them, rejects go."""
    return quality.keep(docs, quality.classifier(docs, table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts with a five-word Jaccard similarity of 0.8 or more stays."""
    return neardup.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, in whatever order of its passages, go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is masked; n_chars follows."""
    return pii.redact(docs, pii.train(), n_chars="n_chars")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that are left, placed in sequences."""
    return packing.pack(docs)


STAGES = [("quality", quality_stage), ("near_duplicates", near_duplicate_stage), ("decontamination", decontamination_stage), ("pii", pii_stage), ("packing", packing_stage)]

#: Fitted trees, tilings and token ids are beyond SQL; tests/llm checks the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the table documents; each result but the last is written to the shared checkpoint folder and read back.

    The tables stay there for who wants to look at them or to start again from one; they go when the folder is cleared.
    """
    docs, base = table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
