"""The corpus pipeline: quality rules, classifier, near-duplicates, mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's docs. Each sends the package to the workers first, as stages are also called by themselves. All but the last
return the columns of documents. SQL can express neither the classifier nor the signatures, so there is no oracle; tests
hold the stages to brute-force versions.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tether.llm import mixing, near_copies, packing, quality_classifier, quality_rules
from tether.llm.common import shared_dir, table
from tether.session import shipped


@shipped
def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs, passage=quality_rules.PASSAGE)


@shipped
def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels, documents = table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents")
    return quality_classifier.keep_good(docs, labels, known=documents)


@shipped
def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_copies.keep_one(docs)


@shipped
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixture(docs)


@shipped
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path(packing.MODEL))


STAGES = [
    ("quality rules", quality_rules_stage),
    ("quality classifier", quality_classifier_stage),
    ("SimHash near-duplicates", near_duplicates_stage),
    ("mixing", mixing_stage),
    ("best-fit packing", packing_stage),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; each stage's result goes through Parquet in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        path = f"{folder}/{i}"
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
