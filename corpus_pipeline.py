"""The training-data pipeline: five stages over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it kept;
``run`` writes the result of each to the shared checkpoint folder and hands the
reread table on.  Columns that ``documents`` may have besides its own pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.llm.decontaminate import drop_contaminated
from pitpanel.llm.mixing import with_rates
from pitpanel.llm.secrets import redact
from pitpanel.llm.simhash import drop_near_duplicates
from pitpanel.llm.toxicity import drop_toxic
from pitpanel.session import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below a half."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: shingles of 4 words, 4 bits."""
    return drop_near_duplicates(docs, shingle=4, distance=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark and ``n_chars`` counted anew."""
    return redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with tokens, domain, posterior and rate, for equal shares of the domains."""
    return with_rates(docs, table(spark, sf_dir, "labels"))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("mixing", mixing),
]

# models and component searches are beyond SQL; tests/llm/test_pipeline.py holds each stage to its operator
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
