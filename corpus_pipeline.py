"""Documents to training windows: quality, language, near-duplicates, personal data, packing.

Every stage takes what its predecessor kept, written as Parquet and read again.  All but the
last return the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormspan.llm import language, packing, passages, personal, shared, simhash


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what the quality classifier scores at its threshold or above; fitted on the labelled
    rows of ``docs``."""
    model = passages.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    name = shared.free_name(docs, "score")
    scored = passages.score(docs, model, name=name)
    return scored.filter(F.col(name) >= passages.THRESHOLD).select(docs.columns)


def one_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what the language models do not reject; fitted on ``docs``."""
    name = shared.free_name(docs, "rejected")
    judged = language.identify(docs, language.fit(docs))
    return judged.filter(~F.col(name)).select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest key."""
    return simhash.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data; ``n_chars`` follows the text."""
    masked = personal.mask(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("language identification", one_language),
    ("SimHash near-duplicates", near_copies),
    ("personal data", personal_data),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = shared.spill(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: No SQL expresses the stages; tests hold them against brute force.
ORACLE_SQL = None
