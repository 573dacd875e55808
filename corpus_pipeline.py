"""The corpus pipeline: documents in, a cleaned corpus and its mix out, stage by stage.

Every stage works on all that the one before it kept; all but the last return the columns they got.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm import decontaminate, langid, mixing, neardup, secrets
from stayline.llm.store import keep

# The classifiers and the scanners' models have no SQL; tests hold them against brute force.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter; all of them if none is labelled. No decision of the classifiers drops a row."""
    model = langid.fit(docs.where(~langid.held_out()))
    if not model.families:
        return docs
    # Rows are told apart by their place, so that input columns of the same names stay as they are.
    whole = docs.select(F.struct(*docs.columns).alias("row"), "text")
    found = langid.identify(whole, model).where(F.col("lang_pred") != langid.UNKNOWN)
    return found.select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates stays: five-word shingles, 80 per cent."""
    return neardup.keep_one(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kind; every document stays."""
    return secrets.redact(docs, secrets.fit(secrets.corpus_samples(docs)))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes, by target weights of the sources."""
    return mixing.mix_documents(docs)


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("decontaminate", benchmark_free),
    ("secrets", secret_free),
    ("mix", source_mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; every stage before it is stored in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
