"""From raw documents to a training mix: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stateloom.llm import decontaminate, langid, minhash, mixing, pii
from stateloom.llm.shared import free_name, importable, kept

PII_KEY = "stateloom"  # a user takes a secret one
MIX_WEIGHTS = [3.0, 1.0, 2.0]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told and that is their label's; profiles are learnt from the labelled ones.

    Rejected are null texts, texts without a letter, documents whose label is another language than their text's
    (`langid.MARGIN`), and everything if no row has a language. Without a label, a document stays; so does one whose text is
    in two languages of which the label is one.
    """
    importable(spark)
    profiles = kept(langid.learn_profiles(docs), "language-profiles")
    return langid.keep_identified(docs, profiles, lang="lang")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8): the least id."""
    importable(spark)
    return minhash.keep_one_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    importable(spark)
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal data."""
    return pii.hide_personal_data(docs, PII_KEY)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with size and taken (words, repeats counted)."""
    mixed, plan = mixing.mix(docs, "text", F.array(F.col("source").cast("string")), MIX_WEIGHTS)
    size, taken = free_name(docs, "size"), free_name(docs, "taken")
    taking = mixed.select(*docs.columns, F.col(f"{plan['column']}.size").alias(size), F.col(f"{plan['column']}.taken").alias(taken))
    return taking.filter(F.col(taken) > 0)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("mixture", mixture),
]

# SQL cannot say rank-order profiles, keyed pseudonyms or the seeded mix
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
