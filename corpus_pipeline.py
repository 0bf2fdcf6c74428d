"""The corpus pipeline: documents to a training set, each stage over all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import decontaminate, language, mixing, near_dup, queries
from tallyloom.llm.common import materialize, quoted, small_batches


def _with_row(docs: DataFrame) -> DataFrame:
    """What a stage looks at, and the row itself, so that columns called like a stage's own stay as they are."""
    return docs.select("doc_id", "text", "lang", F.struct(*[quoted(c) for c in docs.columns]).alias("_row"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labelled documents; those that the model rejects go.

    Null texts, empty ones and those without a letter go; texts of any length are read whole.  Rows that repeat get the
    same answer; equal probabilities go to the language that comes first.  Without labelled rows nothing is learned and all
    documents go; an empty table stays empty.  Null ids and labels are no reason to go; columns stay as they came.
    """
    rows = _with_row(docs)
    with small_batches(spark):
        return materialize(language.predict(rows, language.fit(rows)).filter("not rejected").select("_row.*"), "language_id")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group linked over five-word shingles at 0.8.

    The smallest doc_id stays.  Null and empty texts are in no group; rows that share a doc_id but not their text, or have
    none, are compared like others; of rows equal in both one stays.  Texts are compared whole; an empty table stays
    empty; columns stay as they came.
    """
    return near_dup.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more is benchmark text go.

    Null and empty texts have no words and stay; texts of any length are read whole; rows that repeat are judged alike.  An
    empty benchmark or an item without text removes nothing; an empty table stays empty; columns stay as they came.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    judged = decontaminate.decontaminate(_with_row(docs), benchmark)
    return judged.filter("not contaminated").select("_row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks.

    A null source is a source like others; rows whose doc_id repeats, null ones among them, share their coin.  Documents of a
    source without any word go, empty texts of other sources come as often as its rate says.  An empty table stays
    empty; columns stay as they came.
    """
    return mixing.mix(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, read back: place and checksum of every copy that the mix emitted.

    In ascending doc_id order, null ids first, copies and repeated ids after each other.  Null and empty texts are their
    end id alone; an empty table gives no rows.  The only stage that returns columns of its own.
    """
    return queries.token_digest(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mix_sources", mix_sources),
    ("token_output", token_output),
]

# Training, MinHash and the tokenizer have no SQL; tests/llm compares the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
