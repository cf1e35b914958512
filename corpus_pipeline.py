"""The corpus pipeline: quality rules, near-duplicates, repeated passages, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet in the shared folder and read again as
the next one's ``docs``. All but the last return the columns of ``docs``, whatever other columns there are and whatever their
names. An empty table gives an empty one in every stage; null ids are carried and never compared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textloom.llm import op2_quality, op3_decontaminate, op4_suffix, op8_simhash, op10_pack
from textloom.llm.scratch import Scratch, made
from textloom.ship import shipped


@shipped
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are good with a posterior probability of a half or more.

    Null and empty texts are judged by the length rule alone (bad); repeated rows get the same verdict; a posterior of exactly a
    half stays.
    """
    return op2_quality.keep_good(docs)


@shipped
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the least id (null ids last).

    Of repeated rows one stays. Null texts are nobody's copies and all stay; empty texts are copies of each other.
    """
    return op8_simhash.keep_one(docs)


@shipped
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of passages of 50 words or more; the first by (doc_id, position) keeps its copy.

    A document of which no word is left goes, so one of repeated long rows stays whole. Null, empty and shorter texts stay.
    """
    return op4_suffix.cut_repeats(docs)


@shipped
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark; null and empty texts and items match nothing, repeated rows go together."""
    return op3_decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@shipped
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents' tokens in bins of the model's context, a row for each piece of a document.

    Null and empty texts get one row without a bin; repeated rows are packed each; ties take slots in the order of a hash.
    """
    return op10_pack.pack_texts(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Expectation-maximisation, graph search and greedy packing aren't SQL: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of ``sf_dir``."""
    scratch = Scratch(spark)
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        with made():
            docs = scratch.table(name, stage(spark, docs, sf_dir))
        if before:
            scratch.remove(before)
        before = name
    return docs
