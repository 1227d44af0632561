"""The corpus pipeline: quality, repeated passages, near copies, benchmark passages, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearloom.llm import bpe, decontaminate, line_dedup, near_copies, quality
from yearloom.llm.catalog import QUALITY, WORD_BPE, known_labels, quality_model
from yearloom.llm.common import table
from yearloom.session import store


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1000  # whole texts are long, so fewer of them go to Python at a time


def _documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents, to be sent to Python in batches that are not larger than set."""
    if not 0 < int(spark.conf.get(BATCH)) <= BATCH_ROWS:
        spark.conf.set(BATCH, str(BATCH_ROWS))
    return docs


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the discriminant, fitted on the labelled ones, does not reject."""
    docs = _documents(spark, docs)
    known = store(quality.features(docs).select("doc_id", "features"), "quality")
    model = quality_model(known, known_labels(spark, sf_dir, "quality"))
    vector, score = "__quality_features", "__quality_score"
    scored = quality.score(quality.features(docs, out=vector), model, vector, score)
    return scored.where(F.col(score) >= QUALITY).drop(vector, score)


def new_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that another one holds; of full copies nothing is left."""
    return line_dedup.dedup(_documents(spark, docs)).withColumn("n_chars", F.length("text").cast("long"))


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    copies = near_copies.find(_documents(spark, docs)).where(~F.col("kept")).select("doc_id")
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def no_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.remove(_documents(spark, docs), table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the ids of their texts, and what the ids decode to."""
    return bpe.encode(_documents(spark, docs), WORD_BPE, decoded="decoded")


STAGES = [
    ("quality", good_quality),
    ("line_dedup", new_lines),
    ("near_copies", no_near_copies),
    ("decontaminate", no_benchmarks),
    ("bpe", tokens),
]

# Neither hashes of shingles and lines nor the fitted model can be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; each one's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
