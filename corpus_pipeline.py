"""A training corpus from ``documents`` in stages, each one operator of ``lanecast.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as
the next stage's ``docs``. All but the last return the columns of ``documents``. Null ids and texts, empty tables and further columns
pass through; what each stage does with them is said by its operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lanecast.llm import jaccard_join, nb_svm, suffix_dedup, template_match, unigram
from lanecast.llm.queries import piece_model
from lanecast.session import materialise

#: Bytes of a passage whose repetition counts: a little under fifty words.
PASSAGE_BYTES = 240


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return nb_svm.accepted(docs, nb_svm.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 80 % of its five-word shingles."""
    return jaccard_join.one_of_each(docs, jaccard_join.JaccardSettings(words=5, percent=80))


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that occur more than once."""
    return suffix_dedup.without_repeats(docs, suffix_dedup.RepeatSettings(length=PASSAGE_BYTES))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item was found."""
    return template_match.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece numbers of every document left, checked by decoding."""
    return unigram.encoded(docs, piece_model())


STAGES = [
    ("quality_classifier", good_quality),
    ("jaccard_join", without_near_copies),
    ("suffix_dedup", without_repeated_passages),
    ("benchmark_decontamination", without_benchmark),
    ("sentencepiece", pieces),
]

#: Stages that learn a model or sort suffixes are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` through all stages."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
