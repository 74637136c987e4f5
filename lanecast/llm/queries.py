"""Registered queries of this subpackage, one per operator, each over its whole table with production settings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanecast.llm import html_layout, jaccard_join, language_spans, line_crf, line_filters, maxent_lm, merkle_manifest, nb_svm, periodic_runs
from lanecast.llm import suffix_dedup, template_match, token_file, unigram
from lanecast.llm.oracles import ORACLES
from lanecast.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written to a token file in the shared folder and read back."""
    import public_tokenizers

    path = scratch_path(spark, "tokens")
    token_file.write_token_file(_table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_file.read_token_file(spark, path)


def op2_html_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visible text of every page."""
    return html_layout.extracted(_table(spark, sf_dir, "pages"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked by the Jaccard similarity of their four-word shingles, 0.85 or more."""
    settings = jaccard_join.JaccardSettings(words=4, percent=85)
    return jaccard_join.linked_documents(_table(spark, sf_dir, "documents"), settings)


def op4_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and the verdict of the line labels for every document."""
    documents = _table(spark, sf_dir, "documents")
    return line_crf.judged(documents, line_crf.fit(documents, _table(spark, sf_dir, "labels")))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of each document without every byte under a string of 400 bytes that also starts elsewhere."""
    return suffix_dedup.removal_report(_table(spark, sf_dir, "documents"), suffix_dedup.RepeatSettings(length=400))


def op6_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every document, learned from six of seven."""
    documents = _table(spark, sf_dir, "documents")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    return maxent_lm.scored(documents, maxent_lm.fit(documents.where(~held)), held)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, by a model fitted to ``labels``."""
    documents = _table(spark, sf_dir, "documents")
    model = nb_svm.fit(documents, _table(spark, sf_dir, "labels"))
    rows = nb_svm.scored(documents, model)
    return rows.select("doc_id", nb_svm.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items found in them, given again with the same or other values."""
    found = template_match.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.drop("row_key")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from ``lang`` of two thirds of them."""
    documents = _table(spark, sf_dir, "documents")
    held = nb_svm.held_out(F.col("doc_id"))
    rows = language_spans.predicted(documents, language_spans.fit(documents.where(~held)))
    return rows.select("doc_id", held.alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


def piece_model() -> str:
    """The public piece model of the installed tokenizer files."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece numbers of every document, and whether decoding them gives the text again."""
    return unigram.encoded(_table(spark, sf_dir, "documents"), piece_model())


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, a tenth of them with a repetition planted by their id."""
    rows = periodic_runs.periodic_runs(periodic_runs.planted(_table(spark, sf_dir, "documents")))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    rows = rows.withColumn("best", periodic_runs.strongest(F.col("runs")))
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and whether a leaf, tampered with in one of seven documents, folds to the root."""
    seventh = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    manifest = merkle_manifest.build(_table(spark, sf_dir, "documents"), seventh)
    rows = merkle_manifest.proofs(manifest, merkle_manifest.proof_digest).withColumnRenamed("siblings", "proof_sha256")
    return rows.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


def op13_line_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that ten documents or more have."""
    documents = _table(spark, sf_dir, "documents")
    rows = line_filters.without_common_lines(documents, line_filters.build(documents, min_docs=10))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


__all__ = ["ORACLES", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_file": op1_token_file,
    "op2_html_layout": op2_html_layout,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_line_crf": op4_line_crf,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_maxent_lm": op6_maxent_lm,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_language_id": op9_language_id,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_line_filters": op13_line_filters,
}
