"""The operators bound to the driver's tables: opN_<name>(spark, sf_dir) with production parameters, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collisions, decontaminate, exact_dedup, html_text, licenses, ngram_join, packing, periodic, secrets, spelling, substring_dedup, suffix_dedup, toxicity
from .common import load

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))
    scored = toxicity.toxicity(docs, model)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "hits", "words")


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(load(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_scan(load(spark, sf_dir, "documents"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(load(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(load(spark, sf_dir, "pages"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"), TOKENIZER)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(load(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(load(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(load(spark, sf_dir, "documents"))


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collisions.nearest(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.periodic_runs(periodic.with_planted_runs(load(spark, sf_dir, "documents"))).drop("runs")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(load(spark, sf_dir, "documents"), misspell_every=199)


_ALL = (
    op1_toxicity, op2_ngram_jaccard_join, op3_secret_scan, op4_suffix_array_dedup, op5_html_extraction, op6_packing,
    op7_decontamination, op8_substring_dedup, op9_license_scan, op10_exact_dedup, op11_nearest_neighbours,
    op12_periodic_runs, op13_spelling_variants,
)
QUERIES = {f.__name__: f for f in _ALL}

ORACLE_SQL = {
    "op2_ngram_jaccard_join": ngram_join.ORACLE,
    "op4_suffix_array_dedup": suffix_dedup.ORACLE,
    "op7_decontamination": decontaminate.ORACLE,
    "op8_substring_dedup": substring_dedup.ORACLE,
    "op9_license_scan": licenses.oracle(),
    "op10_exact_dedup": exact_dedup.ORACLE,
    "op12_periodic_runs": periodic.ORACLE,
    "op13_spelling_variants": spelling.ORACLE,
}
