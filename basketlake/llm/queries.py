"""The registered queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketlake.llm import decontaminate, language, lm, mixing, negatives, neighbours, repeats, sanitise, simhash, spelling, tokens, toxicity, urls
from basketlake.llm.common import table


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(table(spark, sf_dir, "documents"), order=3)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.clusters(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op8_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.personal_data(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_digest(table(spark, sf_dir, "documents"))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (op1_language, op2_toxicity, op3_neighbours, op4_lm_scores, op5_simhash, op6_decontamination, op7_repeats, op8_sanitisation, op9_mixing, op10_token_files, op11_url_filter, op12_spelling, op13_hard_negatives)
}
ORACLE = {"op6_decontamination": decontaminate.SQL, "op11_url_filter": urls.SQL, "op13_hard_negatives": negatives.SQL}
