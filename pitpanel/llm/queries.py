"""The registered queries of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pitpanel.llm.decontaminate import contaminated
from pitpanel.llm.lm_score import interpolated_scores
from pitpanel.llm.lz_dedup import duplicate_words
from pitpanel.llm.mixing import mixed_rates
from pitpanel.llm.planes import token_files
from pitpanel.llm.ranking import ranked_search
from pitpanel.llm.runs import periodic_runs, repeated_tail
from pitpanel.llm.secrets import find_secrets
from pitpanel.llm.simhash import near_duplicates
from pitpanel.llm.spotsigs import edited_fingerprints
from pitpanel.llm.suffix_dedup import duplicate_bytes
from pitpanel.llm.toxicity import toxicity_scores
from pitpanel.llm.url_filter import judge_urls


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolated_scores(table(spark, sf_dir, "documents"))


def op2_latent_retrieval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_randomness_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))


def op4_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))


def op5_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_url_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


def op8_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_bytes(table(spark, sf_dir, "documents")).drop("spans")


def op9_lempel_ziv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_words(table(spark, sf_dir, "documents")).drop("spans")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def op10_simhash_balls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_repair_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"), rewrite=repeated_tail, full=False)


def op12_geometric_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_id_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES = {f.__name__: f for f in (op1_deleted_interpolation, op2_latent_retrieval, op3_randomness_battery, op4_spotsigs, op5_kneser_ney,
                                   op6_soft_mixing, op7_url_vocabulary, op8_suffix_array, op9_lempel_ziv, op10_simhash_balls, op11_repair_runs, op12_geometric_blocks, op13_id_planes, pipeline)}
