"""The corpus operators as queries on the given tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siftwork.llm import bag_minhash, conversation_repair, curve_packing, epsilon_grid, nnpu_toxicity, prefix_tokens, quality_outliers, recompression, setm_phrases, soft_mixing, suffix_dedup, template_lines, unigram_language
from siftwork.llm.common import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_template_lines", template_lines.ORACLE)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template_lines.drop_templates(table(spark, sf_dir, "documents").select("doc_id", "text"), counts=True)


@query("op2_curve_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curve_packing.pack(table(spark, sf_dir, "documents"), with_ids=False)


@query("op3_quality_outliers")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_outliers.judge(table(spark, sf_dir, "documents"), steps=30)


@query("op4_suffix_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), with_bytes=False)


@query("op5_recompression")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.remove_repeats(table(spark, sf_dir, "documents"), with_words=False)


@query("op6_bag_minhash")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bag_minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op7_epsilon_grid")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return epsilon_grid.near_vectors(table(spark, sf_dir, "embeddings"))


@query("op8_prefix_tokens")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_tokens.token_counts(table(spark, sf_dir, "documents"))


@query("op9_soft_mixing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return soft_mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("print")


@query("op10_nnpu_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return nnpu_toxicity.score(documents, nnpu_toxicity.fit(documents, table(spark, sf_dir, "labels")))


@query("op11_setm_phrases", setm_phrases.ORACLE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setm_phrases.phrases(table(spark, sf_dir, "documents"))


@query("op12_unigram_language")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return unigram_language.identify(documents, unigram_language.fit(documents))


@query("op13_conversation_repair")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_damaged(table(spark, sf_dir, "conversations"))
