"""From raw documents to packed training sequences, in five stages.

Every stage is written as Parquet and read again by the next, so a lost executor costs one stage at most.

1. Toxicity: documents that the model rejects go.
2. Line deduplication: lines of recurring templates go, but for the first document that has them.
3. Near duplicates: of each group the document with the smallest id stays.
4. Mixing: documents are repeated so that the domains' expected shares meet the targets; none is dropped.
5. Packing: the documents' token ids, cut into full sequences along the curve.

Null texts pass stages 1 to 3 as texts without words (one of them stays), and are packed as their closing id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from siftwork.llm import bag_minhash, curve_packing, nnpu_toxicity, soft_mixing, template_lines
from siftwork.llm.catalog import table
from siftwork.llm.common import ship
from siftwork.sources.shared import stage


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return nnpu_toxicity.keep_clean(docs, nnpu_toxicity.fit(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    out = template_lines.drop_templates(docs)
    return out.withColumn("n_chars", F.char_length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return bag_minhash.one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return soft_mixing.mixed(docs, table(spark, sf_dir, "labels"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return curve_packing.pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("near duplicates", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]

# Trained models and signatures decide what stays, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
