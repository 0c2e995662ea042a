"""Split tables: one parquet folder partitioned by split, read back pruned."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from siftwork.functions.columns import col
from siftwork.operators.split import SPLITS

SPLIT = "split_group"


def save_splits(df: DataFrame, path: str, split: str = SPLIT) -> dict[str, str]:
    """Write all splits at once and return the folder of each."""
    df.write.mode("overwrite").partitionBy(split).parquet(path)
    return {s: f"{path}/{split}={s}" for s in SPLITS}


def load_split(spark: SparkSession, path: str, name: str, split: str = SPLIT) -> DataFrame:
    """One split; the filter is on the partition column, so the other folders are not opened."""
    return spark.read.parquet(path).where(col(split) == F.lit(name)).drop(split)


def features_and_target(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """The table without its target, and the target alone. Rows are matched by key, never by position."""
    return df.drop(target), df.select(col(target))
