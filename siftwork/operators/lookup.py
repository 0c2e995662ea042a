"""Labels named through a lookup table: joined by broadcast, its size checked; every distinct cell is cleaned once."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from siftwork.functions.columns import col
from siftwork.functions.labels import MAX_LOOKUP_ENTRIES, strict_text

LABEL, NAME, CELL = "__label", "__name", "__cell"


def lookup_table(spark: SparkSession, entries: Mapping[str, str]) -> DataFrame:
    """The entries as a table small enough to be sent to every task."""
    if len(entries) > MAX_LOOKUP_ENTRIES:
        raise ValueError(f"lookup of {len(entries)} entries exceeds {MAX_LOOKUP_ENTRIES}")
    return F.broadcast(spark.createDataFrame(sorted(entries.items()), f"{LABEL} string, {NAME} string"))


def with_name(df: DataFrame, label: Column, column: str, entries: Mapping[str, str]) -> DataFrame:
    """``df`` with ``column``, the strict name of a label; null for an unknown, empty or missing one."""
    table = lookup_table(df.sparkSession, entries)
    named = df.withColumn(CELL, strict_text(label)).join(table, F.col(CELL) == F.col(LABEL), "left")
    return named.withColumn(column, F.col(NAME)).drop(*{CELL, LABEL, NAME} - {column})


def clean_column(df: DataFrame, column: str, entries: Mapping[str, str]) -> DataFrame:
    """``df`` with a column of lists cleaned: sorted distinct names joined by commas, ``unknown`` where there is none.

    Only distinct cells are split and looked up.  Rows without a list match nothing; they are dealt over all tasks.
    """
    cell = col(column)
    known = cell.isNotNull() & (cell != "unknown")
    labels = F.explode(F.array_distinct(F.transform(F.split(CELL, ","), strict_text)))
    cells = df.where(known).select(cell.alias(CELL)).distinct().select(CELL, labels.alias(LABEL))
    names = cells.join(lookup_table(df.sparkSession, entries), LABEL).groupBy(CELL)
    names = names.agg(F.array_join(F.array_sort(F.collect_set(NAME)), ",").alias(NAME))
    # No cell can hold this text, which begins with the separator of a list and a null character.
    none = F.concat(F.lit(",\0"), F.monotonically_increasing_id().cast("string"))
    named = df.withColumn("__key", F.when(known, cell).otherwise(none)).join(names, F.col("__key") == F.col(CELL), "left")
    return named.withColumn(column, F.coalesce(NAME, F.lit("unknown"))).drop("__key", CELL, NAME)
