"""Small JSON documents: reports written as one row, run records read back by glob."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from siftwork.functions.columns import col


def write_document(row: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a one-row report as JSON. Reports are per-column or per-class, so one file is right."""
    row.coalesce(1).write.mode(mode).json(path)


def read_documents(
    spark: SparkSession, base: str, schema: str, pattern: str = r"_metadata(\.json)?(/|$)", multi_line: bool = False
) -> DataFrame:
    """Every JSON document below ``base`` whose path matches; fields a document lacks are null."""
    reader = spark.read.schema(schema).option("recursiveFileLookup", True).option("multiLine", multi_line)
    return reader.json(base).where(F.col("_metadata.file_path").rlike(pattern))


def landing_document(
    raw: DataFrame,
    kept: Column,
    target: str,
    existing: Sequence[str],
    missing: Sequence[str],
    constants: Mapping[str, str] | None = None,
    sampled: DataFrame | None = None,
) -> DataFrame:
    """Totals, kept rows, columns and class counts of a landing as one nested row, from one scan.

    When a sample was written the class counts are those of the sample.
    """
    grade = F.when(kept, F.upper(col(target)))
    counted = raw.groupBy(grade.alias("grade")).agg(F.count(F.lit(1)).alias("n"), F.lit(0).alias("drawn"))
    shown = F.col("n")
    if sampled is not None:
        drawn = sampled.groupBy(F.upper(col(target)).alias("grade")).agg(F.count(F.lit(1)).alias("drawn"))
        counted = counted.drop("drawn").join(drawn, "grade", "left")
        shown = F.coalesce("drawn", F.lit(0))
    # One row per class from here on.
    classes = F.filter(F.collect_list(F.struct("grade", shown.alias("n"))), lambda e: e["grade"].isNotNull())
    row = counted.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_products"),
        F.coalesce(F.sum(F.when(F.col("grade").isNotNull(), F.col("n"))), F.lit(0)).alias("filtered_products"),
        F.lit(len(existing)).cast("bigint").alias("columns"),
        F.array(*[F.lit(c) for c in missing]).cast("array<string>").alias("missing_columns"),
        F.map_from_entries(F.array_sort(classes)).alias("grade_distribution"),
    )
    return row.withColumns({k: F.lit(v) for k, v in (constants or {}).items()})
