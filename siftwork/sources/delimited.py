"""Delimited files: a tolerant scan with a declared schema, and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from siftwork.functions import presets
from siftwork.functions.columns import col, nan_to_null, tokens_to_null

RAW = "__raw"

# Columns of the product file that hold text.
TEXT_COLUMNS = {
    "nutriscore_grade", "code", "product_name", "brands", "categories", "countries", "nutrition_grade_fr",
    "pnns_groups_1", "pnns_groups_2", "main_category",
}

# Cell texts read as missing.
NULL_TOKENS = [
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
]


def product_schema(columns: Sequence[str]) -> T.StructType:
    """Text for identifiers and labels, double for everything else."""
    return T.StructType(
        [T.StructField(c, T.StringType() if c in TEXT_COLUMNS else T.DoubleType()) for c in columns]
    )


def header_of(spark: SparkSession, path: str, sep: str = "\t") -> list[str]:
    """Column names from the first line of the first file."""
    return spark.read.option("sep", sep).option("header", True).csv(path).columns


def _too_long(raw: Column, sep: str, width: int) -> Column:
    """More fields than the header. Quoted cells are removed first, but only where the plain count is too high."""
    plain = F.length(raw) - F.length(F.replace(raw, F.lit(sep), F.lit("")))
    unquoted = F.regexp_replace(raw, r'"(?:[^"]|"")*"', "")
    outside = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(sep), F.lit("")))
    return F.when(plain < width, F.lit(False)).otherwise(outside >= width)


def scan_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sep: str = "\t",
    null_tokens: Sequence[str] = NULL_TOKENS,
    partitions: int | None = None,
    multi_line: bool = False,
    header: bool = True,
) -> DataFrame:
    """Rows with too many fields are dropped, rows with too few are padded with nulls.

    ``schema`` covers every column of the file, in order. Numbers are parsed
    after the scan, so a bad number is a missing cell and not a lost row. A
    gzip file is read by one task; ``partitions`` spreads its rows afterwards.
    """
    names = [f.name for f in schema]
    # One field more than the header: rows that fill it exactly are the only ones without a raw copy.
    text = T.StructType([T.StructField(c, T.StringType()) for c in [*names, "__extra", RAW]])
    reader = (
        spark.read.schema(text)
        .option("sep", sep)
        .option("header", header)
        .option("enforceSchema", True)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RAW)
        .option("multiLine", multi_line)
    )
    rows = reader.csv(path)
    rows = rows.where(F.col(RAW).isNotNull() & F.col("__extra").isNull() & ~_too_long(F.col(RAW), sep, len(names)))
    rows = rows.drop("__extra", RAW)
    if partitions is not None:
        rows = rows.repartition(partitions)
    rows = tokens_to_null(rows, null_tokens)
    typed = [
        col(f.name) if isinstance(f.dataType, T.StringType) else col(f.name).try_cast(f.dataType).alias(f.name)
        for f in schema
    ]
    return nan_to_null(rows.select(*typed))


def select_wanted(df: DataFrame, wanted: Sequence[str] = presets.RELEVANT_COLUMNS) -> DataFrame:
    """Wanted columns that the table has, in the wanted order."""
    return df.select(*[col(c) for c in wanted if c in df.columns])


def valid_class(target: str = presets.TARGET, classes: Sequence[str] = presets.CLASSES):
    """Case-insensitive class test; a missing class fails."""
    return F.coalesce(F.lower(col(target)).isin(*classes), F.lit(False))


def land(df: DataFrame, target: str = presets.TARGET, classes: Sequence[str] = presets.CLASSES) -> DataFrame:
    """Wanted columns of the rows with a valid class; the class keeps its spelling."""
    return select_wanted(df).where(valid_class(target, classes))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


def landed_before(spark: SparkSession, path: str) -> bool:
    """Whether a finished table is already there; a write that broke off leaves no success mark."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def land_once(df: DataFrame, path: str) -> None:
    """Write unless a finished output is already there; what a broken write left is replaced."""
    if not landed_before(df.sparkSession, path):
        df.write.mode("overwrite").parquet(path)
