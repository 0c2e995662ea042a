"""Incremental landing: keep valid rows, maintain class counts, an exact sample and profiles, batch by batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from siftwork.functions import presets
from siftwork.functions.columns import col
from siftwork.operators.sketches import merged_profile, sketched_profile
from siftwork.operators.split import sample_exact
from siftwork.sources.delimited import land, valid_class

BATCH = "__batch"
COUNTS = "grade string, n long"


def finish(query: StreamingQuery, seconds: int | None = None) -> None:
    """Wait for an available-now query, for ``seconds`` at most if given; a failed or late one is an error."""
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        query.stop()
        raise TimeoutError("the stream did not finish in time")
    if query.exception() is not None:
        raise query.exception()


def source(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", **options) -> DataFrame:
    """A folder as a stream of its files."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def class_totals(df: DataFrame, target: str, classes: Sequence[str]) -> DataFrame:
    """Rows per upper-cased valid class; rejected rows under a null class. Works on tables and streams."""
    grade = F.when(valid_class(target, classes), F.upper(col(target)))
    return df.groupBy(grade.alias("grade")).agg(F.count(F.lit(1)).alias("n"))


def land_batches(
    stream: DataFrame, out: str, target: str, classes: Sequence[str], key: str | None = None, sample: int = 0
) -> StreamingQuery:
    """Append the wanted columns of valid rows, a sample of them and the class counts to folders named by the batch.

    A batch is read once: its counts are observed while its rows are written.  The counts are written last and say that
    the batch is complete; one that is repeated after a failure replaces its own folders and nothing else.
    """
    names = [None, *dict.fromkeys(c.upper() for c in classes)]

    def save(batch: DataFrame, number: int) -> None:
        seen = Observation()
        grade = F.when(valid_class(target, classes), F.upper(col(target)))
        counts = [F.count(F.when(grade.eqNullSafe(F.lit(c)), 1)).alias(f"n{i}") for i, c in enumerate(names)]
        rows = f"{out}/rows/{BATCH}={number}"
        land(batch.observe(seen, *counts), target, classes).write.mode("overwrite").parquet(rows)
        spark = batch.sparkSession
        if sample:
            # The sample of a union lies within the union of the samples.
            part = sample_exact(spark.read.parquet(rows), key, sample)
            part.write.mode("overwrite").parquet(f"{out}/sample/{BATCH}={number}")
        found = seen.get
        totals = [(c, found[f"n{i}"]) for i, c in enumerate(names) if found.get(f"n{i}")]
        spark.createDataFrame(totals, COUNTS).coalesce(1).write.mode("overwrite").parquet(f"{out}/counts/{BATCH}={number}")

    return (
        stream.writeStream.foreachBatch(save)
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def _written(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """What the batches wrote to ``path``, with their numbers; nothing if none has been."""
    numbered = spark.createDataFrame([], schema).withColumn(BATCH, F.lit(0).cast("long"))
    try:
        return spark.read.schema(numbered.schema).option("basePath", path).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return numbered


def landed(spark: SparkSession, out: str, name: str, schema: StructType) -> DataFrame:
    """Rows (``rows`` or ``sample``) of complete batches."""
    complete = _written(spark, f"{out}/counts", COUNTS).select(BATCH).distinct()
    return _written(spark, f"{out}/{name}", schema).join(complete, BATCH, "left_semi").drop(BATCH)


def landed_counts(spark: SparkSession, out: str) -> DataFrame:
    """Rows per class over all complete batches; rejected rows under a null class."""
    return _written(spark, f"{out}/counts", COUNTS).groupBy("grade").agg(F.sum("n").alias("n"))


def landed_sample(spark: SparkSession, out: str, schema: StructType, key: str, sample: int) -> DataFrame:
    """The same rows as ``sample_exact`` draws from everything landed, from the samples of the batches alone."""
    return sample_exact(landed(spark, out, "sample", schema), key, sample)


def land_stream(
    stream: DataFrame,
    out: str,
    target: str = presets.TARGET,
    classes: Sequence[str] = presets.CLASSES,
    seconds: int | None = None,
    key: str | None = None,
    sample: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """Process what is there; returns the landed rows and the counters.

    Run again on the same ``out`` to pick up new files only.
    """
    spark = stream.sparkSession
    finish(land_batches(stream, out, target, classes, key, sample), seconds)
    return landed(spark, out, "rows", land(stream, target, classes).schema), landed_counts(spark, out)


def profile_stream(stream: DataFrame, out: str, columns: Sequence[str] | None = None, seconds: int | None = None) -> DataFrame:
    """Profile of all rows that have arrived so far; only sketches of earlier batches are read again."""

    def save(batch: DataFrame, number: int) -> None:
        sketched_profile(batch, columns).write.mode("overwrite").parquet(f"{out}/profiles/{BATCH}={number}")

    spark = stream.sparkSession
    query = (
        stream.writeStream.foreachBatch(save)
        .option("checkpointLocation", f"{out}/checkpoint-profiles")
        .trigger(availableNow=True)
        .start()
    )
    finish(query, seconds)
    empty = sketched_profile(spark.createDataFrame([], stream.schema), columns)
    return merged_profile(_written(spark, f"{out}/profiles", empty.schema))
