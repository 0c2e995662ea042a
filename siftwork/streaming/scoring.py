"""Scoring a stream with a fitted flow, batch by batch.

Each batch is an ordinary table, so models that join or stage (neighbours by cells, large encoders) score streams too.  A
batch writes a folder named by its number; one that is repeated after a failure replaces its own folder and nothing else.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import Transformer
from pyspark.sql import DataFrame

from siftwork.streaming.landing import finish

BATCH = "__batch"


def score_stream(stream: DataFrame, model: Transformer, out: str, seconds: int | None = None) -> DataFrame:
    """Transform the available rows into ``out``; returns what was written so far."""

    def write(batch: DataFrame, number: int) -> None:
        model.transform(batch).write.mode("overwrite").parquet(f"{out}/rows/{BATCH}={number}")

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    finish(query, seconds)
    spark = stream.sparkSession
    empty = model.transform(spark.createDataFrame([], stream.schema))
    try:
        written = spark.read.schema(empty.schema).option("basePath", f"{out}/rows").parquet(f"{out}/rows")
    except AnalysisException as missing:
        # Nothing has arrived yet.
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty
    return written.select(*empty.columns)
