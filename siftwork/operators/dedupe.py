"""Duplicate elimination with a fixed choice of the surviving row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from siftwork.functions.columns import col


def drop_duplicates(df: DataFrame, keys: Sequence[str], keep_first_by: str) -> DataFrame:
    """One row per key: the one with the smallest ``keep_first_by``; a missing one comes last, ties go by a row hash.

    Keys are grouped by a 128-bit digest, so long texts are neither sorted nor compared.  Copies are reduced inside
    each task before the shuffle, so a key held by a large part of the table arrives as one row per task.
    """
    digest = F.md5(F.to_json(F.struct(*[col(k) for k in keys])).cast("binary"))
    rows = F.struct(*[col(c) for c in df.columns])
    order = F.struct(col(keep_first_by).isNull(), col(keep_first_by), F.xxhash64(*[col(c) for c in df.columns]))
    return df.groupBy(digest.alias("__digest")).agg(F.min_by(rows, order).alias("kept")).select("kept.*")
