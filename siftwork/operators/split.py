"""Exact seeded samples, stratified splits, folds, and the check of a split."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from siftwork.functions.columns import col, require_columns
from siftwork.operators.ranking import cut_hashes, key_hash, label_by_quota, largest_remainder, stratum_sizes

SPLITS = ("train", "val", "test")
BALANCE_TOLERANCE = 0.05


def sample_exact(df: DataFrame, key: Sequence[str] | str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows without replacement, the same ones for the same seed; all rows when there are fewer.

    Copies of one key are interchangeable: when the cut falls among them, as many as fit are taken.
    """
    keys = [key] if isinstance(key, str) else list(key)
    total = df.count()
    if total <= n:
        return df
    if n <= 0:
        return df.limit(0)
    edge, copies = cut_hashes(df, keys, {None: [n]}, {None: total}, None, seed)[None][n]
    below = df.where(key_hash(keys, seed) < F.lit(edge))
    if not copies:
        return below
    return below.unionByName(df.where(key_hash(keys, seed) == F.lit(edge)).limit(copies))


def check_ratios(train: float, val: float, test: float) -> None:
    if not math.isclose(train + val + test, 1.0, rel_tol=0.0, abs_tol=1e-6):
        raise ValueError(f"the three shares add up to {train + val + test}, not to 1")


def split_quotas(sizes: dict, train: float, val: float, test: float) -> dict:
    """Rows per stratum and split. The held-out share is rounded up, then halved the same way."""
    n = sum(sizes.values())
    n_rest = math.ceil((val + test) * n)
    in_train = largest_remainder(sizes, n - n_rest) if n else {}
    rest = {k: sizes[k] - in_train[k] for k in sizes}
    n_test = math.ceil((1 - val / (val + test)) * n_rest) if val + test else 0
    in_val = largest_remainder(rest, n_rest - n_test) if n_rest else dict.fromkeys(rest, 0)
    return {k: [in_train[k], in_val[k], rest[k] - in_val[k]] for k in sizes}


def assign_split(
    df: DataFrame,
    target: str,
    key: Sequence[str] | str,
    train: float = 0.7,
    val: float = 0.15,
    test: float = 0.15,
    seed: int = 42,
    stratify: bool = True,
    out: str = "split_group",
) -> DataFrame:
    """Add a train/val/test column, stratified by the target unless told otherwise."""
    check_ratios(train, val, test)
    require_columns(df, [target], "target column")
    keys = [key] if isinstance(key, str) else list(key)
    stratum = target if stratify else None
    sizes = stratum_sizes(df, stratum)
    quotas = split_quotas(sizes, train, val, test)
    return label_by_quota(df, keys, quotas, sizes, SPLITS, stratum, seed, out)


def mark_split(df: DataFrame, key: str, train_keys: DataFrame, val_keys: DataFrame, out: str = "split_group"):
    """Mark rows by membership in two key tables; rows in neither are test."""
    groups = train_keys.select(col(key).alias("__k"), F.lit("train").alias("__g")).union(
        val_keys.select(col(key).alias("__k"), F.lit("val").alias("__g"))
    )
    # A later list wins when a key is in both, as when the marks are written one after the other.
    groups = groups.groupBy("__k").agg(F.max("__g").alias("__g"))
    return (
        df.join(groups, col(key) == F.col("__k"), "left")
        .withColumn(out, F.coalesce("__g", F.lit("test")))
        .drop("__k", "__g")
    )


def fold_quotas(sizes: dict, folds: int) -> dict:
    """Rows per class and fold: classes laid end to end and dealt round-robin, so folds differ by one at most."""
    quotas, offset = {}, 0
    for k in sorted(sizes, key=lambda x: (x is not None, x)):
        n = sizes[k]
        quotas[k] = [max(0, (n - (f - offset) % folds + folds - 1) // folds) for f in range(folds)]
        offset += n
    return quotas


def assign_folds(
    df: DataFrame, target: str, key: Sequence[str] | str, folds: int = 5, seed: int = 42, out: str = "fold"
) -> DataFrame:
    """Add a stratified, shuffled fold number 0 .. folds-1."""
    if folds < 2:
        raise ValueError("at least two folds are needed")
    keys = [key] if isinstance(key, str) else list(key)
    sizes = stratum_sizes(df, target)
    return label_by_quota(
        df, keys, fold_quotas(sizes, folds), sizes, list(range(folds)), target, seed, out, label_type="int"
    )


def split_distribution(df: DataFrame, target: str, split: str = "split_group") -> DataFrame:
    """Rows and share per (split, class); a class absent from a split counts 0."""
    totals = df.agg(*[F.count_if(col(split) == s).alias(s) for s in SPLITS]).collect()[0]
    counted = df.groupBy(col(target).alias("class")).agg(
        *[F.count_if(col(split) == s).alias(f"n_{s}") for s in SPLITS]
    )
    return counted.select(
        "*", *[(F.col(f"n_{s}") / F.lit(max(totals[s], 1))).alias(f"share_{s}") for s in SPLITS]
    )


def verify_stratification(df: DataFrame, target: str, split: str = "split_group") -> DataFrame:
    """One row: largest deviation of a val/test class share from the train share, and the verdict."""
    shares = split_distribution(df, target, split)
    deviation = F.greatest(
        F.abs(F.col("share_val") - F.col("share_train")), F.abs(F.col("share_test") - F.col("share_train"))
    )
    return shares.agg(F.coalesce(F.max(deviation), F.lit(0.0)).alias("max_deviation")).select(
        "max_deviation", (F.col("max_deviation") < BALANCE_TOLERANCE).alias("is_balanced")
    )


def split_metadata(df: DataFrame, target: str, config: dict, split: str = "split_group") -> DataFrame:
    """The split report as one nested row: configuration, counts, shares, verdict."""
    shares = split_distribution(df, target, split)
    entries = F.collect_list(
        F.struct(
            F.col("class"),
            *[F.col(f"n_{s}") for s in SPLITS],
            *[F.col(f"share_{s}") for s in SPLITS],
        )
    )
    deviation = F.max(
        F.greatest(F.abs(F.col("share_val") - F.col("share_train")), F.abs(F.col("share_test") - F.col("share_train")))
    )
    packed = shares.agg(F.array_sort(entries).alias("e"), deviation.alias("d"))

    def as_map(field: str, present: str):
        kept = F.filter(F.col("e"), lambda x: x[present] > 0)
        return F.map_from_entries(F.transform(kept, lambda x: F.struct(x["class"].cast("string"), x[field])))

    return packed.select(
        F.struct(
            F.lit(float(config.get("train_ratio", 0.7))).alias("train_ratio"),
            F.lit(float(config.get("val_ratio", 0.15))).alias("val_ratio"),
            F.lit(float(config.get("test_ratio", 0.15))).alias("test_ratio"),
            F.lit(int(config.get("random_state", 42))).alias("random_state"),
            F.lit(bool(config.get("stratify", True))).alias("stratify"),
        ).alias("configuration"),
        F.struct(
            *[as_map(f"n_{s}", f"n_{s}").alias(f"{s}_size") for s in SPLITS],
            *[as_map(f"share_{s}", f"n_{s}").alias(f"{s}_distribution") for s in SPLITS],
            F.col("d").alias("max_deviation"),
            (F.col("d") < BALANCE_TOLERANCE).alias("is_balanced"),
        ).alias("statistics"),
    )
