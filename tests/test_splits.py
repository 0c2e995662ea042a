import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siftwork.operators import ranking
from siftwork.operators.ranking import largest_remainder
from siftwork.operators.split import (
    assign_folds,
    assign_split,
    fold_quotas,
    mark_split,
    sample_exact,
    split_metadata,
    verify_stratification,
)


@pytest.fixture(scope="module")
def rows(spark):
    """One class holds a third of the rows, one is tiny, some labels are missing."""
    label = (
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 1000 == 1, "rare")
        .when(F.col("id") % 11 == 1, None)
        .otherwise(F.concat(F.lit("c"), (F.col("id") % 4).cast("string")))
    )
    return spark.range(9000).select(F.col("id").alias("code"), label.alias("y")).cache()


def split_counts(df, column):
    return Counter((r["y"], r[column]) for r in df.select("y", column).collect())


def test_split_is_a_partition_with_exact_quotas(rows):
    out = assign_split(rows, "y", "code")
    assert out.count() == 9000
    per_split = Counter(r["split_group"] for r in out.collect())
    assert per_split == {"train": 6300, "val": 1350, "test": 1350}
    sizes = Counter(r["y"] for r in rows.collect())
    for (label, split), n in split_counts(out, "split_group").items():
        share = {"train": 0.7, "val": 0.15, "test": 0.15}[split]
        assert abs(n - share * sizes[label]) <= 1.5


def test_deep_refinement_gives_the_same_rows(rows, monkeypatch):
    plain = {r["code"]: r["split_group"] for r in assign_split(rows, "y", "code").collect()}
    monkeypatch.setattr(ranking, "BUCKET_ROWS", 3)
    deep = {r["code"]: r["split_group"] for r in assign_split(rows, "y", "code").collect()}
    assert plain == deep


def test_cuts_follow_the_md5_order(rows):
    import hashlib

    out = assign_split(rows, "y", "code", stratify=False).collect()
    ordered = sorted(out, key=lambda r: hashlib.md5(f"42:{r['code']}".encode()).hexdigest())
    assert [r["split_group"] for r in ordered] == ["train"] * 6300 + ["val"] * 1350 + ["test"] * 1350


def test_seed_changes_rows_not_sizes(rows):
    a = assign_split(rows, "y", "code", seed=1)
    b = assign_split(rows, "y", "code", seed=2)
    assert split_counts(a, "split_group") == split_counts(b, "split_group")
    assert a.join(b.withColumnRenamed("split_group", "other"), "code").where("split_group <> other").count() > 0


def test_all_in_one_split(rows):
    out = assign_split(rows, "y", "code", 1.0, 0.0, 0.0)
    assert {r["split_group"] for r in out.collect()} == {"train"}


def test_bad_ratios_and_target(rows):
    with pytest.raises(ValueError, match="add up to"):
        assign_split(rows, "y", "code", 0.5, 0.2, 0.2)
    with pytest.raises(ValueError, match="target"):
        assign_split(rows, "z", "code")


def test_folds_differ_by_at_most_one(rows):
    out = assign_folds(rows, "y", "code", 7)
    sizes = Counter(r["fold"] for r in out.collect())
    assert set(sizes) == set(range(7)) and max(sizes.values()) - min(sizes.values()) <= 1
    per_class = {}
    for (label, fold), n in split_counts(out, "fold").items():
        per_class.setdefault(label, {})[fold] = n
    for counts in per_class.values():
        filled = [counts.get(f, 0) for f in range(7)]
        assert max(filled) - min(filled) <= 1


def test_fold_quotas_deal_round_robin():
    sizes = {"a": 7, "b": 4, "c": 1}
    dealt = {k: [0] * 5 for k in sizes}
    for i, k in enumerate("a" * 7 + "b" * 4 + "c"):
        dealt[k][i % 5] += 1
    assert fold_quotas(sizes, 5) == dealt


def test_largest_remainder_adds_up():
    assert largest_remainder({"a": 5, "b": 3, "c": 2}, 7) == {"a": 4, "b": 2, "c": 1}
    assert sum(largest_remainder({"x": 1, "y": 1, "z": 1}, 2).values()) == 2


def test_sample(rows):
    assert sample_exact(rows, "code", 1234).count() == 1234
    assert sample_exact(rows, "code", 99999).count() == 9000
    first = {r["code"] for r in sample_exact(rows, "code", 100).collect()}
    assert first == {r["code"] for r in sample_exact(rows, "code", 100).collect()}


def test_mark_split_defaults_to_test(spark, rows):
    train, val = rows.where("code < 10").select("code"), rows.where("code between 10 and 14").select("code")
    got = Counter(r["split_group"] for r in mark_split(rows, "code", train, val).collect())
    assert got == {"train": 10, "val": 5, "test": 8985}


def test_verdict(spark, rows):
    good = verify_stratification(assign_split(rows, "y", "code"), "y").collect()[0]
    assert good["is_balanced"] and good["max_deviation"] < 0.01
    bad = spark.createDataFrame([("a", "train"), ("b", "train"), ("a", "val"), ("c", "test")], "y string, split_group string")
    row = verify_stratification(bad, "y").collect()[0]
    assert not row["is_balanced"] and math.isclose(row["max_deviation"], 1.0)
    statistics = split_metadata(bad, "y", {}).collect()[0]["statistics"]
    assert statistics["val_size"] == {"a": 1} and statistics["test_distribution"] == {"c": 1.0}


def test_labelling_moves_no_rows(rows):
    plan = assign_split(rows, "y", "code")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Window" not in plan


def test_one_key_on_a_third_of_the_rows(spark, monkeypatch):
    """Copies of a key cannot be told apart: samples stay exact, splits keep them together."""
    df = spark.range(900).select(F.when(F.col("id") < 300, -1).otherwise(F.col("id")).alias("code"), F.lit("a").alias("y"))
    for bucket_rows in (50_000, 10):
        monkeypatch.setattr(ranking, "BUCKET_ROWS", bucket_rows)
        for n in (1, 250, 450, 899):
            assert sample_exact(df, "code", n).count() == n
        out = assign_split(df, "y", "code")
        assert out.where("code = -1").select("split_group").distinct().count() == 1
