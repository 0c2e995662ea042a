import math

import pytest
from pyspark.sql import functions as F

from siftwork.functions.columns import nan_to_null, tokens_to_null
from siftwork.operators.missing import MissingValueHandler, MissingValueModel
from siftwork.operators.outliers import OutlierFilter, outlier_profile, range_filter, rejection_counts
from siftwork.operators.profile import missing_profile, skewness_table


def test_both_missing_forms_pass_a_range(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (200.0,)], "fat_100g double")
    kept = range_filter(nan_to_null(df), {"fat_100g": (0, 100)}).collect()
    assert sorted(str(r[0]) for r in kept) == ["1.0", "None", "None"]


def test_drop_threshold_compares_the_rounded_share(spark):
    def column(missing):
        return F.when(F.col("id") >= missing, 1.0)

    df = spark.range(100000).select(
        F.lit("a").alias("y"), column(95004).alias("kept"), column(95010).alias("gone"), column(99999).alias("y2")
    )
    assert MissingValueHandler("y").fit(df).dropped_columns == ["gone", "y2"]
    assert "y2" not in MissingValueHandler("y2").fit(df).dropped_columns


def test_median_ignores_rows_without_target(spark):
    rows = [("a", 1.0), ("b", 3.0), (None, 1e9), ("a", None), ("a", 2.0)]
    df = spark.createDataFrame(rows, "y string, x double")
    out = MissingValueHandler("y").fit(df).transform(df)
    assert sorted(r["x"] for r in out.collect()) == [1.0, 2.0, 2.0, 3.0]


def test_imputation_rules(spark):
    rows = [("a", 1, None, None, 7), ("b", 2, 4.0, "k", None), ("a", None, None, "k", None)]
    df = spark.createDataFrame(rows, "y string, n int, additives_n double, t string, code bigint")
    model = MissingValueHandler("y").fit(df)
    out = {r["n"]: r for r in model.transform(df).collect()}
    assert set(out) == {1.0, 2.0, 1.5}
    assert out[1.0]["additives_n"] == 0 and out[1.0]["t"] == "unknown"
    assert out[2.0]["code"] is None
    stats = {r["column"]: r for r in model.imputation_stats(df).collect()}
    assert stats["additives_n"]["rationale"] == "Assume no additives"
    assert stats["n"]["method"] == "median" and stats["n"]["missing_count"] == 1
    assert set(stats) == {"n", "additives_n", "t"}


def test_fitted_parameters_do_not_follow_new_rows(spark, tmp_path):
    fit = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "y string, x double")
    model = MissingValueHandler("y").fit(fit)
    model.write().overwrite().save(str(tmp_path / "m"))
    new = spark.createDataFrame([("a", None), ("a", 100.0)], "y string, x double")
    assert sorted(r["x"] for r in MissingValueModel.load(str(tmp_path / "m")).transform(new).collect()) == [2.0, 100.0]


def test_unfitted_and_missing_target(spark):
    with pytest.raises(ValueError, match="no fitted state"):
        MissingValueModel().transform(spark.range(1))
    with pytest.raises(ValueError, match="target"):
        MissingValueHandler("y").fit(spark.range(1))


def test_profile(spark):
    df = spark.createDataFrame([(1, None), (1, "x"), (None, "y"), (2, "y")], "a int, b string")
    got = {r["column"]: r for r in missing_profile(df).collect()}
    assert got["a"].asDict() == {
        "column": "a", "missing_count": 1, "missing_percentage": 25.0, "dtype": "int", "unique_values": 2
    }
    empty = missing_profile(df.limit(0)).collect()
    assert [r["missing_percentage"] for r in empty] == [0.0, 0.0]


def test_row_is_charged_to_the_first_rule(spark):
    df = spark.createDataFrame([(-1.0, 999.0), (5.0, 999.0), (5.0, 5.0), (None, None)], "a double, b double")
    got = {r["reason"]: r["rejected"] for r in rejection_counts(df, {"a": (0, 10), "b": (0, 10)}).collect()}
    assert got == {"a": 1, "b": 1}


def test_only_the_upper_fence_removes(spark):
    rows = [(float(x),) for x in [50] * 5 + list(range(45, 56)) + [0, 100]] + [(None,)]
    df = spark.createDataFrame(rows, "v double")
    ranges = {"v": (0, 100)}
    left = [r["v"] for r in OutlierFilter(ranges, statistical=True).fit(df).transform(df).collect()]
    assert 0.0 in left and 100.0 not in left and None in left
    both = [r["v"] for r in OutlierFilter(ranges, True, both_sides=True).fit(df).transform(df).collect()]
    assert 0.0 not in both
    plain = OutlierFilter(ranges).fit(df).transform(df)
    assert plain.count() == df.count()


def test_outlier_report(spark):
    df = spark.createDataFrame([(x,) for x in [-5.0, 1.0, 2.0, 3.0, 4.0, 500.0, None]], "v double")
    row = outlier_profile(df, {"v": (0, 100), "absent": (0, 1)}).collect()
    assert len(row) == 1
    row = row[0]
    assert (row["negative_count"], row["below_min"], row["above_max"], row["statistical_outliers"]) == (1, 1, 1, 1)
    assert row["median"] == 2.5 and row["min"] == -5.0
    model = OutlierFilter({"v": (0, 100)}).fit(df)
    totals = model.removal_totals(df).collect()[0]
    assert totals["rows_removed"] == 2 and math.isclose(totals["removal_percentage"], 200 / 7)
    assert model.removal_totals(df.limit(0)).collect()[0]["removal_percentage"] is None


def test_null_tokens(spark):
    df = spark.createDataFrame([("NA",), ("nation",), (None,)], "a string")
    assert [r["a"] for r in tokens_to_null(df, ["NA"]).collect()] == [None, "nation", None]


def test_adjusted_skewness(spark):
    values = [1.0, 2.0, 2.0, 3.0, 10.0]
    df = spark.createDataFrame([(v, 4.0) for v in values], "a double, b double")
    n, mean = len(values), sum(values) / len(values)
    m2, m3 = (sum((v - mean) ** p for v in values) / n for p in (2, 3))
    got = {r["column"]: r["skewness"] for r in skewness_table(df).collect()}
    assert math.isclose(got["a"], m3 / m2**1.5 * math.sqrt(n * (n - 1)) / (n - 2))
    assert got["b"] == 0.0
