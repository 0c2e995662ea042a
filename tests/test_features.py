import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftwork.functions.labels import clean_list, iso_entries, parse_labels, strict_entries, strict_label
from siftwork.operators.lookup import clean_column, with_name
from siftwork.operators import encode
from siftwork.operators.derive import FeatureDeriver
from siftwork.operators.encode import FeatureEncoder, FeatureEncoderModel, LabelCoder, out_of_fold_target
from siftwork.operators.reduce import FeatureReducer, component_info, plane, variance_table
from siftwork.operators.scale import FeatureScaler, FeatureScalerModel


def labels_of(spark, cell):
    return spark.createDataFrame([(cell,)], "c string").select(parse_labels(F.col("c")).alias("l")).collect()[0]["l"]


def test_parse_keeps_duplicates_and_unmapped(spark):
    assert labels_of(spark, "France, fr,Unknown,,  Atlantis") == ["France", "France", "Atlantis"]
    assert labels_of(spark, None) == [] and labels_of(spark, "unknown") == []
    assert labels_of(spark, "\tUSA ,pays-bas") == ["United States", "Netherlands"]


@pytest.fixture(scope="module")
def entries(spark):
    iso = spark.createDataFrame(
        [("FR", "FRA", "France"), ("US", "USA", "United States"), ("KR", "KOR", "Republic of Korea"), ("PE", "PER", "Peru")],
        "a2 string, a3 string, name string",
    )
    return strict_entries(iso_entries(iso, ["a2", "a3"]))


@pytest.mark.parametrize(
    "cell,expected",
    [
        ("en:france,usa,Atlantis", "France,United States"),
        ("pays-bas", "unknown"),
        ("", "unknown"),
        (None, "unknown"),
        ("unknown", "unknown"),
        ("PER, kor,fr", "France,Peru,South Korea"),
        ("en: france", "unknown"),
    ],
)
def test_strict_cleaning(spark, entries, cell, expected):
    df = spark.createDataFrame([(cell,)], "c string")
    assert df.select(clean_list(F.col("c"), entries)).collect()[0][0] == expected


def test_cleaning_by_join_equals_cleaning_by_cell(spark, entries):
    cells = [None, "unknown", "", "PER, kor,fr", "en:france,Atlantis", "fr,fr,FR", ",", "Atlantis", "en:", "-"] * 3
    df = spark.createDataFrame([(n, c) for n, c in enumerate(cells)], "n int, cell string")
    by_join = clean_column(df, "cell", entries)
    assert by_join.columns == df.columns
    assert "map(" not in by_join._jdf.queryExecution().optimizedPlan().toString()
    by_cell = df.select("n", clean_list(F.col("cell"), entries).alias("cell"))
    assert sorted(map(tuple, by_join.collect())) == sorted(map(tuple, by_cell.collect()))
    named = with_name(df, F.col("cell"), "name", entries).select("n", "name")
    assert sorted(map(tuple, named.collect()), key=str) == sorted(map(tuple, df.select("n", strict_label(F.col("cell"), entries)).collect()), key=str)
    assert clean_column(df.limit(0), "cell", {}).count() == 0
    assert {r["cell"] for r in clean_column(df, "cell", {}).collect()} == {"unknown"}


def test_strict_label_of_nothing_is_null(spark, entries):
    df = spark.createDataFrame([("en:",), (" ",)], "c string")
    assert [r[0] for r in df.select(strict_label(F.col("c"), entries)).collect()] == [None, None]


def test_multilabel_ties_and_order(spark):
    df = spark.createDataFrame([("b,b,a",), ("c,a",), ("b",), (None,)], "countries string")
    model = FeatureEncoder({"countries": "multilabel"}, "y", top_n=2).fit(df)
    out = model.transform(df)
    assert out.columns == ["countries_a", "countries_b"]
    assert [tuple(r) for r in out.collect()] == [(1, 1), (1, 0), (0, 1), (0, 0)]


def test_onehot_unseen_level_and_limit(spark):
    df = spark.createDataFrame([("x y",), ("a.b",)], "pnns_groups_1 string")
    model = FeatureEncoder({"pnns_groups_1": "onehot"}, "y").fit(df)
    out = model.transform(spark.createDataFrame([("new",), ("a.b",), (None,)], "pnns_groups_1 string"))
    assert out.columns == ["pnns_groups_1_a.b", "pnns_groups_1_x y"]
    assert [tuple(r) for r in out.collect()] == [(0.0, 0.0), (1.0, 0.0), (0.0, 0.0)]
    with pytest.raises(ValueError, match="levels"):
        FeatureEncoder({"pnns_groups_1": "onehot"}, "y", max_levels=1).fit(df)


def smooth(y, group):
    v, n = np.var(y), len(group)
    weight = v * n / (v * n + np.var(group))
    return weight * np.mean(group) + (1 - weight) * np.mean(y)


@pytest.mark.parametrize("inline", [True, False])
def test_target_encoding(spark, monkeypatch, tmp_path, inline):
    if not inline:
        monkeypatch.setattr(encode, "MAX_INLINE_LEVELS", 1)
    rows = [("p", "a"), ("p", "b"), ("p", "a"), ("q", "c"), ("q", "a"), ("r", "c")]
    df = spark.createDataFrame(rows, "pnns_groups_2 string, y string")
    model = FeatureEncoder({"pnns_groups_2": "target"}, "y").fit(df)
    model.write().overwrite().save(str(tmp_path / "e"))
    model = FeatureEncoderModel.load(str(tmp_path / "e"))
    assert bool(model.tables()) is not inline
    hits = {k: [float(y == "a") for g, y in rows if g == k] for k in "pqr"}
    everything = sum(hits.values(), [])
    new = spark.createDataFrame([("p",), ("q",), ("r",), ("unseen",), (None,)], "pnns_groups_2 string")
    got = [r[0] for r in model.transform(new.coalesce(1).select("pnns_groups_2")).collect()]
    expected = [smooth(everything, hits[k]) for k in "pqr"] + [0.5, 0.5]
    np.testing.assert_allclose(sorted(got), sorted(expected))


def test_target_encoding_of_numbers_and_of_two_classes(spark):
    rows = [("p", 1.5, "n"), ("p", 2.0, "y"), ("q", 7.0, "y"), ("q", 9.5, "y"), ("q", 8.0, "n")]
    df = spark.createDataFrame(rows, "g string, v double, y string")
    numbers = FeatureEncoder({"g": "target"}, "v").fit(df).transform(df)
    expected = {k: smooth([v for _, v, _ in rows], [v for g, v, _ in rows if g == k]) for k in "pq"}
    for r, (g, _, _) in zip(numbers.collect(), rows):
        assert math.isclose(r["g"], expected[g])
    hits = {k: [float(y == "y") for g, _, y in rows if g == k] for k in "pq"}
    second = FeatureEncoder({"g": "target"}, "y").fit(df).transform(df)
    for r, (g, _, _) in zip(second.collect(), rows):
        assert math.isclose(r["g"], smooth(hits["p"] + hits["q"], hits[g]))


def test_target_encoding_needs_a_target(spark):
    df = spark.createDataFrame([("p",)], "pnns_groups_2 string")
    with pytest.raises(ValueError, match="needs the column"):
        FeatureEncoder({"pnns_groups_2": "target"}, "y").fit(df)


def test_out_of_fold_never_sees_its_own_fold(spark):
    rows = [("p", 0, 1.0), ("p", 1, 0.0), ("p", 1, 1.0), ("q", 0, 0.0), ("q", 1, 1.0), ("only", 0, 1.0)]
    df = spark.createDataFrame(rows, "g string, fold int, y double")
    got = {(r["g"], r["fold"]): r["e"] for r in out_of_fold_target(df, "g", F.col("y"), "fold", "e").collect()}
    rest = [y for _, f, y in rows if f != 0]
    assert math.isclose(got["p", 0], smooth(rest, [0.0, 1.0]))
    assert math.isclose(got["only", 0], np.mean(rest))


def test_label_codes(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "y string")
    model = LabelCoder("y").fit(df)
    out = model.transform(df.union(spark.createDataFrame([("zz",)], "y string")))
    assert [r["label"] for r in out.collect()] == [1.0, 0.0, 2.0, None]
    assert [r[0] for r in model.transform(df).select(model.decode(F.col("label"))).collect()] == ["b", "a", "c"]


def test_derived_features(spark):
    rows = [(3.0, 0.0, 20.0), (3.0, None, 20.1), (0.0, 2.0, None), (1.0, 4.0, 21.0)]
    df = spark.createDataFrame(rows, "fat_100g double, proteins_100g double, salt_100g double")
    out = FeatureDeriver(contributions=False).transform(df)
    assert [r["fat_to_protein_ratio"] for r in out.collect()] == [0.0, 0.0, 0.0, 0.25]
    assert [r["high_salt"] for r in out.collect()] == [1, 1, 0, 1]
    assert [r["high_fat"] for r in out.collect()] == [0, 0, 0, 0]
    assert "calories_from_fat" not in out.columns and "energy_density" not in out.columns


def test_constant_and_zero_iqr_columns(spark):
    df = spark.createDataFrame([(2.0, 0.0)] * 7 + [(2.0, 5.0)], "same double, spread double")
    for method in ("standard", "minmax", "robust"):
        out = FeatureScaler(method, exclude=[]).fit(df).transform(df).collect()
        assert {r["same"] for r in out} == {0.0}
    assert out[-1]["spread"] == 5.0
    assert FeatureScaler("auto", exclude=[]).fit(df).kinds() == {"standard": 1, "minmax": 1}


def test_scaler_properties(spark, tmp_path):
    df = spark.range(1000).select((F.rand(1) * 7).alias("a"), F.exp(F.randn(2)).alias("energy_100g"), F.lit("x").alias("t"))
    df = df.cache()
    model = FeatureScaler("standard", exclude=[]).fit(df)
    out = model.transform(df).agg(*[f(c) for c in ("a", "energy_100g") for f in (F.avg, F.stddev_pop)]).collect()[0]
    np.testing.assert_allclose(list(out), [0, 1, 0, 1], atol=1e-9)
    logged = {r["column"]: r["logged"] for r in model.parameters(spark).collect()}
    assert logged == {"a": False, "energy_100g": True}
    assert not any(r["logged"] for r in FeatureScaler("auto", exclude=[]).fit(df).parameters(spark).collect())
    model.write().overwrite().save(str(tmp_path / "s"))
    again = FeatureScalerModel.load(str(tmp_path / "s")).transform(df)
    assert again.exceptAll(model.transform(df)).count() == 0
    with pytest.raises(ValueError, match="to scale"):
        FeatureScaler(exclude=["a", "energy_100g"]).fit(df)
    with pytest.raises(ValueError, match="unknown scaling"):
        FeatureScaler("cube")


@pytest.fixture(scope="module")
def cloud(spark):
    base = spark.range(500).select(
        F.col("id").alias("code"), F.randn(1).alias("x"), F.randn(2).alias("y"), F.randn(3).alias("z")
    )
    return base.selectExpr("code", "3 * x + 5 AS `a-1`", "x + y AS `b.2`", "0.1 * z AS c", "3 * x + 5 AS d").cache()


def test_pca_matches_eigenvectors(spark, cloud):
    model = FeatureReducer(0.9, metadata=["code"]).fit(cloud)
    matrix = np.array([list(r)[1:] for r in cloud.collect()])
    values, vectors = np.linalg.eigh(np.cov(matrix.T))
    order = np.argsort(values)[::-1]
    ratios = values[order] / values.sum()
    k = int(np.argmax(np.cumsum(ratios) >= 0.9)) + 1
    info = component_info(model)
    np.testing.assert_allclose(info["all_ratios"], ratios, atol=1e-9)
    assert len(info["ratios"]) == k
    loadings = np.array(info["loadings"])
    np.testing.assert_allclose(loadings.T @ loadings, np.eye(k), atol=1e-9)
    top = loadings[np.abs(loadings).argmax(axis=0), np.arange(k)]
    assert (top > 0).all()
    out = model.transform(cloud)
    assert out.columns == [f"PC{i + 1}" for i in range(k)] + ["code"]
    got = np.array([list(r)[:k] for r in out.orderBy("code").collect()])
    np.testing.assert_allclose(got, (matrix - matrix.mean(axis=0)) @ loadings, atol=1e-8)
    scree = variance_table(spark, model).orderBy("component").collect()
    np.testing.assert_allclose([r["cumulative"] for r in scree], np.cumsum(ratios)[:k])


def test_pca_full_threshold_and_cap(spark, cloud):
    assert len(component_info(FeatureReducer(1.1, metadata=["code"]).fit(cloud))["ratios"]) == 4
    assert len(component_info(FeatureReducer(n_components=99, metadata=["code"]).fit(cloud))["ratios"]) == 4
    with pytest.raises(ValueError, match="to reduce"):
        FeatureReducer(metadata=cloud.columns).fit(cloud)
    model = FeatureReducer(n_components=2, metadata=["code"]).fit(cloud)
    with pytest.raises(ValueError, match="missing feature column"):
        model.transform(cloud.drop("c"))
    flat = plane(model.transform(cloud).withColumn("g", F.lit("b")), "g", ["a", "b"])
    assert {r["class_code"] for r in flat.collect()} == {1}


def test_out_of_fold_encoding_reaches_every_row(spark):
    from siftwork.operators.encode import out_of_fold_target

    rows = [(1, "a", 0, 1.0), (2, "a", 1, 0.0), (3, None, 0, 1.0), (4, None, 1, 1.0), (5, "a", 0, None), (6, "b", 1, None)]
    df = spark.createDataFrame(rows, "k int, c string, fold int, y double")
    got = {r.k: r.e for r in out_of_fold_target(df, "c", F.col("y"), "fold", "e").collect()}
    assert all(v is not None for v in got.values()) and len(got) == 6
    assert got[5] == got[1] and got[6] == 1.0


def test_duplicates_without_an_order_key_keep_their_columns(spark):
    from siftwork.operators.dedupe import drop_duplicates

    df = spark.createDataFrame([("x", None, 1), ("x", None, 1), ("y", 2, 5), ("y", None, 6), ("y", 1, 7)], "t string, o int, v int")
    assert sorted(map(tuple, drop_duplicates(df, ["t"], "o").collect())) == [("x", None, 1), ("y", 1, 7)]


def test_gamma_of_far_values(spark):
    from pyspark.ml.linalg import Vectors

    from siftwork.operators.fourier import gamma_scale

    df = spark.createDataFrame([(Vectors.dense([1e9 + a, 1e9 + b]),) for a, b in ((0, 1), (1, 0), (0, 0), (1, 1))], ["v"])
    assert abs(gamma_scale(df, "v", 2) - 2.0) < 1e-6


def test_grid_points_that_mean_the_same(spark):
    from siftwork.operators.train import effective

    assert effective("knn", {"metric": "minkowski", "n_neighbors": 5}) == effective("knn", {"metric": "euclidean", "n_neighbors": 5})
    assert effective("knn", {"metric": "manhattan"}) != effective("knn", {"metric": "euclidean"})
    assert effective("random_forest", {"max_depth": None, "min_samples_split": 5}) == effective("random_forest", {"max_depth": 30})
