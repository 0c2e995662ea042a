import numpy as np
import pytest
from pyspark.sql import functions as F

from siftwork.operators.neighbours import KNNClassifier, KNNModel

KINDS = {"broadcast": {}, "cells": {"broadcast_bytes": 0, "block_rows": 40}}


@pytest.fixture(scope="module")
def points(spark):
    """A third of the points are the same point, the rest form a cloud on a coarse grid (many ties)."""
    cell = F.when(F.col("id") % 3 == 0, 1.0).otherwise(F.round(F.rand(5) * 8))
    other = F.when(F.col("id") % 3 == 0, 1.0).otherwise(F.round(F.rand(6) * 8) / 2)
    return spark.range(600).select(
        "id", (F.col("id") % 4).cast("int").alias("label"), F.array(cell, other, cell * other).alias("features")
    ).cache()


def brute(points, asking, k, p):
    train = points.orderBy("id").toPandas()
    x, ids = np.stack(train.features), train.id.to_numpy()
    found = {}
    for _, row in asking.toPandas().iterrows():
        d = (np.abs(x - np.asarray(row.features)) ** p).sum(axis=1) ** (1 / p)
        order = np.lexsort((ids, d))[:k]
        found[row.id] = (ids[order].tolist(), d[order])
    return found


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("metric,p", [("minkowski", 2), ("manhattan", 2), ("minkowski", 3)])
def test_neighbours_are_exact(points, kind, metric, p):
    asking = points.where("id % 5 < 2").withColumn("id", F.col("id") + 10000)
    model = KNNClassifier(n_neighbors=7, metric=metric, p=p, **KINDS[kind]).fit(points)
    power = 1 if metric == "manhattan" else p
    expected = brute(points, asking, 7, power)
    rows = model.neighbours(asking).collect()
    assert len(rows) == len(expected)
    for r in rows:
        ids, gaps = expected[r["id"]]
        np.testing.assert_allclose([n["distances"] for n in r["__near"]], gaps, atol=1e-9)
        if power != 3:
            assert [n["ids"] for n in r["__near"]] == ids


def test_an_exact_hit_outvotes_the_rest(spark):
    train = spark.createDataFrame(
        [(1, 0, [0.0]), (2, 1, [0.1]), (3, 1, [0.1]), (4, 1, [0.2])], "id bigint, label int, features array<double>"
    )
    asking = spark.createDataFrame([(9, [0.0]), (8, [0.15])], "id bigint, features array<double>")
    got = {r["id"]: r for r in KNNClassifier(n_neighbors=4).fit(train).transform(asking).collect()}
    assert got[9]["prediction"] == 0.0 and got[9]["probability"] == [1.0, 0.0]
    assert got[8]["prediction"] == 1.0
    uniform = KNNClassifier(n_neighbors=4, weights="uniform").fit(train).transform(asking)
    assert {r["id"]: r["probability"] for r in uniform.collect()}[9] == [0.25, 0.75]


def test_vote_tie_goes_to_the_lowest_class(spark):
    train = spark.createDataFrame([(1, 1, [0.0]), (2, 0, [2.0])], "id bigint, label int, features array<double>")
    asking = spark.createDataFrame([(9, [1.0])], "id bigint, features array<double>")
    assert KNNClassifier(n_neighbors=2).fit(train).transform(asking).collect()[0]["prediction"] == 0.0


def test_bad_options(spark):
    with pytest.raises(ValueError):
        KNNClassifier(weights="odd")
    with pytest.raises(ValueError):
        KNNClassifier(p=0.5)
    with pytest.raises(ValueError, match="no rows"):
        KNNClassifier().fit(spark.createDataFrame([], "id bigint, label int, features array<double>"))


def test_the_search_runs_once(points):
    scored = KNNClassifier(n_neighbors=3).fit(points).transform(points)
    text = scored.select(F.posexplode("probability"))._jdf.queryExecution().executedPlan().toString()
    assert text.count("ArrowEvalPython") == 1


def test_cells_join_without_pairs(points):
    model = KNNClassifier(n_neighbors=3, **KINDS["cells"]).fit(points)
    plan = model.neighbours(points)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("kind", KINDS)
def test_text_keys(spark, points, kind):
    named = points.withColumn("id", F.format_string("p%05d", "id"))
    model = KNNClassifier(n_neighbors=5, **KINDS[kind]).fit(named)
    got = {r["id"]: [n["ids"] for n in r["__near"]] for r in model.neighbours(named).collect()}
    plain = KNNClassifier(n_neighbors=5).fit(points).neighbours(points).collect()
    assert got == {f"p{r['id']:05d}": [f"p{n['ids']:05d}" for n in r["__near"]] for r in plain}


@pytest.mark.parametrize("kind", KINDS)
def test_saved_model_stands_on_its_own(points, tmp_path, kind):
    model = KNNClassifier(n_neighbors=3, **KINDS[kind]).fit(points)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = KNNModel.load(str(tmp_path / "m"))
    assert all(folder.startswith(str(tmp_path)) for folder in again.tables().values())
    columns = ["id", "prediction"]
    assert again.transform(points).select(columns).exceptAll(model.transform(points).select(columns)).count() == 0


@pytest.mark.parametrize("kind", KINDS)
def test_asking_rows_need_no_key(spark, points, kind):
    """Keys repeated, missing, texts, or absent: every row gets the answer for its own point."""
    asking = points.where("id % 7 = 0").withColumn("row", F.col("id"))
    model = KNNClassifier(n_neighbors=5, **KINDS[kind]).fit(points)
    expected = brute(points, asking, 5, 2)
    odd = {
        "repeated": asking.withColumn("id", F.lit(3)),
        "missing": asking.withColumn("id", F.lit(None).cast("long")),
        "text": asking.withColumn("id", F.concat(F.lit("k"), (F.col("id") % 3).cast("string"))),
        "absent": asking.drop("id"),
    }
    for rows in odd.values():
        got = {r["row"]: [n["ids"] for n in r["__near"]] for r in model.neighbours(rows).collect()}
        assert got == {i: ids for i, (ids, _) in expected.items()}


@pytest.mark.parametrize("p", [1, 2, 3])
@pytest.mark.parametrize("copies", [1, 50])
def test_search_holds_a_tile_at_a_time(p, copies):
    """Memory of a search doesn't grow with its points; ties and copies in different tiles go by id."""
    import tracemalloc

    from siftwork.operators.neighbours import search

    draw = np.random.default_rng(p)
    rows = draw.normal(size=(256, 4)).round(1)
    points = np.tile(draw.normal(size=(40_000 // copies, 4)).round(2), (copies, 1))
    ids = draw.permutation(len(points))
    ids.sort()
    tracemalloc.start()
    got = search(rows, points, ids, np.zeros(len(points), "int32"), 5, p)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # All distances at once are 82 MB.
    assert peak < 60e6
    for i in range(0, 256, 16):
        d = (np.abs(points - rows[i]) ** p).sum(axis=1) ** (1 / p)
        order = np.lexsort((ids, d.round(12)))[:5]
        np.testing.assert_allclose(got.distances[i], d[order], atol=1e-9)
        if copies > 1 and p < 3:
            assert got.ids[i] == ids[order].tolist()


@pytest.mark.parametrize("p", [1, 2])
@pytest.mark.parametrize("kind", ["cloud", "grid", "copies", "offset", "outliers", "mixed", "huge", "same"])
def test_quick_arithmetic_loses_no_neighbour(kind, p):
    """Bounds in single precision or whole numbers: the lists are those of plain double precision, ties by id."""
    from siftwork.operators.neighbours import Rough, listed_distances, search

    draw = np.random.default_rng(p)
    x = draw.normal(size=(5000, 6))
    if kind == "grid":
        x = x.round(1)
    elif kind == "copies":
        x = np.tile(x[:50], (100, 1))
    elif kind == "offset":
        x = x * 1e-3 + 1e6
    elif kind == "outliers":
        x[::500] *= 1e9
    elif kind == "mixed":
        x[:, 0] *= 1e8
    elif kind == "huge":
        x *= 1e120
    elif kind == "same":
        x[:] = 1.0
    if kind == "cloud":
        assert Rough(x, p).kind == {1: "grid", 2: "single"}[p]
    asking, ids = np.vstack([x[:60], x[:40] * 1.5 + 0.1, x[:20] * 1e6]), np.arange(len(x))
    got = search(asking, x, ids, np.zeros(len(x), "int32"), 7, p)
    for i, row in enumerate(asking):
        gaps = listed_distances(row[None], x[None], p)[0]
        order = np.lexsort((ids, gaps))[:7]
        assert got.ids[i] == order.tolist()
        np.testing.assert_array_equal(got.distances[i], gaps[order])


def test_rows_that_need_most_cells_travel_once_per_span(spark, monkeypatch):
    """In 16 dimensions hardly a cell is ruled out; a row goes to spans of cells then."""
    draw = np.random.default_rng(3)
    cloud = [(i, i % 3, x.tolist()) for i, x in enumerate(draw.normal(size=(600, 16)))]
    points = spark.createDataFrame(cloud, "id bigint, label int, features array<double>")
    model = KNNClassifier(n_neighbors=5, broadcast_bytes=0, block_rows=200).fit(points)
    asking = points.where("id < 50")
    visits, search_places = [], KNNModel._search_places

    def counted(self, rows, places):
        visits.append(rows.agg(F.sum(F.size("places"))).first()[0])
        return search_places(self, rows, places)

    monkeypatch.setattr(KNNModel, "_search_places", counted)
    got = {r["id"]: [n["ids"] for n in r["__near"]] for r in model.neighbours(asking).collect()}
    assert got == {i: ids for i, (ids, _) in brute(points, asking, 5, 2).items()}
    # 24 cells in four spans at most.
    assert visits[1] <= 50 * 6
