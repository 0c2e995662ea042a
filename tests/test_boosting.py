"""Softmax boosting against a plain version that holds everything in one array."""

import numpy as np
import pytest

from siftwork.operators import boosting as bo


def rows(spark, n=500, parts=3, seed=1, k=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)).round(2)
    y = (x[:, 0] > 0).astype(int) + (x[:, 1] * x[:, 2] > 0.2)
    data = [(i, r.tolist(), int(c)) for i, (r, c) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, "id long, features array<double>, label int").repartition(parts), x, y


def plain(x, y, edges, k, rounds, depth, rate, alpha, l2, least):
    """Margins after all rounds: splits by trying every edge of every feature on the rows themselves."""
    margins = np.zeros((k, len(x)))
    unit = float(1 << 24)

    def score(g, h):
        return max(abs(g) - alpha, 0) ** 2 / (h + l2)

    def value(g, h):
        return -np.sign(g) * max(abs(g) - alpha, 0) / (h + l2) * rate

    def grow(at, g, h, left, out):
        best = (1e-6, None)
        if left:
            for j, cuts in enumerate(edges):
                for e in cuts:
                    low = at[x[at, j] <= e]
                    high = at[x[at, j] > e]
                    if len(low) and len(high) and h[low].sum() >= least and h[high].sum() >= least:
                        gain = score(g[low].sum(), h[low].sum()) + score(g[high].sum(), h[high].sum()) - score(g[at].sum(), h[at].sum())
                        if gain > best[0] + 1e-12:
                            best = (gain, (low, high))
        if best[1] is None:
            out[at] += value(g[at].sum(), h[at].sum())
        else:
            for part in best[1]:
                grow(part, g, h, left - 1, out)

    for _ in range(rounds):
        p = np.exp(margins - margins.max(axis=0))
        p /= p.sum(axis=0)
        more = np.zeros_like(margins)
        for c in range(k):
            g = np.rint((p[c] - (y == c)) * unit) / unit
            h = np.rint(np.maximum(2 * p[c] * (1 - p[c]), 1e-16) * unit) / unit
            grow(np.arange(len(x)), g, h, depth, more[c])
        margins += more
    return margins


EDGES = [[-1.0, -0.5, 0.0, 0.5, 1.0]] * 4
WHOLE = dict(n_classes=3, subsample=1.0, colsample_bytree=1.0, edges=EDGES, key="id")


def shares(model, df):
    got = {r.id: r.probability for r in model.transform(df).collect()}
    return np.array([got[i] for i in sorted(got)])


@pytest.mark.parametrize("alpha, l2, least", [(0.0, 0.0, 0.0), (0.1, 1.0, 1.0), (3.0, 10.0, 8.0)])
def test_same_as_the_plain_version(spark, alpha, l2, least):
    df, x, y = rows(spark)
    model = bo.SoftmaxBooster(n_estimators=3, max_depth=3, learning_rate=0.3, reg_alpha=alpha, reg_lambda=l2 + 1e-9, min_child_weight=least, **WHOLE).fit(df)
    margins = plain(x, y, EDGES, 3, 3, 3, 0.3, alpha, l2 + 1e-9, least)
    e = np.exp(margins - margins.max(axis=0))
    np.testing.assert_allclose(shares(model, df), (e / e.sum(axis=0)).T, atol=1e-9)


def test_partitions_and_writes_do_not_matter(spark, monkeypatch):
    options = dict(n_classes=3, n_estimators=5, max_depth=3, max_bins=16, key="id")
    first = bo.SoftmaxBooster(**options).fit(rows(spark, parts=1)[0])
    monkeypatch.setattr(bo, "TASK_ROWS", 50)
    monkeypatch.setattr(bo, "ROUNDS_BETWEEN_WRITES", 2)
    second = bo.SoftmaxBooster(**options).fit(rows(spark, parts=7)[0])
    assert first.values["trees"] == second.values["trees"]
    other = bo.SoftmaxBooster(seed=43, **options).fit(rows(spark, parts=1)[0])
    assert other.values["trees"] != first.values["trees"]


def test_learns_and_stages_agree(spark, tmp_path):
    df, _, y = rows(spark, 1500)
    model = bo.SoftmaxBooster(n_classes=3, n_estimators=12, max_depth=4, learning_rate=0.3, key="id").fit(df)
    scored = model.transform(df).collect()
    assert np.mean([r.prediction == r.label for r in scored]) > 0.97
    short = bo.SoftmaxBooster(n_classes=3, n_estimators=4, max_depth=4, learning_rate=0.3, key="id").fit(df)
    assert model.rounds(4).values["trees"] == short.values["trees"]
    model.write().save(str(tmp_path / "m"))
    assert bo.SoftmaxModel.load(str(tmp_path / "m")).values == model.values


def test_missing_cells_one_class_and_bad_arguments(spark):
    df = spark.createDataFrame([(i, [float("nan") if i % 2 else float(i), 1.0], i % 2) for i in range(60)] + [(99, [1.0, 1.0], None)], "id long, features array<double>, label int")
    model = bo.SoftmaxBooster(n_classes=2, n_estimators=8, max_depth=2, learning_rate=0.5, key="id").fit(df)
    assert all(r.prediction == r.label for r in model.transform(df).where("label is not null").collect())
    one = bo.SoftmaxBooster(n_classes=1, n_estimators=2, max_depth=2).fit(df.withColumn("label", df.label * 0))
    assert {tuple(r.probability) for r in one.transform(df).collect()} == {(1.0,)}
    with pytest.raises(ValueError, match="no rows"):
        bo.SoftmaxBooster().fit(df.where("id < 0"))
    with pytest.raises(ValueError, match="max_bins"):
        bo.SoftmaxBooster(max_bins=500)
    assert model.transform(df.where("id < 0")).collect() == []


def test_a_level_is_one_stage_and_large_sums_are_added_in_a_shuffle(spark, monkeypatch):
    """Few sums: one job of one stage a level. More than the limit: a shuffle adds them up; same trees."""
    df, _, _ = rows(spark, 400, parts=4)
    options = dict(n_classes=3, n_estimators=2, max_depth=3, max_bins=16, key="id")
    monkeypatch.setattr(bo, "TASK_ROWS", 100)
    stages = []
    kept = bo.all_offers

    def counted(*args):
        context = spark.sparkContext
        context.setJobGroup(name := f"level-{len(stages)}-{bo.GATHERED_BYTES}", "a level of trees")
        found = kept(*args)
        jobs = [context.statusTracker().getJobInfo(i) for i in context.statusTracker().getJobIdsForGroup(name)]
        stages.append(sum(len(j.stageIds) for j in jobs))
        context._jsc.clearJobGroup()
        return found

    monkeypatch.setattr(bo, "all_offers", counted)
    gathered = bo.SoftmaxBooster(**options).fit(df)
    assert set(stages) == {1}
    stages.clear()
    monkeypatch.setattr(bo, "GATHERED_BYTES", 0)
    shuffled = bo.SoftmaxBooster(**options).fit(df)
    assert set(stages) == {2}
    assert gathered.values["trees"] == shuffled.values["trees"]


def test_one_of_two_siblings_is_summed(spark, monkeypatch):
    """The other's sums are what is left of the parent's, wherever sums are added up; all nodes where they stay apart."""
    df, _, _ = rows(spark, 400, parts=4)
    options = dict(n_classes=3, n_estimators=2, max_depth=4, max_bins=16, key="id")
    monkeypatch.setattr(bo, "TASK_ROWS", 100)
    built = []
    kept = bo.histograms

    def seen(rows, growing, nodes, *args):
        built.append(nodes)
        return kept(rows, growing, nodes, *args)

    monkeypatch.setattr(bo, "histograms", seen)
    halves = lambda: [len({(n - 1) // 2 for n in nodes}) == len(nodes) for level in built for nodes in level if max(nodes, default=0)]
    gathered = bo.SoftmaxBooster(**options).fit(df)
    assert halves() and all(halves())
    built.clear()
    # Enough for the sums of all nodes of the last level once: 3 classes, 8 nodes, 3 features, 16 bins.
    monkeypatch.setattr(bo, "GATHERED_BYTES", 3 * 8 * 3 * 16 * 24)
    added = bo.SoftmaxBooster(**options).fit(df)
    assert halves() and all(halves())
    built.clear()
    monkeypatch.setattr(bo, "GATHERED_BYTES", 0)
    apart = bo.SoftmaxBooster(**options).fit(df)
    assert not any(halves())
    assert gathered.values["trees"] == added.values["trees"] == apart.values["trees"]


@pytest.mark.parametrize("depth", [0, 1, 3, 4, 5, 6, 7, 9])
def test_leaves_are_found_as_by_walking_down(depth):
    rng = np.random.default_rng(depth)
    bins = rng.integers(0, 16, (5, 700))
    size = 2 ** (depth + 1) - 1
    tree = {"feature": [bo.LEAF] * size, "bin": [0] * size}
    for node in range(size // 2):
        if (not node or tree["feature"][(node - 1) // 2] != bo.LEAF) and rng.random() < 0.85:
            tree["feature"][node], tree["bin"][node] = int(rng.integers(5)), int(rng.integers(16))
    want = []
    for row in bins.T:
        node = 0
        while tree["feature"][node] != bo.LEAF:
            node = 2 * node + 1 + int(row[tree["feature"][node]] > tree["bin"][node])
        want.append(node)
    assert bo.reached(bins.astype(np.intp), bo.router(tree, depth, 16), np.arange(size)).tolist() == want


def test_rows_are_dealt_evenly(spark, monkeypatch):
    """More rows than a task per core needs: as many blocks of rows in every partition, whatever the files."""
    monkeypatch.setattr(bo, "TASK_ROWS", 20)
    seen = []
    kept = bo.grown
    monkeypatch.setattr(bo, "grown", lambda rows, *args: (seen.append(rows.map(lambda b: b[0]).glom().map(sum).collect()), kept(rows, *args))[1])
    df, _, _ = rows(spark, 800, parts=1)
    bo.SoftmaxBooster(n_classes=3, n_estimators=1, max_depth=2, subsample=1.0, key="id").fit(df)
    assert len(seen[0]) == spark.sparkContext.defaultParallelism and max(seen[0]) <= 1.2 * min(seen[0])
