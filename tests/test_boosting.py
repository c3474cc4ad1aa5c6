"""Histogram boosting against a plain version that looks at every row for every split."""

from datetime import date, timedelta

import numpy as np
import pytest

from signalflow.config import ForecastSpec
from signalflow.operators import boosting as bo
from signalflow.operators import series_models as sm

FEATURES = ["a", "b", "c"]


def data(n=260, seed=3):
    rng = np.random.default_rng(seed)
    x = np.c_[rng.normal(size=n), rng.integers(0, 6, n), rng.normal(size=n)]
    y = np.exp(0.5 * x[:, 0] + 0.2 * x[:, 1] + rng.normal(size=n) / 5)
    return x, y


def plain_tree(x, g, h, spec):
    """Best-first growth by trying every threshold on the rows of every leaf; one dict a node."""

    def value(rows):
        return -spec.rate * g[rows].sum() / (h[rows].sum() + spec.l2)

    def split(rows, depth):
        best = None
        if spec.max_depth is not None and depth >= spec.max_depth:
            return None
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for t in (values[:-1] + values[1:]) / 2:
                left, right = rows[x[rows, f] <= t], rows[x[rows, f] > t]
                if min(len(left), len(right)) < spec.min_leaf or min(h[left].sum(), h[right].sum()) < 1e-3:
                    continue
                parts = [g[r].sum() ** 2 / (h[r].sum() + spec.l2) for r in (left, right, rows)]
                gain = parts[0] + parts[1] - parts[2]
                if gain > 1e-12 and (best is None or gain > best[0] * (1 + 1e-9)):
                    best = (gain, f, t, left, right)
        return best

    root = {"rows": np.arange(len(g)), "depth": 0, "path": 1}
    root["split"] = split(root["rows"], 0)
    leaves, nodes = [root], [root]
    while len(leaves) < spec.max_leaves:
        able = [n for n in leaves if n["split"]]
        if not able:
            break
        node = max(able, key=lambda n: (n["split"][0], -n["path"]))
        leaves = [n for n in leaves if n is not node]
        for k, rows in enumerate(node["split"][3:]):
            child = {"rows": rows, "depth": node["depth"] + 1, "path": 2 * node["path"] + k}
            child["split"] = split(rows, child["depth"])
            leaves.append(child)
            nodes.append(child)
    out = np.empty(len(g))
    for n in leaves:
        out[n["rows"]] = value(n["rows"])
    kept = {id(n) for n in leaves}
    inner = {(n["path"], n["split"][1], round(n["split"][2], 9)) for n in nodes if id(n) not in kept}
    return out, inner


def splits(tree):
    todo, out = [(0, 1)], set()
    for node, path in todo:
        if tree.feature[node] >= 0:
            out.add((path, tree.feature[node], round(tree.threshold[node], 9)))
            todo += [(tree.left[node], 2 * path), (tree.right[node], 2 * path + 1)]
    return out


SPECS = [
    bo.BoostSpec("gamma", 4, 0.05, 10, 3, 10, 1.0, max_bins=1000),
    bo.BoostSpec("squared", 3, 0.1, 7, None, 12, 0.0, max_bins=1000),
    bo.BoostSpec("gamma", 3, 0.3, 4, None, 5, 0.5, max_bins=1000),
]


@pytest.mark.parametrize("spec", SPECS)
def test_splits_and_leaves_equal_the_plain_version(spec):
    x, y = data()
    model = bo.fit_rows(x, y, FEATURES, spec)
    raw = np.full(len(y), model.base)
    assert np.isclose(model.base, np.log(y.mean()) if spec.loss == "gamma" else y.mean())
    for tree in model.trees:
        g, h = (1 - y * np.exp(-raw), y * np.exp(-raw)) if spec.loss == "gamma" else (raw - y, np.ones(len(y)))
        step, inner = plain_tree(x, g, h, spec)
        assert splits(tree) == inner
        raw = raw + step
    assert np.allclose(model.raw(x), raw)


@pytest.mark.parametrize("spec", SPECS)
def test_distributed_fit_equals_the_one_in_memory(spark, monkeypatch, spec):
    monkeypatch.setattr(bo, "REFRESH", 2)
    x, y = data(180)
    df = spark.createDataFrame([(*map(float, r), float(t), i) for i, (r, t) in enumerate(zip(x, y))], "a double, b double, c double, y double, i int")
    here, there = bo.fit_rows(x, y, FEATURES, spec), bo.fit(df.repartition(5), FEATURES, spec)
    assert [splits(t) for t in here.trees] == [splits(t) for t in there.trees]
    assert np.allclose(here.raw(x), there.raw(x))
    got = {r.i: r.yhat for r in there.predict(df).collect()}
    assert np.allclose([got[i] for i in range(len(y))], here.predict_rows(x))


def test_many_values_are_binned_and_models_kept(spark, tmp_path):
    x, y = data(900)
    spec = bo.with_settings(bo.RESTRICTED, iterations=5, max_bins=16)
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, y double")
    model = bo.fit(df, FEATURES, spec)
    assert all(sum(f >= 0 for f in t.feature) <= 7 for t in model.trees)
    # the ends of the bins are approximate quantiles
    assert np.abs(bo.fit(df.repartition(3), FEATURES, spec).raw(x) - model.raw(x)).mean() < 0.02
    model.save(df, str(tmp_path / "m"))
    assert bo.BoostedTrees.load(df, str(tmp_path / "m")) == model
    assert np.mean((np.log(y) - model.raw(x)) ** 2) < np.var(np.log(y))


def test_each_split_draws_from_its_share_of_features():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 10))
    y = np.exp(x[:, 0])
    spec = bo.BoostSpec("gamma", 30, max_depth=1, min_leaf=5, max_features=0.5)
    first = [t.feature[0] for t in bo.fit_rows(x, y, [str(i) for i in range(10)], spec).trees]
    assert 0.2 < np.mean(np.array(first) == 0) < 0.8
    assert {t.feature[0] for t in bo.fit_rows(x, y, [str(i) for i in range(10)], bo.with_settings(spec, max_features=1.0, iterations=3)).trees} == {0}


def test_early_stopping_is_asked_for(spark):
    x, y = data(400)
    noise = np.exp(np.random.default_rng(9).normal(size=400))
    spec = bo.with_settings(bo.RESTRICTED, iterations=60, rate=0.5, early_stop=True, patience=3)
    assert len(bo.fit_rows(x, noise, FEATURES, spec).trees) < 60
    df = spark.createDataFrame([(*map(float, r), float(t), i) for i, (r, t) in enumerate(zip(x, noise))], "a double, b double, c double, y double, i int")
    assert len(bo.fit(df, FEATURES, spec, key=["i"]).trees) < 60
    with pytest.raises(ValueError):
        bo.fit(df, FEATURES, spec)


def test_no_rows_and_targets_that_are_not_positive(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0.0), (2.0, 1.0, 3.0)], "a double, b double, y double")
    with pytest.raises(ValueError):
        bo.fit(df, ["a", "b"], bo.RESTRICTED)
    with pytest.raises(ValueError):
        bo.fit(df.limit(0), ["a", "b"])
    flat = bo.fit(df, ["a", "b"], bo.with_settings(bo.DEFAULT, iterations=2))
    assert np.allclose(flat.predict_rows(np.zeros((1, 2))), 1.5)


def test_all_folds_of_all_series_in_one_job_equal_fits_one_by_one(spark):
    rows = []
    for s, seed in (("p", 1), ("q", 2)):
        x, y = data(60, seed)
        rows += [(s, date(2024, 1, 1) + timedelta(days=7 * i), date(2024, 1, 8) + timedelta(days=7 * i), *map(float, x[i]), float(y[i])) for i in range(60)]
    df = spark.createDataFrame(rows, "s string, date date, target_date date, a double, b double, c double, y double")
    spec, boost = ForecastSpec(n_splits=5, test_size=2, gap=1, max_train=40), bo.with_settings(bo.RESTRICTED, iterations=8)
    got = {(r.s, r.fold, r.date): r.yhat for r in sm.cross_validate(df, FEATURES, ("s",), spec, sm.Trainer(boost=boost)).collect()}
    assert len(got) == 2 * 5 * 2
    for s in ("p", "q"):
        mine = [r for r in rows if r[0] == s]
        for fold in range(5):
            low = 60 - (5 - fold) * 2
            train = mine[max(0, low - 1 - 40) : low - 1]
            model = bo.fit_rows([r[3:6] for r in train], [r[6] for r in train], FEATURES, boost)
            for r in mine[low : low + 2]:
                assert np.isclose(got[s, fold, r[1]], model.predict_rows(np.array([r[3:6]]))[0])
    fitted = sm.fit_series(df, FEATURES, ("s",), sm.Trainer(boost=boost)).cache()
    models = {r.s: sm.unpacked(r.model) for r in fitted.collect()}
    alone = bo.fit_rows([r[3:6] for r in rows if r[0] == "q"], [r[6] for r in rows if r[0] == "q"], FEATURES, boost)
    assert models["q"] == alone
    scored = sm.predict_series(df, fitted.filter("s = 'q'"), FEATURES, ("s",)).collect()
    assert {r.s for r in scored} == {"q"} and len(scored) == 60
    assert np.allclose([r.yhat for r in scored], models["q"].predict_rows(np.array([[r.a, r.b, r.c] for r in scored])))
    importance = sm.series_importance(df, fitted, FEATURES, ("s",), repeats=3).toPandas()
    assert len(importance) == 2 * 3 * 3
    assert importance.groupby("variable").value.mean()["a"] > importance.groupby("variable").value.mean()["c"]
    nodes = sm.tree_nodes(fitted, ("s",)).filter("s = 'q' and tree = 0").toPandas()
    assert nodes.feature.notna().sum() == sum(f >= 0 for f in models["q"].trees[0].feature)
