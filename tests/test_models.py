from datetime import date, timedelta

import numpy as np
import pytest

from signalflow.config import ForecastSpec
from signalflow.operators import importance as imp
from signalflow.operators import models, series_models
from signalflow.operators.features import supervised
from signalflow.plans.forecast import run_forecast

BY = ("s",)


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(7)
    data = []
    for s in ("a", "b"):
        x = np.cumsum(rng.normal(size=60)) + 20
        for i in range(60):
            target = 2 * x[i - 1] + rng.normal() / 10 if i else 40.0
            data.append((s, date(2024, 1, 1) + timedelta(days=7 * i), float(target), float(x[i]), float(rng.normal())))
    return spark.createDataFrame(data, "s string, date date, cases double, x double, noise double")


@pytest.fixture(scope="module")
def frame(series):
    return supervised(series, "cases", 1, 1, BY, drop=("cases",)).cache()


NAMES = ["x", "noise", "x_lag1", "noise_lag1"]


@pytest.mark.parametrize("spec", [ForecastSpec(n_splits=6, max_train=20), ForecastSpec(n_splits=3, test_size=2, gap=1, max_train=None)])
def test_ridge_folds_closed_form(frame, spec):
    got = models.ridge_cv(frame, NAMES, BY, spec, alpha=0.5).toPandas()
    for s, g in frame.toPandas().groupby("s"):
        g = g.sort_values("date").reset_index(drop=True)
        for fold, lo in enumerate(range(len(g) - spec.n_splits * spec.test_size, len(g), spec.test_size)):
            stop = lo - spec.gap
            train = g.iloc[0 if spec.max_train is None else max(0, stop - spec.max_train) : stop]
            # augmented least squares: the penalty as extra rows, the intercept unpenalised
            a = np.vstack([np.c_[np.ones(len(train)), train[NAMES]], np.c_[np.zeros(4), np.sqrt(0.5) * np.eye(4)]])
            w = np.linalg.lstsq(a, np.r_[train.y, np.zeros(4)], rcond=None)[0]
            test = g.iloc[lo : lo + spec.test_size]
            mine = got[(got.s == s) & (got.fold == fold)].sort_values("date")
            assert list(mine.date) == list(test.date)
            assert np.allclose(mine.yhat, np.c_[np.ones(len(test)), test[NAMES]] @ w)


def test_short_series_have_no_folds(frame):
    assert models.ridge_cv(frame, NAMES, BY, ForecastSpec(n_splits=58)).count() == 0


@pytest.mark.parametrize("kind", ["ridge", "gamma"])
def test_cross_validate_folds(frame, kind):
    spec = ForecastSpec(n_splits=2, test_size=2, max_train=40)
    positive = frame.filter("y > 0")
    got = models.cross_validate(positive, NAMES, BY, spec, models.estimator(kind, frame)).toPandas()
    assert len(got) == 8 and set(got.fold) == {0, 1} and got.yhat.notna().all()
    for _, g in positive.toPandas().groupby("s"):
        last = set(g.sort_values("date").date.tail(4))
        assert set(got[got.s == g.s.iloc[0]].date) == last


def test_ridge_penalty(frame):
    fitted = models.fit(frame, NAMES, models.estimator("ridge", frame, alpha=3.0))
    pdf = frame.toPandas()
    x, y = pdf[NAMES].to_numpy(), pdf["y"].to_numpy()
    xc = x - x.mean(axis=0)
    w = np.linalg.solve(xc.T @ xc + 3.0 * np.eye(4), xc.T @ (y - y.mean()))
    assert np.allclose(fitted.coefficients.toArray(), w)
    with pytest.raises(ValueError):
        models.estimator("ridge")


def test_unknown_kind():
    with pytest.raises(ValueError):
        models.estimator("forest")
    with pytest.raises(ValueError):
        series_models.trainer("forest")


def test_result_table_and_saved_model(series, frame, tmp_path):
    spec = ForecastSpec(n_splits=5)
    cv = models.ridge_cv(frame, NAMES, BY, spec)
    result = models.forecast_result(series, cv, BY, "cases", "fr").toPandas()
    assert len(result) == 120 and result.cv_preds.notna().sum() == 10
    tested = result[result.cv_preds.notna()].groupby("s").date.min()
    assert (tested == date(2024, 1, 1) + timedelta(days=7 * 55)).all()  # the date predicted for, not the row's own
    fitted = models.fit(frame, NAMES, models.estimator("ridge", frame))
    models.save(fitted, str(tmp_path / "m"))
    again = type(fitted).load(str(tmp_path / "m"))
    assert np.allclose(again.coefficients, fitted.coefficients)


def test_permutation_is_exact(frame):
    keyed = frame.withColumnsRenamed({"s": "__key0", "date": "__key1"})
    out = imp._shuffled(keyed, NAMES, 3, 1, keyed.count()).select("repeat", "x", "__donor.x").toPandas()
    out.columns = ["repeat", "x", "donor"]
    for _, g in out.groupby("repeat"):
        assert sorted(g.x) == sorted(g.donor) and (g.x != g.donor).mean() > 0.8


def test_importance(frame, rows):
    fitted = models.fit(frame, NAMES, models.estimator("ridge", frame, alpha=0.1))
    got = imp.permutation_importance(fitted, frame, NAMES, ("s", "date"), repeats=4).cache()
    assert got.count() == 16
    means = {r.variable: r.mean_value for r in imp.top_variables(got, 10).collect()}
    assert means["x"] > 1 and abs(means["noise"]) < 0.1
    assert imp.top_variables(got, 2).first().variable == "x"
    wide = imp.wide_importance(got, NAMES)
    assert wide.columns == ["repeat", *NAMES]
    assert rows(imp.long_importance(wide), "variable", "value") == rows(got, "variable", "value")


def test_forecast_job(spark, series, tmp_path):
    spec = ForecastSpec(target="cases", lags=1, n_splits=4, normalize=False, drop=("cases",))
    run = run_forecast(series, BY, spec, "ridge", "fr", repeats=2, out=str(tmp_path), name="job")
    assert run.summary.count() == 2 and run.scores.first().split == "train"
    stored = spark.read.option("header", True).csv(str(tmp_path / "job"))
    assert stored.columns == ["s", "date", "lang", "target", "cv_preds", "abs_diff"] and stored.count() == 120
    assert spark.read.option("header", True).csv(str(tmp_path / "job_featureimp")).count() == 16
    split = run_forecast(series, BY, spec, "gbt_restricted", "fr", split="2024-12-02", repeats=1, iterations=2)
    assert {r.split for r in split.scores.collect()} == {"train", "test"}
