from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest

from signalflow.operators import features as ops
from signalflow.operators.folds import fold_rows, unfoldable

BY = ("s",)


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(1)
    data = []
    for s, n in (("a", 30), ("b", 24)):
        for i in range(n):
            target = None if (s, i) in {("a", 5), ("b", 23)} else float(rng.random() / 100)
            data.append((s, date(2024, 1, 1) + timedelta(days=7 * i), target, int(rng.integers(0, 50)), float(rng.random())))
    return spark.createDataFrame(data, "s string, date date, ili_incidence double, posts int, share double")


def pandas_supervised(pdf, lags, horizon, normalize):
    """Positional construction: shifted features, shifted target, one row per date."""
    pdf = pdf.sort_values("date").reset_index(drop=True)
    out = pdf[["s", "date", "posts", "share"]].copy()
    for n in range(1, lags + 1):
        for c in ("posts", "share"):
            out[f"{c}_lag{n}"] = pdf[c].shift(n)
    out["y"] = (pdf["ili_incidence"] * 100_000).shift(-horizon)
    out["target_date"] = pdf["date"].shift(-horizon)
    if normalize:
        out["y"] = out["y"] / out["y"].iloc[lags:].max()
    return out.dropna()


@pytest.mark.parametrize(("lags", "horizon", "normalize"), [(2, 1, False), (3, 2, True)])
def test_supervised(frame, lags, horizon, normalize):
    got = ops.supervised(frame, "ili_incidence", lags, horizon, BY, drop=("ili_incidence",), normalize=normalize)
    got = got.toPandas().sort_values(["s", "date"]).reset_index(drop=True)
    want = pd.concat([pandas_supervised(g, lags, horizon, normalize) for _, g in frame.toPandas().groupby("s")]).reset_index(drop=True)
    assert list(got["date"]) == list(want["date"]) and list(got["target_date"]) == list(want["target_date"])
    for c in [x for x in want.columns if x not in ("s", "date", "target_date")]:
        assert np.allclose(got[c].astype(float), want[c].astype(float)), c


def test_train_test_boundary(frame):
    split = date(2024, 4, 1)  # a Monday in the data
    got = ops.train_test(frame, "ili_incidence", 2, 1, BY, split, drop=("ili_incidence",)).toPandas()
    train, test = got[got.split == "train"], got[got.split == "test"]
    assert train.target_date.max() == split and test.date.min() == split
    assert not set(zip(train.s, train.date)) & set(zip(test.s, test.date))
    scaled = ops.train_test(frame, "ili_incidence", 2, 1, BY, split, drop=("ili_incidence",), normalize=True).toPandas()
    assert np.allclose(scaled.groupby(["s", "split"]).y.max(), 1.0)
    by_train = ops.train_test(frame, "ili_incidence", 2, 1, BY, split, drop=("ili_incidence",), normalize=True, scale_by="train").toPandas()
    assert np.allclose(by_train[by_train.split == "train"].groupby("s").y.max(), 1.0)


def test_one_hot_reads_categories(spark, rows):
    df = spark.createDataFrame([(1, 10, "Winter"), (2, 9, "Spring"), (3, None, "Winter")], "id int, week int, season string")
    got = ops.one_hot(df, ("week", "season"))
    assert got.columns == ["id", "week_9", "week_10", "season_Spring", "season_Winter"]
    assert rows(got) == [(1, 0.0, 1.0, 0.0, 1.0), (2, 1.0, 0.0, 1.0, 0.0), (3, 0.0, 0.0, 0.0, 1.0)]
    with pytest.raises(ValueError):
        ops.one_hot(df, ("week", "season"), max_categories=1)


def de_boor(x, period, n, degree=3):
    """Basis values from the Cox-de Boor recursion on wrapped knots."""
    h = period / n
    knots = np.arange(-degree, n + degree + 1) * h

    def b(i, k):
        if k == 0:
            return float(knots[i] <= x < knots[i + 1])
        left = (x - knots[i]) / (knots[i + k] - knots[i]) * b(i, k - 1)
        right = (knots[i + k + 1] - x) / (knots[i + k + 1] - knots[i + 1]) * b(i + 1, k - 1)
        return left + right

    x = x % period
    full = [b(i, degree) for i in range(n + degree)]
    return [full[i] + (full[i + n] if i < degree else 0.0) for i in range(n)]


@pytest.mark.parametrize(("period", "n"), [(12, 6), (54, 27), (7, 4)])
def test_periodic_splines(spark, period, n):
    df = spark.createDataFrame([(float(x),) for x in np.arange(0, period + 1, 0.5)], "m double")
    for r in ops.spline_features(df, "m", period, n).collect():
        got = [r[f"m_spline_{i}"] for i in range(n)]
        assert np.isclose(sum(got), 1.0)
        assert np.allclose(got, de_boor(r.m, period, n))


def test_calendar(spark):
    df = spark.createDataFrame([(date(2024, 12, 30),), (date(2024, 6, 1),)], "date date")
    got = [tuple(r) for r in ops.calendar_features(df, with_day=True).orderBy("date").collect()]
    assert got == [(date(2024, 6, 1), 2024, 6, 22, "Summer", 1), (date(2024, 12, 30), 2024, 12, 1, "Winter", 30)]
    codes = ops.calendar_features(df).select(ops.season_code().alias("c")).collect()
    assert {r.c for r in codes} == {0, 2}


def test_slices(frame, rows):
    assert ops.without_ends(frame, BY, first=2, last=3).count() == 54 - 2 * 5
    assert ops.without_open_week(frame, BY).count() == 52


@pytest.mark.parametrize(
    ("n_splits", "size", "gap", "max_train"), [(5, 1, 0, 10), (4, 3, 2, 6), (3, 2, 0, None), (23, 1, 0, 200)]
)
def test_folds_against_definition(frame, n_splits, size, gap, max_train):
    got = fold_rows(frame.select("s", "date"), BY, n_splits=n_splits, test_size=size, gap=gap, max_train=max_train).toPandas()
    for s, n in (("a", 30), ("b", 24)):
        mine = got[got.s == s]
        if n - gap - n_splits * size <= 0:
            assert mine.empty
            continue
        for fold, start in enumerate(range(n - n_splits * size, n, size)):
            stop = start - gap
            begin = 0 if max_train is None else max(0, stop - max_train)
            part = mine[mine.fold == fold]
            assert sorted(part[part.role == "test"].rn) == list(range(start, start + size))
            assert sorted(part[part.role == "train"].rn) == list(range(begin, stop))


def test_weekly_fold_numbers(spark):
    df = spark.createDataFrame([("a", date(2023, 1, 2) + timedelta(days=7 * i)) for i in range(86)], "s string, date date")
    got = fold_rows(df, BY).toPandas()
    test = got[got.role == "test"]
    assert test.rn.min() == 44 and test.rn.max() == 85 and test.fold.nunique() == 42
    first = got[(got.fold == 0) & (got.role == "train")].rn
    assert (first.min(), first.max()) == (0, 43)
    assert unfoldable(df, BY, 86).count() == 1 and unfoldable(df, BY).count() == 0
