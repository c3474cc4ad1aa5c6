import numpy as np
import pandas as pd

from signalflow.operators import stats


def test_correlation_like_pandas(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(rng.normal(size=(40, 3)), columns=list("abc"))
    pdf.loc[3:8, "a"] = np.nan
    pdf["k"] = 5.0
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).values.tolist(), "a double, b double, c double, k double")
    got = stats.correlation(df, ["a", "b", "c", "k"]).toPandas().pivot(index="x", columns="y", values="r")
    want = pdf.corr()
    assert np.allclose(got.loc[want.index, want.columns].to_numpy(float), want.to_numpy(), equal_nan=True)


def test_error_summary_like_numpy(spark):
    rng = np.random.default_rng(4)
    y, yhat = rng.normal(size=42), rng.normal(size=42)
    df = spark.createDataFrame([("s", i, float(a), float(b)) for i, (a, b) in enumerate(zip(y, yhat))], "s string, fold int, y double, yhat double")
    row = stats.error_summary(stats.fold_errors(df, ("s", "fold")), ("s",)).first()
    mae = np.abs(y - yhat)
    want = [42, mae.mean(), mae.std(), np.median(mae), np.percentile(mae, 2.5), np.percentile(mae, 97.5), mae.mean(), mae.std()]
    assert np.allclose([row[c] for c in row.asDict() if c != "s"], want)


def test_scores(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (4.0, 3.0)], "y double, yhat double")
    row = stats.regression_scores(df).first()
    y, p = np.array([1, 2, 4.0]), np.array([1.5, 2, 3.0])
    assert np.isclose(row.r2, 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert np.isclose(row.mae, 0.5) and np.isclose(row.rmse, np.sqrt(1.25 / 3))
