"""Forecast models, cross-validation and results."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression, LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalflow.config import ForecastSpec
from signalflow.functions.rates import scaled_target
from signalflow.operators import boosting
from signalflow.operators.boosting import BoostedTrees, BoostSpec
from signalflow.session import written


def estimator(kind: str, train: DataFrame | None = None, alpha: float = 1.0, **overrides) -> Estimator:
    """Spark ML estimator of a model name; boosted trees are in ``boosting``.

    ``gamma`` is a log-linear gamma regression for positive targets, ``ridge`` a linear regression with the penalty ``alpha`` on the summed squared error.
    Spark averages that error and works on the label divided by its deviation, so
    ``ridge`` reads the number of rows and the deviation of ``y`` from ``train``.
    """
    common = {"labelCol": "y", "predictionCol": "yhat"}
    if kind == "gamma":
        return GeneralizedLinearRegression(**{**common, "family": "gamma", "link": "log", **overrides})
    if kind == "ridge":
        if train is None:
            raise ValueError("ridge needs its training rows")
        label = train.agg(F.count("y").alias("n"), F.stddev_pop("y").alias("sd")).first()
        penalty = alpha * (label.sd or 1.0) / max(label.n, 1)
        return LinearRegression(
            **{**common, "elasticNetParam": 0.0, "regParam": penalty, "solver": "normal", "standardization": False, **overrides}
        )
    raise ValueError(f"unsupported model kind {kind!r}")


def with_vector(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(df)


def cross_validate(
    df: DataFrame,
    features: Sequence[str],
    by: Sequence[str],
    spec: ForecastSpec,
    model: Estimator | Callable[[DataFrame], Estimator],
    ts: str = "date",
    parallelism: int = 4,
) -> DataFrame:
    """Out-of-fold predictions ``(*by, fold, date, target_date, y, yhat)`` of a Spark ML model.

    The model of fold f is trained on the training rows of all series at once, so
    each fit is a distributed job. Folds are cut by date, the same for all series: no
    model sees a row of any series that is later than what it is tested on. ``model``
    may be a function that makes the estimator for the training rows of a fold.
    ``parallelism`` folds are submitted at a time, as Spark ML's own cross-validator does.
    """
    # the dates of the calendar, so the window is bounded
    dates = df.select(ts).distinct().withColumns(
        {"rn": F.row_number().over(Window.orderBy(ts)) - 1, "n": F.count(F.lit(1)).over(Window.partitionBy())}
    )
    rows = with_vector(df, features).join(dates, ts).select(*by, ts, "target_date", "y", "features", "rn", "n")
    rows = written(rows, "cv-rows").cache()
    size, gap = spec.test_size, spec.gap

    def one(fold: int) -> DataFrame:
        start = F.col("n") - (spec.n_splits - fold) * size
        train = F.col("rn") < start - gap
        if spec.max_train is not None:
            train = train & (F.col("rn") >= start - gap - spec.max_train)
        chosen = rows.filter(train)
        fitted = (model(chosen) if callable(model) else model).fit(chosen)
        test = rows.filter((F.col("rn") >= start) & (F.col("rn") < start + size))
        return fitted.transform(test).select(*by, F.lit(fold).alias("fold"), ts, "target_date", "y", "yhat")

    spark = df.sparkSession
    pool = ThreadPool(min(parallelism, spec.n_splits))
    try:
        parts = pool.map(inheritable_thread_target(spark)(one), range(spec.n_splits))
    finally:
        pool.close()
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _ridge_predict(x: np.ndarray, y: np.ndarray, at: np.ndarray, alpha: float) -> np.ndarray:
    """Ridge regression with intercept on (x, y), evaluated at the rows ``at``."""
    mx, my = x.mean(axis=0), y.mean()
    xc = x - mx
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ (y - my))
    return (at - mx) @ w + my


def ridge_cv(
    df: DataFrame, features: Sequence[str], by: Sequence[str], spec: ForecastSpec, alpha: float = 1.0, ts: str = "date"
) -> DataFrame:
    """Out-of-fold ridge predictions of every series and fold in one job.

    Unlike ``cross_validate`` every series has its own models. A task gets one series,
    which the calendar bounds, and solves the small normal equations of its folds; the
    rows are shuffled once instead of once per fold that trains on them.
    """
    features = list(features)
    rows = df.select(*by, ts, "target_date", F.col("y").cast("double").alias("y"), *[F.col(c).cast("double").alias(c) for c in features])
    fields = [*[rows.schema[c] for c in by], T.StructField("fold", T.IntegerType())]
    fields += [rows.schema[c] for c in (ts, "target_date", "y")]
    schema = T.StructType([*fields, T.StructField("yhat", T.DoubleType())])
    names = schema.names
    n_splits, size, gap, max_train = spec.n_splits, spec.test_size, spec.gap, spec.max_train

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(ts, ignore_index=True)
        x, y = pdf[features].to_numpy(), pdf["y"].to_numpy()
        first = len(pdf) - n_splits * size
        out = pdf.iloc[first:].copy() if first - gap > 0 else pdf.iloc[:0].copy()
        out["fold"] = (np.arange(len(out)) // size).astype("int32")
        found = []
        for lo in range(first, len(pdf), size) if len(out) else ():
            stop = lo - gap
            start = 0 if max_train is None else max(0, stop - max_train)
            found.append(_ridge_predict(x[start:stop], y[start:stop], x[lo : lo + size], alpha))
        out["yhat"] = np.concatenate(found) if found else np.empty(0)
        return out[names]

    return rows.groupBy(*by).applyInPandas(solve, schema)


def fit(df: DataFrame, features: Sequence[str], model: Estimator | BoostSpec) -> Model | BoostedTrees:
    """One model over all rows, a distributed fit of either kind."""
    if isinstance(model, BoostSpec):
        return boosting.fit(df, features, model)
    return model.fit(with_vector(df, features))


def predict(df: DataFrame, features: Sequence[str], fitted: Model | BoostedTrees) -> DataFrame:
    """``df`` with the prediction column ``yhat``."""
    if isinstance(fitted, BoostedTrees):
        return fitted.predict(df)
    return fitted.transform(with_vector(df, features)).drop("features")


def save(fitted: Model, path: str) -> None:
    fitted.write().overwrite().save(path)


def forecast_result(
    df: DataFrame, predictions: DataFrame, by: Sequence[str], target: str, lang: str, ts: str = "date"
) -> DataFrame:
    """Result table on the full date axis: ``date, lang, target, cv_preds, abs_diff``, all in the unit of ``y``.

    A prediction belongs to the date it is made for. ``cv_preds`` is the prediction
    itself, NULL on dates no fold tested.
    """
    made = predictions.select(
        *by, F.col("target_date").alias(ts), F.col("yhat").alias("cv_preds"), F.abs(F.col("y") - F.col("yhat")).alias("abs_diff")
    )
    base = df.select(*by, ts, F.lit(lang).alias("lang"), scaled_target(target, target).alias("target"))
    return base.join(made, [*by, ts], "left")
