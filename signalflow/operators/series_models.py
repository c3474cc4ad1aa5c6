"""A model of its own for every series and fold, all of them fitted side by side in one job.

The rows of a series are bounded by the calendar, those of a fold by its largest training size, so each is one group of
rows; how many series and folds there are only decides how many groups Spark deals out. For one model over all rows of
all series see :func:`signalflow.operators.boosting.fit` and :mod:`signalflow.operators.models`.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalflow.config import ForecastSpec
from signalflow.operators.boosting import DEFAULT, RESTRICTED, BoostedTrees, BoostSpec, fit_rows, with_settings
from signalflow.operators.folds import fold_rows

KINDS = ("gbt", "gbt_restricted", "ridge")


@dataclass
class RidgeFit:
    """Linear model with intercept; the penalty is on the summed squared error."""

    features: list[str]
    intercept: float
    weights: list[float]

    def predict_rows(self, x: np.ndarray) -> np.ndarray:
        return np.asarray(x, np.float64) @ np.asarray(self.weights) + self.intercept

    def packed(self) -> str:
        return json.dumps({"kind": "ridge", "features": self.features, "intercept": self.intercept, "weights": self.weights})


def unpacked(text: str) -> BoostedTrees | RidgeFit:
    held = json.loads(text)
    if held["kind"] == "ridge":
        return RidgeFit(held["features"], held["intercept"], held["weights"])
    return BoostedTrees.unpacked(text)


@dataclass(frozen=True)
class Trainer:
    """How the model of a series is made; see :func:`trainer`."""

    alpha: float = 1.0
    boost: BoostSpec | None = None

    def fit(self, x: np.ndarray, y: np.ndarray, features: Sequence[str]) -> BoostedTrees | RidgeFit:
        if self.boost is not None:
            return fit_rows(x, y, features, self.boost)
        mx, my = x.mean(axis=0), y.mean()
        xc = x - mx
        w = np.linalg.solve(xc.T @ xc + self.alpha * np.eye(x.shape[1]), xc.T @ (y - my))
        return RidgeFit(list(features), float(my - mx @ w), w.tolist())


def trainer(kind: str, alpha: float = 1.0, **settings) -> Trainer:
    """Trainer of a model name: ``gbt``, ``gbt_restricted`` (with the fields of ``BoostSpec`` as settings) or ``ridge``."""
    if kind not in KINDS:
        raise ValueError(f"unsupported model kind {kind!r}")
    if kind == "ridge":
        return Trainer(alpha)
    return Trainer(boost=with_settings(DEFAULT if kind == "gbt" else RESTRICTED, **settings))


def _values(features: Sequence[str]):
    return F.array(*[F.col(f"`{c}`").cast("double") for c in features]).alias("__x")


def _matrix(pdf: pd.DataFrame, features: Sequence[str]) -> np.ndarray:
    return np.stack(pdf["__x"].to_numpy()) if len(pdf) else np.zeros((0, len(features)))


def _schema(df: DataFrame, columns: Sequence[str], more: str) -> T.StructType:
    return T.StructType([*[df.schema[c] for c in columns], *T.DataType.fromDDL(more).fields])


def _dealt(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows dealt out by key to all cores: fitting takes long on few bytes, by which adaptive execution would merge the tasks."""
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys)


def cross_validate(df: DataFrame, features: Sequence[str], by: Sequence[str], spec: ForecastSpec, train: Trainer, ts: str = "date") -> DataFrame:
    """Out-of-fold predictions ``(*by, fold, date, target_date, y, yhat)`` of every series and fold in one job.

    The rows of a fold meet in one task, so the number of jobs depends neither on the folds nor on the series.
    A series too short for the folds has none.
    """
    features = list(features)
    rows = fold_rows(df.select(*by, ts, "target_date", "y", *features), by, ts, spec.n_splits, spec.test_size, spec.gap, spec.max_train)
    rows = rows.select(*by, "fold", ts, "target_date", "role", F.col("y").cast("double").alias("y"), _values(features))
    schema = _schema(rows, [*by, "fold", ts, "target_date", "y"], "yhat double")

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(ts, kind="stable", ignore_index=True)
        seen, test = pdf[pdf.role == "train"], pdf[pdf.role == "test"].copy()
        model = train.fit(_matrix(seen, features), seen["y"].to_numpy(), features)
        test["yhat"] = model.predict_rows(_matrix(test, features))
        return test[schema.names]

    return _dealt(rows, [*by, "fold"]).groupBy(*by, "fold").applyInPandas(one, schema)


def fit_series(df: DataFrame, features: Sequence[str], by: Sequence[str], train: Trainer, ts: str = "date") -> DataFrame:
    """``(*by, model)``: the model of every series as a text for :func:`unpacked`."""
    features = list(features)
    rows = df.select(*by, ts, F.col("y").cast("double").alias("y"), _values(features))
    schema = _schema(rows, by, "model string")

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(ts, kind="stable", ignore_index=True)
        model = train.fit(_matrix(pdf, features), pdf["y"].to_numpy(), features)
        return pd.DataFrame({**{c: [pdf[c].iloc[0]] for c in by}, "model": [model.packed()]})

    return _dealt(rows, by).groupBy(*by).applyInPandas(one, schema)


def predict_series(df: DataFrame, models: DataFrame, features: Sequence[str], by: Sequence[str]) -> DataFrame:
    """``df`` with ``yhat`` of the model of the row's series; a series without a model drops out."""
    features = list(features)
    rows = df.select("*", _values(features))
    schema = _schema(df, df.columns, "yhat double")

    def scored(pdf: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        if not len(model) or not len(pdf):
            return pd.DataFrame(columns=schema.names, dtype=object)
        return pdf.assign(yhat=unpacked(model["model"].iloc[0]).predict_rows(_matrix(pdf, features)))[schema.names]

    return _dealt(rows, by).groupBy(*by).cogroup(_dealt(models, by).groupBy(*by)).applyInPandas(scored, schema)


def series_importance(
    df: DataFrame, models: DataFrame, features: Sequence[str], by: Sequence[str], ts: str = "date", repeats: int = 25, seed: int = 42
) -> DataFrame:
    """Increase of a series' MAE when one feature is permuted within it: ``(*by, variable, repeat, value)``.

    Permutations follow from seed, series, feature and repeat, so that a task that runs again repeats its result.
    """
    features = list(features)
    rows = df.select(*by, ts, F.col("y").cast("double").alias("y"), _values(features))
    schema = _schema(rows, by, "variable string, repeat int, value double")

    def measured(pdf: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        if not len(model) or not len(pdf):
            return pd.DataFrame(columns=schema.names, dtype=object)
        pdf = pdf.sort_values(ts, kind="stable", ignore_index=True)
        x, y, fitted = _matrix(pdf, features), pdf["y"].to_numpy(), unpacked(model["model"].iloc[0])
        base = np.abs(y - fitted.predict_rows(x)).mean()
        name = zlib.crc32("/".join(str(pdf[c].iloc[0]) for c in by).encode())
        out = []
        for f, variable in enumerate(features):
            many = np.tile(x, (repeats, 1))
            for r in range(repeats):
                order = np.random.default_rng((seed, name, f, r)).permutation(len(y))
                many[r * len(y) : (r + 1) * len(y), f] = x[order, f]
            errors = np.abs(np.tile(y, repeats) - fitted.predict_rows(many)).reshape(repeats, len(y)).mean(axis=1)
            out += [(variable, r, e - base) for r, e in enumerate(errors.tolist())]
        made = pd.DataFrame(out, columns=["variable", "repeat", "value"])
        for c in by:
            made[c] = pdf[c].iloc[0]
        return made[schema.names]

    return _dealt(rows, by).groupBy(*by).cogroup(_dealt(models, by).groupBy(*by)).applyInPandas(measured, schema)


def tree_nodes(models: DataFrame, by: Sequence[str]) -> DataFrame:
    """``(*by, tree, node, feature, threshold, gain, value)`` of all nodes of boosted models; leaves have no feature."""
    schema = _schema(models, by, "tree int, node int, feature string, threshold double, gain double, value double")

    def listed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = [(*[r[c] for c in by], *s) for r in pdf.to_dict("records") for s in unpacked(r["model"]).splits()]
            yield pd.DataFrame(rows, columns=schema.names)

    return models.mapInPandas(listed, schema)
