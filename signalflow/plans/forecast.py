"""The forecast job: supervised frame, folds, fit, scores, importance, result tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalflow.config import ForecastSpec
from signalflow.operators import features as feats
from signalflow.operators import importance as imp
from signalflow.operators import models, series_models
from signalflow.operators.folds import unfoldable
from signalflow.operators.stats import error_summary, fold_errors, regression_scores
from signalflow.session import written
from signalflow.sources.sinks import export_forecast, replace


@dataclass
class ForecastRun:
    features: list[str]
    frame: DataFrame
    cv: DataFrame
    summary: DataFrame
    predictions: DataFrame
    scores: DataFrame
    importance: DataFrame
    result: DataFrame
    model: Model | DataFrame


def model_columns(df: DataFrame) -> DataFrame:
    """Numeric form of the calendar features (season as its position in the year)."""
    return df.withColumn("season", feats.season_code()) if "season" in df.columns else df


def _by_series(by: Sequence[str]) -> list[str]:
    return [*by, "fold"]


def run_forecast(
    df: DataFrame,
    by: Sequence[str],
    spec: ForecastSpec,
    kind: str = "gbt",
    lang: str | Column = "",
    split: str | None = None,
    repeats: int = 25,
    alpha: float = 1.0,
    out: str | None = None,
    name: str = "forecast",
    **model_params,
) -> ForecastRun:
    """Fit and evaluate one model kind on a signal frame of one or many series.

    Cross-validates on the training rows, fits on all of them, scores train (and test
    with ``split``), and joins the fold predictions back to the date axis. Boosted trees and ridge have
    a model for every series, and all series and folds are fitted in the same few jobs; ``gamma`` is one
    model over all series. With ``out`` the result tables and the fitted models are stored below it.
    """
    base = model_columns(df).select(*by, *[c for c in df.columns if c not in by])
    base_features = [c for c in base.columns if c not in {*by, "date", *spec.drop}]
    names = feats.feature_names(base_features, spec.lags)
    settings = {"drop": spec.drop, "normalize": spec.normalize, "scale": "y_scale"}
    if split is None:
        frame = feats.supervised(base, spec.target, spec.lags, spec.horizon, by, **settings).withColumn("split", F.lit("train"))
    else:
        frame = feats.train_test(base, spec.target, spec.lags, spec.horizon, by, split, **settings)
    frame = written(frame, "supervised")
    train = frame.filter("split = 'train'")
    short = unfoldable(train, by, spec.n_splits, spec.test_size, spec.gap)
    if not short.isEmpty():
        raise ValueError(f"series too short for {spec.n_splits} folds, among them: {[tuple(r) for r in short.limit(10).collect()]}")
    held_out = frame if split is None else frame.filter("split = 'test'")
    keyed = kind in series_models.KINDS
    if keyed:
        how = series_models.trainer(kind, alpha, **model_params)
        cv = written(series_models.cross_validate(train, names, by, spec, how), "cv")
        fitted = written(series_models.fit_series(train, names, by, how), "models")
        predictions = series_models.predict_series(frame, fitted, names, by)
        importance = series_models.series_importance(held_out, fitted, names, by, repeats=repeats)
    else:
        cv = models.cross_validate(train, names, by, spec, lambda rows: models.estimator(kind, rows, alpha, **model_params))
        cv = written(cv, "cv")
        fitted = models.fit(train, names, models.estimator(kind, train, alpha, **model_params))
        predictions = models.predict(frame, names, fitted)
        importance = imp.permutation_importance(fitted, held_out, names, [*by, "date"], repeats)
    in_unit = cv
    if spec.normalize:
        by_row = [*by, "date"]
        in_unit = cv.join(train.select(*by_row, "y_scale"), by_row).withColumns({c: F.col(c) * F.col("y_scale") for c in ("y", "yhat")})
    result = models.forecast_result(df, in_unit, by, spec.target, lang)
    if out:
        importance = written(importance, "importance")
        export_forecast(result, importance, out, name, by if keyed else ())
        if keyed:
            replace(fitted, f"{out}/{name}_model")
        else:
            models.save(fitted, f"{out}/{name}_model")
    return ForecastRun(
        features=names,
        frame=frame,
        cv=cv,
        summary=error_summary(fold_errors(cv, _by_series(by)), by),
        predictions=predictions.select(*by, "date", "target_date", "split", "y", "yhat"),
        scores=regression_scores(predictions, ("split",)),
        importance=importance,
        result=result,
        model=fitted,
    )
