"""Forecast queries: folds, ridge, boosted trees, gamma regression, importance."""

from __future__ import annotations

from pyspark.sql import functions as F

from signalflow.config import ForecastSpec
from signalflow.operators import features as feats
from signalflow.operators import importance as imp
from signalflow.operators import models, series_models
from signalflow.operators.align import zero_filled
from signalflow.operators.boosting import BoostSpec
from signalflow.operators.folds import positioned
from signalflow.operators.stats import error_summary, fold_errors, regression_scores
from signalflow.plans.forecast import model_columns, run_forecast
from signalflow.plans.q_features import BY, short_signal
from signalflow.plans.registry import query
from signalflow.plans.standins import with_ctes
from signalflow.session import literal_rows, scratch_path, written
from signalflow.sources import sinks

# one feature and its lag: small enough that SQL can solve the same regression
RIDGE = ForecastSpec(lags=1, horizon=1, normalize=False, n_splits=42, max_train=200)
RIDGE_FEATURES = ("norm_post_count", "norm_post_count_lag1")
TREES = ForecastSpec(lags=2, horizon=1, normalize=False, n_splits=42, max_train=200, drop=("ili_incidence",))


def ridge_frame(spark, sf):
    frame = short_signal(spark, sf).select("country_code", "date", "ili_incidence", "norm_post_count")
    return feats.supervised(frame, "ili_incidence", RIDGE.lags, RIDGE.horizon, BY, drop=("ili_incidence",))


def ridge_predictions(spark, sf):
    return models.ridge_cv(ridge_frame(spark, sf), RIDGE_FEATURES, BY, RIDGE)


_RIDGE = """, l AS (SELECT country_code, date, norm_post_count AS a, lag(norm_post_count) OVER w AS b,
         lead(ili_incidence) OVER w * 100000 AS y, lead(date) OVER w AS target_date
  FROM wsig WINDOW w AS (PARTITION BY country_code ORDER BY date)),
p AS (SELECT *, row_number() OVER (PARTITION BY country_code ORDER BY date) - 1 AS rn, count(*) OVER (PARTITION BY country_code) AS n
  FROM l WHERE b IS NOT NULL AND y IS NOT NULL),
t AS (SELECT *, (rn - (n - 42))::INT AS fold FROM p WHERE rn >= n - 42 AND n > 42),
s AS (SELECT t.country_code, t.fold, avg(r.a) AS ma, avg(r.b) AS mb, avg(r.y) AS my,
         var_pop(r.a) * count(*) + 1 AS saa, var_pop(r.b) * count(*) + 1 AS sbb, covar_pop(r.a, r.b) * count(*) AS sab,
         covar_pop(r.a, r.y) * count(*) AS say, covar_pop(r.b, r.y) * count(*) AS sby
  FROM t JOIN p r ON r.country_code = t.country_code AND r.rn < t.rn AND r.rn >= t.rn - 200 GROUP BY ALL),
c AS (SELECT *, (sbb * say - sab * sby) / (saa * sbb - sab * sab) AS wa, (saa * sby - sab * say) / (saa * sbb - sab * sab) AS wb FROM s),
ridge AS (SELECT t.country_code, t.fold, t.date, t.target_date, t.y, my + wa * (a - ma) + wb * (b - mb) AS yhat
  FROM t JOIN c USING (country_code, fold))
"""


@query("ridge_cv", with_ctes("wsig", _RIDGE + "SELECT country_code, fold, date, target_date, round(y, 6) AS y, round(yhat, 6) AS yhat FROM ridge"))
def ridge_cv(spark, sf):
    return ridge_predictions(spark, sf).withColumns({"y": F.round("y", 6), "yhat": F.round("yhat", 6)})


@query(
    "error_summary",
    with_ctes(
        "wsig",
        _RIDGE
        + """, e AS (SELECT country_code, fold, avg(abs(y - yhat)) AS mae, sqrt(avg((y - yhat) ** 2)) AS rmse FROM ridge GROUP BY ALL)
SELECT country_code, count(*)::BIGINT AS folds, round(avg(mae), 6) AS mae_mean, round(stddev_pop(mae), 6) AS mae_std,
       round(median(mae), 6) AS mae_median, round(quantile_cont(mae, 0.025), 6) AS mae_p025, round(quantile_cont(mae, 0.975), 6) AS mae_p975,
       round(avg(rmse), 6) AS rmse_mean, round(stddev_pop(rmse), 6) AS rmse_std FROM e GROUP BY 1""",
    ),
)
def errors(spark, sf):
    out = error_summary(fold_errors(ridge_predictions(spark, sf), ("country_code", "fold")), BY)
    return out.select("country_code", "folds", *[F.round(c, 6).alias(c) for c in out.columns if "_" in c and c != "country_code"])


@query(
    "regression_scores",
    with_ctes(
        "wsig",
        _RIDGE
        + """SELECT country_code, count(*)::BIGINT AS n, round(avg(abs(y - yhat)), 6) AS mae, round(sqrt(avg((y - yhat) ** 2)), 6) AS rmse,
       round(1 - sum((y - yhat) ** 2) / nullif(sum((y - m) ** 2), 0), 6) AS r2
FROM ridge JOIN (SELECT country_code, avg(y) AS m FROM ridge GROUP BY 1) USING (country_code) GROUP BY 1""",
    ),
)
def scores(spark, sf):
    out = regression_scores(ridge_predictions(spark, sf), BY)
    return out.select("country_code", "n", *[F.round(c, 6).alias(c) for c in ("mae", "rmse", "r2")])


@query(
    "forecast_result",
    with_ctes(
        "wsig",
        _RIDGE
        + """SELECT w.country_code, w.date, 'F' AS lang, w.ili_incidence * 100000 AS target,
       round(r.yhat, 6) AS cv_preds, round(abs(r.y - r.yhat), 6) AS abs_diff
FROM wsig w LEFT JOIN ridge r ON w.country_code = r.country_code AND w.date = r.target_date""",
    ),
)
def forecast_result(spark, sf):
    out = models.forecast_result(short_signal(spark, sf), ridge_predictions(spark, sf), BY, "ili_incidence", "F")
    return out.withColumns({"cv_preds": F.round("cv_preds", 6), "abs_diff": F.round("abs_diff", 6)})


_EXPORTED = """SELECT w.country_code, w.date, 'F' AS lang, w.ili_incidence * 100000 AS target,
       round(r.yhat, 6) AS cv_preds, round(abs(r.y - r.yhat), 6) AS abs_diff
FROM wsig w LEFT JOIN ridge r ON w.country_code = r.country_code AND w.date = r.target_date"""


@query("forecast_export", with_ctes("wsig", _RIDGE + _EXPORTED))
def forecast_export(spark, sf):
    """The result table as it is exported for the dashboard and read back."""
    path = scratch_path(spark, "export")
    rows = written(ridge_frame(spark, sf), "ridge-rows")
    fitted = written(series_models.fit_series(rows, RIDGE_FEATURES, BY, series_models.trainer("ridge")), "models")
    importance = series_models.series_importance(rows, fitted, RIDGE_FEATURES, BY, repeats=2)
    result = models.forecast_result(short_signal(spark, sf), models.ridge_cv(rows, RIDGE_FEATURES, BY, RIDGE), BY, "ili_incidence", "F")
    sinks.export_forecast(result, importance, path, "signal", BY)
    schema = "country_code string, date date, lang string, target double, cv_preds double, abs_diff double"
    stored = spark.read.option("header", True).schema(schema).csv(f"{path}/signal")
    return stored.withColumns({"cv_preds": F.round("cv_preds", 6), "abs_diff": F.round("abs_diff", 6)})


@query(
    "stored_models",
    with_ctes(
        "wsig",
        _RIDGE.replace("r.rn < t.rn AND r.rn >= t.rn - 200", "true")
        + "SELECT country_code, date, round(y, 4) AS y, round(yhat, 4) AS yhat FROM ridge",
    ),
)
def stored_models(spark, sf):
    """Models of all countries, stored, loaded again, and applied to the last 42 rows of each."""
    path = scratch_path(spark, "models")
    rows = written(ridge_frame(spark, sf), "ridge-rows")
    sinks.replace(series_models.fit_series(rows, RIDGE_FEATURES, BY, series_models.trainer("ridge")), path)
    placed = positioned(rows, BY).filter("rn >= n - 42 and n > 42").drop("rn", "n")
    made = series_models.predict_series(placed, spark.read.parquet(path), RIDGE_FEATURES, BY)
    return made.select("country_code", "date", F.round("y", 4).alias("y"), F.round("yhat", 4).alias("yhat"))


def full_signal(spark, sf):
    """Weekly signal with calendar features; weeks without posts count 0 here, as in the daily signal."""
    return feats.calendar_features(zero_filled(short_signal(spark, sf), ("grippe_posts", "rest_posts")))


def tree_frame(spark, sf):
    frame = model_columns(full_signal(spark, sf))
    names = feats.feature_names([c for c in frame.columns if c not in ("country_code", "date", "ili_incidence")], TREES.lags)
    rows = feats.supervised(frame, "ili_incidence", TREES.lags, TREES.horizon, BY, drop=TREES.drop)
    return written(rows, "trees"), names


@query("gbt_cv")
def gbt_cv(spark, sf):
    """42 folds of every country, each with its own 100 trees, in one job."""
    rows, names = tree_frame(spark, sf)
    return series_models.cross_validate(rows, names, BY, TREES, series_models.trainer("gbt_restricted"))


@query("gbt_metrics")
def gbt_metrics(spark, sf):
    """Scores of the default booster, one model a country."""
    rows, names = tree_frame(spark, sf)
    fitted = written(series_models.fit_series(rows, names, BY, series_models.trainer("gbt")), "models")
    return regression_scores(series_models.predict_series(rows, fitted, names, BY), BY)


STUMP = BoostSpec("gamma", iterations=1, rate=0.05, max_depth=1, min_leaf=10, l2=1.0, max_bins=1 << 20)

_STUMP = """, f AS (SELECT country_code, date, ili_incidence, coalesce(grippe_posts, 0) AS grippe_posts, coalesce(rest_posts, 0) AS rest_posts, norm_post_count,
         year(date) AS year, month(date) AS month, week(date) AS week,
         CASE WHEN month(date) IN (12, 1, 2) THEN 0 WHEN month(date) < 6 THEN 1 WHEN month(date) < 9 THEN 2 ELSE 3 END AS season FROM wsig),
{lags}
rows AS (SELECT * FROM l WHERE y IS NOT NULL AND {known}),
means AS (SELECT {keys}avg(y) AS mean FROM rows GROUP BY ALL),
cells AS (UNPIVOT (SELECT {keys}1 - y / mean AS g, y / mean AS h, {columns} FROM rows {join_base}) ON {names} INTO NAME feature VALUE v),
sums AS (SELECT {keys}feature, v, sum(g) AS g, sum(h) AS h, count(*) AS n FROM cells GROUP BY ALL),
total AS (SELECT {keys}sum(1 - y / mean) AS tg, sum(y / mean) AS th, count(*) AS tn FROM rows {join_base} GROUP BY ALL),
left_side AS (SELECT *, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(n) OVER w AS nl, (v + lead(v) OVER w0) / 2 AS threshold
  FROM sums WINDOW w AS (PARTITION BY {keys}feature ORDER BY v ROWS UNBOUNDED PRECEDING), w0 AS (PARTITION BY {keys}feature ORDER BY v)),
gains AS (SELECT l.*, tg, th, gl * gl / (hl + 1) + (tg - gl) ** 2 / (th - hl + 1) - tg * tg / (th + 1) AS gain FROM left_side l {join_total}
  WHERE threshold IS NOT NULL AND nl >= 10 AND tn - nl >= 10 AND hl >= 0.001 AND th - hl >= 0.001),
tops AS (SELECT *, max(gain) OVER ({by}) AS top FROM gains),
best AS (SELECT * FROM tops QUALIFY row_number() OVER ({by} ORDER BY round(gain / top, 9) DESC, list_position({order}, feature), threshold) = 1)
SELECT {keys}feature, round(threshold, 9) AS threshold, round(gain, 6) AS gain,
       round(-0.05 * gl / (hl + 1), 9) AS left_value, round(-0.05 * (tg - gl) / (th - hl + 1), 9) AS right_value FROM best"""


def _stump_sql(by: str) -> str:
    base = ["grippe_posts", "rest_posts", "norm_post_count", "year", "month", "week", "season"]
    names = feats.feature_names(base, TREES.lags)
    lags = ", ".join(f"lag({c}, {k}) OVER w AS {c}_lag{k}" for k in range(1, TREES.lags + 1) for c in base)
    lagged = f"l AS (SELECT *, {lags}, lead(ili_incidence) OVER w * 100000 AS y FROM f WINDOW w AS (PARTITION BY country_code ORDER BY date)),"
    # rows with a NULL feature, also one that is no feature of the model, are no rows of the supervised frame
    known = " AND ".join(f"{c} IS NOT NULL" for c in names)
    return _STUMP.format(
        lags=lagged, known=known, keys=f"{by}, " if by else "", columns=", ".join(f"{c}::DOUBLE AS {c}" for c in names), names=", ".join(names),
        join_base=f"JOIN means USING ({by})" if by else "CROSS JOIN means", join_total=f"JOIN total USING ({by})" if by else "CROSS JOIN total",
        by=f"PARTITION BY {by}" if by else "", order=names,
    )


def _stump(nodes, by):
    """The split of a tree's first node beside the values of its two leaves."""
    root = nodes.filter("node = 0").select(*by, "feature", F.round("threshold", 9).alias("threshold"), F.round("gain", 6).alias("gain"))
    left, right = (nodes.filter(F.col("node") == k).select(*by, F.round("value", 9).alias(f"{side}_value")) for k, side in ((1, "left"), (2, "right")))
    return root.join(left, list(by)).join(right, list(by)) if by else root.crossJoin(left).crossJoin(right)


@query("boosted_stumps", with_ctes("wsig", _stump_sql("country_code")))
def boosted_stumps(spark, sf):
    """The first tree of every country's model, cut after its first split."""
    rows, names = tree_frame(spark, sf)
    fitted = written(series_models.fit_series(rows, names, BY, series_models.Trainer(boost=STUMP)), "models")
    return _stump(series_models.tree_nodes(fitted, BY), BY)


@query("boosted_pooled_stump", with_ctes("wsig", _stump_sql("")))
def boosted_pooled_stump(spark, sf):
    """The same over the rows of all countries at once, by the fit that is distributed over rows."""
    rows, names = tree_frame(spark, sf)
    fitted = models.fit(rows, names, STUMP)
    nodes = literal_rows(spark, ("node", "feature", "threshold", "gain", "value"), [s[1:] for s in fitted.splits()])
    return _stump(nodes, ())


@query("gamma_metrics")
def gamma_metrics(spark, sf):
    rows, names = tree_frame(spark, sf)
    fitted = models.fit(rows.filter("y > 0"), names, models.estimator("gamma", regParam=0.01))
    return regression_scores(models.predict(rows, names, fitted), BY)


@query(
    "train_test_predictions",
    with_ctes(
        "wsig",
        """, l AS (SELECT country_code, date, norm_post_count AS a, lag(norm_post_count) OVER w AS b,
         lead(ili_incidence) OVER w * 100000 AS y, lead(date) OVER w AS target_date
  FROM wsig WINDOW w AS (PARTITION BY country_code ORDER BY date)),
p AS (SELECT *, CASE WHEN target_date <= DATE '2000-01-03' THEN 'train' WHEN date >= DATE '2000-01-03' THEN 'test' END AS split
  FROM l WHERE b IS NOT NULL AND y IS NOT NULL),
s AS (SELECT avg(a) AS ma, avg(b) AS mb, avg(y) AS my, var_pop(a) * count(*) + 1 AS saa, var_pop(b) * count(*) + 1 AS sbb,
         covar_pop(a, b) * count(*) AS sab, covar_pop(a, y) * count(*) AS say, covar_pop(b, y) * count(*) AS sby FROM p WHERE split = 'train'),
c AS (SELECT *, (sbb * say - sab * sby) / (saa * sbb - sab * sab) AS wa, (saa * sby - sab * say) / (saa * sbb - sab * sab) AS wb FROM s)
SELECT country_code, date, target_date, split, round(y, 4) AS y, round(my + wa * (a - ma) + wb * (b - mb), 4) AS yhat
FROM p CROSS JOIN c WHERE split IS NOT NULL""",
    ),
)
def train_test_predictions(spark, sf):
    """One ridge model over all countries, its predictions on both sides of the split date."""
    frame = short_signal(spark, sf).select("country_code", "date", "ili_incidence", "norm_post_count")
    rows = written(feats.train_test(frame, "ili_incidence", 1, 1, BY, "2000-01-03", drop=("ili_incidence",)), "split")
    train = rows.filter("split = 'train'")
    fitted = models.fit(train, RIDGE_FEATURES, models.estimator("ridge", train))
    out = models.predict(rows, RIDGE_FEATURES, fitted)
    return out.select("country_code", "date", "target_date", "split", F.round("y", 4).alias("y"), F.round("yhat", 4).alias("yhat"))


def tree_importance(spark, sf):
    rows, names = tree_frame(spark, sf)
    fitted = written(series_models.fit_series(rows, names, BY, series_models.trainer("gbt_restricted")), "models")
    return series_models.series_importance(rows, fitted, names, BY, repeats=25), names


@query("permutation_importance")
def permutation_importance(spark, sf):
    return tree_importance(spark, sf)[0]


@query("top_variables")
def top_variables(spark, sf):
    return imp.top_variables(tree_importance(spark, sf)[0], 10)


@query("importance_long_table")
def importance_long_table(spark, sf):
    importance, names = tree_importance(spark, sf)
    return imp.long_importance(imp.wide_importance(written(importance, "importance"), names, BY), BY)


@query("forecast_job")
def forecast_job(spark, sf):
    """The whole job with boosted trees on a split: its result table on the date axis."""
    return run_forecast(full_signal(spark, sf), BY, TREES, "gbt_restricted", lang="F", split="2000-08-01", repeats=25).result
