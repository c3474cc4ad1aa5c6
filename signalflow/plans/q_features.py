"""Feature, split, fold and correlation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from signalflow.operators import features as ops
from signalflow.operators.align import aligned_frame
from signalflow.operators.counts import resample
from signalflow.operators.folds import fold_rows
from signalflow.operators.stats import correlation
from signalflow.plans.q_signals import signal
from signalflow.plans.registry import query
from signalflow.plans.standins import cases, posts, table, with_ctes

BY = ("country_code",)


def short_signal(spark, sf):
    return signal(spark, sf).select("country_code", "date", "ili_incidence", "grippe_posts", "rest_posts", "norm_post_count")


_CALENDAR = """year(date)::INT AS year, month(date)::INT AS month, week(date)::INT AS week,
  CASE WHEN month(date) IN (12, 1, 2) THEN 'Winter' WHEN month(date) < 6 THEN 'Spring' WHEN month(date) < 9 THEN 'Summer' ELSE 'Autumn' END AS season"""


@query("calendar_features", with_ctes("wsig", f"SELECT *, {_CALENDAR}, day(date)::INT AS day FROM wsig"))
def calendar_features(spark, sf):
    return ops.calendar_features(short_signal(spark, sf), with_day=True)


_YEARS, _SEASONS = range(1995, 2002), ("Autumn", "Spring", "Summer", "Winter")


@query(
    "one_hot",
    with_ctes(
        "wsig",
        f""", c AS (SELECT country_code, date, {_CALENDAR} FROM wsig)
SELECT country_code, date, month, week, {', '.join(f'(year = {y})::INT::DOUBLE AS year_{y}' for y in _YEARS)},
  {', '.join(f"(season = '{s}')::INT::DOUBLE AS season_{s}" for s in _SEASONS)} FROM c""",
    ),
)
def one_hot(spark, sf):
    frame = ops.calendar_features(short_signal(spark, sf).select("country_code", "date"))
    return ops.one_hot(frame, ("year", "season"))


def _spline_sql(column: str, period: int, n: int) -> str:
    """Cubic B-spline as a sum of truncated powers."""
    out = []
    for i in range(n):
        t = f"((({column} % {period}) * {n} / {period}.0::DOUBLE - ({i - 3}) + 2 * {n}) % {n}.0::DOUBLE)"
        powers = " + ".join(f"({c}) * power(greatest({t} - {k}, 0), 3)" for k, c in enumerate((1, -4, 6, -4, 1)))
        out.append(f"round(CASE WHEN {t} < 4 THEN ({powers}) / 6 ELSE 0 END, 9) + 0 AS {column}_spline_{i}")
    return ", ".join(out)


@query(
    "periodic_spline",
    with_ctes(
        "wsig",
        f""", c AS (SELECT DISTINCT date, month(date)::INT AS month, week(date)::INT AS week FROM wsig)
SELECT date, {_spline_sql('month', 12, 6)}, {_spline_sql('week', 54, 27)} FROM c""",
    ),
)
def periodic_spline(spark, sf):
    frame = short_signal(spark, sf).select("date").distinct()
    frame = frame.withColumns({"month": F.month("date"), "week": F.weekofyear("date")})
    frame = ops.spline_features(ops.spline_features(frame, "month", 12, 6), "week", 54, 27)
    return frame.select("date", *[F.round(c, 9).alias(c) for c in frame.columns if "_spline_" in c])


_LAGS = ", ".join(
    f"lag({c}, {n}) OVER w AS {c}_lag{n}" for n in (1, 2) for c in ("grippe_posts", "rest_posts", "norm_post_count")
)


@query("lag_matrix", with_ctes("wsig", f"SELECT *, {_LAGS} FROM wsig WINDOW w AS (PARTITION BY country_code ORDER BY date)"))
def lag_matrix(spark, sf):
    return ops.lag_features(short_signal(spark, sf), ("grippe_posts", "rest_posts", "norm_post_count"), 2, BY)


_LABELLED = f""", l AS (
  SELECT country_code, date, grippe_posts, rest_posts, norm_post_count, {_LAGS},
         lead(ili_incidence) OVER w * 100000 AS y_raw, lead(date) OVER w AS target_date, row_number() OVER w AS pos
  FROM wsig WINDOW w AS (PARTITION BY country_code ORDER BY date))"""
_NOT_NULL = " AND ".join(
    f"{c} IS NOT NULL"
    for c in ["y_raw", "grippe_posts", "rest_posts", *[f"{c}_lag{n}" for n in (1, 2) for c in ("grippe_posts", "rest_posts", "norm_post_count")]]
)


@query(
    "supervised_frame",
    with_ctes(
        "wsig",
        f"""{_LABELLED}, m AS (SELECT country_code, max(y_raw) FILTER (pos > 2) AS top FROM l GROUP BY 1)
SELECT l.* EXCLUDE (y_raw, pos), y_raw / top AS y FROM l JOIN m USING (country_code) WHERE {_NOT_NULL}""",
    ),
)
def supervised_frame(spark, sf):
    return ops.supervised(short_signal(spark, sf), "ili_incidence", 2, 1, BY, drop=("ili_incidence",), normalize=True)


@query(
    "train_test_split",
    with_ctes(
        "wsig",
        f"""{_LABELLED}, s AS (SELECT *, CASE WHEN target_date <= DATE '2000-01-03' THEN 'train' WHEN date >= DATE '2000-01-03' THEN 'test' END AS split FROM l),
m AS (SELECT country_code, split, max(y_raw) FILTER (split = 'test' OR pos > 2) AS top FROM s GROUP BY ALL)
SELECT s.* EXCLUDE (y_raw, pos), y_raw / top AS y FROM s JOIN m USING (country_code, split) WHERE {_NOT_NULL}""",
    ),
)
def train_test_split(spark, sf):
    return ops.train_test(
        short_signal(spark, sf), "ili_incidence", 2, 1, BY, "2000-01-03", drop=("ili_incidence",), normalize=True
    )


@query(
    "ts_folds",
    with_ctes(
        "wsig",
        """, p AS (SELECT country_code, date, row_number() OVER (PARTITION BY country_code ORDER BY date) - 1 AS rn,
       count(*) OVER (PARTITION BY country_code) AS n FROM wsig),
f AS (SELECT f::INT AS fold, country_code, n - (5 - f) * 3 AS lo FROM range(5) r(f), (SELECT DISTINCT country_code, n FROM p) WHERE n - 2 - 15 > 0)
SELECT country_code, date, rn::INT AS rn, fold, 'test' AS role FROM p JOIN f USING (country_code) WHERE rn >= lo AND rn < lo + 3
UNION ALL
SELECT country_code, date, rn::INT, fold, 'train' FROM p JOIN f USING (country_code) WHERE rn < lo - 2 AND rn >= lo - 2 - 100""",
    ),
)
def ts_folds(spark, sf):
    rows = fold_rows(short_signal(spark, sf).select("country_code", "date"), BY, n_splits=5, test_size=3, gap=2, max_train=100)
    return rows.select("country_code", "date", "rn", "fold", "role")


_COLUMNS = ("grippe_posts", "rest_posts", "ili_incidence")


def _correlation_sql(source: str, columns=_COLUMNS, by: str = "") -> str:
    keys = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    cells = [f"SELECT {keys}'{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 3) AS r FROM {source}{group}" for a in columns for b in columns]
    return " UNION ALL ".join(cells)


@query("correlation_matrix", with_ctes("wsig", _correlation_sql("wsig", by="country_code")))
def correlation_matrix(spark, sf):
    return correlation(short_signal(spark, sf), _COLUMNS, BY, digits=3)


def exploratory(spark, sf):
    """Two keyword series, cases, positives and a baseline on Tuesday..Monday bins."""
    p = posts(spark, sf)
    kept = p.filter(F.contains(F.col("record__langs"), F.lit("fr")) & ~F.contains(F.col("record__text"), F.lit("eauenaux")))
    one = F.count(F.lit(1))
    grippe = resample(kept, "record__created_at", {"n": one})
    rhume = resample(p.filter("n_chars > 500"), "record__created_at", {"n": one})
    fluid = resample(cases(spark, sf), "iso_weekstartdate", {"ili_cases": F.sum("ili_case"), "inf_vir": F.sum("ari_case")})
    base = resample(table(spark, sf, "orders").filter("o_orderpriority = '5-LOW'"), "o_orderdate", {"n": one})
    return aligned_frame(
        grippe.select("date"),
        {"grippe": (grippe, "n"), "rhume": (rhume, "n"), "ili_cases": (fluid, "ili_cases"), "inf_vir": (fluid, "inf_vir"), "base": (base, "n")},
    )


_EXPLORE = """, grippe AS (SELECT date_trunc('week', record__created_at::DATE - 1)::DATE AS date, count(*)::BIGINT AS n FROM posts
  WHERE record__langs LIKE '%fr%' AND record__text NOT LIKE '%eauenaux%' GROUP BY 1),
rhume AS (SELECT date_trunc('week', record__created_at::DATE - 1)::DATE AS date, count(*)::BIGINT AS n FROM posts WHERE n_chars > 500 GROUP BY 1),
fluid AS (SELECT date_trunc('week', iso_weekstartdate - 1)::DATE AS date, sum(ili_case) AS ili_cases, sum(ari_case) AS inf_vir FROM cases GROUP BY 1),
base AS (SELECT date_trunc('week', o_orderdate::DATE - 1)::DATE AS date, count(*)::BIGINT AS n FROM orders WHERE o_orderpriority = '5-LOW' GROUP BY 1),
frame AS (SELECT g.date, g.n AS grippe, r.n AS rhume, f.ili_cases, f.inf_vir, b.n AS base FROM grippe g
  LEFT JOIN rhume r USING (date) LEFT JOIN fluid f USING (date) LEFT JOIN base b USING (date))
"""


@query("exploratory_frame", with_ctes("posts cases", _EXPLORE + "SELECT * FROM frame"))
def exploratory_frame(spark, sf):
    return exploratory(spark, sf)


_FRAME_COLUMNS = ("grippe", "rhume", "ili_cases", "inf_vir", "base")


@query(
    "correlation_truncated",
    with_ctes("posts cases", _EXPLORE + ", late AS (SELECT * FROM frame WHERE date >= DATE '1998-01-01') " + _correlation_sql("late", _FRAME_COLUMNS)),
)
def correlation_truncated(spark, sf):
    return correlation(exploratory(spark, sf).filter("date >= '1998-01-01'"), _FRAME_COLUMNS, digits=3)
