"""Signal, incidence and date-axis queries."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from signalflow.operators.counts import unmatched_keywords
from signalflow.operators.gapfill import gap_fill
from signalflow.operators.spines import spine_between
from signalflow.operators.stats import freshness
from signalflow.plans import signals
from signalflow.plans.registry import query
from signalflow.plans.standins import CAL, CONTROL, SPEC, SYMPTOM, cases, counts, table, with_ctes

OTHER_SPEC = replace(SPEC, series_id="O", lang="O", country_code="3", age_codes=("O",), smoothing=1.0)
SPECS = (SPEC, OTHER_SPEC)


def weekly(spark, sf, gappy=False):
    return signals.weekly_incidence(cases(spark, sf, gappy), CAL.start, CAL.end, age_codes=SPEC.age_codes)


def signal(spark, sf):
    return signals.weekly_signal(counts(spark, sf), weekly(spark, sf), SPEC, CAL)


@query("signal_weekly", with_ctes("signal", "SELECT * FROM signal"))
def signal_weekly(spark, sf):
    return signal(spark, sf)


@query(
    "signal_daily",
    with_ctes(
        "daily total_daily",
        """SELECT i.country_code, t.date, coalesce(i.ili_incidence, 0) AS ili_incidence, t.grippe_posts, t.rest_posts,
       coalesce(t.grippe_posts / (t.grippe_posts + t.rest_posts + 1), 0) AS norm_post_count
FROM daily i JOIN total_daily t ON i.date = t.date WHERE t.date > DATE '1995-08-01'""",
    ),
)
def signal_daily(spark, sf):
    daily = signals.daily_incidence(weekly(spark, sf), CAL.start, CAL.end)
    return signals.daily_signal(counts(spark, sf), daily, SPEC, CAL)


@query(
    "signal_weekly_zero_filled",
    with_ctes(
        "cases total_weekly",
        """SELECT t.date, coalesce(c.ili_case, 0) AS ili_case, coalesce(c.ili_pop_cov, 0) AS ili_pop_cov,
       coalesce(c.ari_case, 0) AS ari_case, coalesce(c.ari_pop_cov, 0) AS ari_pop_cov,
       coalesce(t.grippe_posts, 0) AS grippe_posts, coalesce(t.rest_posts, 0) AS rest_posts,
       CASE WHEN coalesce(t.grippe_posts, 0) + coalesce(t.rest_posts, 0) = 0 THEN 0
            ELSE coalesce(t.grippe_posts, 0) / (coalesce(t.grippe_posts, 0) + coalesce(t.rest_posts, 0)) END AS norm_post_count
FROM total_weekly t LEFT JOIN cases c ON t.date = c.iso_weekstartdate AND c.country_code = '7'
WHERE t.date > DATE '1995-08-01'""",
    ),
)
def signal_weekly_zero_filled(spark, sf):
    return signals.zero_filled_signal(counts(spark, sf), cases(spark, sf), SPEC, CAL)


@query(
    "signals_for_all_specs",
    with_ctes(
        "cases counts weeks",
        """, spec(series_id, country_code, age, smoothing) AS (VALUES ('F', '7', 'F', 0.0), ('O', '3', 'O', 1.0)),
b AS (SELECT s.series_id, s.country_code, w.date, c.ili_case, c.ili_pop_cov, c.ari_case, c.ari_pop_cov,
             c.ili_case / (c.ili_pop_cov + s.smoothing) AS raw, c.ari_case / (c.ari_pop_cov + s.smoothing) AS ari_incidence
      FROM spec s CROSS JOIN weeks w LEFT JOIN cases c
        ON c.country_code = s.country_code AND c.agegroup_code = s.age AND c.iso_weekstartdate = w.date),
k AS (SELECT series_id, date AS ts, raw AS v FROM b WHERE raw IS NOT NULL),
t AS (SELECT s.series_id, date_trunc('week', period_start)::DATE AS date,
             sum(post_count) FILTER (query IN ('1-URGENT', '2-HIGH'))::BIGINT AS grippe_posts,
             sum(post_count) FILTER (query IN ('3-MEDIUM', '4-NOT SPECIFIED'))::BIGINT AS rest_posts
      FROM counts c JOIN spec s ON contains(c.langs, s.series_id) GROUP BY 1, 2)
SELECT b.series_id, b.country_code, b.date, ili_case, ili_pop_cov, ari_case, ari_pop_cov,
       CASE WHEN p.ts = b.date THEN p.v ELSE p.v + (q.v - p.v) * (b.date - p.ts) / (q.ts - p.ts) END AS ili_incidence,
       ari_incidence, grippe_posts, rest_posts,
       coalesce(grippe_posts / (grippe_posts + rest_posts + 1), 0) AS norm_post_count
FROM b ASOF LEFT JOIN k p ON b.series_id = p.series_id AND b.date >= p.ts
ASOF LEFT JOIN k q ON b.series_id = q.series_id AND b.date < q.ts
LEFT JOIN t ON b.series_id = t.series_id AND b.date = t.date
WHERE b.date > DATE '1995-08-01'""",
    ),
)
def signals_for_all_specs(spark, sf):
    return signals.weekly_signals(counts(spark, sf), cases(spark, sf), SPECS, CAL, ("grippe_posts", "rest_posts"))


@query("incidence_weekly_gapfilled", with_ctes("weekly", "SELECT * FROM weekly", gappy=True))
def incidence_weekly_gapfilled(spark, sf):
    return weekly(spark, sf, gappy=True)


@query(
    "incidence_weekly_listed_countries",
    with_ctes(
        "cases weeks",
        """SELECT n.country_code, w.date AS iso_weekstartdate, c.ili_case / (c.ili_pop_cov + 1) AS ili_incidence,
       c.ili_case, c.ili_pop_cov, c.ari_case, c.ari_pop_cov, c.ari_case / (c.ari_pop_cov + 1) AS ari_incidence
FROM (VALUES ('3'), ('7'), ('no such country')) n(country_code) CROSS JOIN weeks w
LEFT JOIN cases c ON c.country_code = n.country_code AND c.agegroup_code = 'O' AND c.iso_weekstartdate = w.date""",
    ),
)
def incidence_weekly_listed_countries(spark, sf):
    return signals.weekly_incidence(
        cases(spark, sf), CAL.start, CAL.end, ("3", "7", "no such country"), ("O",), smoothing=1.0, fill=()
    )


@query("incidence_daily_upsampled", with_ctes("daily", "SELECT * FROM daily", gappy=True))
def incidence_daily_upsampled(spark, sf):
    return signals.daily_incidence(weekly(spark, sf, gappy=True), CAL.start, CAL.end)


@query(
    "gap_fill_methods",
    with_ctes(
        "cases",
        """, c AS (SELECT country_code, iso_weekstartdate AS date, ili_case, ari_case, ili_pop_cov FROM cases WHERE agegroup_code = 'O'),
g AS (SELECT country_code, unnest(generate_series(min(date), max(date), INTERVAL 7 DAY))::DATE AS date FROM c GROUP BY 1),
ki AS (SELECT country_code, date, ili_case FROM c WHERE ili_case IS NOT NULL),
ka AS (SELECT country_code, date, ari_case FROM c WHERE ari_case IS NOT NULL)
SELECT g.country_code, g.date,
       CASE WHEN p.date = g.date THEN p.ili_case
            ELSE p.ili_case + (q.ili_case - p.ili_case) * (g.date - p.date) / (q.date - p.date) END AS ili_case,
       a.ari_case, c.ili_pop_cov
FROM g ASOF LEFT JOIN ki p ON g.country_code = p.country_code AND g.date >= p.date
ASOF LEFT JOIN ki q ON g.country_code = q.country_code AND g.date < q.date
ASOF LEFT JOIN ka a ON g.country_code = a.country_code AND g.date >= a.date
LEFT JOIN c ON g.country_code = c.country_code AND g.date = c.date""",
        gappy=True,
    ),
)
def gap_fill_methods(spark, sf):
    rows = cases(spark, sf, gappy=True).filter("agegroup_code = 'O'").withColumnRenamed("iso_weekstartdate", "date")
    methods = {"ili_case": "linear", "ari_case": "locf", "ili_pop_cov": "null"}
    return gap_fill(rows, "date", methods, ("country_code",), bucket_days=7)


@query(
    "day_spine",
    "SELECT unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE, INTERVAL 1 DAY))::DATE AS date FROM orders",
)
def day_spine(spark, sf):
    bounds = table(spark, sf, "orders").agg(F.to_date(F.min("o_orderdate")).alias("lo"), F.to_date(F.max("o_orderdate")).alias("hi"))
    return spine_between(bounds, "day")


@query(
    "week_spine",
    """SELECT DISTINCT date_trunc('week', d)::DATE AS date FROM (
  SELECT unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE, INTERVAL 1 DAY)) AS d FROM orders)""",
)
def week_spine(spark, sf):
    bounds = table(spark, sf, "orders").agg(F.to_date(F.min("o_orderdate")).alias("lo"), F.to_date(F.max("o_orderdate")).alias("hi"))
    return spine_between(bounds, "week")


@query(
    "freshness",
    with_ctes("cases", "SELECT country_code, max(iso_weekstartdate) AS last_date FROM cases GROUP BY 1"),
)
def case_freshness(spark, sf):
    return freshness(cases(spark, sf))


@query(
    "unmatched_keywords",
    """SELECT s.series_id, s.grp, s.query FROM (VALUES
  ('F', 'grippe_posts', '1-URGENT'), ('F', 'grippe_posts', '2-HIGH'), ('F', 'rest_posts', '3-MEDIUMS')) s(series_id, grp, query)
WHERE s.query NOT IN (SELECT o_orderpriority FROM orders)""",
)
def missing_keywords(spark, sf):
    misspelt = replace(SPEC, control=replace(CONTROL, keywords=("3-MEDIUMS",)), symptom=SYMPTOM)
    return unmatched_keywords(counts(spark, sf), (misspelt,))
