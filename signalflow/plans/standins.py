"""The engine's input tables derived from the star-schema test tables.

Every frame has a SQL twin in ``CTES`` so that a query and its SQL counterpart start
from the same rows.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalflow.config import Calendar, KeywordGroup, SignalSpec
from signalflow.functions.dates import iso_week
from signalflow.session import spread

SYMPTOM = KeywordGroup("grippe_posts", ("1-URGENT", "2-HIGH"))
CONTROL = KeywordGroup("rest_posts", ("3-MEDIUM", "4-NOT SPECIFIED"))
SPEC = SignalSpec("F", "F", "7", SYMPTOM, CONTROL, age_codes=("F",))
CAL = Calendar(date(1995, 1, 1), date(2001, 12, 31), date(1995, 8, 1))
# languages of the posts stand-in live on the same date axis
POST_SPEC = SignalSpec("en", "en", "7", SYMPTOM, CONTROL, age_codes=("F",))
MIXED_SOURCES = ("src0", "src1", "src2")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count fact: orders per day, status (language) and priority (keyword)."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(
            F.to_date("o_orderdate").alias("period_start"),
            F.col("o_orderstatus").alias("langs"),
            F.col("o_orderpriority").alias("query"),
        )
        .agg(F.count(F.lit(1)).alias("post_count"))
    )


def cases(spark: SparkSession, sf_dir: str, gappy: bool = False) -> DataFrame:
    """Surveillance fact: shipped quantities per week, supplier nation and line status.

    ``gappy`` leaves out every fifth calendar week, for the queries whose feature it is to fill gaps.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_linestatus", "l_returnflag", "l_quantity", "l_extendedprice", iso_week("l_shipdate").alias("iso_weekstartdate")
    )
    nations = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").cast("string").alias("country_code"))
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    if gappy:
        lines = lines.filter(F.weekofyear("iso_weekstartdate") % 5 != 0)
    return (
        lines.join(nations, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("iso_weekstartdate", "country_code", F.col("l_linestatus").alias("agegroup_code"))
        .agg(
            F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))).alias("ili_case"),
            F.sum("l_quantity").alias("ili_pop_cov"),
            F.sum(F.when(F.col("l_returnflag") == "A", F.col("l_quantity"))).alias("ari_case"),
            (F.sum(cents) / 100.0).alias("ari_pop_cov"),
        )
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts: documents, dated by the order of the same number; some carry two languages."""
    docs = spread(table(spark, sf_dir, "documents"))
    dates = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    mixed = F.when(F.col("source").isin(*MIXED_SOURCES), F.concat("lang", F.lit(",en"))).otherwise(F.col("lang"))
    return docs.join(dates, F.col("doc_id") == F.col("o_orderkey")).select(
        F.col("doc_id").cast("string").alias("uri"),
        F.col("o_orderdate").alias("record__created_at"),
        F.col("text").alias("record__text"),
        mixed.alias("record__langs"),
        F.col("source").alias("keyword"),
        "n_chars",
    )


def hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotations: one per labelled document."""
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("uri"),
        (F.col("quality") == 1).alias("ili_related"),
        F.when(F.col("toxic") == 1, "fever,cough").otherwise("").alias("symptoms"),
    )


def event_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawled posts: events, the type as keyword, an hour of a type as one page."""
    k = F.from_json("props", "k int")["k"]
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("uri"),
        F.col("ts").alias("event_time"),
        F.col("event_type").alias("keyword"),
        F.concat_ws("/", "event_type", F.date_format("ts", "yyyy-MM-dd HH")).alias("page_id"),
        F.when(k % 3 == 0, F.array(F.lit("fr"), F.lit("de"))).when(k % 3 == 1, F.array(F.lit("fr"))).otherwise(F.array().cast("array<string>")).alias("langs"),
        "value",
        k.alias("k"),
    )


CTES = {
    "counts": """counts AS (
  SELECT o_orderdate::DATE AS period_start, o_orderstatus AS langs, o_orderpriority AS query, count(*)::BIGINT AS post_count
  FROM orders GROUP BY ALL)""",
    "cases": """cases AS (
  SELECT date_trunc('week', l_shipdate)::DATE AS iso_weekstartdate, s_nationkey::VARCHAR AS country_code,
         l_linestatus AS agegroup_code,
         sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS ili_case, sum(l_quantity) AS ili_pop_cov,
         sum(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS ari_case,
         sum(round(l_extendedprice * 100)::BIGINT)::BIGINT / 100.0::DOUBLE AS ari_pop_cov
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  GROUP BY 1, 2, 3)""",
    "posts": """posts AS (
  SELECT doc_id::VARCHAR AS uri, o_orderdate AS record__created_at, text AS record__text,
         CASE WHEN source IN ('src0', 'src1', 'src2') THEN lang || ',en' ELSE lang END AS record__langs,
         source AS keyword, n_chars
  FROM documents JOIN orders ON doc_id = o_orderkey)""",
    "hints": """hints AS (
  SELECT doc_id::VARCHAR AS uri, quality = 1 AS ili_related,
         CASE WHEN toxic = 1 THEN 'fever,cough' ELSE '' END AS symptoms FROM labels)""",
    "event_posts": """event_posts AS (
  SELECT event_id::VARCHAR AS uri, ts AS event_time, event_type AS keyword,
         event_type || '/' || strftime(ts, '%Y-%m-%d %H') AS page_id,
         CASE (props->>'k')::INT % 3 WHEN 0 THEN 'fr,de' WHEN 1 THEN 'fr' ELSE '' END AS langs,
         value, (props->>'k')::INT AS k
  FROM events)""",
    "weeks": """weeks AS (
  SELECT DISTINCT date_trunc('week', d)::DATE AS date
  FROM generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY) g(d))""",
    "days": """days AS (
  SELECT d::DATE AS date FROM generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY) g(d))""",
    # weekly incidence of all countries, age group F, interior gaps interpolated
    "weekly": """base AS (
  SELECT n.country_code, w.date AS iso_weekstartdate, c.ili_case, c.ili_pop_cov, c.ari_case, c.ari_pop_cov,
         c.ili_case / c.ili_pop_cov AS ili_raw, c.ari_case / c.ari_pop_cov AS ari_incidence
  FROM (SELECT DISTINCT country_code FROM cases WHERE agegroup_code = 'F') n CROSS JOIN weeks w
  LEFT JOIN (SELECT * FROM cases WHERE agegroup_code = 'F') c
    ON c.country_code = n.country_code AND c.iso_weekstartdate = w.date),
known AS (SELECT country_code, iso_weekstartdate AS ts, ili_raw AS v FROM base WHERE ili_raw IS NOT NULL),
weekly AS (
  SELECT b.country_code, b.iso_weekstartdate,
         CASE WHEN p.ts = b.iso_weekstartdate THEN p.v
              ELSE p.v + (q.v - p.v) * (b.iso_weekstartdate - p.ts) / (q.ts - p.ts) END AS ili_incidence,
         b.ili_case, b.ili_pop_cov, b.ari_case, b.ari_pop_cov, b.ari_incidence
  FROM base b
  ASOF LEFT JOIN known p ON b.country_code = p.country_code AND b.iso_weekstartdate >= p.ts
  ASOF LEFT JOIN known q ON b.country_code = q.country_code AND b.iso_weekstartdate < q.ts)""",
    "daily": """points AS (
  SELECT country_code, iso_weekstartdate AS ts, ili_incidence AS v FROM weekly
  WHERE ili_incidence IS NOT NULL AND iso_weekstartdate >= DATE '1995-01-01'),
daily AS (
  SELECT n.country_code, d.date,
         CASE WHEN p.ts = d.date THEN p.v ELSE p.v + (q.v - p.v) * (d.date - p.ts) / (q.ts - p.ts) END AS ili_incidence
  FROM (SELECT DISTINCT country_code FROM weekly) n CROSS JOIN days d
  ASOF LEFT JOIN points p ON n.country_code = p.country_code AND d.date >= p.ts
  ASOF LEFT JOIN points q ON n.country_code = q.country_code AND d.date < q.ts)""",
    "total_weekly": """total_weekly AS (
  SELECT w.date,
         sum(CASE WHEN query IN ('1-URGENT', '2-HIGH') THEN post_count END)::BIGINT AS grippe_posts,
         sum(CASE WHEN query IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN post_count END)::BIGINT AS rest_posts
  FROM weeks w LEFT JOIN counts c ON w.date = date_trunc('week', c.period_start)::DATE AND c.langs LIKE '%F%'
  GROUP BY 1)""",
    "total_daily": """total_daily AS (
  SELECT d.date,
         coalesce(sum(CASE WHEN query IN ('1-URGENT', '2-HIGH') THEN post_count END), 0)::BIGINT AS grippe_posts,
         coalesce(sum(CASE WHEN query IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN post_count END), 0)::BIGINT AS rest_posts
  FROM days d LEFT JOIN counts c ON d.date = c.period_start AND c.langs LIKE '%F%' GROUP BY 1)""",
    "signal": """signal AS (
  SELECT i.country_code, t.date, i.ili_case, i.ili_pop_cov, i.ari_case, i.ari_pop_cov, i.ili_incidence, i.ari_incidence,
         t.grippe_posts, t.rest_posts,
         coalesce(t.grippe_posts / (t.grippe_posts + t.rest_posts + 1), 0) AS norm_post_count
  FROM weekly i JOIN total_weekly t ON i.iso_weekstartdate = t.date WHERE t.date > DATE '1995-08-01')""",
    "wsig": """wsig AS (
  SELECT country_code, date, ili_incidence, grippe_posts, rest_posts, norm_post_count FROM signal)""",
}

_ORDER = list(CTES)
_NEEDS = {
    "weekly": ("cases", "weeks"),
    "daily": ("weekly", "days"),
    "total_weekly": ("counts", "weeks"),
    "total_daily": ("counts", "days"),
    "signal": ("weekly", "total_weekly"),
    "wsig": ("signal",),
}


def with_ctes(names: str, body: str, gappy: bool = False) -> str:
    """``body`` behind the named stand-in CTEs and all they need; ``gappy`` as in :func:`cases`."""
    wanted: set[str] = set()

    def add(name: str) -> None:
        wanted.add(name)
        for dep in _NEEDS.get(name, ()):
            add(dep)

    for name in names.split():
        add(name)
    ctes = dict(CTES)
    if gappy:
        ctes["cases"] = ctes["cases"].replace("  GROUP BY 1, 2, 3)", "  WHERE week(l_shipdate) % 5 <> 0 GROUP BY 1, 2, 3)")
    return "WITH " + ",\n".join(ctes[n] for n in _ORDER if n in wanted) + "\n" + body
