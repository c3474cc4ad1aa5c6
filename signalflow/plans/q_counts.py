"""Crawl windows, page and daily counts, merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from signalflow.config import KeywordGroup
from signalflow.operators import counts as ops
from signalflow.operators.align import aligned_sum
from signalflow.operators.spines import chunked_windows, daily_windows
from signalflow.plans.registry import query
from signalflow.plans.standins import counts, event_posts, table, with_ctes
from signalflow.sources import sinks
from signalflow.sources.pages import count_pages, unpack_count_pages
from signalflow.session import scratch_path

START, END = "2024-01-01", "2024-01-31"


def event_types(spark, sf):
    return table(spark, sf, "events").select(F.col("event_type").alias("query")).distinct()


@query(
    "crawl_windows_daily",
    """SELECT query, strftime(d, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS since, strftime(d, '%Y-%m-%dT') || '23:59:59+00:00' AS until
FROM (SELECT DISTINCT event_type AS query FROM events), generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY) g(d)""",
)
def crawl_windows_daily(spark, sf):
    return daily_windows(event_types(spark, sf), START, END)


@query(
    "crawl_windows_chunked",
    """SELECT query, i::INT AS chunk,
       strftime(d + to_microseconds(round(i * 86400000000 / 7)::BIGINT), '%Y-%m-%dT%H:%M:%SZ') AS since,
       strftime(d + to_microseconds(round((i + 1) * 86400000000 / 7 - 1000000)::BIGINT), '%Y-%m-%dT%H:%M:%SZ') AS until
FROM (SELECT DISTINCT event_type AS query, ts::DATE::TIMESTAMP AS d FROM events), range(7) r(i)""",
)
def crawl_windows_chunked(spark, sf):
    days = table(spark, sf, "events").select(F.col("event_type").alias("query"), F.to_date("ts").alias("day")).distinct()
    return chunked_windows(days, 7)


@query(
    "page_lang_counts",
    with_ctes(
        "event_posts",
        """, p AS (SELECT keyword, page_id, min(event_time) AS period_start FROM event_posts GROUP BY 1, 2)
SELECT keyword, page_id, langs, count(*)::BIGINT AS post_count, any_value(period_start) AS period_start,
       any_value(period_start) - INTERVAL 5 SECOND AS next_until
FROM event_posts JOIN p USING (keyword, page_id) GROUP BY ALL""",
    ),
)
def page_lang_counts(spark, sf):
    return ops.page_counts(event_posts(spark, sf))


@query(
    "count_pages_roundtrip",
    with_ctes(
        "event_posts",
        """, p AS (SELECT keyword, page_id, min(event_time) AS period_start, max(event_time) AS period_end FROM event_posts GROUP BY 1, 2)
SELECT keyword, page_id, langs, count(*)::BIGINT AS post_count, period_start, period_end
FROM event_posts JOIN p USING (keyword, page_id) GROUP BY ALL""",
    ),
)
def count_pages_roundtrip(spark, sf):
    posts = event_posts(spark, sf)
    ends = posts.groupBy("keyword", "page_id").agg(F.max("event_time").alias("page_until"))
    pages = count_pages(posts.join(ends, ["keyword", "page_id"]))
    return unpack_count_pages(pages)


@query(
    "daily_counts",
    with_ctes(
        "event_posts",
        "SELECT event_time::DATE AS period_start, langs, keyword AS query, count(*)::BIGINT AS post_count FROM event_posts GROUP BY ALL",
    ),
)
def daily_counts(spark, sf):
    return ops.daily_counts(event_posts(spark, sf))


@query(
    "daily_counts_by_page_start",
    with_ctes(
        "event_posts",
        """, p AS (SELECT keyword, page_id, min(event_time)::DATE AS period_start FROM event_posts GROUP BY 1, 2)
SELECT p.period_start, langs, keyword AS query, count(*)::BIGINT AS post_count
FROM event_posts JOIN p USING (keyword, page_id) GROUP BY ALL""",
    ),
)
def daily_counts_by_page_start(spark, sf):
    return ops.daily_counts(event_posts(spark, sf), attribution="page_min")


_AGG_SQL = {"sum": "sum", "mean": "avg", "min": "min", "max": "max", "count": "count", "median": "median", "std": "stddev_samp"}


@query(
    "daily_aggregates",
    with_ctes(
        "event_posts",
        " UNION ALL ".join(
            f"SELECT '{name}' AS fn, event_time::DATE AS event_time, langs, round({fn}(k), 6)::DOUBLE AS k FROM event_posts GROUP BY ALL"
            for name, fn in _AGG_SQL.items()
        )
        + " UNION ALL SELECT 'range' AS fn, event_time::DATE, langs, round(max(k) - min(k), 6)::DOUBLE FROM event_posts GROUP BY ALL",
    ),
)
def daily_aggregates(spark, sf):
    """Every aggregate by name, and one given as a function, of a small integer (a page's post count)."""
    posts = event_posts(spark, sf).withColumn("langs", F.array_join("langs", ","))
    functions = {**ops.AGGREGATES, "range": lambda c: F.max(c) - F.min(c)}
    wide = ops.by_day(posts, "event_time", lambda c: F.struct(*[F.round(fn(c).cast("double"), 6).alias(name) for name, fn in functions.items()]), "k")
    # all measures come from one scan and one aggregation
    return wide.select("event_time", "langs", "k.*").unpivot(["event_time", "langs"], list(functions), "fn", "k")


@query(
    "dense_daily_counts",
    with_ctes(
        "event_posts",
        """, c AS (SELECT event_time::DATE AS period_start, langs, keyword AS query, count(*) AS n FROM event_posts GROUP BY ALL),
k AS (SELECT DISTINCT query, langs FROM c)
SELECT d::DATE AS period_start, k.query, k.langs, coalesce(c.n, 0)::BIGINT AS post_count
FROM k CROSS JOIN generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY) g(d)
LEFT JOIN c ON c.query = k.query AND c.langs = k.langs AND c.period_start = d::DATE""",
    ),
)
def dense_daily_counts(spark, sf):
    found = ops.daily_counts(event_posts(spark, sf))
    return ops.dense_days(found, found.select("query", "langs").distinct(), START, END)


@query(
    "window_completeness",
    with_ctes(
        "event_posts",
        """, p AS (SELECT keyword, page_id, min(event_time) AS period_start, max(event_time) AS period_end FROM event_posts GROUP BY 1, 2),
w AS (SELECT *, min(period_start) OVER (PARTITION BY keyword, period_end::DATE ORDER BY period_end DESC, page_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newer_start FROM p)
SELECT keyword, page_id, period_start, period_end, newer_start, coalesce(period_end >= newer_start - INTERVAL 10 MINUTE, true) AS complete FROM w""",
    ),
)
def window_completeness(spark, sf):
    pages = event_posts(spark, sf).groupBy("keyword", "page_id").agg(
        F.min("event_time").alias("period_start"), F.max("event_time").alias("period_end")
    )
    return ops.window_gaps(pages, "10 minutes")


@query(
    "crawl_gaps",
    with_ctes(
        "event_posts",
        """, p AS (SELECT keyword, min(event_time) AS s, max(event_time) AS e FROM event_posts GROUP BY keyword, page_id
  UNION ALL SELECT keyword, min(event_time), max(event_time) FROM event_posts GROUP BY keyword, floor(epoch(event_time) / 9000)),
days AS (SELECT keyword, unnest(generate_series(min(event_time)::DATE, max(event_time)::DATE, INTERVAL 1 DAY))::TIMESTAMP AS ws FROM event_posts GROUP BY 1),
w AS (SELECT keyword, ws, ws + INTERVAL 86399 SECOND AS we FROM days),
r AS (SELECT w.keyword, ws, we, greatest(s, ws) AS s, e FROM w JOIN p ON p.keyword = w.keyword AND s <= we AND e >= ws
  UNION ALL SELECT keyword, ws, we, we, we FROM w),
g AS (SELECT *, greatest(ws, coalesce(max(e) OVER (PARTITION BY keyword, ws ORDER BY s, least(e, ws + INTERVAL 1 DAY) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ws)) AS reached FROM r)
SELECT keyword, reached AS window_start, s AS window_end FROM g WHERE s > reached + INTERVAL 10 MINUTE""",
    ),
)
def crawl_gaps(spark, sf):
    """What pages of an hour and pages of two and a half hours, which overlap, leave uncovered of every day."""
    events = event_posts(spark, sf)
    bounds = (F.min("event_time").alias("period_start"), F.max("event_time").alias("period_end"))
    wide = F.floor(F.unix_seconds(F.col("event_time").cast("timestamp")) / 9000)
    pages = events.groupBy("keyword", "page_id").agg(*bounds).drop("page_id").unionByName(events.groupBy("keyword", wide.alias("block")).agg(*bounds).drop("block"))
    days = events.groupBy("keyword").agg(F.to_date(F.min("event_time")).alias("lo"), F.to_date(F.max("event_time")).alias("hi"))
    days = days.select("keyword", F.explode(F.transform(F.sequence("lo", "hi"), lambda d: d.cast("timestamp_ntz"))).alias("window_start"))
    wanted = days.withColumn("window_end", F.col("window_start") + F.expr("interval 86399 seconds"))
    return ops.crawl_gaps(pages, wanted, "10 minutes")


GROUPS = (KeywordGroup("symptom_posts", ("error", "signup")), KeywordGroup("control_posts", ("view", "click", "no such word")))
_GROUP_SQL = """sum(CASE WHEN keyword IN ('error', 'signup') THEN 1 END)::BIGINT AS symptom_posts,
       sum(CASE WHEN keyword IN ('view', 'click') THEN 1 END)::BIGINT AS control_posts
FROM event_posts WHERE keyword IN ('error', 'signup', 'view', 'click')"""


@query(
    "weekly_counts_by_group",
    with_ctes("event_posts", f"SELECT date_trunc('week', event_time)::DATE AS date, {_GROUP_SQL} AND langs LIKE '%fr%' GROUP BY 1"),
)
def weekly_counts_by_group(spark, sf):
    return ops.group_counts(ops.daily_counts(event_posts(spark, sf)), GROUPS, "fr")


@query(
    "daily_counts_by_group_exact_lang",
    with_ctes("event_posts", f"SELECT event_time::DATE AS date, {_GROUP_SQL} AND langs = 'fr' GROUP BY 1"),
)
def daily_counts_by_group_exact_lang(spark, sf):
    return ops.group_counts(ops.daily_counts(event_posts(spark, sf)), GROUPS, "fr", unit="day", match="exact")


@query(
    "weekly_counts_tue_mon",
    """SELECT event_type AS query, date_trunc('week', ts::DATE - 1)::DATE AS date, count(*)::BIGINT AS posts, round(sum(value), 4) AS value
FROM events GROUP BY ALL""",
)
def weekly_counts_tue_mon(spark, sf):
    events = table(spark, sf, "events").withColumnRenamed("event_type", "query")
    return ops.resample(events, "ts", {"posts": F.count(F.lit(1)), "value": F.round(F.sum("value"), 4)}, ("query",))


@query(
    "baseline_sum_aligned",
    """WITH a AS (SELECT ts::DATE AS period_start, count(*) AS n FROM events WHERE event_type = 'view' AND value > 20 GROUP BY 1),
b AS (SELECT ts::DATE AS period_start, count(*) AS n FROM events WHERE event_type = 'click' AND value < 40 GROUP BY 1)
SELECT coalesce(a.period_start, b.period_start) AS period_start, coalesce(a.n + b.n, 0)::BIGINT AS post_count
FROM a FULL JOIN b ON a.period_start = b.period_start""",
)
def baseline_sum_aligned(spark, sf):
    events = table(spark, sf, "events")

    def series(kind, condition):
        return (
            events.filter((F.col("event_type") == kind) & condition)
            .groupBy(F.to_date("ts").alias("period_start"))
            .agg(F.count(F.lit(1)).alias("post_count"))
        )

    return aligned_sum(series("view", F.col("value") > 20), series("click", F.col("value") < 40), "period_start", "post_count")


@query(
    "upsert_latest",
    """SELECT user_id, event_type, arg_max(value, (ts, event_id)) AS value, max(ts) AS ts
FROM events GROUP BY ALL""",
)
def upsert_latest(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id", "value")
    return sinks.keep_latest(events, ("user_id", "event_type"), ("ts", "event_id")).drop("event_id")


@query(
    "upsert_merge",
    with_ctes(
        "counts",
        """SELECT period_start, langs, query,
       CASE WHEN period_start >= DATE '2000-06-15' THEN post_count + 100 ELSE post_count END::BIGINT AS post_count,
       date_trunc('month', period_start)::DATE AS period_month FROM counts""",
    ),
)
def upsert_merge(spark, sf):
    fact = counts(spark, sf)
    path = scratch_path(spark, "counts")
    first = fact.filter("period_start < '2001-01-01'")
    late = fact.filter("period_start >= '2000-06-15'").withColumn("post_count", F.col("post_count") + 100)
    sinks.upsert_counts(spark, path, first)
    sinks.upsert_counts(spark, path, late)
    sinks.upsert_counts(spark, path, late)  # a repeated run changes nothing
    return spark.read.parquet(path)
