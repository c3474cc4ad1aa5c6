"""Streaming queries. The landed files are written from the events table first."""

from __future__ import annotations

from pyspark.sql import functions as F

from signalflow.plans.q_sources import land_pages
from signalflow.plans.registry import query
from signalflow.plans.standins import event_posts, with_ctes
from signalflow.session import scratch_path
from signalflow.sources import pages
from signalflow.streaming import counts as stream


def landed_posts(spark, sf):
    """Posts as three landed folders in time order, then read as a stream of files."""
    path = scratch_path(spark, "landed")
    posts = event_posts(spark, sf)
    posts.repartitionByRange(3, "event_time").write.parquet(path)
    return spark.readStream.schema(posts.schema).option("maxFilesPerTrigger", 2).parquet(path)


@query(
    "stream_daily_counts",
    with_ctes(
        "event_posts",
        """SELECT event_time::DATE AS period_start, langs, keyword AS query, count(*)::BIGINT AS post_count,
       date_trunc('month', event_time)::DATE AS period_month FROM event_posts GROUP BY ALL""",
    ),
)
def stream_daily_counts(spark, sf):
    path = scratch_path(spark, "counts")
    stream.stream_counts(landed_posts(spark, sf), path, scratch_path(spark, "ckpt"), lateness="40 days")
    return spark.read.parquet(path)


@query(
    "stream_weekly_counts",
    with_ctes(
        "event_posts",
        """SELECT date_trunc('week', event_time)::DATE AS period_start, langs, keyword AS query, count(*)::BIGINT AS post_count,
       date_trunc('month', date_trunc('week', event_time))::DATE AS period_month FROM event_posts GROUP BY ALL""",
    ),
)
def stream_weekly_counts(spark, sf):
    path = scratch_path(spark, "counts")
    stream.stream_counts(landed_posts(spark, sf), path, scratch_path(spark, "ckpt"), unit="week", lateness="40 days")
    return spark.read.parquet(path)


@query(
    "stream_upsert",
    with_ctes(
        "event_posts",
        """SELECT k::VARCHAR AS uri, max(event_time) AS event_time, keyword FROM event_posts GROUP BY 1, 3""",
    ),
)
def stream_upsert(spark, sf):
    """Latest version of a post per keyword over all landed files (the value in ``props`` stands for the uri)."""
    path = scratch_path(spark, "posts")
    versions = landed_posts(spark, sf).select(F.col("k").cast("string").alias("uri"), "event_time", "keyword")
    stream.stream_posts(versions, path, scratch_path(spark, "ckpt"), order="event_time", created="event_time")
    return spark.read.parquet(path).drop("post_month", "post_bucket")


@query(
    "stream_late_rows",
    with_ctes(
        "event_posts",
        """, t AS (SELECT event_time, keyword, k % 3 AS part, (SELECT max(event_time) FROM event_posts WHERE k % 3 = 0) - INTERVAL 1 DAY AS mark FROM event_posts)
SELECT event_time::DATE AS period_start, keyword AS query, count(*)::BIGINT AS post_count
FROM t WHERE part < 2 OR event_time::DATE + INTERVAL 1 DAY > mark GROUP BY ALL""",
    ),
)
def stream_late_rows(spark, sf):
    """A third of the posts comes when all but the last days lie behind the watermark, and only those of these days count."""
    path, store = scratch_path(spark, "landed"), scratch_path(spark, "counts")
    posts = event_posts(spark, sf)
    for part in range(3):
        posts.filter(F.col("k") % 3 == part).coalesce(1).write.mode("append").parquet(path)
    landed = spark.readStream.schema(posts.schema).option("maxFilesPerTrigger", 1).parquet(path)
    stream.stream_counts(landed, store, scratch_path(spark, "ckpt"), lateness="1 day")
    return spark.read.parquet(store).groupBy("period_start", "query").agg(F.sum("post_count").alias("post_count"))


@query(
    "stream_late_repaired",
    with_ctes(
        "event_posts",
        "SELECT event_time::DATE AS period_start, langs, keyword AS query, count(*)::BIGINT AS post_count FROM event_posts GROUP BY ALL",
    ),
)
def stream_late_repaired(spark, sf):
    """Posts that come days late, kept aside and counted by a repair of their days: the counts of all posts."""
    path, base, store = (scratch_path(spark, n) for n in ("landed", "late", "counts"))
    posts = event_posts(spark, sf)
    for part in range(3):
        posts.filter(F.col("k") % 3 == part).write.mode("append").parquet(path)
    landed = spark.readStream.schema(posts.schema).option("maxFilesPerTrigger", 4).parquet(path)
    stream.stream_counts_with_late(landed, base, store, scratch_path(spark, "ckpt"))
    stream.repair_late_days(spark, base, store)
    return spark.read.parquet(store).select("period_start", "langs", "query", "post_count")


@query("stream_dedup", with_ctes("event_posts", "SELECT DISTINCT keyword || '/' || k AS uri FROM event_posts"))
def stream_dedup(spark, sf):
    path = scratch_path(spark, "posts")
    versions = landed_posts(spark, sf).select(F.concat_ws("/", "keyword", "k").alias("uri"), "event_time")
    stream.append_stream(stream.unique_posts(versions, "40 days"), path, scratch_path(spark, "ckpt"))
    return spark.read.parquet(path).select("uri")


@query(
    "stream_page_files",
    with_ctes(
        "event_posts",
        """SELECT keyword, count(*)::BIGINT AS posts, min(CASE WHEN k % 2 = 0 THEN event_time - INTERVAL 1 HOUR ELSE event_time END) AS first_seen
FROM event_posts GROUP BY 1""",
    ),
)
def stream_page_files(spark, sf):
    path = scratch_path(spark, "posts")
    landed = pages.stream_post_pages(spark, land_pages(spark, sf), files_per_trigger=4)
    stream.append_stream(landed.select("uri", "keyword", "event_time"), path, scratch_path(spark, "ckpt"))
    return spark.read.parquet(path).groupBy("keyword").agg(F.count(F.lit(1)).alias("posts"), F.min("event_time").alias("first_seen"))
