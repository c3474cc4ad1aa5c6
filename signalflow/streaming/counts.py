"""Incremental form of the nightly ingest: file streams merged into the batch tables.

Every job runs with ``availableNow``: it takes what has landed since the last run, as
recorded in its checkpoint, and stops.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from signalflow.functions.dates import utc_instant, utc_time
from signalflow.functions.text import joined
from signalflow.session import written
from signalflow.sources import sinks


def _watermarked(posts: DataFrame, lateness: str) -> DataFrame:
    return posts.withColumn("event_time", utc_instant("event_time")).withWatermark("event_time", lateness)


def windowed_counts(posts: DataFrame, unit: str = "day", lateness: str = "1 day") -> DataFrame:
    """Event-time counts per (day or ISO week, langs, keyword) of a post stream.

    Weeks start on Monday: the epoch was a Thursday, so 7-day windows are shifted by 4 days.
    Posts later than ``lateness`` behind the newest are dropped (see ``dropped_rows``).
    """
    window = {
        "day": F.window("event_time", "1 day"),
        "week": F.window("event_time", "7 days", "7 days", "4 days"),
    }[unit]
    return (
        _watermarked(posts, lateness)
        .groupBy(window.alias("w"), joined("langs").alias("langs"), F.col("keyword").alias("query"))
        .agg(F.count(F.lit(1)).alias("post_count"))
        .select(F.to_date(utc_time("w.start")).alias("period_start"), "langs", "query", "post_count")
    )


def unique_posts(posts: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Each uri once, however many overlapping crawls deliver it within ``lateness``.

    All copies of a uri meet in one task here. Where single posts come in very many
    copies use ``stream_posts``, which reduces copies before its shuffle.
    """
    unique = _watermarked(posts, lateness).dropDuplicatesWithinWatermark(["uri"])
    return unique.withColumn("event_time", utc_time("event_time"))


def _run(writer, checkpoint: str) -> StreamingQuery:
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def merge_stream(stream: DataFrame, merge: Callable[[DataFrame], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Run a stream to the end of the landed data; ``merge`` must be idempotent, as a batch may be repeated."""
    return _run(stream.writeStream.outputMode(mode).foreachBatch(lambda df, _: merge(df)), checkpoint)


def stream_counts(posts: DataFrame, path: str, checkpoint: str, unit: str = "day", lateness: str = "1 day") -> StreamingQuery:
    """Keep the count table at ``path`` up to date: changed counts replace the stored ones."""
    return merge_stream(
        windowed_counts(posts, unit, lateness), lambda df: sinks.upsert_counts(df.sparkSession, path, df), checkpoint, "update"
    )


def stream_counts_with_late(posts: DataFrame, base: str, path: str, checkpoint: str, lateness: str = "1 day") -> StreamingQuery:
    """Daily counts of landed posts at ``path``; posts that come too late are kept aside instead of being lost.

    A post is late if it lies more than ``lateness`` behind the newest post of the earlier micro-batches. Below
    ``base`` every micro-batch leaves its counts, its late posts and its newest time, each in a folder of its number,
    so a repeated batch writes the same again. Days of the batch get the sum of their counts so far. No operator state is
    kept, so late posts cost nothing until :func:`repair_late_days`. Posts without a time are counted without a day.
    """

    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        rows = df.select(utc_time(utc_instant("event_time")).alias("event_time"), joined("langs").alias("langs"), F.col("keyword").alias("query"))
        rows = written(rows, "late-batch")
        before = sinks.read_table(spark, f"{base}/marks", "newest timestamp_ntz, batch int").filter(F.col("batch") < number)
        newest = before.agg(F.max("newest")).first()[0]
        is_late = F.lit(False)
        if newest is not None:
            is_late = F.coalesce(F.col("event_time") < F.lit(newest).cast("timestamp_ntz") - F.expr(f"interval {lateness}"), F.lit(False))
        for name, part in (
            ("late", rows.filter(is_late)),
            ("partials", _day_counts(rows.filter(~is_late))),
            ("marks", rows.agg(F.max("event_time").alias("newest"))),
        ):
            part.write.mode("overwrite").parquet(f"{base}/{name}/batch={number}")
        _store_days(spark, base, path, rows.filter(~is_late), _repaired(spark, base))

    return _run(posts.writeStream.outputMode("append").foreachBatch(batch), checkpoint)


_PARTIALS = "period_start date, langs string, query string, post_count bigint"
_LATE = "event_time timestamp_ntz, langs string, query string"


def _day_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.to_date("event_time").alias("period_start"), "langs", "query").agg(F.count(F.lit(1)).alias("post_count"))


def _repaired(spark, base: str) -> int:
    """The last micro-batch whose late posts a repair has counted; none: -1."""
    done = sinks.read_table(spark, f"{base}/repaired", "upto int").agg(F.max("upto")).first()[0]
    return -1 if done is None else done


def _store_days(spark, base: str, path: str, rows: DataFrame, upto: int) -> None:
    """Store the counts of the days of ``rows``, made anew from what all micro-batches have left, with late posts up to one of them."""
    days = rows.select(F.to_date("event_time").alias("__day")).distinct()
    parts = sinks.read_table(spark, f"{base}/partials", _PARTIALS).select("period_start", "langs", "query", "post_count")
    if upto >= 0:
        late = sinks.read_table(spark, f"{base}/late", f"{_LATE}, batch int").filter(F.col("batch") <= upto)
        parts = parts.unionByName(_day_counts(late))
    parts = parts.join(days, F.col("period_start").eqNullSafe(F.col("__day")), "left_semi")
    sinks.upsert_counts(spark, path, parts.groupBy("period_start", "langs", "query").agg(F.sum("post_count").alias("post_count")))


def repair_late_days(spark, base: str, path: str) -> DataFrame:
    """Count the late posts too, on just the days they touch; returns these days. Running it again changes nothing."""
    late = sinks.read_table(spark, f"{base}/late", f"{_LATE}, batch int")
    upto = late.agg(F.max("batch")).first()[0]
    if upto is not None:
        # named first: a batch that comes in between counts these posts as well
        spark.range(1).select(F.lit(upto).cast("int").alias("upto")).write.mode("append").parquet(f"{base}/repaired")
        _store_days(spark, base, path, late, upto)
    return late.select(F.to_date("event_time").alias("period_start")).distinct()


def stream_posts(
    posts: DataFrame, path: str, checkpoint: str, order: str | None = None, created: str | None = "record__created_at"
) -> StreamingQuery:
    """Merge landed posts into the post table by keyword and uri; a micro-batch of new posts only appends files."""
    return merge_stream(posts, lambda df: sinks.upsert_posts(df.sparkSession, path, df, order, created=created), checkpoint)


def append_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return _run(stream.writeStream.outputMode("append").format("parquet").option("path", path), checkpoint)


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that came later than the watermark allowed, over the run's batches."""
    return sum(
        op.get("numRowsDroppedByWatermark", 0) for progress in query.recentProgress for op in _operators(progress)
    )


def _operators(progress) -> list[dict]:
    raw = progress if isinstance(progress, dict) else json.loads(progress.json)
    return raw.get("stateOperators", [])
