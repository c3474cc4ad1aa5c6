"""Date axes and crawl windows. Their size is bounded by the calendar, not by the data."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalflow.functions.dates import iso_seconds, iso_week

def _dates(start: Column, end: Column, step: str) -> Column:
    return F.explode(F.sequence(start, end, F.expr(f"interval {step}")))


def date_spine(spark: SparkSession, start: date | str, end: date | str, unit: str = "day") -> DataFrame:
    """Inclusive spine in column ``date``; unit ``week`` gives the Monday of every touched ISO week."""
    return spine_between(spark.range(1).select(F.lit(str(start)).cast("date").alias("lo"), F.lit(str(end)).cast("date").alias("hi")), unit)


def spine_between(bounds: DataFrame, unit: str = "day") -> DataFrame:
    """Spine from a one-row-per-series frame with columns ``lo`` and ``hi``; other columns are kept."""
    keep = [c for c in bounds.columns if c not in ("lo", "hi")]
    if unit == "day":
        return bounds.select(*keep, _dates(F.col("lo"), F.col("hi"), "1 day").alias("date"))
    if unit == "week":
        return bounds.select(*keep, _dates(iso_week("lo"), iso_week("hi"), "7 days").alias("date"))
    raise ValueError(f"unknown spine unit {unit!r}")


def daily_windows(keywords: DataFrame, start: date | str, end: date | str) -> DataFrame:
    """One crawl window per keyword and day: midnight to one second before the next."""
    days = keywords.select(
        F.col("query"), _dates(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"), "1 day").alias("day")
    )
    begin = F.col("day").cast("timestamp_ntz")
    return days.select(
        "query",
        iso_seconds(begin, "+00:00").alias("since"),
        iso_seconds(begin + F.expr("interval '23:59:59' hour to second"), "+00:00").alias("until"),
    )


def chunked_windows(days: DataFrame, n_chunks: int) -> DataFrame:
    """Split each ``(query, day)`` into equal chunks, each ending a second before the next.

    Chunk bounds may fall between seconds; like the crawl's clock they are cut to the second.
    """
    if n_chunks < 1:
        raise ValueError("n_chunks must be positive")
    length = 86_400_000_000 / n_chunks
    begin = F.col("day").cast("timestamp_ntz")

    def at(i: Column, shift: float) -> Column:
        micros = F.round(i * F.lit(length) + F.lit(shift)).cast("bigint")
        return begin + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (micros / F.lit(1_000_000)).cast("decimal(18,6)"))

    chunks = days.select("query", "day", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))).alias("chunk"))
    return chunks.select(
        "query",
        "chunk",
        iso_seconds(at(F.col("chunk"), 0.0)).alias("since"),
        iso_seconds(at(F.col("chunk") + 1, -1_000_000.0)).alias("until"),
    )


def next_cursor(page_min: Column, kind: str = "counts") -> Column:
    """Upper bound of the next older page: 5 s (counts) or 1 µs (posts) before the earliest post."""
    step = {"counts": "interval 5 seconds", "posts": "interval 1 microsecond"}[kind]
    return page_min - F.expr(step)
