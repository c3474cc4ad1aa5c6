"""Post counts per keyword, language and day, and their sums per keyword group."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalflow.config import KeywordGroup, SignalSpec
from signalflow.functions.dates import week_bucket
from signalflow.functions.text import joined, lang_matches
from signalflow.operators.spines import next_cursor
from signalflow.session import literal_rows

# Rows up to which a configuration table is broadcast; beyond it Catalyst chooses.
DIMENSION_BROADCAST_ROWS = 10_000

AGGREGATES: dict[str, Callable[[Column], Column]] = {
    "sum": F.sum,
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
    "count": F.count,
    "median": F.median,
    "std": F.stddev_samp,
}


def page_counts(posts: DataFrame) -> DataFrame:
    """Posts per page and joined language text, with the page's earliest time and next cursor.

    The page minimum is taken over the already counted (page, langs) rows, so the
    window sorts one row per language of a page, never the posts themselves.
    """
    per_lang = posts.groupBy("keyword", "page_id", joined("langs").alias("langs")).agg(
        F.count(F.lit(1)).alias("post_count"), F.min("event_time").alias("lang_min")
    )
    page = Window.partitionBy("keyword", "page_id")
    return (
        per_lang.withColumn("period_start", F.min("lang_min").over(page))
        .withColumn("next_until", next_cursor(F.col("period_start")))
        .drop("lang_min")
    )


def by_day(
    df: DataFrame,
    date_col: str = "period_start",
    agg: str | Callable[[Column], Column] = "sum",
    agg_col: str = "post_count",
    by: Sequence[str] = ("langs",),
) -> DataFrame:
    """Aggregate ``agg_col`` per day and ``by``; ``agg`` is a name or a Column function.

    The exact median keeps the distinct values of a group: page counts have at most a
    page's size of them. Do not ask for the median of a continuous column of a large table.
    """
    fn = AGGREGATES[agg] if isinstance(agg, str) else agg
    return df.groupBy(F.to_date(date_col).alias(date_col), *by).agg(fn(F.col(agg_col)).alias(agg_col))


def daily_counts(posts: DataFrame, attribution: str = "post") -> DataFrame:
    """Count fact ``(period_start, langs, query, post_count)`` of landed posts.

    ``post`` books every post on its own day; ``page_min`` books a whole page on
    the day of its earliest post.
    """
    if attribution == "page_min":
        return by_day(page_counts(posts), by=("langs", "keyword")).withColumnRenamed("keyword", "query")
    if attribution != "post":
        raise ValueError(f"unknown attribution {attribution!r}")
    return posts.groupBy(
        F.to_date("event_time").alias("period_start"), joined("langs").alias("langs"), F.col("keyword").alias("query")
    ).agg(F.count(F.lit(1)).alias("post_count"))


def dense_days(counts: DataFrame, keys: DataFrame, start, end) -> DataFrame:
    """A row for every configured key (query, langs) and day, 0 where no post was found."""
    days = F.sequence(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"), F.expr("interval 1 day"))
    grid = keys.select(*keys.columns, F.explode(days).alias("period_start"))
    return grid.join(counts, ["period_start", *keys.columns], "left").withColumn(
        "post_count", F.coalesce("post_count", F.lit(0).cast("bigint"))
    )


def _bucket(unit: str, anchor: str) -> Column:
    return F.to_date("period_start") if unit == "day" else week_bucket("period_start", anchor)


def group_counts(
    counts: DataFrame,
    groups: Sequence[KeywordGroup],
    lang: str,
    unit: str = "week",
    match: str = "contains",
    anchor: str = "iso",
) -> DataFrame:
    """One row per bucket, one column per keyword group, NULL where a group has no row.

    All groups come from one scan: the union of their keywords and the language
    are filters on the scan, the split into groups is a conditional sum.
    """
    keywords = sorted({k for g in groups for k in g.keywords})
    rows = counts.filter(F.col("query").isin(keywords) & lang_matches("langs", lang, match))
    return rows.groupBy(_bucket(unit, anchor).alias("date")).agg(
        *[F.sum(F.when(F.col("query").isin(*g.keywords), F.col("post_count"))).alias(g.column) for g in groups]
    )


def group_counts_for_specs(
    counts: DataFrame,
    specs: Sequence[SignalSpec],
    unit: str = "week",
    anchor: str = "iso",
    names: tuple[str, str] = ("symptom_posts", "control_posts"),
) -> DataFrame:
    """``group_counts`` for many series in one job: ``(series_id, date, *names)``.

    Groups are summed by their role in the spec, whatever their own column names; a keyword that is
    listed twice counts once. The counts are read once, filtered to the configured keywords, and
    summed to (keyword, languages, bucket) before they meet the specs.
    """
    rows = sorted(
        {(s.series_id, s.lang, s.lang_match, role, k) for s in specs for role, g in zip(("symptom", "control"), s.groups) for k in g.keywords}
    )
    dim = literal_rows(counts.sparkSession, ("series_id", "lang", "lang_match", "role", "query"), rows)
    if len(rows) <= DIMENSION_BROADCAST_ROWS:
        dim = F.broadcast(dim)
    hit = F.when(F.col("lang_match") == "exact", F.col("langs") == F.col("lang")).otherwise(F.contains(F.col("langs"), F.col("lang")))
    wanted = counts.filter(F.col("query").isin(sorted({r[4] for r in rows})))
    summed = wanted.groupBy("query", "langs", _bucket(unit, anchor).alias("date")).agg(F.sum("post_count").alias("post_count"))
    roles = [F.sum(F.when(F.col("role") == r, F.col("post_count"))).alias(n) for r, n in zip(("symptom", "control"), names)]
    return summed.join(dim, "query").filter(hit).groupBy("series_id", "date").agg(*roles)


def unmatched_keywords(counts: DataFrame, specs: Sequence[SignalSpec]) -> DataFrame:
    """Configured keywords that never occur in the counts (misspelt or not crawled)."""
    rows = [(s.series_id, g.column, k) for s in specs for g in s.groups for k in g.keywords]
    configured = literal_rows(counts.sparkSession, ("series_id", "grp", "query"), rows)
    return configured.join(counts.select("query").distinct(), "query", "left_anti")


def resample(
    df: DataFrame, ts_col: str, measures: dict[str, Column], by: Sequence[str] = (), anchor: str = "mon_left"
) -> DataFrame:
    """Aggregate into 7-day bins labelled ``date``; missing bins between are not added."""
    return df.groupBy(*by, week_bucket(ts_col, anchor).alias("date")).agg(*[m.alias(n) for n, m in measures.items()])


def window_gaps(pages: DataFrame, tolerance: str = "5 seconds") -> DataFrame:
    """Completeness of a crawl: pages run from newest to oldest, each must reach up to what the newer ones cover.

    ``pages`` has ``keyword, page_id, period_start, period_end``. A page is ``complete`` if its upper bound lies within
    ``tolerance`` of the earliest post of all newer pages, so a wide page covers the holes between narrower ones. The
    crawl works in windows of one keyword and day, so chains start anew every day.
    """
    newest_first = Window.partitionBy("keyword", F.to_date("period_end")).orderBy(F.col("period_end").desc(), "page_id")
    newer = F.min("period_start").over(newest_first.rowsBetween(Window.unboundedPreceding, -1))
    return pages.select(
        "keyword",
        "page_id",
        "period_start",
        "period_end",
        newer.alias("newer_start"),
        F.coalesce(F.col("period_end") >= newer - F.expr(f"interval {tolerance}"), F.lit(True)).alias("complete"),
    )


def crawl_gaps(pages: DataFrame, wanted: DataFrame, tolerance: str = "5 seconds") -> DataFrame:
    """Windows to crawl again, ``(keyword, window_start, window_end)``: what no page covers of the wanted ones.

    ``pages`` has ``keyword, period_start, period_end`` and may overlap in any way; ``wanted`` has ``keyword,
    window_start, window_end``, windows within one day. Pages are cut at midnight, so that a group is the pages of a keyword
    and day; in order of their start, a gap opens where a page starts behind all ends so far. Gaps up to ``tolerance``
    count as covered. A page without both times covers nothing.
    """
    day = F.explode(F.sequence(F.to_date("period_start"), F.to_date("period_end"))).alias("day")
    cut = pages.filter("period_start <= period_end").select("keyword", "period_start", "period_end", day)
    kind = dict(pages.dtypes)["period_start"]
    midnight = F.col("day").cast(kind)
    cut = cut.select(
        "keyword", "day", F.greatest("period_start", midnight).alias("start"), F.least("period_end", midnight + F.expr("interval 1 day")).alias("end")
    )
    windows = wanted.select("keyword", F.to_date("window_start").alias("day"), *[F.col(c).cast(kind).alias(c) for c in ("window_start", "window_end")])
    inside = windows.join(cut, ["keyword", "day"]).filter("start <= window_end and end >= window_start")
    # an empty page at the end of each window closes it
    closing = windows.withColumns({"start": F.col("window_end"), "end": F.col("window_end")})
    window = ("keyword", "day", "window_start", "window_end")
    before = Window.partitionBy(*window).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.greatest("window_start", F.max("end").over(before)), F.col("window_start"))
    gaps = inside.select(*window, "start", "end").unionByName(closing.select(*window, "start", "end")).withColumn("reached", reached)
    gaps = gaps.filter(F.col("start") > F.col("reached") + F.expr(f"interval {tolerance}"))
    return gaps.select("keyword", F.col("reached").alias("window_start"), F.col("start").alias("window_end"))
