import random
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from signalflow.config import FRANCE, GERMANY, KeywordGroup
from signalflow.operators import counts as ops

GROUPS = (KeywordGroup("ili", ("grippe", "rhume")), KeywordGroup("control", ("travail",)))


@pytest.fixture(scope="module")
def posts(spark):
    data = [
        ("u1", datetime(2024, 1, 2, 0, 10), ["fr"], "grippe", "p1"),
        ("u2", datetime(2024, 1, 1, 23, 50), ["fr", "de"], "grippe", "p1"),
        ("u3", datetime(2024, 1, 2, 0, 20), ["fr"], "grippe", "p1"),
        ("u4", datetime(2024, 1, 3, 1, 0), [], "rhume", "p2"),
        ("u5", datetime(2024, 1, 3, 2, 0), None, "rhume", "p2"),
    ]
    return spark.createDataFrame(data, "uri string, event_time timestamp_ntz, langs array<string>, keyword string, page_id string")


def test_daily_counts_per_post(posts, rows):
    got = rows(ops.daily_counts(posts), "period_start", "langs", "query", "post_count")
    assert got == [
        (date(2024, 1, 1), "fr,de", "grippe", 1), (date(2024, 1, 2), "fr", "grippe", 2), (date(2024, 1, 3), "", "rhume", 2),
    ]


def test_daily_counts_per_page(posts, rows):
    got = rows(ops.daily_counts(posts, "page_min"), "period_start", "langs", "query", "post_count")
    assert got == [
        (date(2024, 1, 1), "fr", "grippe", 2), (date(2024, 1, 1), "fr,de", "grippe", 1), (date(2024, 1, 3), "", "rhume", 2),
    ]
    with pytest.raises(ValueError):
        ops.daily_counts(posts, "random")


@pytest.fixture(scope="module")
def fact(spark):
    data = [
        (date(2024, 1, 2), "fr", "grippe", 1), (date(2024, 1, 3), "fr,de", "grippe", 2), (date(2024, 1, 9), "fr", "travail", 5),
        (date(2024, 1, 9), "de", "grippe", 7), (date(2024, 1, 10), "fr", "unknown", 9),
    ]
    return spark.createDataFrame(data, "period_start date, langs string, query string, post_count bigint")


def test_weeks_are_grouped_by_expression(fact, rows):
    assert rows(ops.group_counts(fact, GROUPS, "fr"), "date", "ili", "control") == [
        (date(2024, 1, 1), 3, None), (date(2024, 1, 8), None, 5),
    ]


def test_exact_language(fact, rows):
    assert rows(ops.group_counts(fact, GROUPS, "fr", match="exact"), "date", "ili", "control")[0] == (date(2024, 1, 1), 1, None)
    with pytest.raises(ValueError):
        ops.group_counts(fact, GROUPS, "fr", match="like")


def test_specs_in_one_job_equal_single_jobs(fact, rows):
    both = ops.group_counts_for_specs(fact, (FRANCE, GERMANY), names=("grippe_posts", "rest_posts"))
    for spec in (FRANCE, GERMANY):
        mine = both.filter(F.col("series_id") == spec.series_id)
        assert rows(mine, "date", "grippe_posts", "rest_posts") == rows(
            ops.group_counts(fact, spec.groups, spec.lang), "date", "grippe_posts", "rest_posts"
        )


def test_unmatched_keywords(fact, rows):
    got = {(r.series_id, r.query) for r in ops.unmatched_keywords(fact, (FRANCE,)).collect()}
    assert ("fr", "voitures") in got and ("fr", "grippe") not in got and ("fr", "travail") not in got


def test_zero_rows(fact, spark, rows):
    keys = spark.createDataFrame([("grippe", "fr")], "query string, langs string")
    got = rows(ops.dense_days(fact, keys, "2024-01-01", "2024-01-03"), "period_start", "post_count")
    assert got == [(date(2024, 1, 1), 0), (date(2024, 1, 2), 1), (date(2024, 1, 3), 0)]


def test_pluggable_aggregate(fact, rows):
    assert rows(ops.by_day(fact, agg="max"), "period_start", "langs", "post_count")[0] == (date(2024, 1, 2), "fr", 1)
    spread = ops.by_day(fact, agg=lambda c: F.max(c) - F.min(c), by=())
    assert (date(2024, 1, 9), 2) in rows(spread, "period_start", "post_count")
    with pytest.raises(KeyError):
        ops.by_day(fact, agg="mode")


def test_window_gaps(spark, rows):
    data = [
        ("g", "p1", datetime(2024, 1, 1, 20), datetime(2024, 1, 1, 23, 59, 59)),
        ("g", "p2", datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 19, 59, 55)),
        ("g", "p3", datetime(2024, 1, 1, 5), datetime(2024, 1, 1, 9, 0)),
    ]
    pages = spark.createDataFrame(data, "keyword string, page_id string, period_start timestamp_ntz, period_end timestamp_ntz")
    assert rows(ops.window_gaps(pages), "page_id", "complete") == [("p1", True), ("p2", True), ("p3", False)]


def test_wide_page_covers_holes_between_narrow_ones(spark):
    at = lambda h: datetime(2024, 1, 1, h)
    pages = [("k", "wide", at(0), at(10)), ("k", "late", at(5), at(8)), ("k", "early", at(1), at(4)), ("k", "gone", at(12), at(13))]
    df = spark.createDataFrame(pages, "keyword string, page_id string, period_start timestamp_ntz, period_end timestamp_ntz")
    assert {r.page_id: r.complete for r in ops.window_gaps(df).collect()} == {"gone": True, "wide": False, "late": True, "early": True}


def test_crawl_gaps_by_the_minute(spark):
    rng = random.Random(5)
    begin = datetime(2024, 1, 1)
    pages, covered = [], {k: np.zeros(3 * 1440 + 1, bool) for k in "ab"}
    for _ in range(60):
        k, s = rng.choice("ab"), rng.randrange(3 * 1440 - 1)
        e = min(s + rng.choice([0, 5, 40, 300]), 3 * 1440 - 1)
        pages.append((k, begin + timedelta(minutes=s), begin + timedelta(minutes=e)))
        covered[k][s:e] = True
    pages += [("a", None, begin), ("other", begin, begin + timedelta(days=1))]
    df = spark.createDataFrame(pages, "keyword string, period_start timestamp_ntz, period_end timestamp_ntz")
    wanted = [(k, begin + timedelta(days=d), begin + timedelta(days=d + 1, minutes=-1)) for k in ("a", "b", "none") for d in range(3)]
    windows = spark.createDataFrame(wanted, "keyword string, window_start timestamp_ntz, window_end timestamp_ntz")
    got = {(r.keyword, r.window_start, r.window_end) for r in ops.crawl_gaps(df, windows, "0 seconds").collect()}
    want = set()
    for k, lo, hi in wanted:
        first, last = (int((t - begin).total_seconds() // 60) for t in (lo, hi))
        open_ = None
        # a page without length also ends a gap and begins another
        points = {int((s - begin).total_seconds() // 60) for kk, s, e in pages if kk == k and s == e and s is not None}
        for m in range(first, last + 1):
            free = m < last and not covered.get(k, np.zeros(3 * 1440 + 1, bool))[m]
            if open_ is not None and (not free or m in points) and m > open_:
                want.add((k, begin + timedelta(minutes=open_), begin + timedelta(minutes=m)))
                open_ = None
            if free and open_ is None:
                open_ = m
    assert got == want
