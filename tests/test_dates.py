from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from signalflow.functions import dates
from signalflow.operators.spines import chunked_windows, daily_windows, date_spine, next_cursor


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    ("text", "iso", "legacy"),
    [
        ("2023-W01", date(2023, 1, 2), date(2023, 1, 2)),
        ("2024-W01", date(2024, 1, 1), date(2024, 1, 1)),
        ("2025-W01", date(2024, 12, 30), date(2025, 1, 6)),
        ("2020-W53", date(2020, 12, 28), date(2021, 1, 4)),
        ("bad", None, None),
        ("2023-W99", None, None),
        ("2021-W53", None, date(2022, 1, 3)),
    ],
)
def test_week_text(spark, text, iso, legacy):
    assert one(spark, dates.week_text_start(F.lit(text))) == iso
    assert one(spark, dates.week_text_start(F.lit(text), legacy=True)) == legacy


def test_legacy_weeks_follow_strptime(spark):
    texts = [(f"{y}-W{w:02d}", datetime.strptime(f"{y}-W{w}-1", "%Y-W%W-%w").date()) for y in range(2018, 2027) for w in range(54)]
    df = spark.createDataFrame([(t, d - timedelta(days=d.weekday())) for t, d in texts], "t string, d date")
    assert df.filter(~dates.week_text_start("t", legacy=True).eqNullSafe(F.col("d"))).count() == 0


def test_iso_week_number(spark):
    assert one(spark, dates.week_number_start(F.lit(202016))) == date(2020, 4, 13)
    assert one(spark, dates.week_number_start(F.lit(202053))) == date(2020, 12, 28)
    assert one(spark, dates.week_number_start(F.lit(202153))) is None


def test_week_bins(spark):
    days = [("2024-01-01 10:00:00", "2023-12-25"), ("2024-01-02 00:00:00", "2024-01-01"), ("2024-01-08 23:59:59", "2024-01-01"), ("2024-01-09 00:00:00", "2024-01-08")]
    for text, label in days:
        ts = F.lit(text).cast("timestamp_ntz")
        assert str(one(spark, dates.week_bucket(ts, "mon_left"))) == label
        assert one(spark, dates.week_bucket(ts, "mon_period")) == date.fromisoformat(label) + timedelta(days=1)
    assert one(spark, dates.week_bucket(F.lit("2024-01-07").cast("date"))) == date(2024, 1, 1)
    with pytest.raises(ValueError):
        dates.week_bucket("x", "sunday")


def test_mmwr_weeks(spark):
    def brute(day):
        sunday = day - timedelta(days=(day.weekday() + 1) % 7)
        year = (sunday + timedelta(days=3)).year
        jan4 = date(year, 1, 4)
        first = jan4 - timedelta(days=(jan4.weekday() + 1) % 7)
        return year, (sunday - first).days // 7 + 1, sunday

    days = [date(2014, 12, 20) + timedelta(days=i) for i in range(0, 4200)]
    df = spark.createDataFrame([(d, *brute(d)) for d in days], "d date, y int, w int, s date")
    got = df.filter(
        (dates.mmwr_year("d") != F.col("y")) | (dates.mmwr_week("d") != F.col("w")) | (dates.mmwr_week_start("y", "w") != F.col("s"))
    )
    assert got.count() == 0


def test_instants(spark):
    assert one(spark, dates.parse_instant(F.lit("2025-03-14T10:00:00Z"))) == datetime(2025, 3, 14, 10)
    assert one(spark, dates.parse_instant(F.lit("2025-03-14T10:00:00+02:00"))) == datetime(2025, 3, 14, 8)
    assert one(spark, dates.parse_instant(F.lit("yesterday"))) is None
    assert one(spark, dates.earliest_instant(F.lit("2025-03-14T10:00:00Z"), F.lit("2025-03-14T11:00:00+02:00"))) == datetime(2025, 3, 14, 9)
    assert one(spark, dates.earliest_instant(F.lit(None).cast("string"), F.lit("2025-03-14T10:00:00Z"))) == datetime(2025, 3, 14, 10)


def test_instants_do_not_depend_on_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert one(spark, dates.parse_instant(F.lit("2025-03-14T23:00:00Z"))) == datetime(2025, 3, 14, 23)
        back = dates.utc_time(dates.utc_instant(F.lit("2025-03-14 23:00:00").cast("timestamp_ntz")))
        assert one(spark, back) == datetime(2025, 3, 14, 23)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_spines(spark):
    days = [r.date for r in date_spine(spark, "2024-02-27", "2024-03-02").collect()]
    assert days == [date(2024, 2, 27) + timedelta(days=i) for i in range(5)]
    weeks = [r.date for r in date_spine(spark, "2023-08-01", "2023-08-14", "week").collect()]
    assert weeks == [date(2023, 7, 31), date(2023, 8, 7), date(2023, 8, 14)]


def test_daily_windows(spark):
    keywords = spark.createDataFrame([("grippe",)], "query string")
    got = [tuple(r) for r in daily_windows(keywords, "2025-03-14", "2025-03-15").collect()]
    assert got[0] == ("grippe", "2025-03-14T00:00:00+00:00", "2025-03-14T23:59:59+00:00")
    assert len(got) == 2


@pytest.mark.parametrize("n", [1, 2, 7, 24, 1000])
def test_chunks_cover_the_day(spark, n):
    days = spark.createDataFrame([("q", date(2025, 3, 14))], "query string, day date")
    got = sorted((r.chunk, r.since, r.until) for r in chunked_windows(days, n).collect())
    start = datetime(2025, 3, 14)
    for i, since, until in got:
        assert since == (start + timedelta(seconds=i * 86400 / n)).strftime("%Y-%m-%dT%H:%M:%SZ")
        assert until == (start + timedelta(seconds=(i + 1) * 86400 / n - 1)).strftime("%Y-%m-%dT%H:%M:%SZ")
    assert got[0][1] == "2025-03-14T00:00:00Z" and got[-1][2] == "2025-03-14T23:59:59Z"


def test_cursor(spark):
    t = F.lit("2025-03-14 10:00:00").cast("timestamp_ntz")
    assert one(spark, next_cursor(t)) == datetime(2025, 3, 14, 9, 59, 55)
    assert one(spark, next_cursor(t, "posts")) == datetime(2025, 3, 14, 9, 59, 59, 999999)
