from datetime import date, datetime

import pytest

from signalflow.config import FRANCE, Calendar, KeywordGroup
from signalflow.operators.align import aligned_frame, aligned_sum, duplicated_keys, zero_filled
from signalflow.plans import signals

CAL = Calendar(date(2023, 8, 1), date(2023, 9, 10), date(2023, 8, 1))
W = [date(2023, 7, 31), date(2023, 8, 7), date(2023, 8, 14), date(2023, 8, 21), date(2023, 8, 28), date(2023, 9, 4)]


@pytest.fixture(scope="module")
def cases(spark):
    data = [
        ("FRA", "All", W[1], 10.0, 100.0, 1.0, 10.0), ("FRA", "All", W[2], None, 100.0, 1.0, 10.0), ("FRA", "All", W[4], 40.0, 100.0, 2.0, 10.0),
        ("FRA", "0-4", W[1], 99.0, 100.0, 9.0, 10.0), ("DEU", "ALL", W[1], 5.0, 0.0, 1.0, 9.0),
    ]
    return spark.createDataFrame(
        data, "country_code string, agegroup_code string, iso_weekstartdate date, ili_case double, ili_pop_cov double, ari_case double, ari_pop_cov double"
    )


@pytest.fixture(scope="module")
def counts(spark):
    data = [(date(2023, 8, 8), "fr", "grippe", 3), (date(2023, 8, 9), "fr", "rhume", 1), (date(2023, 8, 10), "fr", "travail", 5), (date(2023, 8, 15), "fr", "grippe", 2)]
    return spark.createDataFrame(data, "period_start date, langs string, query string, post_count bigint")


def test_weekly_incidence(cases, rows):
    got = rows(signals.weekly_incidence(cases, CAL.start, CAL.end, ("FRA",)), "iso_weekstartdate", "ili_incidence", "ili_case")
    assert [(d, None if v is None else round(v, 9), c) for d, v, c in got] == [
        (W[0], None, None), (W[1], 0.1, 10.0), (W[2], 0.2, None), (W[3], 0.3, None), (W[4], 0.4, 40.0), (W[5], None, None),
    ]


def test_all_countries_equal_listed(cases, rows):
    every = signals.weekly_incidence(cases, CAL.start, CAL.end, smoothing=1.0)
    listed = signals.weekly_incidence(cases, CAL.start, CAL.end, ("FRA", "DEU"), smoothing=1.0)
    assert rows(every) == rows(listed)


def test_zero_population_and_smoothing(cases, rows):
    plain = signals.weekly_incidence(cases, CAL.start, CAL.end, ("DEU",)).filter("ili_case is not null").first()
    assert plain.ili_incidence is None
    smooth = signals.weekly_incidence(cases, CAL.start, CAL.end, ("DEU",), smoothing=1.0).filter("ili_case is not null").first()
    assert smooth.ili_incidence == 5.0 and smooth.ari_incidence == 0.1


def test_weekly_signal_keeps_null_counts(cases, counts, rows):
    weekly = signals.weekly_incidence(cases, CAL.start, CAL.end, ("FRA",))
    got = rows(signals.weekly_signal(counts, weekly, FRANCE, CAL), "date", "grippe_posts", "rest_posts", "norm_post_count")
    assert got == [(W[1], 4, 5, 0.4), (W[2], 2, None, 0.0), (W[3], None, None, 0.0), (W[4], None, None, 0.0), (W[5], None, None, 0.0)]


def test_daily_signal_is_zero_filled(cases, counts, rows):
    weekly = signals.weekly_incidence(cases, CAL.start, CAL.end, ("FRA",))
    daily = signals.daily_incidence(weekly, CAL.start, CAL.end)
    got = {r.date: r for r in signals.daily_signal(counts, daily, FRANCE, CAL).collect()}
    assert len(got) == 40 and min(got) == date(2023, 8, 2)
    assert got[date(2023, 8, 8)].grippe_posts == 3 and got[date(2023, 8, 8)].rest_posts == 0
    assert got[date(2023, 8, 8)].norm_post_count == 0.75
    assert got[date(2023, 8, 2)].ili_incidence == 0.0  # before the first known week
    assert round(got[date(2023, 8, 8)].ili_incidence, 9) == round(0.1 + 0.1 / 7, 9)
    assert got[date(2023, 9, 9)].ili_incidence == 0.0


def test_specs_job_equals_single(cases, counts, rows):
    single = signals.weekly_signal(counts, signals.weekly_incidence(cases, CAL.start, CAL.end, ("FRA",)), FRANCE, CAL)
    many = signals.weekly_signals(counts, cases, (FRANCE,), CAL, ("grippe_posts", "rest_posts"))
    assert rows(many.drop("series_id"), *single.columns) == rows(single)


def test_zero_filled_signal_has_a_row_per_age_group(cases, counts, rows):
    got = signals.zero_filled_signal(counts, cases, FRANCE, CAL)
    assert duplicated_keys(got, ["date"]).first().date == W[1]
    one = signals.zero_filled_signal(counts, cases, FRANCE, CAL, FRANCE.age_codes)
    first = rows(one, "date", "ili_case", "grippe_posts", "rest_posts", "norm_post_count")[0]
    assert first == (W[1], 10.0, 4, 5, 4 / 9)
    assert rows(one, "date", "norm_post_count")[2] == (W[3], 0.0)


def test_labelled_weekly(spark, cases, counts, rows):
    t = datetime(2023, 8, 9, 12)
    posts = spark.createDataFrame(
        [("a", t, "x", "fr"), ("a", t, "edited", "fr"), ("b", t, "y", "fr,de"), ("c", t, "z", "de")],
        "uri string, record__created_at timestamp_ntz, record__text string, record__langs string",
    )
    hints = spark.createDataFrame([("a", True), ("b", True), ("c", True)], "uri string, ili_related boolean")
    weekly = signals.weekly_signal(counts, signals.weekly_incidence(cases, CAL.start, CAL.end, ("FRA",)), FRANCE, CAL)
    got = rows(signals.labelled_weekly(posts, hints, "fr", weekly), "date", "llm_post_count")
    assert got == [(W[1], 2), (W[2], 0), (W[3], 0), (W[4], 0), (W[5], 0)]
    control = signals.control_counts(counts, FRANCE, CAL)
    row = signals.labelled_signal(posts, hints, cases, control, FRANCE, CAL).orderBy("date").first()
    assert (row.date, row.ili_rel_posts, row.rest_posts, row.norm_post_count) == (W[1], 2, 5, 2 / 7)
    assert row.ili_incidence == 10.0 / 101


def test_aligned_sum_and_frame(spark, rows):
    a = spark.createDataFrame([(W[0], 1), (W[1], 2)], "date date, v bigint")
    b = spark.createDataFrame([(W[1], 5), (W[2], 7)], "date date, v bigint")
    assert rows(aligned_sum(a, b, "date", "v"), "date", "v") == [(W[0], 0), (W[1], 7), (W[2], 0)]
    frame = aligned_frame(a.select("date"), {"x": (a, "v"), "y": (b, "v")})
    assert rows(frame) == [(W[0], 1, None), (W[1], 2, 5)]
    assert rows(zero_filled(frame, ["y"]), "y") == [(0,), (5,)]


def test_specs_with_other_group_names_and_repeated_keywords(spark, counts, cases):
    from dataclasses import replace as change

    odd = change(FRANCE, series_id="odd", symptom=KeywordGroup("other_name", (*FRANCE.symptom.keywords, FRANCE.symptom.keywords[0])))
    got = signals.weekly_signals(counts, cases, (FRANCE, odd), CAL)
    by_series = {s: sorted(tuple(r) for r in got.filter(f"series_id = '{s}'").select("date", "symptom_posts", "control_posts", "norm_post_count").collect()) for s in ("fr", "odd")}
    assert by_series["fr"] == by_series["odd"] and any(r[1] for r in by_series["fr"])
