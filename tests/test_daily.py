import json
from datetime import date, timedelta

import pytest

from signalflow.config import FRANCE, GERMANY, Calendar, DailyJob, ForecastSpec, language_spec
from signalflow.plans.daily import ingest_pages, run_daily

START = date(2024, 1, 1)
DAYS = 140
FR = "J'ai de la fièvre, je tousse, courbatures"
DE = "Ich habe Fieber, Husten und Kopfschmerzen"


def land(landing, keyword, day, posts):
    folder = landing / "posts" / f"keyword={keyword}" / f"day={day}"
    folder.mkdir(parents=True, exist_ok=True)
    with (folder / "pages.json").open("a") as f:
        f.write(json.dumps({"page_id": f"{keyword}{day}", "posts": posts}) + "\n")


def post(uri, day, text, langs):
    return {"uri": uri, "record": {"text": text, "createdAt": f"{day}T10:00:00Z", "langs": langs}}


def who(landing, countries):
    lines = ["ISO_WEEKSTARTDATE,COUNTRY_CODE,AGEGROUP_CODE,ILI_CASE,ILI_POP_COV,ARI_CASE,ARI_POP_COV,COMMENTS"]
    lines += [f"{START + timedelta(days=7 * w)},{c},All,{10 + w % 5},1000,{w},1000," for c in countries for w in range(20)]
    (landing / "who_fluid.csv").write_text("\n".join(lines) + "\n")


@pytest.fixture
def job(tmp_path):
    specs = (language_spec("fr", "FRA"), language_spec("de", "DEU", target="ari_incidence", model="ridge"))
    calendar = Calendar(START, START + timedelta(days=DAYS - 1), date(2023, 12, 31))
    (tmp_path / "landing").mkdir()
    return DailyJob(str(tmp_path / "landing"), str(tmp_path / "store"), specs, calendar, ForecastSpec(n_splits=4, max_train=20))


def test_nightly_run_of_two_specs(spark, tmp_path, job):
    landing, store = tmp_path / "landing", tmp_path / "store"
    for n in range(DAYS):
        day = START + timedelta(days=n)
        made = 1 + (n // 7) % 3
        shared = [post(f"shared{n}-{i}", day, FR, ["fr"]) for i in range(made)]
        land(landing, "grippe", day, shared + [post(f"mixed{n}", day, FR, ["fr", "en"])])
        land(landing, "fievre", day, shared[:1])  # also found by another keyword
        land(landing, "travail", day, [post(f"work{n}", day, "au travail", ["fr"])])
        land(landing, "Fieber", day, [post(f"de{n}-{i}", day, DE, ["de"]) for i in range(1 + (n // 7) % 2)])
        land(landing, "Auto", day, [post(f"auto{n}", day, "Auto", ["de"])])
    who(landing, ("FRA", "DEU"))
    last = START + timedelta(days=DAYS - 1)
    run_daily(spark, job, START, last, model=None)
    posts = spark.read.parquet(f"{store}/posts")
    stored = posts.count()
    run_daily(spark, job, last, model=None)  # one day again: nothing changes
    posts = spark.read.parquet(f"{store}/posts")
    assert posts.count() == stored == spark.read.parquet(f"{store}/counts").groupBy().sum("post_count").first()[0]
    assert posts.groupBy("uri").count().filter("count = 2").count() == DAYS
    hints = spark.read.parquet(f"{store}/hints")
    assert hints.count() == hints.select("uri").distinct().count()
    weekly = spark.read.parquet(f"{store}/signals/weekly")
    assert weekly.groupBy("series_id").count().filter("count = 20").count() == 2
    assert weekly.filter("symptom_posts is null or control_posts is null or ili_incidence is null").count() == 0
    labelled = spark.read.parquet(f"{store}/signals/labelled").toPandas()
    # a post that two keywords found is one labelled post; those in two languages aren't of exactly one
    first = labelled.sort_values("date").groupby("series_id").first()
    assert first.llm_post_count.to_dict() == {"fr": 7, "de": 7}
    assert first.symptom_posts.to_dict() == {"fr": 7 + 7 + 7, "de": 7}
    daily = spark.read.parquet(f"{store}/signals/daily")
    assert daily.count() == 2 * DAYS and {r[0] for r in daily.select("target").distinct().collect()} == {"ili_incidence"}
    run_daily(spark, job, last)
    for series, top in (("fr", 14 / 1000), ("de", 19 / 1000)):
        result = spark.read.option("header", True).csv(f"{store}/results/{series}").selectExpr("double(target)", "double(cv_preds)", "double(abs_diff)")
        assert result.count() == 20 and result.filter("cv_preds is not null").count() == 4
        # all columns are per 100,000
        assert abs(result.agg({"target": "max"}).first()[0] - top * 100_000) < 1e-6
        assert result.agg({"cv_preds": "min"}).first()[0] > 100


def test_specs_with_own_targets_and_kinds_in_one_run_equal_single_runs(spark, tmp_path):
    """Two series of one kind and one of another kind, each with its own target, in as many runs as there are kinds."""
    from dataclasses import replace

    from signalflow.operators.features import calendar_features
    from signalflow.plans.daily import forecast_specs

    rows = [
        (s, c, START + timedelta(days=7 * i), 0.001 * (10 + i % 5 + k), 0.002 * (8 + (i * (k + 2)) % 7), 30 + (i * 7 + k) % 11, 90)
        for k, (s, c) in enumerate((("fr", "FRA"), ("de", "DEU"), ("en", "GBR"))) for i in range(30)
    ]
    weekly = spark.createDataFrame(rows, "series_id string, country_code string, date date, ili_incidence double, ari_incidence double, symptom_posts long, control_posts long")
    weekly = calendar_features(weekly).drop("season")
    specs = (replace(FRANCE, model=None), replace(GERMANY, model=None), replace(FRANCE, series_id="en", lang="en", target="ari_incidence", model="gbt_restricted"))
    calendar = Calendar(START, START, date(2023, 12, 31))

    def run(name, chosen):
        job = DailyJob("", str(tmp_path / name), chosen, calendar, ForecastSpec(n_splits=4, max_train=20))
        forecast_specs(weekly, job, "ridge", {"iterations": 5, "min_leaf": 3, "repeats": 2}, {"repeats": 2})
        tables = {}
        for s in chosen:
            for kind in ("", "_featureimp"):
                read = spark.read.option("header", True).csv(str(tmp_path / name / "results" / f"{s.series_id}{kind}"))
                tables[s.series_id + kind] = sorted(map(str, read.collect()))
        return tables

    together = run("all", specs)
    alone = {}
    for s in specs:
        alone |= run(s.series_id, (s,))
    assert together == alone
    assert all(len(together[s]) == 30 for s in ("fr", "de", "en"))
    assert {r.split("lang='")[1][:2] for s in ("fr", "de", "en") for r in together[s]} == {"fr", "de", "en"}


def test_only_the_days_folders_are_read(spark, tmp_path, job):
    for n in range(6):
        day = START + timedelta(days=n)
        land(tmp_path / "landing", "grippe", day, [post(f"u{n}", day, FR, ["fr"])])
    (tmp_path / "landing" / "posts" / "keyword=grippe" / "day=2024-01-06" / "broken.json").write_text("not read")
    got = ingest_pages(spark, job, START + timedelta(days=1))
    assert [r.uri for r in got.collect()] == ["u1"]
    from signalflow.sources.pages import read_post_pages

    plan = read_post_pages(spark, f"{job.landing}/posts", days=(START, START))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_nothing_of_exactly_the_language(spark, tmp_path, job):
    land(tmp_path / "landing", "grippe", START, [post("a", START, FR, ["fr", "en"])])
    who(tmp_path / "landing", ("FRA", "DEU"))
    run_daily(spark, job, START, model=None)
    assert spark.read.parquet(f"{job.store}/signals/labelled").filter("llm_post_count > 0").count() == 0


def test_empty_landing_is_no_error(spark, tmp_path, job):
    land(tmp_path / "landing", "grippe", START, [])
    run_daily(spark, job, START)
    assert not (tmp_path / "store" / "signals").exists()


def test_failed_posts_are_tried_again_without_reading_all_posts(spark, tmp_path, job):
    landing, store = tmp_path / "landing", tmp_path / "store"
    who(landing, ("FRA", "DEU"))
    for n in range(3):
        day = START + timedelta(days=n)
        land(landing, "grippe", day, [post(f"u{n}", day, FR if n else "broken " + FR, ["fr"])])
    asked = []

    def fn(text):
        if text.startswith("broken"):
            raise RuntimeError("down")
        return {"ili_related": True, "symptoms": []}

    for n in range(3):
        run_daily(spark, job, START + timedelta(days=n), fn=fn, model=None)
        asked.append({(r.uri, r.tries) for r in spark.read.parquet(f"{store}/pending").collect()})
    # a day's pages reach into its neighbours, so the first post is met again on the second day, and stands in the ledger once
    assert asked == [{("u0", 1)}, {("u0", 2)}, {("u0", 3)}]
    assert {r.uri for r in spark.read.parquet(f"{store}/hints").collect()} == {"u1", "u2"}
