"""The nightly batch as one driver function over Spark jobs.

One run covers every keyword and language at once, and a day, a range of days, or a
whole backfill: which landed pages are read is a filter on their partition.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalflow.config import DailyJob
from signalflow.operators.annotate import annotate, hint_rows, rule_annotation
from signalflow.operators.counts import daily_counts
from signalflow.operators.features import calendar_features
from signalflow.operators.posts import LEDGER_COLUMNS, due, enqueued, settled
from signalflow.plans import signals
from signalflow.plans.forecast import run_forecast
from signalflow.session import written
from signalflow.sources import sinks
from signalflow.sources.pages import read_post_pages, staged_posts
from signalflow.sources.surveillance import read_who

HINT_COLUMNS = "uri string, ili_related boolean, symptoms string"
POST_COLUMNS = "uri string, record__created_at timestamp_ntz, record__text string, record__langs string, keyword string"
COUNT_COLUMNS = "period_start date, langs string, query string, post_count bigint"


def ingest_pages(spark: SparkSession, job: DailyJob, start: date, end: date | None = None) -> DataFrame:
    """Count fact and post table from the pages landed for ``start..end`` (one day without ``end``).

    Pages lie below ``landing/posts/keyword=<kw>/day=<date>/``; only the folders of these days are read.
    """
    last = end or start
    # a page is landed on the day of its posts, or on the next where it reaches over midnight
    pages = read_post_pages(spark, f"{job.landing}/posts", days=(start - timedelta(days=1), last + timedelta(days=1)))
    day = F.to_date("event_time")
    posts = written(pages.filter(day.between(F.lit(str(start)).cast("date"), F.lit(str(last)).cast("date"))), "posts")
    sinks.upsert_counts(spark, f"{job.store}/counts", daily_counts(posts))
    sinks.upsert_posts(spark, f"{job.store}/posts", staged_posts(posts), order="record__created_at")
    return posts


def annotate_pending(spark: SparkSession, job: DailyJob, posts: DataFrame, fn: Callable[[str], dict] | None = None) -> None:
    """Label the night's ``posts`` and what is left in the ledger: by rules, or by the caller's function.

    The ledger at ``store/pending`` holds the posts that wait, so neither all stored posts nor all labels are read. A
    post whose label failed is tried again in the next nights; labels are stored before the ledger lets a post go.
    """
    path, ledger = f"{job.store}/hints", f"{job.store}/pending"
    waiting = sinks.read_table(spark, ledger, LEDGER_COLUMNS)
    new = posts.select("uri", "record__text", "record__langs")
    waiting = written(enqueued(waiting, new, sinks.hints_of(spark, path, new, HINT_COLUMNS)), "pending")
    todo = due(waiting, sorted({s.lang for s in job.specs}))
    labels = annotate(todo, fn) if fn else rule_annotation(todo).withColumn("error", F.lit(None).cast("string"))
    labels = written(labels, "labels")
    sinks.upsert_hints(spark, path, hint_rows(labels))
    sinks.replace(settled(waiting, labels), ledger)


def ingest_cases(spark: SparkSession, job: DailyJob, schema: str | None = None) -> None:
    cases = read_who(spark, f"{job.landing}/who_fluid.csv", "fluid", schema, lower=True)
    sinks.replace(cases, f"{job.store}/who_fluid")


def build_signals(spark: SparkSession, job: DailyJob) -> None:
    """Weekly, daily and label-filtered signal tables, each of all specs in one job, partitioned by series."""
    counts = sinks.read_table(spark, f"{job.store}/counts", COUNT_COLUMNS)
    cases = spark.read.parquet(f"{job.store}/who_fluid")
    posts = sinks.read_table(spark, f"{job.store}/posts", POST_COLUMNS)
    hints = sinks.read_table(spark, f"{job.store}/hints", HINT_COLUMNS)
    base = f"{job.store}/signals"
    weekly = signals.weekly_signals(counts, cases, job.specs, job.calendar)
    sinks.replace(weekly, f"{base}/weekly", ("series_id",))
    weekly = spark.read.parquet(f"{base}/weekly")
    sinks.replace(signals.daily_signals(counts, weekly, job.specs, job.calendar), f"{base}/daily", ("series_id",))
    sinks.replace(signals.labelled_weeklies(posts, hints, job.specs, weekly), f"{base}/labelled", ("series_id",))


def run_daily(
    spark: SparkSession,
    job: DailyJob,
    start: date,
    end: date | None = None,
    fn: Callable[[str], dict] | None = None,
    case_schema: str | None = None,
    model: str | None = "ridge",
    spec_params: dict | None = None,
    **model_params,
) -> None:
    """Counts and posts, labels, cases, signals, forecast. Running it again for the same days changes nothing.

    A range of days is a backfill: rows of those days replace what is stored. Each spec is forecast
    with its own target and kind of model; ``model`` and ``model_params`` are for specs that name none,
    ``spec_params`` for those that do.
    """
    posts = ingest_pages(spark, job, start, end)
    if posts.isEmpty() and not sinks.table_exists(spark, f"{job.store}/posts"):
        return
    annotate_pending(spark, job, staged_posts(posts), fn)
    ingest_cases(spark, job, case_schema)
    build_signals(spark, job)
    if model is None:
        return
    weekly = calendar_features(spark.read.parquet(f"{job.store}/signals/weekly"))
    forecast_specs(weekly, job, model, spec_params or {}, model_params)


def forecast_specs(weekly: DataFrame, job: DailyJob, model: str, spec_params: dict, model_params: dict) -> None:
    """Forecast all specs of one kind of model in the same jobs, each with its own target, and export one table a spec.

    Only what differs in its settings is a run of its own: the kind of model, whose parameters hold, and whether
    the target is an incidence, which is forecast per 100,000.
    """
    alike: dict[tuple, list] = {}
    for spec in job.specs:
        alike.setdefault((spec.model or model, bool(spec.model), "incidence" in spec.target), []).append(spec)
    targets = {s.target for s in job.specs}
    by = ("series_id", "country_code")
    for (kind, own, incidence), specs in alike.items():
        target = "own_incidence" if incidence else "own_target"
        series = F.col("series_id")
        pick, lang = (F.coalesce(*[F.when(series == s.series_id, value(s)) for s in specs]) for value in (lambda s: F.col(s.target), lambda s: F.lit(s.lang)))
        rows = weekly.filter(series.isin([s.series_id for s in specs])).withColumn(target, pick)
        settings = replace(job.forecast, target=target, drop=tuple(sorted({*job.forecast.drop, *targets, target})))
        run = run_forecast(rows, by, settings, kind, lang, **(spec_params if own else model_params))
        result, importance = written(run.result, "forecast"), written(run.importance, "importance")
        for spec in specs:
            mine = series == spec.series_id
            sinks.export_forecast(result.filter(mine), importance.filter(mine), f"{job.store}/results", spec.series_id)
        sinks.replace(run.model.withColumn("kind", F.lit(kind)), f"{job.store}/models/{kind}_{target}", ("series_id",))
