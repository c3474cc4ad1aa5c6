"""The composite queries: case series, post series, and their join on one date axis.

Every function returns one lazy plan. Frames with a ``by`` argument hold many
series (countries, languages) at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalflow.config import Calendar, KeywordGroup, SignalSpec
from signalflow.functions.dates import iso_week
from signalflow.functions.rates import incidence, share
from signalflow.operators.align import on_spine
from signalflow.operators.counts import DIMENSION_BROADCAST_ROWS, group_counts, group_counts_for_specs
from signalflow.operators.gapfill import gap_fill, interpolate
from signalflow.operators.posts import annotated, language_posts, weekly_distinct
from signalflow.operators.spines import date_spine, spine_between
from signalflow.session import literal_rows

CASE_COLUMNS = ("ili_case", "ili_pop_cov", "ari_case", "ari_pop_cov")
WEEKLY_COLUMNS = ("iso_weekstartdate", "ili_incidence", *CASE_COLUMNS, "ari_incidence")


def country_cases(cases: DataFrame, countries: Sequence[str] | None, age_codes: Sequence[str] | None) -> DataFrame:
    """Surveillance rows of the countries and age groups asked for (None: all)."""
    out = cases
    if countries is not None:
        out = out.filter(F.col("country_code").isin(*countries))
    if age_codes is not None:
        out = out.filter(F.col("agegroup_code").isin(*age_codes))
    return out.select("country_code", "iso_weekstartdate", *CASE_COLUMNS)


def monday(day: date | str) -> date:
    day = date.fromisoformat(str(day))
    return day - timedelta(days=day.weekday())


def country_weeks(spark: SparkSession, start: date | str, end: date | str, countries: Sequence[str]) -> DataFrame:
    """Week spine of every listed country."""
    names = literal_rows(spark, ("country_code",), [(c,) for c in countries])
    bounds = names.select("country_code", F.lit(str(start)).cast("date").alias("lo"), F.lit(str(end)).cast("date").alias("hi"))
    return spine_between(bounds, "week").withColumnRenamed("date", "iso_weekstartdate")


def weekly_incidence(
    cases: DataFrame,
    start: date | str,
    end: date | str,
    countries: Sequence[str] | None = None,
    age_codes: Sequence[str] | None = ("All", "ALL"),
    smoothing: float = 0.0,
    fill: Sequence[str] = ("ili_incidence",),
) -> DataFrame:
    """Weekly incidence of the listed countries, or of all that have rows, on the full week spine.

    Missing weeks stay NULL in the case columns. The ``fill`` columns are interpolated
    linearly between known weeks and stay NULL before the first and after the last.
    """
    rows = country_cases(cases, countries, age_codes)
    rates = {
        "ili_incidence": incidence("ili_case", "ili_pop_cov", smoothing),
        "ari_incidence": incidence("ari_case", "ari_pop_cov", smoothing),
    }
    if countries is None:
        # densify and interpolate in one window pass: the cases are read once, nothing is joined
        methods = {c: "null" for c in CASE_COLUMNS} | {c: "linear" if c in fill else "null" for c in rates}
        filled = gap_fill(
            rows.withColumns(rates), "iso_weekstartdate", methods, ("country_code",), 7, start=monday(start), end=monday(end)
        )
    else:
        weeks = country_weeks(cases.sparkSession, start, end, countries)
        base = on_spine(weeks, rows, ("country_code", "iso_weekstartdate")).withColumns(rates)
        filled = interpolate(base, "iso_weekstartdate", {c: "linear" for c in fill}, ("country_code",))
    return filled.select("country_code", *WEEKLY_COLUMNS)


def daily_incidence(weekly: DataFrame, start: date | str, end: date | str, target: str = "ili_incidence") -> DataFrame:
    """Weekly values on the days of ``start..end``, linear between the weeks."""
    points = weekly.select("country_code", F.col("iso_weekstartdate").alias("date"), target)
    return gap_fill(points, "date", {target: "linear"}, ("country_code",), bucket_days=1, start=start, end=end)


def counts_on_spine(
    counts: DataFrame,
    groups: Sequence[KeywordGroup],
    lang: str,
    start: date | str,
    end: date | str,
    unit: str = "week",
    match: str = "contains",
    null_as_zero: bool | None = None,
) -> DataFrame:
    """Group counts on the spine. Missing buckets: NULL by week, 0 by day, unless ``null_as_zero`` says so."""
    zero = unit == "day" if null_as_zero is None else null_as_zero
    spine = date_spine(counts.sparkSession, start, end, unit)
    out = on_spine(spine, group_counts(counts, groups, lang, unit, match))
    if not zero:
        return out
    return out.withColumns({g.column: F.coalesce(g.column, F.lit(0).cast("bigint")) for g in groups})


def weekly_signal(counts: DataFrame, weekly: DataFrame, spec: SignalSpec, cal: Calendar, smoothing: float = 1.0) -> DataFrame:
    """Cases, incidences, symptom posts, control posts and their share per week and country."""
    total = counts_on_spine(counts, spec.groups, spec.lang, cal.start, cal.end, "week", spec.lang_match)
    part, rest = spec.symptom.column, spec.control.column
    return (
        weekly.withColumnRenamed("iso_weekstartdate", "date")
        .join(total.filter(F.col("date") > F.lit(str(cal.cutoff)).cast("date")), "date")
        .select(
            "country_code", "date", *CASE_COLUMNS, "ili_incidence", "ari_incidence", part, rest,
            share(part, rest, smoothing).alias("norm_post_count"),
        )
    )


def daily_signal(
    counts: DataFrame, daily: DataFrame, spec: SignalSpec, cal: Calendar, smoothing: float = 1.0
) -> DataFrame:
    """The same by day: up-sampled incidence (0 where unknown) against daily counts."""
    target = spec.daily_target
    total = counts_on_spine(counts, spec.groups, spec.lang, cal.start, cal.end, "day", spec.lang_match)
    part, rest = spec.symptom.column, spec.control.column
    return (
        daily.join(total.filter(F.col("date") > F.lit(str(cal.cutoff)).cast("date")), "date")
        .select(
            "country_code", "date", F.coalesce(target, F.lit(0.0)).alias(target), part, rest,
            share(part, rest, smoothing).alias("norm_post_count"),
        )
    )


def _small(frame: DataFrame, rows: int) -> DataFrame:
    """A configuration table with a broadcast hint if it is small."""
    return F.broadcast(frame) if rows <= DIMENSION_BROADCAST_ROWS else frame


ROLES = ("symptom_posts", "control_posts")


def weekly_signals(
    counts: DataFrame, cases: DataFrame, specs: Sequence[SignalSpec], cal: Calendar, names: tuple[str, str] = ROLES
) -> DataFrame:
    """Weekly signals of many specs in one job: counts and cases are each read once.

    A spec's own smoothing of the incidence and its age codes apply to its series. The counts of the
    symptom and the control group get the column names ``names``.
    """
    spec_rows = literal_rows(
        counts.sparkSession,
        ("series_id", "country_code", "smoothing", "age_codes"),
        [(s.series_id, s.country_code, float(s.smoothing), list(s.age_codes)) for s in specs],
    )
    cutoff = F.lit(str(cal.cutoff)).cast("date")
    bounds = spec_rows.select(
        "series_id", "country_code", "smoothing", F.lit(str(cal.start)).cast("date").alias("lo"), F.lit(str(cal.end)).cast("date").alias("hi")
    )
    axis = spine_between(bounds, "week")
    rows = (
        cases.filter(F.col("country_code").isin(sorted({s.country_code for s in specs})))
        .join(_small(spec_rows.select("series_id", "country_code", "age_codes"), len(specs)), "country_code")
        .filter(F.array_contains("age_codes", F.col("agegroup_code")))
        .select("series_id", F.col("iso_weekstartdate").alias("date"), *CASE_COLUMNS)
    )
    base = on_spine(axis, rows, ("series_id", "date")).withColumns(
        {
            "ili_incidence": F.try_divide(F.col("ili_case"), F.col("ili_pop_cov") + F.col("smoothing")),
            "ari_incidence": F.try_divide(F.col("ari_case"), F.col("ari_pop_cov") + F.col("smoothing")),
        }
    )
    filled = interpolate(base, "date", {"ili_incidence": "linear"}, ("series_id",))
    part, rest = names
    total = group_counts_for_specs(counts, specs, "week", names=names)
    return (
        filled.filter(F.col("date") > cutoff)
        .join(total, ["series_id", "date"], "left")
        .select(
            "series_id", "country_code", "date", *CASE_COLUMNS, "ili_incidence", "ari_incidence", part, rest,
            share(part, rest).alias("norm_post_count"),
        )
    )


def daily_signals(
    counts: DataFrame, weekly: DataFrame, specs: Sequence[SignalSpec], cal: Calendar, names: tuple[str, str] = ROLES
) -> DataFrame:
    """Daily signals of many specs from their weekly ones: each spec's target by day, 0 where unknown, against daily counts."""
    targets = literal_rows(counts.sparkSession, ("series_id", "target"), [(s.series_id, s.daily_target) for s in specs])
    value = F.when(F.col("target") == "ari_incidence", F.col("ari_incidence")).otherwise(F.col("ili_incidence"))
    points = weekly.join(_small(targets, len(specs)), "series_id").select("series_id", "country_code", "date", "target", value.alias("incidence"))
    days = gap_fill(points, "date", {"incidence": "linear"}, ("series_id", "country_code", "target"), bucket_days=1, start=cal.start, end=cal.end)
    part, rest = names
    total = group_counts_for_specs(counts, specs, "day", names=names)
    joined = days.filter(F.col("date") > F.lit(str(cal.cutoff)).cast("date")).join(total, ["series_id", "date"], "left")
    zero = {c: F.coalesce(c, F.lit(0).cast("bigint")) for c in names} | {"incidence": F.coalesce("incidence", F.lit(0.0))}
    return joined.withColumns(zero).select(
        "series_id", "country_code", "date", "target", "incidence", part, rest, share(part, rest).alias("norm_post_count")
    )


def labelled_weeklies(posts: DataFrame, hints: DataFrame, specs: Sequence[SignalSpec], weekly: DataFrame) -> DataFrame:
    """``labelled_weekly`` for many specs in one job; a post counts for every spec whose language it has."""
    langs = literal_rows(posts.sparkSession, ("series_id", "lang"), [(s.series_id, s.lang) for s in specs])
    wanted = F.array_distinct(F.array(*[F.when(F.contains("record__langs", F.lit(s.lang)), F.lit(s.lang)) for s in specs]))
    related = annotated(posts.select("uri", "record__created_at", "record__langs"), hints, related_only=True)
    hits = related.select("uri", iso_week("record__created_at").alias("date"), F.explode(F.array_compact(wanted)).alias("lang"))
    per_week = hits.groupBy("lang", "date").agg(F.count_distinct("uri").alias("llm_post_count"))
    per_week = per_week.join(_small(langs, len(specs)), "lang").drop("lang")
    return weekly.join(per_week, ["series_id", "date"], "left").withColumn(
        "llm_post_count", F.coalesce("llm_post_count", F.lit(0).cast("bigint"))
    )


def zero_filled_signal(
    counts: DataFrame, cases: DataFrame, spec: SignalSpec, cal: Calendar, age_codes: Sequence[str] | None = None
) -> DataFrame:
    """Weekly signal with zeros for missing cases and the unsmoothed share.

    Without ``age_codes`` a week has one row per age group of the source (check with
    ``align.duplicated_keys``).
    """
    total = counts_on_spine(counts, spec.groups, spec.lang, cal.start, cal.end, "week", spec.lang_match, null_as_zero=True)
    rows = country_cases(cases, [spec.country_code], age_codes).drop("country_code").withColumnRenamed("iso_weekstartdate", "date")
    part, rest = spec.symptom.column, spec.control.column
    return (
        total.filter(F.col("date") > F.lit(str(cal.cutoff)).cast("date"))
        .join(rows, "date", "left")
        .select(
            "date", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in CASE_COLUMNS], part, rest,
            share(part, rest, 0.0).alias("norm_post_count"),
        )
    )


def labelled_weekly(posts: DataFrame, hints: DataFrame, lang: str, weekly: DataFrame) -> DataFrame:
    """Weekly signal plus the number of posts labelled ILI (0 where there is none)."""
    related = annotated(language_posts(posts, lang), hints, related_only=True)
    per_week = weekly_distinct(related, "llm_post_count_na")
    return weekly.join(per_week, F.col("date") == F.col("iso_weekstartdate"), "left").withColumn(
        "llm_post_count", F.coalesce("llm_post_count_na", F.lit(0).cast("bigint"))
    )


def labelled_signal(
    posts: DataFrame,
    hints: DataFrame,
    cases: DataFrame,
    control: DataFrame,
    spec: SignalSpec,
    cal: Calendar,
) -> DataFrame:
    """Label-filtered posts, cases and control posts per week, with smoothed incidences.

    ``control`` is a weekly frame ``(date, <control column>)``.
    """
    rest = spec.control.column
    in_lang = posts.filter(F.contains(F.col("record__langs"), F.lit(spec.lang)))
    per_week = weekly_distinct(annotated(in_lang, hints, related_only=True), "ili_rel_posts").withColumnRenamed(
        "iso_weekstartdate", "date"
    )
    rows = country_cases(cases, [spec.country_code], spec.age_codes).drop("country_code").withColumnRenamed("iso_weekstartdate", "date")
    spine = date_spine(posts.sparkSession, cal.start, cal.end, "week").filter(
        F.col("date") > F.lit(str(cal.cutoff)).cast("date")
    )
    joined = spine.join(per_week, "date", "left").join(rows, "date", "left").join(control.select("date", rest), "date", "left")
    final = joined.select(
        "date",
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in CASE_COLUMNS],
        F.coalesce("ili_rel_posts", F.lit(0).cast("bigint")).alias("ili_rel_posts"),
        share("ili_rel_posts", rest, 0.0).alias("norm_post_count"),
        rest,
    )
    return final.withColumns(
        {
            "ari_incidence": incidence("ari_case", "ari_pop_cov", 1.0),
            "ili_incidence": incidence("ili_case", "ili_pop_cov", 1.0),
        }
    )


def signal_with_tokens(signal: DataFrame, wide: DataFrame) -> DataFrame:
    """Weekly signal with one column per token; weeks without posts drop out."""
    return signal.join(wide.withColumnRenamed("iso_weekstartdate", "date"), "date")


def control_counts(counts: DataFrame, spec: SignalSpec, cal: Calendar) -> DataFrame:
    """Weekly control counts on the spine, ``(date, <control column>)``."""
    return counts_on_spine(counts, (spec.control,), spec.lang, cal.start, cal.end, "week", spec.lang_match)


