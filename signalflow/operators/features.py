"""Calendar features, lags, targets and splits of time series.

Frames hold one row per (series, date). Every window is partitioned by the series
and ordered by date, so all features of a series share one shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalflow.functions.dates import season
from signalflow.functions.rates import scaled_target, spline_cell, spline_value

# Order of the seasons where a model needs numbers.
SEASONS = ("Winter", "Spring", "Summer", "Autumn")


def calendar_features(df: DataFrame, ts: str = "date", with_day: bool = False) -> DataFrame:
    """Add year, month, ISO week, season (and day of month)."""
    out = df.withColumns(
        {
            "year": F.year(ts),
            "month": F.month(ts),
            "week": F.weekofyear(ts),
            "season": season(F.month(ts)),
        }
    )
    return out.withColumn("day", F.dayofmonth(ts)) if with_day else out


def season_code(c: str = "season") -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in SEASONS]), F.col(c)).cast("int") - 1


def one_hot(
    df: DataFrame, columns: Sequence[str], categories: Mapping[str, Sequence] | None = None, max_categories: int | None = None
) -> DataFrame:
    """Replace columns by 0/1 columns ``{column}_{category}`` in category order.

    Categories not given are read from the data in one pass over all columns; a
    column with more than ``max_categories`` of them, if that is given, is an error.
    """
    known = {c: list(v) for c, v in (categories or {}).items()}
    missing = [c for c in columns if c not in known]
    if missing:
        pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in missing])
        distinct = df.select(F.inline(pairs)).filter("v is not null").distinct()
        found = (distinct if max_categories is None else distinct.limit(max_categories * len(missing) + 1)).collect()
        for c in missing:
            values = [r.v for r in found if r.c == c]
            if max_categories is not None and (len(values) > max_categories or len(found) > max_categories * len(missing)):
                raise ValueError(f"column {c!r} has more than {max_categories} categories")
            numeric = dict(df.dtypes)[c] not in ("string", "date")
            known[c] = sorted(values, key=int if numeric else str)
    keep = [c for c in df.columns if c not in columns]
    hot = [
        F.coalesce((F.col(c).cast("string") == str(v)).cast("double"), F.lit(0.0)).alias(f"{c}_{v}")
        for c in columns
        for v in known[c]
    ]
    return df.select(*keep, *hot)


def spline_features(df: DataFrame, column: str, period: float, n_splines: int) -> DataFrame:
    """Add the uniform periodic cubic B-spline basis ``{column}_spline_{i}``; its columns sum to 1."""
    if n_splines < 4:
        raise ValueError("a periodic cubic basis needs at least 4 splines")
    cell, weights = spline_cell(column, period, n_splines)
    names = {f"{column}_spline_{i}": spline_value(F.col("__cell"), F.col("__weights"), i, n_splines) for i in range(n_splines)}
    return df.withColumns({"__cell": cell, "__weights": weights}).withColumns(names).drop("__cell", "__weights")


def series_order(by: Sequence[str], ts: str):
    return Window.partitionBy(*by).orderBy(ts)


def lag_features(df: DataFrame, columns: Sequence[str], lags: int, by: Sequence[str], ts: str = "date") -> DataFrame:
    """Add ``{column}_lag{l}`` for l = 1..lags."""
    order = series_order(by, ts)
    return df.select(
        "*", *[F.lag(c, l).over(order).alias(f"{c}_lag{l}") for l in range(1, lags + 1) for c in columns]
    )


def feature_names(columns: Sequence[str], lags: int) -> list[str]:
    return [*columns, *[f"{c}_lag{l}" for l in range(1, lags + 1) for c in columns]]


def _labelled(
    df: DataFrame, target: str, lags: int, horizon: int, features: Sequence[str], by: Sequence[str], ts: str
) -> DataFrame:
    order = series_order(by, ts)
    base = df.select(
        *by,
        ts,
        *features,
        F.row_number().over(order).alias("__pos"),
        F.lead(scaled_target(target, target), horizon).over(order).alias("y"),
        F.lead(ts, horizon).over(order).alias("target_date"),
    )
    return lag_features(base, features, lags, by, ts)


def _scaled(df: DataFrame, top: Column, scale: str | None) -> DataFrame:
    """``y`` as a share of ``top``, which stays as the column ``scale`` if that is named."""
    out = df.withColumn("__top", top).withColumn("y", F.try_divide(F.col("y"), F.col("__top")))
    return out.withColumnRenamed("__top", scale) if scale else out.drop("__top")


def supervised(
    df: DataFrame,
    target: str,
    lags: int,
    horizon: int,
    by: Sequence[str],
    ts: str = "date",
    drop: Sequence[str] = (),
    normalize: bool = False,
    scale: str | None = None,
) -> DataFrame:
    """Features of day t with their lags, and ``y`` = target at t + horizon, as one frame.

    ``y`` is per 100 000 for incidences and divided by its own maximum on request.
    Rows with a NULL feature or target are dropped; since y is attached by date
    order inside one frame, a gap never shifts it against the features.
    """
    features = [c for c in df.columns if c not in {*by, ts, *drop}]
    out = _labelled(df, target, lags, horizon, features, by, ts)
    if normalize:
        top = F.max(F.when(F.col("__pos") > lags, F.col("y"))).over(Window.partitionBy(*by))
        out = _scaled(out, top, scale)
    return out.drop("__pos").na.drop()


def train_test(
    df: DataFrame,
    target: str,
    lags: int,
    horizon: int,
    by: Sequence[str],
    split: date | str,
    ts: str = "date",
    drop: Sequence[str] = (),
    normalize: bool = False,
    scale_by: str = "own",
    scale: str | None = None,
) -> DataFrame:
    """``supervised`` with a ``split`` column.

    ``train``: the target date is not after the split date. ``test``: the row is
    not before it. Rows that look across the split are in neither. ``scale_by``:
    ``own`` divides by the maximum of the row's split, ``train`` by that of train.
    """
    at = F.lit(str(split)).cast("date")
    features = [c for c in df.columns if c not in {*by, ts, *drop}]
    out = _labelled(df, target, lags, horizon, features, by, ts)
    part = F.when(F.col("target_date") <= at, "train").when(F.col(ts) >= at, "test")
    out = out.withColumn("split", part).filter("split is not null")
    if normalize:
        usable = F.when((F.col("split") == "test") | (F.col("__pos") > lags), F.col("y"))
        if scale_by == "own":
            top = F.max(usable).over(Window.partitionBy(*by, "split"))
        elif scale_by == "train":
            top = F.max(F.when(F.col("split") == "train", usable)).over(Window.partitionBy(*by))
        else:
            raise ValueError(f"unknown scale_by {scale_by!r}")
        out = _scaled(out, top, scale)
    return out.drop("__pos").na.drop()


def without_ends(df: DataFrame, by: Sequence[str], ts: str = "date", first: int = 0, last: int = 0) -> DataFrame:
    """Drop the first and last rows of every series by position."""
    out = df
    if first:
        out = out.withColumn("__a", F.row_number().over(series_order(by, ts))).filter(F.col("__a") > first).drop("__a")
    if last:
        back = Window.partitionBy(*by).orderBy(F.col(ts).desc())
        out = out.withColumn("__z", F.row_number().over(back)).filter(F.col("__z") > last).drop("__z")
    return out


def without_open_week(df: DataFrame, by: Sequence[str], ts: str = "date") -> DataFrame:
    """Drop the latest, still incomplete, bucket of every series."""
    return (
        df.withColumn("__top", F.max(ts).over(Window.partitionBy(*by))).filter(F.col(ts) < F.col("__top")).drop("__top")
    )
