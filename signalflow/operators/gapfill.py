"""Dense date grids and gap filling.

Input has one row per (series, date), so a window over one series is bounded by
the calendar (a century of days is 36 500 rows) whatever the fact tables hold.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

METHODS = ("linear", "locf", "null")


def _interpolated(at: Column, prev: Column, nxt: Column, method: str) -> Column:
    if method == "locf":
        return prev["v"]
    span = F.datediff(nxt["ts"], prev["ts"])
    slope = (nxt["v"] - prev["v"]) * F.datediff(at, prev["ts"]) / span
    return F.when(prev["ts"] == at, prev["v"]).when(nxt.isNotNull(), prev["v"] + slope)


def _neighbours(column: str, ts: str, by: Sequence[str]) -> tuple[Column, Column]:
    """Nearest known point at or before, and strictly after, each row.

    The look-ahead is a look-back over the reversed order: Spark evaluates a
    growing frame in linear time but a shrinking one in quadratic time.
    """
    known = F.when(F.col(column).isNotNull(), F.struct(F.col(ts).alias("ts"), F.col(column).alias("v")))
    forward = Window.partitionBy(*by).orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)
    backward = Window.partitionBy(*by).orderBy(F.col(ts).desc()).rowsBetween(Window.unboundedPreceding, -1)
    return F.last(known, ignorenulls=True).over(forward), F.last(known, ignorenulls=True).over(backward)


def interpolate(df: DataFrame, ts: str, methods: Mapping[str, str], by: Sequence[str]) -> DataFrame:
    """Fill NULLs of the named columns on the rows that are there; no row is added."""
    _check(methods)
    methods = {c: m for c, m in methods.items() if m != "null"}
    named = df
    for c in methods:
        prev, nxt = _neighbours(c, ts, by)
        named = named.withColumns({f"__prev_{c}": prev, f"__next_{c}": nxt})
    return named.select(
        *[
            _interpolated(F.col(ts), F.col(f"__prev_{c}"), F.col(f"__next_{c}"), methods[c]).alias(c) if c in methods else c
            for c in df.columns
        ]
    )


def gap_fill(
    df: DataFrame,
    ts: str,
    methods: Mapping[str, str],
    by: Sequence[str],
    bucket_days: int = 1,
    start: date | str | None = None,
    end: date | str | None = None,
) -> DataFrame:
    """Dense grid of ``bucket_days`` per series with its value columns filled.

    A NULL input value counts as unknown. ``linear`` interpolates between known
    points and leaves the ends NULL, ``locf`` carries the last known value, ``null``
    only adds the rows. The grid runs from the first to the last row of a series,
    or from ``start`` to ``end`` (rows outside are dropped first).

    One shuffle on the series: every input row looks up its neighbours and then
    explodes the buckets up to the next row, so no grid is joined back.
    """
    _check(methods)
    if not by:
        raise ValueError("gap_fill needs at least one series column")
    step = F.expr(f"interval {int(bucket_days)} days")
    lo, hi = (F.lit(str(d)).cast("date") if d else None for d in (start, end))
    rows = df.select(*by, ts, *methods)
    if lo is not None:
        rows = rows.filter(F.col(ts) >= lo)
    if hi is not None:
        rows = rows.filter(F.col(ts) <= hi)
    order = Window.partitionBy(*by).orderBy(ts)
    upto = F.date_sub(F.lead(ts).over(order), bucket_days)
    columns: dict[str, Column] = {
        # rows that share a date each stand for themselves, as in a join on the date
        "__to": F.when(upto.isNotNull(), F.greatest(upto, F.col(ts))).otherwise(hi if hi is not None else F.col(ts)),
        "__from": F.col(ts) if lo is None else F.when(F.lag(ts).over(order).isNull(), lo).otherwise(F.col(ts)),
    }
    for c, method in methods.items():
        if method != "null":
            columns[f"__prev_{c}"], columns[f"__next_{c}"] = _neighbours(c, ts, by)
    grid = rows.withColumns(columns).withColumn("__at", F.explode(F.sequence("__from", "__to", step)))
    return grid.select(
        *by, F.col("__at").alias(ts), *[_filled(c, m, ts).alias(c) for c, m in methods.items()]
    )


def _filled(c: str, method: str, ts: str) -> Column:
    at = F.col("__at")
    if method == "null":
        return F.when(at == F.col(ts), F.col(c))
    # grid days before the first row of a series have no earlier point
    return F.when(at >= F.col(ts), _interpolated(at, F.col(f"__prev_{c}"), F.col(f"__next_{c}"), method))


def _check(methods: Mapping[str, str]) -> None:
    for c, m in methods.items():
        if m not in METHODS:
            raise ValueError(f"unknown gap-fill method {m!r} for {c!r}")
