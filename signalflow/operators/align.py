"""Joins that put several series on one date axis."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def on_spine(spine: DataFrame, df: DataFrame, on: Sequence[str] = ("date",)) -> DataFrame:
    """Every spine row, with NULLs where ``df`` has none."""
    return spine.join(df, list(on), "left")


def zero_filled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in columns})


def aligned_sum(left: DataFrame, right: DataFrame, on: str, value: str) -> DataFrame:
    """Sum of two series by date; a date only one of them has gives 0."""
    b = right.select(on, F.col(value).alias("__other"))
    total = F.coalesce(F.col(value) + F.col("__other"), F.lit(0))
    return left.select(on, value).join(b, on, "full_outer").select(on, total.alias(value))


def aligned_frame(spine: DataFrame, series: dict[str, tuple[DataFrame, str]], on: str = "date") -> DataFrame:
    """Several ``name -> (frame, value column)`` series as columns of one frame on the spine."""
    out = spine
    for name, (df, value) in series.items():
        out = out.join(df.select(on, F.col(value).alias(name)), on, "left")
    return out


def duplicated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once: a join on them would multiply rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
