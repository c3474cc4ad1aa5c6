"""Rolling-origin folds as arithmetic on row positions; no fold table and no join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalflow.operators.features import series_order


def positioned(df: DataFrame, by: Sequence[str], ts: str = "date") -> DataFrame:
    """Add the 0-based position ``rn`` of a row in its series and the series length ``n``."""
    return df.withColumns(
        {
            "rn": F.row_number().over(series_order(by, ts)) - 1,
            "n": F.count(F.lit(1)).over(Window.partitionBy(*by)),
        }
    )


def fold_rows(
    df: DataFrame,
    by: Sequence[str],
    ts: str = "date",
    n_splits: int = 42,
    test_size: int = 1,
    gap: int = 0,
    max_train: int | None = 200,
) -> DataFrame:
    """Every row once per fold it belongs to, with ``fold`` and ``role`` (train, test).

    Fold f tests ``test_size`` rows from position ``n - (n_splits - f) * test_size`` and trains on
    the ``max_train`` rows that end ``gap`` rows before. A series too short for
    one training row in the first fold has no folds (see ``unfoldable``).

    The folds that train on a row are a range of fold numbers, so the copies come
    from exploding that range: at most ``max_train / test_size`` per row.
    """
    rows = positioned(df, by, ts)
    first = F.col("n") - n_splits * test_size
    ahead = F.col("rn") + gap - first
    lo = F.greatest(F.floor(ahead / test_size) + 1, F.lit(0).cast("bigint"))
    hi = F.lit(n_splits - 1).cast("bigint")
    if max_train is not None:
        hi = F.least(hi, F.floor((ahead + max_train) / test_size))
    own = F.floor((F.col("rn") - first) / test_size)
    none = F.array().cast("array<bigint>")
    train = F.when(lo <= hi, F.sequence(lo, hi)).otherwise(none)
    test = F.when(own >= 0, F.array(own)).otherwise(none)
    roles = F.concat(
        F.transform(train, lambda f: F.struct(f.cast("int").alias("fold"), F.lit("train").alias("role"))),
        F.transform(test, lambda f: F.struct(f.cast("int").alias("fold"), F.lit("test").alias("role"))),
    )
    return rows.filter(first - gap > 0).select("*", F.inline(roles))


def unfoldable(df: DataFrame, by: Sequence[str], n_splits: int = 42, test_size: int = 1, gap: int = 0) -> DataFrame:
    """Series that are too short for the requested folds."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") - gap - n_splits * test_size <= 0)
