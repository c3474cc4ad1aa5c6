"""Permutation importance of a fitted model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalflow.operators.boosting import BoostedTrees
from signalflow.operators.models import predict
from signalflow.operators.ranks import numbered
from signalflow.session import written

SCORED_ROWS_PER_TASK = 2_000_000


def _shuffled(rows: DataFrame, features: Sequence[str], repeats: int, seed: int, n: int) -> DataFrame:
    """Each row ``repeats`` times beside a donor row, the donors a permutation of all rows.

    A row has a place in the order of its key and, per repeat, one in the order of a hash; joining
    place to place pairs every row with exactly one donor. Both are global positions (every repeat
    takes ``n`` of the second), found without a task that orders all rows. Hashes instead of ``rand``
    make a recomputed task agree with the one it replaces.
    """
    key = [F.col(c) for c in rows.columns if c.startswith("__key")]
    placed = numbered(rows, key, "__place", "importance-places")
    tags = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("repeat")
    draw = F.xxhash64(F.lit(seed), "repeat", *key).alias("__draw")
    drawn = placed.select(tags, F.struct(*features).alias("__donor"), *key).select("repeat", draw, "__donor", *key)
    drawn = numbered(drawn, ["repeat", "__draw", *key], "__drawn", "importance-draws")
    donors = drawn.select("repeat", (F.col("__drawn") - F.col("repeat") * n).alias("__place"), "__donor")
    return placed.join(donors, "__place")


def permutation_importance(
    fitted: Model | BoostedTrees,
    df: DataFrame,
    features: Sequence[str],
    key: Sequence[str],
    repeats: int = 25,
    seed: int = 42,
) -> DataFrame:
    """Increase of the MAE when one feature is permuted: ``(variable, repeat, value)``.

    All features of a repeat share its permutation. All (feature, repeat) variants
    are one tagged frame that is scored in one pass and averaged in one aggregation.
    """
    features = list(features)
    rows = written(
        df.select(*[F.col(c).alias(f"__key{i}") for i, c in enumerate(key)], *features, "y"), "importance-rows"
    )
    n = rows.count()
    # scoring is the expensive part and sees len(features) rows per pair: size its tasks by
    # that, where adaptive execution would go by the bytes of the pairs
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, n * repeats * len(features) // SCORED_ROWS_PER_TASK)
    swapped = F.array(
        *[
            F.struct(
                F.lit(f).alias("variable"),
                F.struct(*[(F.col(f"__donor.{g}") if g == f else F.col(g)).alias(g) for g in features]).alias("x"),
            )
            for f in features
        ]
    )
    variants = (
        _shuffled(rows, features, repeats, seed, n)
        .repartition(tasks)
        .select("repeat", "y", F.inline(swapped))
        .select("variable", "repeat", "y", "x.*")
    )

    def mae(frame: DataFrame, *by: str) -> DataFrame:
        return predict(frame, features, fitted).groupBy(*by).agg(F.avg(F.abs(F.col("y") - F.col("yhat"))).alias("mae"))

    base = mae(rows).scalar()
    return mae(variants, "variable", "repeat").select("variable", "repeat", (F.col("mae") - base).alias("value"))


def top_variables(importance: DataFrame, n: int) -> DataFrame:
    """The ``n`` variables of largest mean importance (a report, so a real limit)."""
    return (
        importance.groupBy("variable")
        .agg(F.avg("value").alias("mean_value"))
        .orderBy(F.col("mean_value").desc(), "variable")
        .limit(n)
    )


def wide_importance(importance: DataFrame, variables: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per series and repeat, one column per variable."""
    return importance.groupBy(*by, "repeat").pivot("variable", list(variables)).agg(F.first("value"))


def long_importance(wide: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, variable, value)`` rows of the wide table."""
    ids = [*by, "repeat"]
    names = [c for c in wide.columns if c not in ids]
    return wide.unpivot(ids, names, "variable", "value").drop("repeat")
