"""Correlation, freshness and error summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def correlation(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), digits: int | None = None) -> DataFrame:
    """Pearson matrix in long form ``(x, y, r)``, one aggregation over the data.

    Only the upper triangle is computed. A pair uses the rows where both values
    are there; the diagonal is 1 (NULL for a constant column).
    """
    cols = [F.col(c).cast("double") for c in columns]
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]

    def pearson(a: Column, b: Column) -> Column:
        # spelt out because ``corr`` divides by zero, an error in ANSI mode, on a constant column
        a, b = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
        return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))

    wide = df.groupBy(*by).agg(*[pearson(cols[i], cols[j]).alias(f"r_{i}_{j}") for i, j in pairs])
    cells = []
    for i, j in pairs:
        r = F.col(f"r_{i}_{j}") if digits is None else F.round(F.col(f"r_{i}_{j}"), digits)
        for a, b in {(i, j), (j, i)}:
            cells.append(F.struct(F.lit(columns[a]).alias("x"), F.lit(columns[b]).alias("y"), r.alias("r")))
    return wide.select(*by, F.inline(F.array(*cells)))


def freshness(df: DataFrame, country_col: str = "country_code", date_col: str = "iso_weekstartdate") -> DataFrame:
    return df.groupBy(country_col).agg(F.max(date_col).alias("last_date"))


def fold_errors(predictions: DataFrame, by: Sequence[str] = ("fold",)) -> DataFrame:
    """MAE, RMSE and mean signed difference of every fold of ``(y, yhat)``."""
    diff = F.col("y") - F.col("yhat")
    return predictions.groupBy(*by).agg(
        F.avg(F.abs(diff)).alias("mae"), F.sqrt(F.avg(diff * diff)).alias("rmse"), F.avg(diff).alias("diff")
    )


def error_summary(fold_scores: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean and population deviation of MAE and RMSE, median and 95 % range of MAE.

    ``by`` names the series: the exact percentiles then hold one value per fold.
    """
    return fold_scores.groupBy(*by).agg(
        F.count(F.lit(1)).alias("folds"),
        F.avg("mae").alias("mae_mean"),
        F.stddev_pop("mae").alias("mae_std"),
        F.median("mae").alias("mae_median"),
        F.percentile("mae", F.lit(0.025)).alias("mae_p025"),
        F.percentile("mae", F.lit(0.975)).alias("mae_p975"),
        F.avg("rmse").alias("rmse_mean"),
        F.stddev_pop("rmse").alias("rmse_std"),
    )


def regression_scores(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE and R² of ``(y, yhat)`` in one pass (R² from the variance of ``y``)."""
    diff = F.col("y") - F.col("yhat")
    return predictions.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(diff)).alias("mae"),
        F.sqrt(F.avg(diff * diff)).alias("rmse"),
        (1 - F.try_divide(F.avg(diff * diff), F.var_pop("y"))).alias("r2"),
    )
