"""Finished tables, the data-set registry, and the text corpus."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalflow.operators.features import calendar_features

Loader = Callable[[SparkSession], DataFrame]


def load_table(spark: SparkSession, name: str, order: str | None = None) -> DataFrame:
    """A stored table by path or catalog name; ``order`` sorts it for display only."""
    df = spark.read.parquet(name) if os.sep in name or "://" in name else spark.table(name)
    return df.orderBy(order) if order else df


class DatasetRegistry:
    """Data sets by name. A name that is not registered is an error."""

    def __init__(self) -> None:
        self._loaders: dict[str, Loader] = {}

    def add(self, name: str, loader: Loader) -> None:
        self._loaders[name] = loader

    def names(self) -> list[str]:
        return sorted(self._loaders)

    def load(self, spark: SparkSession, name: str) -> DataFrame:
        if name not in self._loaders:
            raise ValueError(f"unsupported dataset {name!r}; known: {', '.join(self.names())}")
        return self._loaders[name](spark)


# Column names of the modelling frames.
RENAMED = {"rest_posts": "control_posts", "grippe_posts": "ili_posts"}
LABELLED_COLUMNS = ("date", "llm_post_count", "ili_incidence", "rest_posts")


def _within(df: DataFrame, days: tuple[str, str] | None) -> DataFrame:
    return df if days is None else df.filter(F.col("date").between(*[F.lit(d).cast("date") for d in days]))


def signal_registry(
    weekly: dict[str, str], daily: dict[str, str], labelled: str | None = None, daily_range: tuple[str, str] | None = None
) -> DatasetRegistry:
    """Registry of the modelling data sets from stored signal tables, per language.

    ``grippe_posts_<lang>``: weekly; ``upsampled_<lang>``: daily, within ``daily_range`` if given;
    ``llm_filtered``: weekly with label-filtered counts.
    """
    registry = DatasetRegistry()
    for lang, path in weekly.items():
        registry.add(
            f"grippe_posts_{lang}",
            lambda spark, path=path: calendar_features(load_table(spark, path)).withColumnsRenamed(RENAMED),
        )
    for lang, path in daily.items():
        registry.add(
            f"upsampled_{lang}",
            lambda spark, path=path: calendar_features(_within(load_table(spark, path), daily_range), with_day=True),
        )
    if labelled:
        registry.add(
            "llm_filtered",
            lambda spark: calendar_features(
                load_table(spark, labelled).select(*LABELLED_COLUMNS)
            ),
        )
    return registry


def text_corpus(
    spark: SparkSession, input_file: str | None = None, query: str | None = None, schema: str | None = None, args: dict | list | None = None
) -> DataFrame:
    """Posts from a CSV file or a SQL query; one of the two is required. ``args`` fill the query's parameter markers."""
    if input_file:
        reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
        return (reader.schema(schema) if schema else reader).csv(input_file)
    if query:
        return spark.sql(query, args=args)
    raise ValueError("give an input file or a query")


def read_weekly_tokens(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Wide weekly token table from CSV (one count column per token); without ``schema`` a pass over the file infers it."""
    reader = spark.read.option("header", True)
    df = (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)
    return df.withColumn("iso_weekstartdate", F.to_date("iso_weekstartdate"))


def long_weekly_tokens(wide: DataFrame) -> DataFrame:
    """Wide token table to long rows; zero counts are dropped."""
    names = [c for c in wide.columns if c != "iso_weekstartdate"]
    return wide.unpivot("iso_weekstartdate", names, "token", "cnt").filter("cnt > 0")
