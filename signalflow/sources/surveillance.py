"""Official case and laboratory tables from landed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalflow.functions.dates import mmwr_week_start, week_number_start, week_text_start

# Columns the case tables are stored without.
WHO_DROPPED = {"fluid": ("COMMENTS",), "flunet": ("BVIC_DELUNK", "BYAM")}
CDC_DATASETS = ("fluview", "fluview_clinical")
RKI_DATASETS = ("grippenet", "sentinel", "hospital")


def _checked(dataset: str, allowed) -> None:
    if dataset not in allowed:
        raise ValueError(f"invalid dataset {dataset!r}; choose one of {', '.join(allowed)}")


def read_who(spark: SparkSession, path: str, dataset: str, schema: str | None = None, lower: bool = False) -> DataFrame:
    """Weekly case (``fluid``) or virology (``flunet``) CSV with ``ISO_WEEKSTARTDATE`` as a date.

    Give ``schema`` for large files: inferring it reads them twice.
    """
    _checked(dataset, tuple(WHO_DROPPED))
    reader = spark.read.option("header", True)
    df = reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)
    df = df.withColumn("ISO_WEEKSTARTDATE", F.to_date("ISO_WEEKSTARTDATE")).drop(*WHO_DROPPED[dataset])
    return df.withColumnsRenamed({c: c.lower() for c in df.columns}) if lower else df


def country_rows(df: DataFrame, country: str, column: str = "COUNTRY_CODE") -> DataFrame:
    return df.filter(F.col(column) == country)


def read_rki(spark: SparkSession, path: str, dataset: str, schema: str | None = None, legacy_weeks: bool = False) -> DataFrame:
    """Tab-separated table keyed by week text, plus the date of its Monday."""
    _checked(dataset, RKI_DATASETS)
    reader = spark.read.option("header", True).option("sep", "\t")
    df = reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)
    return df.withColumn("ISO_WEEKSTARTDATE", week_text_start("Kalenderwoche", legacy_weeks))


def read_cdc(spark: SparkSession, path: str, dataset: str, schema: str | None = None) -> DataFrame:
    """National outpatient or clinical-laboratory table, CSV or JSON by file suffix."""
    _checked(dataset, CDC_DATASETS)
    if path.rstrip("/").endswith(".json"):
        return (spark.read.schema(schema) if schema else spark.read).json(path)
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def read_labs(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Laboratory CSV with a quoted text line above the header, plus the Sunday of its (YEAR, WEEK)."""
    reader = spark.read.option("header", True).option("comment", '"')
    df = reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)
    return df.withColumn("week_start", mmwr_week_start("YEAR", "WEEK"))


def read_sentinel(spark: SparkSession, path: str) -> DataFrame:
    """Sentinel incidence CSV below a ``#`` comment line, plus the Monday of its YYYYWW week."""
    schema = (
        "week int, geo_insee string, indicator int, inc bigint, inc100 bigint, "
        "inc_up bigint, inc_low bigint, inc100_up bigint, inc100_low bigint"
    )
    df = spark.read.option("header", True).option("comment", "#").schema(schema).csv(path)
    return df.withColumn("week_start", week_number_start("week"))


def read_baseline(spark: SparkSession, path: str) -> DataFrame:
    """Daily counts from files ``baseline_<keyword>.csv``, the keyword taken from the file name."""
    df = spark.read.option("header", True).schema("period_start date, post_count bigint").csv(path)
    keyword = F.regexp_extract(F.col("_metadata.file_path"), r"baseline_([^/]+?)\.csv", 1)
    return df.select(keyword.alias("query"), "period_start", "post_count")
