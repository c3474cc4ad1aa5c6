"""Writing tables: replace, merge by key, views, exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from signalflow.session import written


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order``, ties broken by the remaining columns.

    A maximum over structs rather than ``row_number``: copies of one key are reduced
    to a single row before the shuffle, so a key with very many copies is no hot spot.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    newest = F.max(F.struct(*order, *rest)).alias("__row")
    return df.groupBy(*keys).agg(newest).select(*keys, "__row.*").select(*df.columns)


def replace(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Full replacement of the table at ``path``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` holds data: files or partitions, not only markers of a finished write."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hadoop_path) and any(f.getPath().getName()[0] not in "_." for f in fs.listStatus(hadoop_path))


def read_table(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The parquet table at ``path`` with its schema, empty where nothing has been written yet."""
    if table_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


# Partition values up to which they are listed in a filter that prunes the scan; more of them are joined.
LISTED_PARTITIONS = 10_000


def _in_partitions(stored: DataFrame, incoming: DataFrame, part: str) -> DataFrame:
    """The rows of the table partitions that the batch touches; the plan differs by their number, the rows don't."""
    values = incoming.select(part).distinct()
    listed = [r[0] for r in values.limit(LISTED_PARTITIONS + 1).collect()]
    if len(listed) > LISTED_PARTITIONS:
        return stored.join(values.withColumnRenamed(part, "__touched"), F.col(part).eqNullSafe(F.col("__touched")), "left_semi")
    known = F.col(part).isin([v for v in listed if v is not None])
    return stored.filter(known | F.col(part).isNull() if None in listed else known)


def upsert(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    partition: tuple[str, Column],
    order: str | None = None,
) -> None:
    """Merge ``batch`` into the parquet table at ``path``: insert new keys, replace known ones.

    ``partition`` names the table's partition column and its expression, a function of the keys, so
    only the partitions of the batch are read and rewritten. With ``order`` the greatest value wins,
    the batch on a tie; without it the batch always wins. Running it twice with the same batch changes
    nothing; an empty batch writes nothing.

    The batch is computed once and written first (it may hold expensive annotations). The merged
    partitions are then written beside the table before the old files are swapped out: if the driver
    dies during the swap, the merged rows are still there.
    """
    part, expression = partition
    incoming = written(batch.withColumn(part, expression), "batch")
    if incoming.isEmpty():
        return
    rows = keep_latest(incoming, keys, [order] if order else [])
    if table_exists(spark, path):
        old = _in_partitions(spark.read.schema(incoming.schema).parquet(path), incoming, part).withColumn("__source", F.lit(0))
        ranked = incoming.withColumn("__source", F.lit(1)).unionByName(old)
        rows = written(keep_latest(ranked, keys, [order, "__source"] if order else ["__source"]).drop("__source"), "merge")
    # rebalance: few files per table partition, while a large partition is split over tasks
    balanced = rows.hint("rebalance", part)
    balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)


# Layouts of the merged tables: keys and partition column.
COUNT_KEYS = ("period_start", "langs", "query")
URI_BUCKETS = 16


def upsert_counts(spark: SparkSession, path: str, counts: DataFrame, order: str | None = None) -> None:
    upsert(spark, path, counts, COUNT_KEYS, ("period_month", F.trunc("period_start", "month")), order)


# A key filter has so many bits for the keys of one table partition; Spark cuts it into bitmaps of 4 KB, of which
# only those with a key are stored.
FILTER_BITS = 1 << 20


def _slot(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(FILTER_BITS))


def _key_filter(rows: DataFrame, keys: Sequence[str], parts: Sequence[str]) -> DataFrame:
    """``(*parts, word, bits)``: which hashes of keys occur in each table partition."""
    slots = rows.select(*parts, _slot(keys).alias("slot"))
    return slots.groupBy(*parts, F.bitmap_bucket_number("slot").alias("word")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))


def possible_partitions(filters: DataFrame, batch: DataFrame, keys: Sequence[str], parts: Sequence[str]) -> DataFrame:
    """Distinct table partitions that may hold a key of ``batch``, which has the last of ``parts`` (the key's bucket)."""
    bucket, slot = parts[-1], F.col("__slot")
    wanted = batch.select(bucket, _slot(keys).alias("__slot")).distinct()
    wanted = wanted.select(bucket, F.bitmap_bucket_number(slot).alias("word"), F.bitmap_bit_position(slot).alias("__at"))
    byte = F.conv(F.hex(F.substring(F.col("bits"), F.expr("cast(__at div 8 + 1 as int)"), F.lit(1))), 16, 10).cast("int")
    hit = byte.bitwiseAND(F.expr("shiftleft(1, cast(__at % 8 as int))")) != 0
    return filters.join(wanted, [bucket, "word"]).filter(hit).select(*parts).distinct()


def _among(parts: Sequence[str], listed: Sequence[tuple]) -> Column:
    """Whether a row lies in one of the listed table partitions; a filter on partition columns only, so it prunes the scan."""
    out = F.lit(False)
    by_first: dict = {}
    for first, bucket in listed:
        by_first.setdefault(first, []).append(bucket)
    for first, buckets in by_first.items():
        own = F.col(parts[0]).isNull() if first is None else F.col(parts[0]) == F.lit(first)
        out = out | (own & F.col(parts[1]).isin(buckets))
    return F.coalesce(out, F.lit(False))


def merge(
    spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str], period: tuple[str, Column], bucket: tuple[str, Column], order: str | None = None
) -> None:
    """Merge ``batch`` into a table whose partitions are a period and, within it, a bucket of the key's hash.

    The period need not follow from the key: a known key stays in the partition it was first stored in. Beside the table, at
    ``<path>_keys``, lies a filter of the keys of each partition. Only partitions that may hold a key of the batch
    by their filter are read and rewritten; the rows of all others are appended as new files. So the cost follows
    the batch and what it replaces, not the age of the table. ``order`` and repeated batches are as in :func:`upsert`.

    Filters are written first: if the driver dies before the data are there, the next run reads a partition in vain
    or finds the rows, but never stores a key twice. Merged partitions are written beside the table before they are swapped.
    """
    parts = (period[0], bucket[0])
    incoming = written(keep_latest(batch.withColumns(dict([period, bucket])), keys, [order] if order else []), "batch")
    if incoming.isEmpty():
        return
    filters = f"{path}_keys"
    new = written(_key_filter(incoming, keys, parts), "keys")
    listed: list[tuple] = []
    if table_exists(spark, filters) and table_exists(spark, path):
        hits = possible_partitions(spark.read.schema(new.schema).parquet(filters), incoming, keys, parts)
        listed = [tuple(r) for r in hits.collect()]  # partitions, of which a table has few beside its rows
    if not listed:
        new.write.mode("append").partitionBy(*parts).parquet(filters)
        _append(incoming, path, parts)
        return
    touched = _among(parts, listed)
    old = spark.read.schema(incoming.schema).parquet(path).filter(touched)
    both = incoming.withColumn("__source", F.lit(1)).unionByName(old.withColumn("__source", F.lit(0)))
    # a known key stays where it is
    home = F.min(F.when(F.col("__source") == 0, F.struct(*[F.col(p).alias(f"__{p}") for p in parts]))).alias("__home")
    rest = [c for c in both.columns if c not in keys and c not in (order, "__source")]
    newest = F.max(F.struct(*([order] if order else []), "__source", *rest)).alias("__row")
    latest = both.groupBy(*keys).agg(newest, home).select(*keys, "__row.*", "__home")
    for p in parts:
        latest = latest.withColumn(p, F.when(F.col("__home").isNotNull(), F.col(f"__home.__{p}")).otherwise(F.col(p)))
    rows = written(latest.select(*incoming.columns), "merge")
    kept, fresh = rows.filter(touched), rows.filter(~touched)
    new.write.mode("append").partitionBy(*parts).parquet(filters)
    kept.hint("rebalance", *parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)
    _append(fresh, path, parts)
    # now the rewritten partitions' filters can be made of what they hold, once each
    _key_filter(kept, keys, parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(filters)


def stored_keys(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str], bucket: tuple[str, Column], period: str, schema: str) -> DataFrame:
    """Rows of the table of :func:`merge` that may have a key of ``batch``: those of the partitions its filters name."""
    if not (table_exists(spark, path) and table_exists(spark, f"{path}_keys")):
        return spark.createDataFrame([], schema)
    parts = (period, bucket[0])
    filters = spark.read.parquet(f"{path}_keys")
    listed = [tuple(r) for r in possible_partitions(filters, batch.withColumn(*bucket), keys, parts).collect()]
    return spark.read.parquet(path).filter(_among(parts, listed))


def _append(rows: DataFrame, path: str, parts: Sequence[str]) -> None:
    if not rows.isEmpty():
        rows.hint("rebalance", *parts).write.mode("append").partitionBy(*parts).parquet(path)


def upsert_posts(
    spark: SparkSession, path: str, posts: DataFrame, order: str | None = None, buckets: int = URI_BUCKETS, created: str | None = "record__created_at"
) -> None:
    """Posts by keyword and uri, by month of creation and hash bucket; a post that two keywords find is stored for each.

    ``created`` names the column of the month; without one all posts are of one period.
    """
    month = F.trunc(created, "month") if created else F.lit(None).cast("date")
    bucket = F.pmod(F.xxhash64("keyword", "uri"), F.lit(buckets)).cast("int")
    merge(spark, path, posts, ("keyword", "uri"), ("post_month", month), ("post_bucket", bucket), order)


def upsert_hints(spark: SparkSession, path: str, hints: DataFrame, buckets: int = URI_BUCKETS) -> None:
    """Annotations by uri, by the month they were made in and hash bucket; they are narrow rows without a date of their own."""
    merge(spark, path, hints, ("uri",), ("hint_month", F.trunc(F.current_date(), "month")), _hint_bucket(buckets))


def _hint_bucket(buckets: int) -> tuple[str, Column]:
    return "uri_bucket", F.pmod(F.xxhash64("uri"), F.lit(buckets)).cast("int")


def hints_of(spark: SparkSession, path: str, posts: DataFrame, schema: str, buckets: int = URI_BUCKETS) -> DataFrame:
    """Stored annotations that posts of ``posts`` may have, without reading what none of their uris can hit."""
    return stored_keys(spark, path, posts.select("uri"), ("uri",), _hint_bucket(buckets), "hint_month", schema)


def materialize(df: DataFrame, name: str, kind: str = "view", path: str | None = None) -> DataFrame:
    """Publish a model: a view is re-evaluated by its readers, a table is stored."""
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if kind != "table":
        raise ValueError(f"unknown materialisation {kind!r}")
    if path is None:
        df.write.mode("overwrite").saveAsTable(name)
        return spark.table(name)
    replace(df, path)
    out = spark.read.parquet(path)
    out.createOrReplaceTempView(name)
    return out


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV folder with header. ``single_file`` is for report-sized results only."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).csv(path)


def export_forecast(result: DataFrame, importance: DataFrame, path: str, name: str, by: Sequence[str] = ()) -> None:
    """Forecast and long importance table as CSV folders for the dashboard; ``by`` names the columns of several series."""
    export_csv(result, f"{path}/{name}")
    export_csv(importance.select(*by, "variable", "value"), f"{path}/{name}_featureimp")
