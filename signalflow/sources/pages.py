"""Landed search-result pages (JSON) as post rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalflow.functions.dates import earliest_instant, parse_instant
from signalflow.functions.text import map_strings, strip_nul
from signalflow.operators.counts import page_counts

POST = T.StructType(
    [
        T.StructField("uri", T.StringType()),
        T.StructField("indexedAt", T.StringType()),
        T.StructField("author", T.StructType([T.StructField("did", T.StringType()), T.StructField("handle", T.StringType())])),
        T.StructField(
            "record",
            T.StructType(
                [
                    T.StructField("text", T.StringType()),
                    T.StructField("createdAt", T.StringType()),
                    T.StructField("langs", T.ArrayType(T.StringType())),
                ]
            ),
        ),
        # free-form part of the answer, kept as JSON text
        T.StructField("embed", T.StringType()),
    ]
)

PAGE_SCHEMA = T.StructType(
    [
        T.StructField("page_id", T.StringType()),
        T.StructField("until", T.StringType()),
        T.StructField("posts", T.ArrayType(POST)),
    ]
)


def _posts(pages: DataFrame, keyword_col: str) -> DataFrame:
    page_id = F.coalesce(F.col("page_id"), F.col("__file"))
    rows = pages.select(
        F.col(keyword_col).cast("string").alias("keyword"),
        page_id.alias("page_id"),
        parse_instant("until").alias("page_until"),
        F.inline("posts"),
    )
    rows = rows.select(
        "keyword", "page_id", "page_until", "uri", "indexedAt", "author", "embed",
        map_strings(F.col("record"), POST["record"].dataType, strip_nul).alias("record"),
    )
    # NUL inside free-form JSON is written as its escape
    embed = F.replace(strip_nul("embed"), F.lit("\\u0000"), F.lit(""))
    return rows.select(
        "uri",
        parse_instant("record.createdAt").alias("created_at"),
        parse_instant("indexedAt").alias("indexed_at"),
        earliest_instant("record.createdAt", "indexedAt").alias("event_time"),
        F.col("record.text").alias("text"),
        F.coalesce(F.col("record.langs"), F.array().cast("array<string>")).alias("langs"),
        F.col("author.did").alias("author"),
        embed.alias("embed"),
        "keyword",
        "page_id",
        "page_until",
    )


def read_post_pages(
    spark: SparkSession, path: str, keyword_col: str = "keyword", multi_line: bool = False, days: tuple | None = None
) -> DataFrame:
    """One row per post from pages below ``path/keyword=<kw>/``, or ``path/keyword=<kw>/day=<date>/``.

    With ``days``, the first and last day of the partition column ``day`` to read, other folders are not listed for reading.

    A page is one JSON document: ``{"page_id"?, "until"?, "posts": [...]}``. Without a
    page id the file is the page. Unreadable instants become NULL, NUL characters
    are removed from all texts.
    """
    reader = spark.read.schema(PAGE_SCHEMA).option("multiLine", multi_line)
    pages = reader.json(path)
    if days is not None:
        pages = pages.filter(F.col("day").cast("date").between(*[F.lit(str(d)).cast("date") for d in days]))
    return _posts(pages.withColumn("__file", F.col("_metadata.file_path")), keyword_col)


def stream_post_pages(
    spark: SparkSession, path: str, keyword_col: str = "keyword", multi_line: bool = False, files_per_trigger: int | None = None
) -> DataFrame:
    """The same rows as a file stream: a file is read once, however often the job runs."""
    schema = T.StructType([*PAGE_SCHEMA.fields, T.StructField(keyword_col, T.StringType())])
    reader = spark.readStream.schema(schema).option("multiLine", multi_line)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return _posts(reader.json(path).withColumn("__file", F.col("_metadata.file_path")), keyword_col)


def staged_posts(posts: DataFrame) -> DataFrame:
    """Posts in the staged layout ``uri, record__created_at, record__text, record__langs, keyword``."""
    return posts.select(
        "uri",
        F.col("created_at").alias("record__created_at"),
        F.col("text").alias("record__text"),
        F.array_join("langs", ",").alias("record__langs"),
        "keyword",
    )


def count_pages(posts: DataFrame) -> DataFrame:
    """Pages as structs of parallel arrays: ``period_start[], period_end[], langs[], post_count[]``."""
    per_lang = page_counts(posts)
    # a page that was crawled again counts with its later bound
    ends = posts.groupBy("keyword", "page_id").agg(F.max("page_until").alias("page_until"))
    rows = F.sort_array(F.collect_list(F.struct("langs", "period_start", "page_until", "post_count")))
    return (
        per_lang.join(ends, ["keyword", "page_id"])
        .groupBy("keyword", "page_id")
        .agg(rows.alias("r"))
        .select(
            "keyword",
            "page_id",
            F.col("r.period_start").alias("period_start"),
            F.col("r.page_until").alias("period_end"),
            F.col("r.langs").alias("langs"),
            F.col("r.post_count").alias("post_count"),
        )
    )


def unpack_count_pages(pages: DataFrame) -> DataFrame:
    """Parallel arrays back to one row per (page, language)."""
    return pages.select(
        "keyword", "page_id", F.inline(F.arrays_zip("period_start", "period_end", "langs", "post_count"))
    )
