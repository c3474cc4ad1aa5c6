"""Post tables: union over keywords, de-duplication, and filters by annotation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalflow.functions.dates import iso_week
from signalflow.functions.text import lang_matches

POST_COLUMNS = ("uri", "record__created_at", "record__text")


def union_tables(tables: Mapping[str, DataFrame], exclude: Sequence[str] = ("llm_hints",)) -> DataFrame:
    """UNION ALL of every keyword table but the excluded ones, columns matched by name."""
    chosen = [df for name, df in sorted(tables.items()) if name not in exclude]
    if not chosen:
        raise ValueError("no keyword table to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), chosen)


def language_posts(
    posts: DataFrame, lang: str, match: str = "contains", columns: Sequence[str] = POST_COLUMNS
) -> DataFrame:
    """Posts of a language, once each although several keyword tables hold them."""
    return posts.filter(lang_matches("record__langs", lang, match)).select(*columns).distinct()


def annotated(posts: DataFrame, hints: DataFrame, related_only: bool = False) -> DataFrame:
    """Posts that have an annotation, or only those annotated as ILI related."""
    if related_only:
        hints = hints.filter("ili_related")
    return posts.join(hints.select("uri"), "uri", "left_semi")


def pending(posts: DataFrame, hints: DataFrame, lang: str, limit: int | None = None) -> DataFrame:
    """Posts of exactly this language not annotated yet, with SQL's ``NOT IN`` rules.

    The null-aware anti join of Spark broadcasts the whole right side. The same
    result at any size: a shuffled anti join, plus ``NOT IN``'s two NULL rules as
    uncorrelated EXISTS tests, which are computed once and folded into the filter.
    Only uris pass the anti join; the texts are fetched for what is left, as a rule
    few enough that their uris are broadcast at run time.
    """
    known = hints.select("uri")
    in_lang = posts.filter(lang_matches("record__langs", lang, "exact"))
    keys = in_lang.select("uri").distinct()
    keys = keys.filter(~known.filter(F.col("uri").isNull()).exists())
    keys = keys.filter(F.col("uri").isNotNull() | ~known.exists())
    keys = keys.join(known, "uri", "left_anti").select(F.col("uri").alias("__uri"))
    rows = in_lang.select("uri", "record__text").join(keys, F.col("uri").eqNullSafe(F.col("__uri")), "left_semi")
    return rows if limit is None else rows.limit(limit)


# Tries after which a post that could not be annotated is left alone.
MOST_TRIES = 5
LEDGER_COLUMNS = "uri string, record__text string, record__langs string, tries int"


def enqueued(ledger: DataFrame, posts: DataFrame, hints: DataFrame) -> DataFrame:
    """The ledger of posts to annotate with those of a night's batch: ``(uri, record__text, record__langs, tries)``.

    A post enters once, whatever keywords found it, unless it has an annotation or stands in the ledger already; with
    different texts the greatest holds. ``hints`` needs only to hold the annotations that the batch's uris may have, so
    a night reads the backlog and the new posts, not all posts against all hints. A post without uri can't
    be annotated by uri and doesn't enter. The ledger has one row a uri.
    """
    new = posts.filter("uri IS NOT NULL").groupBy("uri").agg(F.max(F.struct("record__text", "record__langs")).alias("__post"))
    new = new.join(hints.select("uri"), "uri", "left_anti").join(ledger.select("uri"), "uri", "left_anti")
    return ledger.select("uri", "record__text", "record__langs", "tries").unionByName(new.select("uri", "__post.*", F.lit(0).alias("tries")))


def settled(ledger: DataFrame, labels: DataFrame, most_tries: int = MOST_TRIES) -> DataFrame:
    """The ledger after a night: annotated posts leave it, a failed one has one try more and leaves after the last.

    ``labels`` has ``uri`` and ``error`` (NULL: annotated) of the posts that were tried, others wait on.
    """
    tried = labels.groupBy("uri").agg(F.max(F.col("error").isNull()).alias("__done"))
    rows = ledger.join(tried, "uri", "left").filter("__done IS NULL OR NOT __done")
    rows = rows.withColumn("tries", F.col("tries") + F.when(F.col("__done").isNull(), 0).otherwise(1)).drop("__done")
    return rows.filter(F.col("tries") < most_tries).select(*ledger.columns)


def due(ledger: DataFrame, langs: Sequence[str], limit: int | None = None) -> DataFrame:
    """Posts of the ledger in exactly one of these languages, the least tried first where ``limit`` asks for a test run."""
    rows = ledger.filter(F.col("record__langs").isin(list(langs)))
    return rows if limit is None else rows.orderBy("tries", "uri").limit(limit)


def weekly_distinct(posts: DataFrame, name: str) -> DataFrame:
    """Distinct uris per ISO week of creation."""
    return posts.groupBy(iso_week("record__created_at").alias("iso_weekstartdate")).agg(
        F.count_distinct("uri").alias(name)
    )


def long_counts(posts: DataFrame) -> DataFrame:
    """Posts per (day, language, keyword)."""
    return posts.groupBy(
        F.to_date("record__created_at").alias("date"),
        F.col("record__langs").alias("langs"),
        F.col("keyword").alias("query"),
    ).agg(F.count(F.lit(1)).alias("post_count"))


def related_counts(posts: DataFrame, hints: DataFrame) -> DataFrame:
    """Distinct ILI-related posts per (day, language)."""
    return (
        annotated(posts, hints, related_only=True)
        .groupBy(F.to_date("record__created_at").alias("date"), F.col("record__langs").alias("langs"))
        .agg(F.count_distinct("uri").alias("ili_related"))
    )


def sample_rows(df: DataFrame, n: int, seed: int) -> DataFrame:
    """Random sample of exactly ``n`` rows (or all, if there are fewer)."""
    return df.orderBy(F.rand(seed)).limit(n)
