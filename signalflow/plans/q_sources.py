"""Readers and writers: files are written from the test tables, then read back by the engine."""

from __future__ import annotations

from pyspark.sql import functions as F

from signalflow.functions.dates import mmwr_week, mmwr_year
from signalflow.operators import counts as count_ops
from signalflow.operators import tokens as token_ops
from signalflow.operators.posts import language_posts
from signalflow.plans.q_signals import signal
from signalflow.plans.registry import query
from signalflow.plans.standins import cases, event_posts, posts, table, with_ctes
from signalflow.session import scratch_path
from signalflow.sources import drift, pages, sinks, surveillance, tables

INSTANT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def land_pages(spark, sf) -> str:
    """Result pages as JSON: at most 50 posts of one keyword a page, a folder per keyword."""
    p = event_posts(spark, sf).withColumn("page", F.floor(F.col("uri").cast("bigint") / 50))
    created = F.date_format("event_time", INSTANT)
    indexed = F.when(F.col("k") % 2 == 0, F.date_format(F.col("event_time") - F.expr("interval 1 hour"), INSTANT))
    post = F.struct(
        "uri",
        indexed.alias("indexedAt"),
        F.struct(F.concat(F.lit("post\u0000 "), F.col("uri")).alias("text"), created.alias("createdAt"), "langs").alias("record"),
        F.struct(F.lit("image").alias("kind"), F.col("k").alias("size")).alias("embed"),
    )
    landed = p.groupBy("keyword", "page").agg(
        F.collect_list(post).alias("posts"), F.date_format(F.max("event_time"), INSTANT).alias("until")
    )
    path = scratch_path(spark, "pages")
    landed.withColumn("page_id", F.concat_ws("-", "keyword", "page")).drop("page").write.partitionBy("keyword").json(path)
    return path


_LANDED = """, landed AS (SELECT *, CASE WHEN k % 2 = 0 THEN event_time - INTERVAL 1 HOUR ELSE event_time END AS seen,
  keyword || '-' || (uri::BIGINT // 50)::VARCHAR AS page FROM event_posts)"""


@query(
    "read_post_pages",
    with_ctes(
        "event_posts",
        _LANDED
        + """SELECT uri, event_time AS created_at, CASE WHEN k % 2 = 0 THEN event_time - INTERVAL 1 HOUR END AS indexed_at, seen AS event_time,
       'post ' || uri AS text, langs, '{"kind":"image","size":' || k || '}' AS embed, keyword, page AS page_id,
       max(event_time) OVER (PARTITION BY page) AS page_until FROM landed""",
    ),
)
def read_post_pages(spark, sf):
    rows = pages.read_post_pages(spark, land_pages(spark, sf))
    return rows.drop("author").withColumn("langs", F.array_join("langs", ","))


@query(
    "landed_daily_counts",
    with_ctes(
        "event_posts",
        _LANDED + "SELECT seen::DATE AS period_start, langs, keyword AS query, count(*)::BIGINT AS post_count FROM landed GROUP BY ALL",
    ),
)
def landed_daily_counts(spark, sf):
    return count_ops.daily_counts(pages.read_post_pages(spark, land_pages(spark, sf)))


@query(
    "staged_language_posts",
    with_ctes("event_posts", "SELECT uri, event_time AS record__created_at, 'post ' || uri AS record__text FROM event_posts WHERE langs LIKE '%de%'"),
)
def staged_language_posts(spark, sf):
    staged = pages.staged_posts(pages.read_post_pages(spark, land_pages(spark, sf)))
    return language_posts(staged, "de")


WHO_SCHEMA = (
    "ISO_WEEKSTARTDATE string, COUNTRY_CODE string, AGEGROUP_CODE string, ILI_CASE double, ILI_POP_COV double, "
    "ARI_CASE double, ARI_POP_COV double, COMMENTS string"
)


def land_who(spark, sf) -> str:
    c = cases(spark, sf).select(
        F.date_format("iso_weekstartdate", "yyyy-MM-dd").alias("ISO_WEEKSTARTDATE"), F.col("country_code").alias("COUNTRY_CODE"),
        F.col("agegroup_code").alias("AGEGROUP_CODE"), F.col("ili_case").alias("ILI_CASE"), F.col("ili_pop_cov").alias("ILI_POP_COV"),
        F.col("ari_case").alias("ARI_CASE"), F.col("ari_pop_cov").alias("ARI_POP_COV"), F.lit("a, comment").alias("COMMENTS"),
    )
    path = scratch_path(spark, "who")
    sinks.export_csv(c, path)
    return path


@query("who_cases_csv", with_ctes("cases", "SELECT * FROM cases WHERE country_code = '7'"))
def who_cases_csv(spark, sf):
    read = surveillance.read_who(spark, land_who(spark, sf), "fluid", WHO_SCHEMA)
    return surveillance.country_rows(read, "7").withColumnsRenamed({c: c.lower() for c in read.columns})


@query(
    "who_virology_csv",
    with_ctes("cases", "SELECT iso_weekstartdate, country_code, sum(ili_pop_cov)::BIGINT AS inf_all FROM cases GROUP BY ALL"),
)
def who_virology_csv(spark, sf):
    c = cases(spark, sf).groupBy(F.col("iso_weekstartdate").alias("ISO_WEEKSTARTDATE"), F.col("country_code").alias("COUNTRY_CODE")).agg(
        F.sum("ili_pop_cov").cast("bigint").alias("INF_ALL"), F.lit(0).alias("BVIC_DELUNK"), F.lit(0).alias("BYAM")
    )
    path = scratch_path(spark, "virology")
    sinks.export_csv(c, path)
    schema = "ISO_WEEKSTARTDATE string, COUNTRY_CODE string, INF_ALL bigint, BVIC_DELUNK int, BYAM int"
    return surveillance.read_who(spark, path, "flunet", schema, lower=True)


@query(
    "rki_tsv",
    """SELECT date_trunc('week', o_orderdate)::DATE AS ISO_WEEKSTARTDATE, strftime(date_trunc('week', o_orderdate), '%G-W%V') AS Kalenderwoche,
       count(*)::BIGINT AS Faelle FROM orders GROUP BY ALL""",
)
def rki_tsv(spark, sf):
    monday = F.trunc(F.to_date("o_orderdate"), "week")
    weekly = table(spark, sf, "orders").groupBy(
        F.format_string("%d-W%02d", F.year(F.date_add(monday, 3)), F.weekofyear(monday)).alias("Kalenderwoche")
    ).agg(F.count(F.lit(1)).alias("Faelle"))
    path = scratch_path(spark, "rki")
    weekly.write.option("header", True).option("sep", "\t").csv(path)
    return surveillance.read_rki(spark, path, "grippenet", "Kalenderwoche string, Faelle bigint")


@query(
    "cdc_table",
    "SELECT year(o_orderdate)::INT * 100 + week(o_orderdate)::INT AS epiweek, count(*)::BIGINT AS num_ili FROM orders GROUP BY 1",
)
def cdc_table(spark, sf):
    number = F.year("o_orderdate") * 100 + F.weekofyear("o_orderdate")
    weekly = table(spark, sf, "orders").groupBy(number.alias("epiweek")).agg(F.count(F.lit(1)).alias("num_ili"))
    path = scratch_path(spark, "cdc") + ".json"
    weekly.write.json(path)
    return surveillance.read_cdc(spark, path, "fluview", "epiweek int, num_ili bigint")


def _with_first_line(df, line: str, path: str) -> None:
    """CSV text files that each start with a line of free text above the header."""
    header = ",".join(df.columns)
    body = F.concat_ws(",", *[F.col(c).cast("string") for c in df.columns])
    lines = df.select(F.struct(F.lit(2).alias("o"), body.alias("value")).alias("l"))
    top = df.sparkSession.createDataFrame([(0, line), (1, header)], "o int, value string")
    rows = lines.select("l.*").unionByName(top)
    # weekly report: a few hundred rows in one file, as its publishers ship it
    rows.coalesce(1).sortWithinPartitions("o").select("value").write.text(path)


@query(
    "labs_csv",
    """WITH s AS (SELECT o_orderdate::DATE AS d, o_orderdate::DATE - dayofweek(o_orderdate)::INT AS sunday FROM orders),
y AS (SELECT sunday, year(sunday + 3)::INT AS y FROM s),
f AS (SELECT sunday, y, make_date(y, 1, 4) - dayofweek(make_date(y, 1, 4))::INT AS first FROM y)
SELECT y AS YEAR, ((sunday - first) // 7 + 1)::INT AS WEEK, count(*)::BIGINT AS "TOTAL SPECIMENS", sunday AS week_start FROM f GROUP BY ALL""",
)
def labs_csv(spark, sf):
    weekly = table(spark, sf, "orders").groupBy(mmwr_year("o_orderdate").alias("YEAR"), mmwr_week("o_orderdate").alias("WEEK")).agg(
        F.count(F.lit(1)).alias("TOTAL SPECIMENS")
    )
    path = scratch_path(spark, "labs")
    _with_first_line(weekly, '"*Laboratory reports, by week."', path)
    return surveillance.read_labs(spark, path, "YEAR int, WEEK int, `TOTAL SPECIMENS` bigint")


@query(
    "sentinel_csv",
    """SELECT isoyear(o_orderdate)::INT * 100 + week(o_orderdate)::INT AS week, 'FR' AS geo_insee, 25::INT AS indicator, count(*)::BIGINT AS inc,
       date_trunc('week', o_orderdate)::DATE AS week_start FROM orders GROUP BY ALL""",
)
def sentinel_csv(spark, sf):
    monday = F.trunc(F.to_date("o_orderdate"), "week")
    number = F.year(F.date_add(monday, 3)) * 100 + F.weekofyear(monday)
    weekly = table(spark, sf, "orders").groupBy(number.alias("week"), F.lit("FR").alias("geo_insee"), F.lit(25).alias("indicator")).agg(
        F.count(F.lit(1)).alias("inc")
    )
    wide = weekly.select("*", *[F.col("inc").alias(c) for c in ("inc100", "inc_up", "inc_low", "inc100_up", "inc100_low")])
    path = scratch_path(spark, "sentinel")
    _with_first_line(wide, '# {"columns": {"time": "week"}}', path)
    return surveillance.read_sentinel(spark, path).select("week", "geo_insee", "indicator", "inc", "week_start")


@query(
    "baseline_csv",
    "SELECT event_type AS query, ts::DATE AS period_start, count(*)::BIGINT AS post_count FROM events GROUP BY ALL",
)
def baseline_csv(spark, sf):
    daily = table(spark, sf, "events").groupBy(F.col("event_type").alias("query"), F.to_date("ts").alias("period_start")).agg(
        F.count(F.lit(1)).alias("post_count")
    )
    base = scratch_path(spark, "baseline")
    daily.withColumn("file", F.concat(F.lit("baseline_"), F.col("query"), F.lit(".csv"))).drop("query").write.option("header", True).partitionBy("file").csv(base)
    # partition folders named file=baseline_<keyword>.csv stand for the published files
    return surveillance.read_baseline(spark, f"{base}/file=baseline_*")


@query("stored_signal_by_date", with_ctes("signal", "SELECT * FROM signal"))
def stored_signal_by_date(spark, sf):
    path = scratch_path(spark, "signal")
    sinks.materialize(signal(spark, sf), "signal_table", "table", path)
    return tables.load_table(spark, path, order="date")


@query(
    "signal_dataset",
    with_ctes(
        "signal",
        """SELECT * EXCLUDE (grippe_posts, rest_posts), grippe_posts AS ili_posts, rest_posts AS control_posts,
       year(date)::INT AS year, month(date)::INT AS month, week(date)::INT AS week,
       CASE WHEN month(date) IN (12, 1, 2) THEN 'Winter' WHEN month(date) < 6 THEN 'Spring' WHEN month(date) < 9 THEN 'Summer' ELSE 'Autumn' END AS season
FROM signal""",
    ),
)
def signal_dataset(spark, sf):
    path = scratch_path(spark, "weekly")
    sinks.replace(signal(spark, sf), path)
    return tables.signal_registry({"fr": path}, {}).load(spark, "grippe_posts_fr")


@query("text_corpus_from_sql", with_ctes("posts", "SELECT uri, record__created_at, record__text FROM posts WHERE record__langs = 'fr'"))
def text_corpus_from_sql(spark, sf):
    sinks.materialize(posts(spark, sf), "corpus_posts", "view")
    return tables.text_corpus(spark, query="SELECT uri, record__created_at, record__text FROM corpus_posts WHERE record__langs = 'fr'")


@query("text_corpus_from_csv", with_ctes("posts", "SELECT uri, length(record__text)::INT AS n FROM posts"))
def text_corpus_from_csv(spark, sf):
    path = scratch_path(spark, "corpus")
    posts(spark, sf).select("uri", "record__text").write.option("header", True).option("escape", '"').csv(path)
    return tables.text_corpus(spark, input_file=path, schema="uri string, record__text string").select("uri", F.length("record__text").alias("n"))


@query(
    "weekly_tokens_csv",
    with_ctes(
        "posts",
        """SELECT date_trunc('week', record__created_at)::DATE AS iso_weekstartdate, keyword AS token, count(*)::BIGINT AS cnt
FROM posts GROUP BY ALL""",
    ),
)
def weekly_tokens_csv(spark, sf):
    """Wide export and import of a weekly table (sources stand for tokens)."""
    long = posts(spark, sf).groupBy(F.trunc(F.to_date("record__created_at"), "week").alias("iso_weekstartdate"), F.col("keyword").alias("token")).agg(
        F.count(F.lit(1)).alias("cnt")
    )
    path = scratch_path(spark, "wide")
    sinks.export_csv(token_ops.wide_tokens(long), path, single_file=True)
    out = tables.long_weekly_tokens(tables.read_weekly_tokens(spark, path))
    return out.withColumn("cnt", F.col("cnt").cast("bigint"))


@query(
    "json_drift",
    """WITH e AS (SELECT event_id, CAST(props->>'k' AS INT) AS k, user_id, event_type, value, ts >= TIMESTAMP '2024-01-16' AS later FROM events)
SELECT event_id, user_id AS user__id, CASE WHEN later THEN 'k' || k ELSE k::VARCHAR END AS k,
  CASE WHEN later THEN event_type END AS user__kind, CASE WHEN later THEN value END AS post_value,
  CASE WHEN later THEN event_type || ',' || k END AS tags
FROM e""",
)
def json_drift(spark, sf):
    """Two batches of events: the second has new fields, and another type in an old one."""
    k = F.get_json_object("props", "$.k").cast("int")
    text = k.cast("string")
    user, later = F.col("user_id").alias("id"), F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    early = F.to_json(F.struct(k.alias("k"), F.struct(user).alias("user")))
    full = F.struct(
        F.concat(F.lit("k"), text).alias("k"),
        F.struct(user, F.col("event_type").alias("kind")).alias("user"),
        F.col("value").alias("postValue"),
        F.array(F.col("event_type"), text).alias("tags"),
    )
    events, path = table(spark, sf, "events"), scratch_path(spark, "drift")
    drift.land_batch(events.filter(~later).withColumn("raw", early), path, "1", "raw", ("event_id",))
    drift.land_batch(events.filter(later).withColumn("raw", F.to_json(full)), path, "2", "raw", ("event_id",))
    rows = drift.read_drifting(spark, path, ("event_id",))
    return rows.select("event_id", "user__id", "k", "user__kind", F.col("post_value").cast("double"), F.array_join("tags", ",").alias("tags"))
