"""Post tables, annotation filters, slices and nested data."""

from __future__ import annotations

from pyspark.sql import functions as F

from signalflow.functions.dates import iso_seconds, mmwr_week, mmwr_week_start, mmwr_year, season, week_number_start, week_text_start
from signalflow.functions.text import map_strings, strip_nul
from signalflow.operators import posts as ops
from signalflow.operators.annotate import Lexicon, annotate, hint_rows, rule_annotation
from signalflow.operators.features import without_ends, without_open_week
from signalflow.plans import signals
from signalflow.plans.q_signals import signal, weekly
from signalflow.plans.registry import query
from signalflow.plans.standins import CAL, POST_SPEC, SPEC, cases, counts, event_posts, hints, posts, table, with_ctes
from signalflow.session import scratch_path, written
from signalflow.sources import sinks
from signalflow.sources.flatten import child_rows, flatten_struct


def keyword_tables(spark, sf):
    """Overlapping keyword tables: the same post is found by several keywords."""
    p = posts(spark, sf)
    return {
        "grippe": p.filter("keyword IN ('src0', 'src1', 'src2', 'src3', 'src4', 'src5', 'src6', 'src7', 'src8', 'src9')"),
        "rhume": p.filter("n_chars > 500"),
        "llm_hints": p,
    }


_TABLES = """, tables AS (
  SELECT * FROM posts WHERE keyword IN ('src0', 'src1', 'src2', 'src3', 'src4', 'src5', 'src6', 'src7', 'src8', 'src9')
  UNION ALL SELECT * FROM posts WHERE n_chars > 500)
"""


@query("posts_union_all", with_ctes("posts", _TABLES + "SELECT keyword, record__langs, count(*)::BIGINT AS n FROM tables GROUP BY ALL"))
def posts_union_all(spark, sf):
    return ops.union_tables(keyword_tables(spark, sf)).groupBy("keyword", "record__langs").agg(F.count(F.lit(1)).alias("n"))


@query(
    "posts_union_distinct",
    with_ctes("posts", _TABLES + "SELECT DISTINCT uri, record__created_at, record__text FROM tables WHERE record__langs LIKE '%en%'"),
)
def posts_union_distinct(spark, sf):
    return ops.language_posts(ops.union_tables(keyword_tables(spark, sf)), "en")


@query(
    "posts_annotated",
    with_ctes(
        "posts hints",
        "SELECT DISTINCT uri, record__created_at, record__text FROM posts WHERE record__langs LIKE '%fr%' AND uri IN (SELECT uri FROM hints)",
    ),
)
def posts_annotated(spark, sf):
    return ops.annotated(ops.language_posts(posts(spark, sf), "fr"), hints(spark, sf))


@query(
    "posts_related",
    with_ctes(
        "posts hints",
        """SELECT uri, record__created_at FROM posts
WHERE record__langs LIKE '%en%' AND uri IN (SELECT uri FROM hints WHERE ili_related)""",
    ),
)
def posts_related(spark, sf):
    return ops.annotated(ops.language_posts(posts(spark, sf), "en"), hints(spark, sf), related_only=True).select("uri", "record__created_at")


@query(
    "posts_pending",
    with_ctes("posts hints", "SELECT uri, record__text FROM posts WHERE record__langs = 'en' AND uri NOT IN (SELECT uri FROM hints)"),
)
def posts_pending(spark, sf):
    return ops.pending(posts(spark, sf), hints(spark, sf), "en")


@query(
    "posts_pending_null_hint",
    with_ctes(
        "posts hints",
        """, h AS (SELECT CASE WHEN ili_related THEN uri END AS uri FROM hints)
SELECT uri FROM posts WHERE record__langs = 'en' AND uri NOT IN (SELECT uri FROM h)""",
    ),
)
def posts_pending_null_hint(spark, sf):
    some_null = hints(spark, sf).select(F.when(F.col("ili_related"), F.col("uri")).alias("uri"))
    return ops.pending(posts(spark, sf), some_null, "en").select("uri")


@query(
    "posts_pending_test_run",
    with_ctes(
        "posts hints",
        """SELECT least(10, count(*))::BIGINT AS posts, least(10, count(*))::BIGINT AS uris FROM posts
WHERE record__langs = 'en' AND uri NOT IN (SELECT uri FROM hints)""",
    ),
)
def posts_pending_test_run(spark, sf):
    """Which ten posts a test run takes is open, so their number is compared."""
    some = ops.pending(posts(spark, sf), hints(spark, sf), "en", limit=10)
    return some.agg(F.count(F.lit(1)).alias("posts"), F.count_distinct("uri").alias("uris"))


@query(
    "labelled_weekly",
    with_ctes(
        "signal posts hints",
        """, l AS (
  SELECT date_trunc('week', record__created_at)::DATE AS iso_weekstartdate, count(DISTINCT uri)::BIGINT AS llm_post_count_na
  FROM posts WHERE record__langs LIKE '%en%' AND uri IN (SELECT uri FROM hints WHERE ili_related) GROUP BY 1)
SELECT s.*, l.iso_weekstartdate, l.llm_post_count_na, coalesce(l.llm_post_count_na, 0)::BIGINT AS llm_post_count
FROM l RIGHT JOIN signal s ON l.iso_weekstartdate = s.date""",
    ),
)
def labelled_weekly(spark, sf):
    return signals.labelled_weekly(posts(spark, sf), hints(spark, sf), "en", signal(spark, sf))


@query(
    "labelled_signal",
    with_ctes(
        "cases posts hints total_weekly",
        """, l AS (
  SELECT date_trunc('week', record__created_at)::DATE AS date, count(DISTINCT uri)::BIGINT AS n
  FROM posts WHERE record__langs LIKE '%en%' AND uri IN (SELECT uri FROM hints WHERE ili_related) GROUP BY 1),
f AS (SELECT w.date, coalesce(ili_case, 0) AS ili_case, coalesce(ili_pop_cov, 0) AS ili_pop_cov,
       coalesce(ari_case, 0) AS ari_case, coalesce(ari_pop_cov, 0) AS ari_pop_cov,
       coalesce(l.n, 0)::BIGINT AS ili_rel_posts, coalesce(l.n / (l.n + t.rest_posts), 0) AS norm_post_count, t.rest_posts
FROM weeks w LEFT JOIN l ON w.date = l.date
LEFT JOIN cases c ON w.date = c.iso_weekstartdate AND c.country_code = '7' AND c.agegroup_code = 'F'
LEFT JOIN total_weekly t ON w.date = t.date WHERE w.date > DATE '1995-08-01')
SELECT *, ari_case / (ari_pop_cov + 1) AS ari_incidence, ili_case / (ili_pop_cov + 1) AS ili_incidence FROM f""",
    ),
)
def labelled_signal(spark, sf):
    control = signals.control_counts(counts(spark, sf), SPEC, CAL)
    return signals.labelled_signal(posts(spark, sf), hints(spark, sf), cases(spark, sf), control, POST_SPEC, CAL)


@query(
    "long_counts",
    with_ctes(
        "posts",
        "SELECT record__created_at::DATE AS date, record__langs AS langs, keyword AS query, count(*)::BIGINT AS post_count FROM posts GROUP BY ALL",
    ),
)
def long_counts(spark, sf):
    return ops.long_counts(posts(spark, sf))


@query(
    "related_counts",
    with_ctes(
        "posts hints",
        """SELECT record__created_at::DATE AS date, record__langs AS langs, count(DISTINCT uri)::BIGINT AS ili_related
FROM posts WHERE uri IN (SELECT uri FROM hints WHERE ili_related) GROUP BY ALL""",
    ),
)
def related_counts(spark, sf):
    return ops.related_counts(posts(spark, sf), hints(spark, sf))


@query(
    "text_contains_without",
    with_ctes("posts", "SELECT uri FROM posts WHERE record__langs LIKE '%fr%' AND NOT record__text LIKE '%eau%'"),
)
def text_contains_without(spark, sf):
    rows = posts(spark, sf).filter(F.contains(F.col("record__langs"), F.lit("fr")) & ~F.contains(F.col("record__text"), F.lit("eau")))
    return rows.select("uri")


@query("post_sample", with_ctes("posts", "SELECT least(10, count(*))::BIGINT AS posts, least(10, count(*))::BIGINT AS uris FROM posts"))
def post_sample(spark, sf):
    some = ops.sample_rows(posts(spark, sf).select("uri", "record__langs"), 10, seed=42)
    return some.agg(F.count(F.lit(1)).alias("posts"), F.count_distinct("uri").alias("uris"))


@query(
    "closed_date_range",
    with_ctes("signal", "SELECT country_code, date, grippe_posts AS ili_posts, rest_posts AS control_posts FROM signal WHERE date BETWEEN DATE '1996-08-06' AND DATE '1999-03-30'"),
)
def closed_date_range(spark, sf):
    rows = signal(spark, sf).filter(F.col("date").between(F.lit("1996-08-06").cast("date"), F.lit("1999-03-30").cast("date")))
    return rows.select("country_code", "date", "grippe_posts", "rest_posts").withColumnsRenamed({"grippe_posts": "ili_posts", "rest_posts": "control_posts"})


@query(
    "position_slice",
    with_ctes(
        "weekly",
        """, r AS (SELECT country_code, iso_weekstartdate, ili_incidence,
  row_number() OVER (PARTITION BY country_code ORDER BY iso_weekstartdate) AS a,
  row_number() OVER (PARTITION BY country_code ORDER BY iso_weekstartdate DESC) AS z FROM weekly)
SELECT country_code, iso_weekstartdate, ili_incidence FROM r WHERE a > 3 AND z > 2""",
    ),
)
def position_slice(spark, sf):
    rows = weekly(spark, sf).select("country_code", "iso_weekstartdate", "ili_incidence")
    return without_ends(rows, ("country_code",), "iso_weekstartdate", first=3, last=2)


@query(
    "without_open_week",
    with_ctes("cases", "SELECT * FROM cases c WHERE iso_weekstartdate < (SELECT max(iso_weekstartdate) FROM cases d WHERE d.country_code = c.country_code)"),
)
def open_week_dropped(spark, sf):
    return without_open_week(cases(spark, sf), ("country_code",), "iso_weekstartdate")


@query(
    "json_flatten",
    """SELECT event_id, (props->>'k')::INT AS record__k, event_type AS record__meta__event_type, value AS record__meta__post_value FROM events""",
)
def json_flatten(spark, sf):
    nested = table(spark, sf, "events").select(
        F.col("event_id").alias("eventId"),
        F.struct(
            F.from_json("props", "k int")["k"].alias("k"),
            F.struct(F.col("event_type").alias("eventType"), F.col("value").alias("postValue")).alias("meta"),
        ).alias("record"),
    )
    return flatten_struct(nested)


@query(
    "json_child_rows",
    """WITH c AS (SELECT conv_id, turn, string_split(text, chr(10)) AS lines FROM conversations)
SELECT conv_id, turn, (i - 1)::INT AS list_idx, lines[i] AS body, length(lines[i])::INT AS meta__char_count
FROM c, unnest(generate_series(1, len(lines))) u(i)""",
)
def json_child_rows(spark, sf):
    line = lambda x: F.struct(x.alias("body"), F.struct(F.length(x).alias("charCount")).alias("meta"))
    nested = table(spark, sf, "conversations").select("conv_id", "turn", F.transform(F.split("text", "\n"), line).alias("lines"))
    return child_rows(nested, "lines", ("conv_id", "turn"))


@query(
    "nul_free_text",
    """SELECT conv_id, turn, replace(text, 'e', '') AS message__text, upper(role) AS role FROM conversations""",
)
def nul_free_text(spark, sf):
    """NUL characters put into nested texts, then removed by the recursive cleaner."""
    spoilt = table(spark, sf, "conversations").select(
        "conv_id", "turn", F.struct(F.struct(F.translate("text", "e", "\u0000").alias("text")).alias("message"), F.array(F.upper("role")).alias("roles")).alias("record")
    )
    clean = spoilt.withColumn("record", map_strings(F.col("record"), spoilt.schema["record"].dataType, strip_nul))
    return clean.select("conv_id", "turn", F.col("record.message.text").alias("message__text"), F.col("record.roles")[0].alias("role"))


LEXICON = Lexicon(
    first_person=("que", "der", "the"),
    fever=("le", "die", "and"),
    respiratory=("la", "und", "is"),
    systemic=("un", "in", "of", "du"),
    other_cause=("ist", "por"),
)
_WORDS = "regexp_extract_all(lower({}), '[\\p{{L}}\\p{{N}}]+')"


def _annotation_sql(source: str, text: str) -> str:
    return f""", w AS (SELECT uri, {_WORDS.format(text)} AS ws FROM {source})
SELECT uri,
       list_has_any(ws, ['que', 'der', 'the']) AND list_has_any(ws, ['le', 'die', 'and']) AND list_has_any(ws, ['la', 'und', 'is'])
         AND list_has_any(ws, ['un', 'in', 'of', 'du']) AND NOT list_has_any(ws, ['ist', 'por']) AS ili_related,
       array_to_string(list_filter(ws, lambda x: x IN ('le', 'die', 'and', 'la', 'und', 'is', 'un', 'in', 'of', 'du')), ',') AS symptoms
FROM w"""


@query("rule_annotation", with_ctes("posts", _annotation_sql("posts", "record__text")))
def rules(spark, sf):
    found = rule_annotation(posts(spark, sf), lexicon=LEXICON)
    return hint_rows(found).withColumn("symptoms", F.lower("symptoms"))


NEAR = Lexicon(LEXICON.first_person, LEXICON.fever, LEXICON.respiratory, LEXICON.systemic, others=("with", "en", "sich"), subject=("the", "que"))


@query(
    "rule_annotation_others",
    with_ctes(
        "posts",
        f""", w AS (SELECT conv_id || '/' || turn AS uri, {_WORDS.format("text")} AS ws FROM conversations)
SELECT uri, coalesce(list_has_any(ws, ['que', 'der', 'the']) AND list_has_any(ws, ['le', 'die', 'and']) AND list_has_any(ws, ['la', 'und', 'is'])
         AND list_has_any(ws, ['un', 'in', 'of', 'du']) AND (NOT list_has_any(ws, ['with', 'en', 'sich']) OR list_has_any(ws, ['the', 'que'])), false) AS ili_related
FROM w""",
    ),
)
def rules_about_others(spark, sf):
    """Turns of conversations: the illness of somebody near counts only if the writer is a subject too."""
    turns = table(spark, sf, "conversations").select(F.concat_ws("/", "conv_id", "turn").alias("uri"), F.col("text").alias("record__text"))
    return rule_annotation(turns, lexicon=NEAR).select("uri", "ili_related")


@query(
    "stored_posts_by_keyword",
    with_ctes("event_posts", "SELECT keyword, count(DISTINCT k)::BIGINT AS uris, max(event_time) AS newest FROM event_posts GROUP BY 1"),
)
def stored_posts_by_keyword(spark, sf):
    """Posts merged in two batches: one that several keywords found is kept for each, in its latest version."""
    path = scratch_path(spark, "posts")
    versions = event_posts(spark, sf).select("keyword", F.col("k").cast("string").alias("uri"), "event_time")
    for batch in (versions.filter("minute(event_time) < 40"), versions.filter("minute(event_time) >= 20")):
        sinks.upsert_posts(spark, path, batch, "event_time", buckets=4, created="event_time")
    return spark.read.parquet(path).groupBy("keyword").agg(F.count("uri").alias("uris"), F.max("event_time").alias("newest"))


def _length_rule(text: str) -> dict:
    if len(text) > 10_000:
        raise ValueError("too long")
    return {"ili_related": len(text) > 1_000, "symptoms": ["long"] if len(text) > 1_000 else []}


@query(
    "function_annotation",
    with_ctes(
        "posts",
        """SELECT uri, CASE WHEN length(record__text) <= 10000 THEN length(record__text) > 1000 END AS ili_related,
       CASE WHEN length(record__text) > 10000 THEN NULL WHEN length(record__text) > 1000 THEN 'long' ELSE '' END AS symptoms,
       CASE WHEN length(record__text) > 10000 THEN 'ValueError: too long' END AS error FROM posts""",
    ),
)
def function_annotation(spark, sf):
    return annotate(posts(spark, sf), _length_rule).withColumn("symptoms", F.array_join("symptoms", ","))


@query(
    "annotation_run",
    with_ctes(
        "posts hints",
        """SELECT uri, ili_related, symptoms FROM hints
UNION ALL SELECT uri, length(record__text) > 1000, CASE WHEN length(record__text) > 1000 THEN 'long' ELSE '' END FROM posts
WHERE record__langs = 'en' AND uri NOT IN (SELECT uri FROM hints) AND length(record__text) <= 10000""",
    ),
)
def annotation_run(spark, sf):
    """Annotate what is pending and merge it into the stored hints; failed rows stay pending."""
    path = scratch_path(spark, "hints")
    sinks.upsert_hints(spark, path, hints(spark, sf), buckets=4)
    stored = spark.read.parquet(path)
    fresh = annotate(ops.pending(posts(spark, sf), stored, "en"), _length_rule)
    sinks.upsert_hints(spark, path, hint_rows(fresh), buckets=4)
    return spark.read.parquet(path).drop("hint_month", "uri_bucket")


@query(
    "annotation_ledger",
    with_ctes(
        "posts hints",
        """SELECT uri, CASE WHEN record__langs <> 'en' THEN 0 WHEN record__created_at < TIMESTAMP '1998-01-01' THEN 2 ELSE 1 END AS tries
FROM posts WHERE uri NOT IN (SELECT uri FROM hints) AND (record__langs <> 'en' OR length(record__text) > 10000)""",
    ),
)
def annotation_ledger(spark, sf):
    """What waits after two nights: posts of other languages, and English ones whose annotation fails, with their tries."""
    path = scratch_path(spark, "hints")
    sinks.upsert_hints(spark, path, hints(spark, sf), buckets=4)
    schema = "uri string, ili_related boolean, symptoms string"
    ledger = spark.createDataFrame([], ops.LEDGER_COLUMNS)
    early = F.col("record__created_at") < F.lit("1998-01-01").cast("timestamp")
    for night in (early, ~early):
        new = posts(spark, sf).filter(night)
        ledger = written(ops.enqueued(ledger, new, sinks.hints_of(spark, path, new, schema, buckets=4)), "ledger")
        labels = written(annotate(ops.due(ledger, ("en",)), _length_rule), "labels")
        sinks.upsert_hints(spark, path, hint_rows(labels), buckets=4)
        ledger = written(ops.settled(ledger, labels), "ledger")
    return ledger.select("uri", "tries")


@query(
    "mmwr_week",
    """WITH s AS (SELECT DISTINCT o_orderdate::DATE AS d, o_orderdate::DATE - dayofweek(o_orderdate)::INT AS sunday FROM orders),
y AS (SELECT d, sunday, year(sunday + 3)::INT AS y FROM s),
f AS (SELECT d, sunday, y, make_date(y, 1, 4) - dayofweek(make_date(y, 1, 4))::INT AS first FROM y)
SELECT d AS date, y AS mmwr_year, ((sunday - first) // 7 + 1)::INT AS mmwr_week, sunday AS week_start FROM f""",
)
def epi_weeks(spark, sf):
    days = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date")).distinct()
    weeks = days.withColumns({"mmwr_year": mmwr_year("date"), "mmwr_week": mmwr_week("date")})
    return weeks.withColumn("week_start", mmwr_week_start("mmwr_year", "mmwr_week"))


@query(
    "week_text_and_number",
    """SELECT DISTINCT date_trunc('week', o_orderdate)::DATE AS monday, strftime(o_orderdate, '%G-W%V') AS week_text,
       isoyear(o_orderdate)::INT * 100 + week(o_orderdate)::INT AS week_number,
       date_trunc('week', o_orderdate)::DATE AS from_text, date_trunc('week', o_orderdate)::DATE AS from_number,
       strptime(isoyear(o_orderdate) || '-W' || lpad(week(o_orderdate)::VARCHAR, 2, '0') || '-1', '%Y-W%W-%w')::DATE AS from_text_legacy,
       true AS bad_text_is_null
FROM orders""",
)
def week_parsing(spark, sf):
    weeks = table(spark, sf, "orders").select(F.trunc(F.to_date("o_orderdate"), "week").alias("monday")).distinct()
    iso_year = F.year(F.date_add("monday", 3))
    number = F.weekofyear("monday")
    text = F.format_string("%d-W%02d", iso_year, number)
    return weeks.select(
        "monday",
        text.alias("week_text"),
        (iso_year * 100 + number).alias("week_number"),
        week_text_start(text).alias("from_text"),
        week_number_start(iso_year * 100 + number).alias("from_number"),
        week_text_start(text, legacy=True).alias("from_text_legacy"),
        week_text_start(F.concat(text, F.lit("x"))).isNull().alias("bad_text_is_null"),
    )


@query(
    "date_parts",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS text, year(ts)::INT AS year, month(ts)::INT AS month, week(ts)::INT AS week, day(ts)::INT AS day,
       CASE WHEN month(ts) IN (12, 1, 2) THEN 'Winter' WHEN month(ts) < 6 THEN 'Spring' WHEN month(ts) < 9 THEN 'Summer' ELSE 'Autumn' END AS season
FROM events""",
)
def date_parts(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", iso_seconds("ts").alias("text"), F.year("ts").alias("year"), F.month("ts").alias("month"),
        F.weekofyear("ts").alias("week"), F.dayofmonth("ts").alias("day"), season(F.month("ts")).alias("season"),
    )
