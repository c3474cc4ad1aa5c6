"""Text queries: cleaning, weekly tokens, vocabularies."""

from __future__ import annotations

from pyspark.sql import functions as F

from signalflow.functions import french
from signalflow.functions.text import clean_text, stop_words
from signalflow.operators import tokens as ops
from signalflow.operators.models import estimator
from signalflow.operators.stats import regression_scores
from signalflow.plans import signals
from signalflow.plans.q_signals import signal
from signalflow.plans.registry import query
from signalflow.plans.standins import posts, with_ctes
from signalflow.session import scratch_path

STOP = ("the", "and", "of", "is", "le", "la", "les", "un", "une", "der", "die", "und", "de", "que", "el")
STOP_SQL = ", ".join(f"'{w}'" for w in STOP)
WORDS = ("eau", "the", "and", "der", "que")

# white space as Python sees it, for a regular-expression engine whose \s is ASCII only
_WS = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def _clean_sql(text: str) -> str:
    for pattern in (f"http[^{_WS}]+", f"@[^{_WS}]+", f"#[^{_WS}]+", f"[^a-zA-ZÀ-ÿ{_WS}]"):
        text = f"regexp_replace({text}, '{pattern}', '', 'g')"
    return f"lower({text})"


_SPLIT = {"cannot": "can not", "gimme": "gim me", "gonna": "gon na", "gotta": "got ta", "lemme": "lem me", "wanna": "wan na"}
_TOKENS = f"""raw AS (
  SELECT uri, record__langs, date_trunc('week', record__created_at)::DATE AS iso_weekstartdate,
         list_filter(regexp_split_to_array({_clean_sql('record__text')}, '[{_WS}]+'), lambda w: w <> '') AS ws FROM posts),
arrays AS (
  SELECT uri, record__langs, iso_weekstartdate, list_filter(flatten(list_transform(ws, lambda w: CASE w
    {' '.join(f"WHEN '{k}' THEN {v.split()}" for k, v in _SPLIT.items())} ELSE [w] END)), lambda w: w NOT IN ({STOP_SQL})) AS ws FROM raw),
tokens AS (SELECT uri, record__langs, iso_weekstartdate, unnest(ws) AS token FROM arrays),
weekly_tokens AS (SELECT iso_weekstartdate, token, count(*)::BIGINT AS cnt FROM tokens GROUP BY ALL)"""


def weekly_tokens(spark, sf, **options):
    return ops.weekly_tokens(posts(spark, sf), stop=STOP, **options)


@query("clean_text", with_ctes("posts", f"SELECT uri, {_clean_sql('record__text')} AS cleaned FROM posts"))
def cleaned(spark, sf):
    return posts(spark, sf).select("uri", clean_text("record__text").alias("cleaned"))


@query("token_arrays", with_ctes("posts", f", {_TOKENS} SELECT uri, array_to_string(ws, ' ') AS preprocessed_text, len(ws)::INT AS n FROM arrays"))
def token_arrays(spark, sf):
    out = ops.token_arrays(posts(spark, sf), stop=STOP)
    return out.select("uri", "preprocessed_text", F.size("tokenized_text").alias("n"))


@query("weekly_token_counts", with_ctes("posts", f", {_TOKENS} SELECT * FROM weekly_tokens"))
def weekly_token_counts(spark, sf):
    return weekly_tokens(spark, sf)


@ops.by_columns
def _first_five(word):
    return F.left(word, F.lit(5))


@query(
    "weekly_stem_counts",
    with_ctes(
        "posts",
        f""", {_TOKENS.replace(f'lambda w: w NOT IN ({STOP_SQL})', 'lambda w: true')}
SELECT iso_weekstartdate, left(token, 5) AS token, count(*)::BIGINT AS cnt FROM tokens
WHERE left(token, 5) NOT IN ({STOP_SQL}) GROUP BY ALL""",
    ),
)
def weekly_stem_counts(spark, sf):
    """Stems are compared with the unstemmed stop list, after stemming."""
    return weekly_tokens(spark, sf, stemmer=_first_five)


@query("weekly_french_stem_counts")
def weekly_french_stem_counts(spark, sf):
    """The French stems of all posts per week, without those equal to a stop word of the default French list."""
    return ops.weekly_tokens(posts(spark, sf), stop=stop_words(spark, "french"), stemmer=french.stem)


@query(
    "weekly_bigram_counts",
    with_ctes(
        "posts",
        f""", {_TOKENS},
grams AS (SELECT iso_weekstartdate, unnest(ws) AS token FROM arrays
  UNION ALL SELECT iso_weekstartdate, unnest(list_transform(generate_series(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1])) FROM arrays)
SELECT iso_weekstartdate, token, count(*)::BIGINT AS cnt FROM grams GROUP BY ALL""",
    ),
)
def weekly_bigram_counts(spark, sf):
    return weekly_tokens(spark, sf, ngram_range=(1, 2))


@query(
    "vocab_filtered",
    with_ctes(
        "posts",
        f""", {_TOKENS} SELECT * FROM weekly_tokens WHERE token IN (
  SELECT token FROM weekly_tokens WHERE cnt >= 3 GROUP BY token HAVING count(*) >= 10)""",
    ),
)
def vocab_filtered(spark, sf):
    return ops.frequent_tokens(weekly_tokens(spark, sf), min_weeks=10, min_mention=3)


@query(
    "vocabulary",
    with_ctes("posts", f", {_TOKENS} SELECT token, count(*)::BIGINT AS weeks FROM weekly_tokens WHERE cnt >= 3 GROUP BY token HAVING count(*) >= 10"),
)
def vocabulary(spark, sf):
    return ops.vocabulary(weekly_tokens(spark, sf), min_weeks=10, min_mention=3)


@query(
    "vectorizer_weekly_counts",
    with_ctes(
        "posts",
        f""", {_TOKENS} SELECT * FROM weekly_tokens""",
    ),
)
def vectorizer_weekly_counts(spark, sf):
    tokenized = ops.token_arrays(posts(spark, sf), stop=STOP)
    path = scratch_path(spark, "vectorizer")
    ops.save_vectorizer(ops.fit_vectorizer(tokenized), path)
    return ops.weekly_vectors(tokenized, ops.load_vectorizer(path))


@query(
    "signal_with_tokens",
    with_ctes(
        "signal posts",
        f""", {_TOKENS.replace(f'lambda w: w NOT IN ({STOP_SQL})', 'lambda w: true')},
t AS (SELECT iso_weekstartdate, {', '.join(f"coalesce(sum(cnt) FILTER (token = '{w}'), 0)::BIGINT AS {w}" for w in WORDS)}
      FROM weekly_tokens GROUP BY 1)
SELECT signal.*, {', '.join(f't.{w}' for w in WORDS)} FROM signal JOIN t ON signal.date = t.iso_weekstartdate""".replace(" AS and", ' AS "and"').replace("t.and", 't."and"').replace(" AS the", ' AS "the"'),
    ),
)
def signal_with_tokens(spark, sf):
    wide = ops.wide_tokens(ops.weekly_tokens(posts(spark, sf)), WORDS)
    return signals.signal_with_tokens(signal(spark, sf), wide)


# surviving vocabulary of all posts, and the weekly signal of one country
_KEPT = """kept AS (SELECT * FROM weekly_tokens WHERE token IN (
  SELECT token FROM weekly_tokens WHERE cnt >= 3 GROUP BY token HAVING count(*) >= 10))"""
_ONE = "one AS (SELECT date, ili_incidence * 100000 AS y, row_number() OVER (ORDER BY date) AS at FROM signal WHERE country_code = '7')"
LAGS = 2


def one_signal(spark, sf):
    return signal(spark, sf).filter("country_code = '7'").select("date", (F.col("ili_incidence") * 100_000).alias("y"))


@query(
    "signal_token_lags",
    with_ctes(
        "signal posts",
        f""", {_TOKENS}, {_KEPT}, {_ONE}
SELECT b.date, k.token, (b.at - a.at)::INT AS lag, k.cnt, round(b.y, 6) AS y FROM kept k JOIN one a ON a.date = k.iso_weekstartdate
JOIN one b ON b.at BETWEEN a.at AND a.at + {LAGS}""",
    ),
)
def signal_token_lags(spark, sf):
    """Every surviving token and its lags beside the signal, in long form."""
    kept = ops.frequent_tokens(weekly_tokens(spark, sf), min_weeks=10, min_mention=3)
    one = one_signal(spark, sf)
    return ops.token_lags(kept, one, LAGS).join(one, "date").withColumn("y", F.round("y", 6))


@query(
    "token_correlation",
    with_ctes(
        "signal posts",
        f""", {_TOKENS}, {_ONE},
rated AS (SELECT date, y FROM one WHERE y IS NOT NULL AND date IN (SELECT iso_weekstartdate FROM weekly_tokens)),
x AS (SELECT token, date, y, cnt FROM weekly_tokens JOIN rated ON date = iso_weekstartdate),
m AS (SELECT avg(y) AS my, count(*) AS n, var_pop(y) * count(*) AS syy FROM rated),
s AS (SELECT token, count(*)::BIGINT AS weeks, sum(cnt)::DOUBLE AS sx, sum(cnt * cnt)::DOUBLE AS sxx, sum(cnt * (y - my)) AS sxy, any_value(n) AS n, any_value(syy) AS syy
      FROM x CROSS JOIN m GROUP BY 1)
SELECT token, weeks, CASE WHEN sxx - sx * sx / n > 1e-9 * sxx THEN round(sxy / sqrt((sxx - sx * sx / n) * syy), 6) END AS r FROM s""",
    ),
)
def token_correlation(spark, sf):
    """Correlation of each token of the whole vocabulary with the incidence."""
    return ops.token_correlation(weekly_tokens(spark, sf), one_signal(spark, sf), "y", digits=6)


@query("token_ridge_scores")
def token_ridge_scores(spark, sf):
    """Fit on the sparse vectors of all surviving tokens and their lags; its scores on its own rows."""
    kept = ops.frequent_tokens(weekly_tokens(spark, sf), min_weeks=10, min_mention=3)
    one = one_signal(spark, sf).filter("y IS NOT NULL")
    rows = ops.token_vectors(ops.token_lags(kept, one, LAGS), one, LAGS)
    fitted = estimator("ridge", rows, alpha=10.0, solver="l-bfgs", maxIter=50).fit(rows)
    return regression_scores(fitted.transform(rows))


@query("french_default_stop_words")
def french_default_stop_words(spark, sf):
    """Weekly tokens of French posts without the stop list that ships with Spark."""
    french = posts(spark, sf).filter(F.col("record__langs") == "fr")
    return ops.weekly_tokens(french, stop=stop_words(spark, "french"))
