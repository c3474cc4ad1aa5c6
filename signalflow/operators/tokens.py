"""Text to weekly token counts.

The long form (week, token, count) is the working representation: it is an
ordinary two-column aggregation with map-side combine, so neither a hot token nor
a large vocabulary is a problem. The wide table with one column per token is only
built for a vocabulary of known size.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import wraps

import pandas as pd
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalflow.functions.dates import week_bucket
from signalflow.functions.text import clean_text, joined, raw_words, without_words, words
from signalflow.operators.ranks import numbered
from signalflow.session import literal_rows, scratch_path, written

# A function of a word in Python, or a column expression marked by ``by_columns``.
Stemmer = Callable[[str], str] | Callable[[Column], Column]
WEEK = "iso_weekstartdate"
# Characters of a week's posts whose n-grams are counted by one task.
WEEK_CHARS = 1 << 25


def by_columns(expression: Callable[[Column], Column]) -> Callable[[Column], Column]:
    """Mark a stemmer as a column expression, so that it stays in the JVM."""

    @wraps(expression)
    def marked(word: Column) -> Column:
        return expression(word)

    marked.by_columns = True
    return marked


def _is_expression(stemmer: Stemmer) -> bool:
    return getattr(stemmer, "by_columns", False)


def stemmed(tokens: Column, stemmer: Stemmer) -> Column:
    """Apply a per-word stemmer to token arrays; one in Python sees each distinct word of a batch once."""
    if _is_expression(stemmer):
        return F.transform(tokens, stemmer)

    @F.pandas_udf("array<string>")
    def apply(batch: pd.Series) -> pd.Series:
        known: dict[str, str] = {}

        def stem(word: str) -> str:
            if word not in known:
                known[word] = stemmer(word)
            return known[word]

        return batch.map(lambda ws: None if ws is None else [stem(w) for w in ws])

    return apply(tokens)


def stemmed_word(token: Column, stemmer: Stemmer) -> Column:
    """The stem of a word; one in Python is made once, whatever filters use it."""
    if _is_expression(stemmer):
        return stemmer(token)

    @F.pandas_udf("string")
    def apply(batch: pd.Series) -> pd.Series:
        return batch.map({w: stemmer(w) for w in batch.unique()})

    # a filter on the outcome of a deterministic function is moved ahead of it, as a second call
    return apply.asNondeterministic()(token)


def ngrams(tokens: Column, lo: int, hi: int) -> Column:
    """Space-joined runs of ``lo`` to ``hi`` neighbouring tokens.

    Runs grow by zipping them with the tokens shifted one further, linear in the text
    length. ``tokens`` should be a plain column.
    """
    if not 1 <= lo <= hi:
        raise ValueError("need 1 <= lo <= hi")
    runs = {1: tokens}
    for n in range(2, hi + 1):
        count = F.greatest(F.size(tokens) - (n - 1), F.lit(0))
        shorter, shifted = F.slice(runs[n - 1], 1, count), F.slice(tokens, n, count)
        runs[n] = F.zip_with(shorter, shifted, lambda a, b: F.concat(a, F.lit(" "), b))
    return F.concat(*[runs[n] for n in range(lo, hi + 1)])


def token_arrays(
    posts: DataFrame, text: str = "record__text", stop: Sequence[str] = (), stemmer: Stemmer | None = None
) -> DataFrame:
    """Add ``tokenized_text`` (cleaned, split, stemmed, then stop words dropped) and its joined form."""
    tokens = words("__text")
    if stemmer is not None:
        tokens = stemmed(tokens, stemmer)
    out = posts.withColumn("__text", clean_text(text)).withColumn("tokenized_text", without_words(tokens, stop)).drop("__text")
    return out.withColumn("preprocessed_text", joined("tokenized_text", " "))


def weekly_tokens(
    posts: DataFrame,
    text: str = "record__text",
    created: str = "record__created_at",
    stop: Sequence[str] = (),
    stemmer: Stemmer | None = None,
    ngram_range: tuple[int, int] = (1, 1),
    by: Sequence[str] = (),
    anchor: str = "iso",
) -> DataFrame:
    """Long weekly token counts ``(*by, iso_weekstartdate, token, cnt)``.

    Single words are counted before they are stemmed, and every distinct word of the
    vocabulary is stemmed once, in a row with its counts; these are one for each week and group.
    """
    week = week_bucket(created, anchor).alias(WEEK)
    keys = [*by, WEEK, "token"]
    rows = posts.select(*by, week, clean_text(text).alias("__text"))
    if ngram_range != (1, 1):
        tokens = words("__text")
        if stemmer is not None:
            tokens = stemmed(tokens, stemmer)
        # a column of its own: inside a lambda the tokeniser would run per element
        rows = rows.select(*by, WEEK, without_words(tokens, stop).alias("__words"))
        return _weekly_ngrams(posts.select(*by, week, F.char_length(text).alias("__n")), rows, ngram_range, by)
    # empty and stop words are dropped after the explode, in generated code
    dropped = ["", *stop] if stemmer is None else [""]
    # explode_outer: for a plain explode the optimizer adds a filter on the array's
    # size below it, which runs the whole cleaning and splitting a second time
    exploded = rows.select(*by, WEEK, F.explode_outer(raw_words("__text")).alias("token")).filter("token is not null")
    exploded = exploded.filter(~F.col("token").isin(dropped))
    counted = exploded.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"))
    if stemmer is None:
        return counted
    # a row per word, with its counts beside it: a join with the vocabulary would read and split all texts a second time.
    # The word is an aggregate: the optimizer would move a filter on the stem of a grouping key below the counts, where
    # every word of every text would be stemmed
    each = counted.groupBy("token").agg(F.min("token").alias("__word"), F.collect_list(F.struct(*keys[:-1], "cnt")).alias("__counts"))
    stems = each.select(stemmed_word(F.col("__word"), stemmer).alias("token"), "__counts").select("token", F.inline("__counts"))
    if stop:
        stems = stems.filter(~F.col("token").isin(*stop))
    return stems.groupBy(*keys).agg(F.sum("cnt").alias("cnt"))


def _weekly_ngrams(lengths: DataFrame, rows: DataFrame, ngram_range: tuple[int, int], by: Sequence[str]) -> DataFrame:
    """Counts of the runs of ``__words``, most of which occur once, so that they are made behind the shuffle.

    The words themselves are dealt out by week, where all equal runs of a week meet. Weeks of more than :data:`WEEK_CHARS`
    characters are cut into several parts, all weeks alike, whose counts are added up in one more shuffle.
    """
    sizes = lengths.groupBy(*by, WEEK).agg(F.sum("__n").alias("n")).agg(F.max("n").alias("most"), F.sum("n").alias("total")).first()
    parts = max(-(-(sizes.most or 0) // WEEK_CHARS), 1)
    spark = rows.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism, (sizes.total or 0) // WEEK_CHARS)
    salt = [] if parts == 1 else ["__part"]
    if salt:
        rows = rows.withColumn("__part", F.pmod(F.xxhash64("__words"), F.lit(parts)))
    dealt = rows.repartition(tasks, *by, WEEK, *salt)
    exploded = dealt.select(*by, WEEK, *salt, F.explode_outer(ngrams(F.col("__words"), *ngram_range)).alias("token")).filter("token is not null")
    counted = exploded.groupBy(*by, WEEK, *salt, "token").agg(F.count(F.lit(1)).alias("cnt"))
    return counted.groupBy(*by, WEEK, "token").agg(F.sum("cnt").alias("cnt")) if salt else counted


def frequent_tokens(tokens: DataFrame, min_weeks: int = 10, min_mention: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Keep tokens counted at least ``min_mention`` times in at least ``min_weeks`` weeks.

    The window holds one token's weeks, so it is bounded by the calendar; the
    filter needs no second scan and no join with a vocabulary.
    """
    token = Window.partitionBy(*by, "token")
    support = F.count_if(F.col("cnt") >= min_mention).over(token)
    return tokens.withColumn("__support", support).filter(F.col("__support") >= min_weeks).drop("__support")


def vocabulary(tokens: DataFrame, min_weeks: int = 10, min_mention: int = 10) -> DataFrame:
    """Surviving tokens with the number of weeks that support them."""
    return (
        tokens.groupBy("token")
        .agg(F.count_if(F.col("cnt") >= min_mention).alias("weeks"))
        .filter(F.col("weeks") >= min_weeks)
    )


def token_correlation(tokens: DataFrame, series: DataFrame, value: str, ts: str = "date", digits: int | None = None) -> DataFrame:
    """Pearson correlation of every token's weekly count with a series: ``(token, weeks, r)``.

    A week in which a token does not occur counts 0 without being stored: with the values taken from
    their mean, three sums per token over the rows there are suffice. Weeks are those of the series that have any token
    and a value. ``r`` is NULL for a token or a series that doesn't vary. ``tokens`` has one row per week and token.
    """
    weeks = tokens.select(WEEK).distinct()
    known = series.select(F.col(ts).alias(WEEK), F.col(value).cast("double").alias("__y")).filter("__y IS NOT NULL").join(weeks, WEEK)
    known = known.withColumn("__y", F.col("__y") - known.agg(F.avg("__y")).scalar())
    n, syy = known.agg(F.count("__y")).scalar(), known.agg(F.sum(F.col("__y") * F.col("__y"))).scalar()
    x, y = F.col("cnt").cast("double"), F.col("__y")
    sums = tokens.join(known, WEEK).groupBy("token").agg(F.count("*").alias("weeks"), F.sum(x).alias("__x"), F.sum(x * x).alias("__xx"), F.sum(x * y).alias("__xy"))
    spread = (F.col("__xx") - F.col("__x") * F.col("__x") / n) * syy
    r = F.when(spread > 1e-9 * F.col("__xx") * syy, F.try_divide(F.col("__xy"), F.sqrt(spread)))
    return sums.select("token", "weeks", (r if digits is None else F.round(r, digits)).alias("r"))


def token_lags(tokens: DataFrame, dates: DataFrame, lags: int, by: Sequence[str] = (), ts: str = "date") -> DataFrame:
    """Counts of every token and their lags along the axis ``dates`` in long form: ``(*by, date, token, lag, cnt)``, no zeros.

    A count is the feature of its own date (lag 0) and of the next ``lags`` dates of its series, by position. So a lag
    is an offset that each stored count is copied to, at ``lags + 1`` rows a count whatever the vocabulary, and nothing
    becomes a column.
    """
    placed = dates.select(*by, ts).distinct().withColumn("__at", F.row_number().over(Window.partitionBy(*by).orderBy(ts)))
    counts = placed.join(tokens.select(F.col(WEEK).alias(ts), "token", "cnt"), ts).select(*by, "__at", "token", "cnt")
    copies = counts.select(*by, "token", "cnt", F.col("__at").alias("__own"), F.explode(F.sequence(F.lit(0), F.lit(lags))).alias("lag"))
    copies = copies.withColumn("__at", F.col("__own") + F.col("lag")).drop("__own")
    return placed.join(copies, [*by, "__at"]).select(*by, ts, "token", "lag", "cnt")


def token_vectors(long: DataFrame, frame: DataFrame, lags: int, by: Sequence[str] = (), ts: str = "date") -> DataFrame:
    """``frame`` with the sparse vector ``features`` of its tokens and lags; dates without tokens have an empty one.

    ``long`` is the outcome of :func:`token_lags`. Tokens are numbered by a distributed rank, and lag l of token i is entry
    ``l * size + i``, so the vocabulary is never on the driver; only its size is.
    """
    index = numbered(long.select("token").distinct(), ["token"], "__i", "token-index")
    size = index.count()
    entries = long.join(index, "token").select(*by, ts, (F.col("lag") * size + F.col("__i")).cast("int").alias("i"), F.col("cnt").cast("double").alias("v"))
    packed = entries.groupBy(*by, ts).agg(F.sort_array(F.collect_list(F.struct("i", "v"))).alias("__e"))
    joined = frame.join(packed, [*by, ts], "left")
    total = max(size, 1) * (lags + 1)

    return with_sparse(joined, "__e", total, "features")


def with_sparse(df: DataFrame, entries: str, size: int, name: str) -> DataFrame:
    """``df`` with the array ``entries`` of sorted ``(i, v)`` as a sparse vector ``name`` of ``size``; NULL is the empty one.

    The vectors are written as the plain columns they are stored in and read back by their type, so no Python worker sees them.
    """
    index, value = F.transform(entries, lambda e: e["i"]), F.transform(entries, lambda e: e["v"])
    indices, values = F.coalesce(index, F.array().cast("array<int>")), F.coalesce(value, F.array().cast("array<double>"))
    vector = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), indices.alias("indices"), values.alias("values"))
    plain = df.withColumn(name, vector).drop(entries)
    schema = T.StructType([T.StructField(f.name, VectorUDT()) if f.name == name else f for f in plain.schema.fields])
    path = scratch_path(df.sparkSession, "vectors")
    plain.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def wide_tokens(tokens: DataFrame, names: Sequence[str] | None = None, max_columns: int | None = None) -> DataFrame:
    """One row per week, one column per token, 0 where a token is absent.

    With ``names`` other tokens are filtered before the shuffle; weeks that have none of them stay, with
    zeros. Without ``names`` the driver reads the vocabulary to name the columns; more than
    ``max_columns`` of them is then an error. Wide tables are for vocabularies of report size: the long
    form has no such limit.
    """
    weeks = None
    if names is None:
        found = tokens.select("token").distinct().orderBy("token")
        names = [r.token for r in (found if max_columns is None else found.limit(max_columns + 1)).collect()]
    else:
        weeks = tokens.select(WEEK).distinct()
        tokens = tokens.filter(F.col("token").isin(list(names)))
    if max_columns is not None and len(names) > max_columns:
        raise ValueError(f"vocabulary exceeds {max_columns} columns; raise min_weeks or min_mention")
    wide = tokens.groupBy(WEEK).pivot("token", list(names)).agg(F.sum("cnt"))
    if weeks is not None:
        wide = weeks.join(wide, WEEK, "left")
    return wide.na.fill(0, subset=list(names)) if names else wide


class TokenVectorizer:
    """Count vectoriser whose vocabulary ``(token, i)`` is a table, the most frequent token first.

    Spark's own model holds the vocabulary as one array on the driver and in every task.
    """

    def __init__(self, vocabulary: DataFrame, size: int, binary: bool = False, min_tf: float = 1.0):
        self.vocabulary, self.size, self.binary, self.min_tf = vocabulary, size, binary, min_tf

    def entries(self, tokenized: DataFrame, keys: Sequence[Column]) -> DataFrame:
        """``(*keys, token, cnt)``: what the vectors of all rows with equal keys add up to, without zeros.

        Counts are added up by token before they meet their number, with map-side combine, since a number stands for one token.
        """
        tokens = F.array_distinct("tokenized_text") if self.binary and self.min_tf == 1 else F.col("tokenized_text")
        rows = tokenized.select(*keys, tokens.alias("__tokens"))
        names = rows.columns[:-1]
        one = F.count(F.lit(1)).alias("cnt")
        if self.min_tf == 1:
            return _exploded(rows, names).groupBy(*names, "token").agg(one)
        # the least count is one of a row, so these are counted first
        rows = rows.withColumns({"__at": F.monotonically_increasing_id(), "__n": F.size("__tokens")})
        each = _exploded(rows, [*names, "__at", "__n"]).groupBy(*names, "__at", "__n", "token").agg(one)
        each = each.filter(F.col("cnt") >= (self.min_tf if self.min_tf >= 1 else F.col("__n") * self.min_tf))
        return each.groupBy(*names, "token").agg((F.count(F.lit(1)) if self.binary else F.sum("cnt")).alias("cnt"))

    def transform(self, tokenized: DataFrame) -> DataFrame:
        """``tokenized`` with the sparse vector ``count_vector`` of each row."""
        columns = tokenized.columns
        rows = written(tokenized.withColumn("__row", F.monotonically_increasing_id()), "vectorizer-rows")
        counted = self.entries(rows, [F.col("__row")]).join(self.vocabulary, "token")
        packed = counted.groupBy("__row").agg(F.sort_array(F.collect_list(F.struct("i", F.col("cnt").cast("double").alias("v")))).alias("__e"))
        return with_sparse(rows.join(packed, "__row", "left"), "__e", self.size, "count_vector").select(*columns, "count_vector")

    def write(self) -> _VectorizerWriter:
        return _VectorizerWriter(self)

    @classmethod
    def load(cls, path: str) -> TokenVectorizer:
        spark = SparkSession.active()
        kept = spark.read.parquet(f"{path}/params").first()
        return cls(spark.read.parquet(f"{path}/vocabulary"), kept["size"], kept["binary"], kept["min_tf"])


class _VectorizerWriter:
    def __init__(self, model: TokenVectorizer):
        self.model, self.mode = model, "error"

    def overwrite(self) -> _VectorizerWriter:
        self.mode = "overwrite"
        return self

    def save(self, path: str) -> None:
        model = self.model
        model.vocabulary.write.mode(self.mode).parquet(f"{path}/vocabulary")
        params = literal_rows(model.vocabulary.sparkSession, ("size", "binary", "min_tf"), [(model.size, model.binary, float(model.min_tf))])
        params.write.mode(self.mode).parquet(f"{path}/params")


def _exploded(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    # explode_outer, for the reason given in ``weekly_tokens``
    return rows.select(*names, F.explode_outer("__tokens").alias("token")).filter("token is not null")


def fit_vectorizer(
    tokenized: DataFrame, vocabSize: int | None = None, minDF: float = 1.0, maxDF: float | None = None, minTF: float = 1.0, binary: bool = False
) -> TokenVectorizer:
    """Count vectoriser with the whole vocabulary, unless ``vocabSize`` asks for less; parameters as in Spark's own.

    ``minDF`` and ``maxDF`` are numbers of rows, or shares of them below 1. The vocabulary is numbered by a distributed
    rank of its counts and never on the driver.
    """
    tokens = tokenized.select(F.col("tokenized_text").alias("__tokens"))
    counted = _exploded(tokens, []).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    if minDF != 1 or maxDF is not None:
        held = _exploded(tokens.select(F.array_distinct("__tokens").alias("__tokens")), []).groupBy("token").agg(F.count(F.lit(1)).alias("__df"))
        total = tokens.count() if minDF < 1 or (maxDF or 1) < 1 else 0
        within = F.col("__df") >= (minDF if minDF >= 1 else minDF * total)
        if maxDF is not None:
            within = within & (F.col("__df") <= (maxDF if maxDF >= 1 else maxDF * total))
        counted = counted.join(held.filter(within).select("token"), "token")
    ranked = numbered(counted, [F.desc("n"), F.asc("token")], "i", "vectorizer").select("token", F.col("i").cast("int").alias("i"))
    if vocabSize is not None:
        ranked = ranked.filter(F.col("i") < vocabSize)
    return TokenVectorizer(ranked, ranked.count(), binary, minTF)


def save_vectorizer(model: TokenVectorizer, path: str) -> None:
    model.write().overwrite().save(path)


def load_vectorizer(path: str) -> TokenVectorizer:
    return TokenVectorizer.load(path)


def weekly_vectors(tokenized: DataFrame, model: TokenVectorizer, created: str = "record__created_at") -> DataFrame:
    """Weekly sums of the count vectors as long rows, each named by its token.

    Tokens outside the vocabulary drop out in the join with it; no task holds a vector as long as the vocabulary.
    """
    sums = model.entries(tokenized, [week_bucket(created).alias(WEEK)])
    return sums.join(model.vocabulary.select("token"), "token").select(WEEK, "token", "cnt")
