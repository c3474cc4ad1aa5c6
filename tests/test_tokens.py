from collections import Counter
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from signalflow.operators import tokens as ops

W1, W2 = date(2024, 1, 1), date(2024, 1, 8)


@pytest.fixture(scope="module")
def posts(spark):
    data = [
        ("u1", datetime(2024, 1, 2), "J'ai la grippe, la GRIPPE! http://x.y @moi #tag"),
        ("u2", datetime(2024, 1, 7, 23), "grippe et fièvre"),
        ("u3", datetime(2024, 1, 8), "fièvre  \n fièvres"),
        ("u4", datetime(2024, 1, 8), "!!! 123"),
        ("u5", datetime(2024, 1, 8), None),
    ]
    return spark.createDataFrame(data, "uri string, record__created_at timestamp_ntz, record__text string")


def counts(df):
    return {(r.iso_weekstartdate, r.token): r.cnt for r in df.collect()}


def test_weekly_tokens(posts):
    got = counts(ops.weekly_tokens(posts, stop=["la", "et"]))
    assert got == {(W1, "jai"): 1, (W1, "grippe"): 3, (W1, "fièvre"): 1, (W2, "fièvre"): 1, (W2, "fièvres"): 1}


def test_stop_words_meet_stems(posts):
    stem = lambda w: w.rstrip("s")[:4]
    got = counts(ops.weekly_tokens(posts, stop=["grip", "la", "et"], stemmer=stem))
    assert got == {(W1, "jai"): 1, (W1, "fièv"): 1, (W2, "fièv"): 2}
    arrays = ops.token_arrays(posts, stop=["grip", "la", "et"], stemmer=stem)
    long = Counter()
    for r in arrays.collect():
        for t in r.tokenized_text or []:
            long[(W1 if r.record__created_at < datetime(2024, 1, 8) else W2, t)] += 1
    assert dict(long) == got


def test_ngrams(posts, spark):
    got = counts(ops.weekly_tokens(posts, ngram_range=(2, 3)))
    assert got[(W1, "la grippe")] == 2 and got[(W1, "la grippe la")] == 1 and got[(W2, "fièvre fièvres")] == 1
    df = spark.createDataFrame([(["a", "b", "c", "d"],), (["a"],), ([],)], "w array<string>")
    assert [r.g for r in df.select(ops.ngrams(df.w, 1, 3).alias("g")).collect()] == [
        ["a", "b", "c", "d", "a b", "b c", "c d", "a b c", "b c d"], ["a"], [],
    ]


def test_vectorizer_gives_the_same_counts(posts, tmp_path):
    tokenized = ops.token_arrays(posts.filter("record__text is not null"), stop=["la"])
    model = ops.fit_vectorizer(tokenized)
    model.write().overwrite().save(str(tmp_path / "cv"))
    again = type(model).load(str(tmp_path / "cv"))
    assert counts(ops.weekly_vectors(tokenized, again)) == counts(ops.weekly_tokens(posts, stop=["la"]))


def test_vectorizer_keeps_its_vocabulary_as_a_table(spark, tmp_path):
    from pyspark.ml.feature import CountVectorizer

    data = [(["b", "a", "b", "c"],), (["b", "d"],), ([],), (["a", "a", "a", "a", "e", "b"],)]
    df = spark.createDataFrame(data, "tokenized_text array<string>")
    for params in ({}, {"vocabSize": 2}, {"minDF": 2}, {"minDF": 0.5, "binary": True}, {"minTF": 2}, {"minTF": 0.4, "binary": True}, {"maxDF": 2}):
        model = ops.fit_vectorizer(df, **params)
        assert not isinstance(model.vocabulary, list)  # a table, not an array on the driver
        ops.save_vectorizer(model, str(tmp_path / "cv"))
        model = ops.load_vectorizer(str(tmp_path / "cv"))
        names = [r.token for r in model.vocabulary.orderBy("i").collect()]
        own = CountVectorizer(inputCol="tokenized_text", outputCol="v", **params).fit(df)
        assert sorted(names) == sorted(own.vocabulary) and model.size == len(names)

        def named(frame, column, words):
            found = [(r.tokenized_text, r[column]) for r in frame.collect()]
            return sorted((t, sorted((words[i], n) for i, n in zip(v.indices, v.values))) for t, v in found)

        assert named(model.transform(df), "count_vector", names) == named(own.transform(df), "v", own.vocabulary)


def test_vocabulary(spark, rows):
    data = [(date(2024, 1, 1 + 7 * w), t, c) for w in range(4) for t, c in (("often", 5), ("rare", 1), ("once", 9 if w == 0 else 1))]
    df = spark.createDataFrame(data, "iso_weekstartdate date, token string, cnt bigint")
    assert {r.token for r in ops.frequent_tokens(df, 3, 5).collect()} == {"often"}
    assert rows(ops.vocabulary(df, 1, 5), "token", "weeks") == [("often", 4), ("once", 1)]


def test_wide(posts):
    wide = ops.wide_tokens(ops.weekly_tokens(posts, stop=["la", "et"]))
    assert wide.columns == ["iso_weekstartdate", "fièvre", "fièvres", "grippe", "jai"]
    assert [tuple(r) for r in wide.orderBy("iso_weekstartdate").collect()] == [(W1, 1, 0, 3, 1), (W2, 1, 1, 0, 0)]
    with pytest.raises(ValueError):
        ops.wide_tokens(ops.weekly_tokens(posts), max_columns=2)


def weekly(spark):
    weeks = [date(2024, 1, 1) + timedelta(days=7 * i) for i in range(8)]
    counts = {"up": [1, 2, 3, 4, 5, 6, 7, 8], "rare": [0, 0, 5, 0, 0, 0, 0, 1], "flat": [2] * 8}
    rows = [(w, t, c) for t, cs in counts.items() for w, c in zip(weeks, cs) if c]
    y = [1.0, 3.0, None, 2.0, 5.0, 4.0, 7.0, 9.0]
    return weeks, counts, y, spark.createDataFrame(rows, "iso_weekstartdate date, token string, cnt long"), spark.createDataFrame(list(zip(weeks, y)), "date date, y double")


def test_correlation_counts_absent_tokens_as_zero(spark):
    weeks, counts, y, tokens, series = weekly(spark)
    got = {r.token: r.r for r in ops.token_correlation(tokens, series, "y").collect()}
    there = [i for i, v in enumerate(y) if v is not None]
    for t in ("up", "rare"):
        want = np.corrcoef([counts[t][i] for i in there], [y[i] for i in there])[0, 1]
        assert abs(got[t] - want) < 1e-12
    assert got["flat"] is None
    assert ops.token_correlation(tokens.limit(0), series, "y").count() == 0


def test_lags_of_tokens_in_long_form_and_as_vectors(spark):
    weeks, counts, y, tokens, series = weekly(spark)
    axis = series.filter("y IS NOT NULL")  # without the third week: lags go by position
    long = ops.token_lags(tokens, axis, 2)
    there = [w for w, v in zip(weeks, y) if v is not None]
    want = {}
    for i, w in enumerate(there):
        for lag in range(3):
            for t, cs in counts.items():
                if i >= lag and cs[weeks.index(there[i - lag])]:
                    want[w, t, lag] = cs[weeks.index(there[i - lag])]
    assert {(r.date, r.token, r["lag"]): r.cnt for r in long.collect()} == want
    vectors = {r.date: r.features for r in ops.token_vectors(long, axis, 2).collect()}
    names = sorted({t for _, t, _ in want})
    assert len(vectors) == 7
    for w, v in vectors.items():
        dense = np.zeros(len(names) * 3)
        for (d, t, lag), c in want.items():
            if d == w:
                dense[lag * len(names) + names.index(t)] = c
        assert np.array_equal(v.toArray(), dense)
    empty = ops.token_vectors(long.limit(0), axis, 2).collect()
    assert len(empty) == 7 and all(r.features.numNonzeros() == 0 for r in empty)


def test_stemmer_as_expression(posts):
    from signalflow.functions.french import french_stem

    french = ops.by_columns(french_stem)
    got = counts(ops.weekly_tokens(posts, stop=["la", "et"], stemmer=french))
    assert got == {(W1, "jai"): 1, (W1, "gripp"): 3, (W1, "fievr"): 1, (W2, "fievr"): 2}
    arrays = {r.uri: r.preprocessed_text for r in ops.token_arrays(posts, stop=["la", "et"], stemmer=french).collect()}
    assert arrays["u1"] == "jai gripp gripp" and arrays["u2"] == "gripp fievr" and arrays["u4"] == ""


def test_vectors_are_made_without_python_workers(spark, monkeypatch):
    weeks, counts, y, tokens, series = weekly(spark)
    monkeypatch.setattr(F, "udf", None)
    vectors = ops.token_vectors(ops.token_lags(tokens, series, 1), series, 1)
    assert vectors.count() == 8 and "Python" not in vectors._jdf.queryExecution().toString()


def test_ngrams_are_made_behind_the_shuffle(spark, posts, monkeypatch):
    whole = ops.weekly_tokens(posts, ngram_range=(1, 2), stop=["la"])
    plan = whole._jdf.queryExecution().sparkPlan().toString()
    assert plan.index("Generate") < plan.index("REPARTITION_BY_NUM")  # plans are written from the end
    want = counts(whole)
    assert want[W1, "grippe"] == 3 and want[W2, "fièvre fièvres"] == 1
    monkeypatch.setattr(ops, "WEEK_CHARS", 10)
    assert counts(ops.weekly_tokens(posts, ngram_range=(1, 2), stop=["la"])) == want
    assert ops.weekly_tokens(posts.limit(0), ngram_range=(1, 2)).count() == 0


def test_texts_are_split_once_and_a_word_is_stemmed_once(spark, posts):
    calls = spark.sparkContext.accumulator(0)

    def stem(word):
        calls.add(1)
        return word[:4]

    many = posts.unionAll(posts).unionAll(posts).repartition(3)
    stems = ops.weekly_tokens(many, stop=["grip", "la", "et"], stemmer=stem)
    assert stems._jdf.queryExecution().optimizedPlan().toString().count("Generate explode") == 1
    assert counts(stems) == {(W1, "jai"): 3, (W1, "fièv"): 3, (W2, "fièv"): 6}
    assert calls.value == len({"jai", "la", "grippe", "et", "fièvre", "fièvres"})
    # a column expression stays above the counts too
    plan = ops.weekly_tokens(many, stop=["grip"], stemmer=ops.by_columns(lambda w: F.left(w, F.lit(4))))._jdf.queryExecution().optimizedPlan().toString()
    assert "substring(" in plan and "substring(" not in plan[plan.index("count(1)") :]  # plans are written from the end
