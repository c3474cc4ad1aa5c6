from datetime import datetime

import pytest

from signalflow.operators import posts as ops

T = datetime(2024, 1, 2, 10)
POSTS = "uri string, record__created_at timestamp_ntz, record__text string, record__langs string, keyword string"


@pytest.fixture(scope="module")
def posts(spark):
    data = [("a", T, "x", "fr", "k1"), ("a", T, "x", "fr", "k2"), ("b", T, "y", "fr,de", "k1"), ("c", T, "z", "fr", "k1"), ("a", T, "edited", "fr", "k3")]
    return spark.createDataFrame(data, POSTS)


def hints(spark, *data):
    return spark.createDataFrame(list(data), "uri string, ili_related boolean")


def test_union_excludes_hints(posts, spark):
    tables = {"k1": posts.filter("keyword = 'k1'"), "k2": posts.filter("keyword = 'k2'"), "llm_hints": posts}
    assert ops.union_tables(tables).count() == 4
    with pytest.raises(ValueError):
        ops.union_tables({"llm_hints": posts})


def test_distinct_posts_keep_edits(posts, rows):
    assert rows(ops.language_posts(posts, "fr"), "uri", "record__text") == [("a", "edited"), ("a", "x"), ("b", "y"), ("c", "z")]


def test_annotated_any_and_related(posts, spark, rows):
    h = hints(spark, ("a", True), ("b", False))
    assert {r.uri for r in ops.annotated(posts, h).collect()} == {"a", "b"}
    assert {r.uri for r in ops.annotated(posts, h, related_only=True).collect()} == {"a"}


@pytest.mark.parametrize(
    "known", [[], ["a"], ["a", None], [None], ["a", "b", "c"]],
)
def test_pending_follows_not_in(spark, rows, known):
    data = [("a", T, "x", "fr", "k"), ("b", T, "y", "fr,de", "k"), ("c", T, "z", "fr", "k"), (None, T, "n", "fr", "k")]
    p, h = spark.createDataFrame(data, POSTS), spark.createDataFrame([(k,) for k in known], "uri string")
    p.createOrReplaceTempView("p_not_in")
    h.createOrReplaceTempView("h_not_in")
    want = rows(spark.sql("select uri from p_not_in where record__langs like 'fr' and uri not in (select uri from h_not_in)"))
    assert rows(ops.pending(p, h, "fr"), "uri") == want


def test_pending_limit(posts, spark):
    assert ops.pending(posts, hints(spark), "fr", limit=1).count() == 1


def test_weekly_and_long_counts(posts, spark, rows):
    assert [r.n for r in ops.weekly_distinct(posts, "n").collect()] == [3]
    assert (T.date(), "fr", "k1", 2) in rows(ops.long_counts(posts), "date", "langs", "query", "post_count")
    assert rows(ops.related_counts(posts, hints(spark, ("a", True))), "langs", "ili_related") == [("fr", 1)]


def test_sample_size(posts):
    assert ops.sample_rows(posts, 2, 1).count() == 2
    assert ops.sample_rows(posts, 99, 1).count() == 5


def test_ledger_of_pending_posts(spark, rows):
    def made(*data):
        return spark.createDataFrame(list(data), "uri string, record__text string, record__langs string")

    hints = spark.createDataFrame([("known", True), (None, False)], "uri string, ili_related boolean")
    ledger = spark.createDataFrame([("old", "t", "fr", 2)], ops.LEDGER_COLUMNS)
    batch = made(("a", "x", "fr"), ("a", "y", "fr"), ("b", "z", "de"), ("known", "k", "fr"), ("old", "new text", "fr"), (None, "n", "fr"), ("c", None, None))
    ledger = ops.enqueued(ledger, batch, hints).cache()
    assert rows(ledger, "uri", "record__text", "tries") == [("a", "y", 0), ("b", "z", 0), ("c", None, 0), ("old", "t", 2)]
    assert rows(ops.due(ledger, ("fr",)), "uri") == [("a",), ("old",)]
    assert [r.uri for r in ops.due(ledger, ("fr", "de"), 2).collect()] == ["a", "b"]
    labels = spark.createDataFrame([("a", None), ("old", "down"), ("b", "down")], "uri string, error string")
    left = ops.settled(ledger, labels, most_tries=3).cache()
    # done, failed for the last time, failed once, not tried
    assert rows(left, "uri", "tries") == [("b", 1), ("c", 0)]
    assert rows(ops.enqueued(left, batch.limit(0), hints.limit(0)), "uri", "tries") == [("b", 1), ("c", 0)]
    assert ops.settled(left.limit(0), labels).count() == 0
