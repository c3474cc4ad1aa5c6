"""The factorisation machine: its identity, its fit, and what it must not see."""

import random
import zlib

import numpy as np

import check
from signalflow.llm import factorization as fm

DOCS = "doc_id long, text string, lang string, score string, label long"
LABELS = "doc_id long, quality int, toxic int, text string"


def rows_of(rng, n):
    good = ["the", "river", "ran", "past", "an", "old", "mill", "and", "into", "town"]
    for i in range(n):
        kind = rng.randrange(4)
        words = [rng.choice(good) for _ in range(rng.randrange(20, 90))]
        if kind == 0:
            words = [w.upper() + "!!" for w in words]
        elif kind == 1 and i % 2:
            words = words[:1] * len(words)
        yield i, " ".join(words), int(not (kind == 0 or (kind == 1 and i % 2)))


def tables(spark, rows, extra=()):
    docs = spark.createDataFrame([(i, t, "en", "clash", 1) for i, t, _ in rows] + list(extra), DOCS)
    return docs, spark.createDataFrame([(i, q, 0, "clash") for i, _, q in rows], LABELS)


def scores(df):
    return {r.doc_id: (r.held_out, r.score, r.predicted) for r in df.collect()}


def test_linear_time_sum_equals_all_pairs():
    rng = np.random.default_rng(1)
    model = fm.Model(0.3, rng.normal(size=fm.FEATURES), rng.normal(size=(fm.FEATURES, fm.RANK)))
    for text in (None, "", "one", "two words", "a b c a ## B! 12\n\nx x x ü"):
        index, value = fm.features(text)
        assert len(set(index.tolist())) == len(index)
        want = 0.3 + sum(model.weight[i] * x for i, x in zip(index, value))
        for a in range(len(index)):
            for b in range(a):
                want += float(model.vector[index[a]] @ model.vector[index[b]]) * value[a] * value[b]
        assert abs(model.margin(index, value) - want) < 1e-9
        assert fm.Model.unpacked(model.packed()).score(text) == model.score(text)


def test_scores_of_unseen_rows(spark):
    rng = random.Random(4)
    rows = list(rows_of(rng, 900))
    docs, labels = tables(spark, rows, [(None, "no id", "en", "", 0), (5, rows[5][1], "de", "", 0), (5000, None, None, None, None), (5001, "", "", "", 0), (5002, "word " * 50000, "", "", 0)])
    got = fm.quality_scores(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    assert got.count() == len(rows) + 5
    found = scores(got)
    assert found[5000][1:] == found[5001][1:] and not found[None][0]
    assert all(0 <= s <= 1 and p == (s >= 0.7) for _, s, p in found.values())
    assert all(found[i][0] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _, _ in rows)
    unseen = [(found[i][2], q) for i, _, q in rows if found[i][0]]
    assert sum(p == q for p, q in unseen) >= 0.95 * len(unseen)


def test_held_out_labels_and_other_columns_change_nothing(spark):
    rows = list(rows_of(random.Random(5), 300))
    docs, labels = tables(spark, rows)
    turned = [(i, t, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q) for i, t, q in rows]
    other = docs.selectExpr("doc_id", "text", "'xx' AS lang", "text AS score", "doc_id AS label")
    assert scores(fm.quality_scores(docs, labels)) == scores(fm.quality_scores(other.repartition(3), tables(spark, turned)[1]))


def test_without_labels_or_rows(spark):
    rows = list(rows_of(random.Random(6), 5))
    docs, labels = tables(spark, rows)
    assert {s for _, s, _ in scores(fm.quality_scores(docs, labels.limit(0))).values()} == {0.5}
    assert fm.quality_scores(docs.limit(0), labels).count() == 0
    one_kind = labels.selectExpr("doc_id", "1 AS quality")
    assert all(p == 1 for h, _, p in scores(fm.quality_scores(docs, one_kind)).values())


def test_held_out_accuracy_on_the_test_tables(spark):
    sf = f"{check.DATA}/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    found = fm.quality_scores(docs, labels).filter("held_out").join(labels, "doc_id").collect()
    assert len(found) > 50
    assert sum(r.predicted == r.quality for r in found) >= 0.95 * len(found)
