import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from signalflow.functions import text

ALPHABET = "aZéÿ×ß'!. \t\n    　\x1c\x1f\x850#@:/hтp中"
SAMPLES = [
    "Voilà http://x.y/é?q=1 la GRIPPE!", "@moi j'ai #grippe la fièvre", "a b@c d", "http", "http ", "@ #", "", "  ",
    "I cannot, gonna lemme CANNOT xcannot", "x\x1chttp:a\x1cb", "tab\there\nnew\r\nline",
]


def python_clean(s):
    s = re.sub(r"http\S+", "", s)
    s = re.sub(r"@\S+", "", s)
    s = re.sub(r"#\S+", "", s)
    s = re.sub(r"[^a-zA-ZÀ-ÿ\s]", "", s)
    return s.lower()


def compare(spark, samples):
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    df = df.withColumn("c", text.clean_text("s")).withColumn("w", text.words("c", split_contractions=False))
    for r in df.collect():
        assert r.c == python_clean(r.s)
        assert r.w == python_clean(r.s).split()


def test_clean_and_words(spark):
    compare(spark, SAMPLES)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=20, max_size=60))
def test_clean_and_words_random(spark, samples):
    compare(spark, samples)


def test_contractions(spark):
    df = spark.createDataFrame([("i cannot wanna be gotten  gonna",)], "s string")
    assert df.select(text.words("s").alias("w")).first().w == ["i", "can", "not", "wan", "na", "be", "gotten", "gon", "na"]


def test_languages(spark):
    data = [(None,), ([],), (["fr"],), (["fr", "de"],)]
    df = spark.createDataFrame(data, "l array<string>").withColumn("j", text.joined("l"))
    assert [r.j for r in df.collect()] == ["", "", "fr", "fr,de"]
    assert df.filter(text.lang_matches("j", "fr")).count() == 2
    assert df.filter(text.lang_matches("j", "fr", "exact")).count() == 1


def test_nested_strings(spark):
    df = spark.createDataFrame([(("a\x00b", ["\x00c", None], 3),), (None,)], "r struct<t:string,l:array<string>,n:int>")
    got = [r.r for r in df.select(text.map_strings(F.col("r"), df.schema["r"].dataType, text.strip_nul).alias("r")).collect()]
    assert (got[0].t, got[0].l, got[0].n) == ("ab", ["c", None], 3)
    assert got[1] is None


def test_stop_words(spark):
    assert len(text.stop_words(spark, "french")) > 100
    df = spark.createDataFrame([(["le", "chat"],)], "w array<string>")
    assert df.select(text.without_words("w", ["le"]).alias("w")).first().w == ["chat"]
    assert df.select(text.without_words("w", []).alias("w")).first().w == ["le", "chat"]


def test_unknown_match():
    with pytest.raises(ValueError):
        text.lang_matches("l", "fr", "prefix")
