"""Registered queries against their SQL on the smallest test tables."""

import os

import pytest

import __spark_entry__ as spark_entry
import check

SF = f"{check.DATA}/sf0.001"
# a quick one of every area; ``check.py`` runs them all
NAMES = (
    "signal_weekly", "signal_daily", "incidence_weekly_gapfilled", "daily_counts", "weekly_counts_by_group", "posts_union_distinct",
    "posts_pending", "weekly_token_counts", "rule_annotation", "supervised_frame", "ts_folds", "mmwr_week", "read_post_pages",
    "stored_posts_by_keyword", "rule_annotation_others", "vectorizer_weekly_counts",
)


def test_names():
    queries, oracles = spark_entry.queries(), spark_entry.oracle_sql()
    assert set(oracles) <= set(queries) and set(NAMES) <= set(oracles)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not there")
@pytest.mark.parametrize("name", NAMES)
def test_against_sql(spark, name):
    got = spark_entry.queries()[name](spark, SF).toPandas()
    assert check.differences(got, check.connect(SF).sql(spark_entry.oracle_sql()[name]).df()) is None


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not there")
def test_entry(spark):
    assert spark_entry.entry(spark).columns[:2] == ["country_code", "date"]
