from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from signalflow.operators.gapfill import gap_fill, interpolate

D0 = date(2024, 1, 1)


def day(n):
    return D0 + timedelta(days=n)


def test_linear_fill_skips_nulls(spark, rows):
    df = spark.createDataFrame([("a", day(0), 10.0), ("a", day(7), 24.0), ("a", day(14), None), ("a", day(21), 3.0), ("a", day(28), None)], "s string, date date, v double")
    got = [r.v for r in gap_fill(df, "date", {"v": "linear"}, ["s"]).orderBy("date").collect()]
    assert len(got) == 29
    assert got[:8] == [10.0, 12.0, 14.0, 16.0, 18.0, 20.0, 22.0, 24.0]
    assert got[14] == 13.5 and got[21] == 3.0
    assert got[22:] == [None] * 7


def test_logged_values(spark):
    known = [("a", date(2023, 8, 14), 29.170718), ("a", date(2023, 8, 21), 29.170718 + 7 * 1.636728)]
    df = spark.createDataFrame(known, "s string, date date, v double")
    got = [r.v for r in gap_fill(df, "date", {"v": "linear"}, ["s"]).orderBy("date").collect()]
    assert np.allclose(got[:5], [29.170718, 30.807446, 32.444174, 34.080902, 35.717630])


def test_bounds_and_methods(spark, rows):
    df = spark.createDataFrame([("a", day(2), 1.0), ("a", day(4), 5.0), ("a", day(9), 7.0)], "s string, date date, v double")
    df = df.withColumn("w", df.v).withColumn("n", df.v)
    got = gap_fill(df, "date", {"v": "linear", "w": "locf", "n": "null"}, ["s"], start=day(0), end=day(6))
    assert [(r.date, r.v, r.w, r.n) for r in got.orderBy("date").collect()] == [
        (day(0), None, None, None), (day(1), None, None, None), (day(2), 1.0, 1.0, 1.0), (day(3), 3.0, 1.0, None),
        (day(4), 5.0, 5.0, 5.0), (day(5), None, 5.0, None), (day(6), None, 5.0, None),
    ]


def test_rows_sharing_a_date_are_kept(spark):
    df = spark.createDataFrame([("a", day(0), 1.0), ("a", day(0), 2.0), ("a", day(14), 3.0)], "s string, date date, v double")
    got = gap_fill(df, "date", {"v": "null"}, ["s"], bucket_days=7)
    assert sorted((r.date, r.v is None) for r in got.collect()) == [(day(0), False), (day(0), False), (day(7), True), (day(14), False)]


def test_arguments_are_checked(spark):
    df = spark.createDataFrame([("a", day(0), 1.0)], "s string, date date, v double")
    with pytest.raises(ValueError):
        gap_fill(df, "date", {"v": "cubic"}, ["s"])
    with pytest.raises(ValueError):
        gap_fill(df, "date", {"v": "linear"}, [])


values = st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6)), min_size=1, max_size=12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(a=values, b=values, step=st.sampled_from([1, 7]))
def test_against_pandas(spark, a, b, step):
    data = [(s, day(i * step), v) for s, vs in (("a", a), ("b", b)) for i, v in enumerate(vs)]
    df = spark.createDataFrame(data, "s string, date date, v double")
    got = gap_fill(df, "date", {"v": "linear"}, ["s"]).toPandas()
    for s, vs in (("a", a), ("b", b)):
        series = pd.Series([np.nan if v is None else v for v in vs], index=pd.to_datetime([day(i * step) for i in range(len(vs))]))
        want = series.resample("D").asfreq().interpolate("time", limit_area="inside")
        mine = got[got.s == s].sort_values("date").v.to_numpy(dtype=float)
        assert np.allclose(mine, want.to_numpy(), equal_nan=True, rtol=1e-9, atol=1e-6)
    weekly = interpolate(df, "date", {"v": "linear"}, ["s"]).toPandas()
    both = weekly.merge(got, on=["s", "date"])
    assert np.allclose(both.v_x.astype(float), both.v_y.astype(float), equal_nan=True)
