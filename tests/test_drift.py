import pytest
from pyspark.sql import types as T

from signalflow.sources import drift
from signalflow.sources.flatten import child_rows


def land(spark, path, batch, texts):
    rows = spark.createDataFrame([(batch, i, t) for i, t in enumerate(texts)], "night string, n int, raw string")
    drift.land_batch(rows, path, batch, "raw", ("night", "n"))


def read(spark, path):
    return drift.read_drifting(spark, path, ("night", "n")).orderBy("night", "n")


def test_later_fields_become_columns(spark, tmp_path):
    path = str(tmp_path)
    land(spark, path, "01", ['{"rowId": 7, "by": {"name": "x"}}', '{"rowId": 8, "seen": null}'])
    first = read(spark, path)
    assert first.columns == ["night", "n", "by__name", "row_id"]
    files = {f: f.stat().st_mtime_ns for f in tmp_path.glob("rows/**/*.parquet")}
    land(spark, path, "02", ['{"row_id": 9, "by": {"name": "y", "age": 4}, "seen": true, "parts": [{"q": 1}, {"q": 2, "r": "z"}]}'])
    out = read(spark, path)
    assert [tuple(r[:6]) for r in out.select("n", "row_id", "by__name", "by__age", "seen", "night").collect()] == [
        (0, 7, "x", None, None, "01"), (1, 8, None, None, None, "01"), (0, 9, "y", 4, True, "02"),
    ]
    assert {f: f.stat().st_mtime_ns for f in files} == files
    lists = child_rows(out, "parts", ("night", "n")).orderBy("list_idx")
    assert [tuple(r) for r in lists.collect()] == [("02", 0, 0, 1, None), ("02", 0, 1, 2, "z")]


def test_mixed_types_and_rows_that_are_no_object(spark, tmp_path):
    path = str(tmp_path)
    land(spark, path, "a", ['{"v": 1, "w": 2, "o": {"p": 1}, "n": 0}', "[1]", "no json", None, "{}"])
    land(spark, path, "b", ['{"v": "one", "w": 2.5, "o": "flat", "n": 5}', '{"v": {"deep": [1]}, "w": 3}'])
    got = read(spark, path)
    assert got.columns == ["night", "n", "doc__n", "o__p", "v", "w", "o"]
    assert [(r.v, r.w and float(r.w), r.o, r.o__p, r.doc__n) for r in got.collect()] == [
        ("1", 2.0, '{"p":1}', 1, 0), *[(None,) * 5] * 4, ("one", 2.5, "flat", None, 5), ('{"deep":[1]}', 3.0, None, None, None),
    ]


def test_batch_landed_again_replaces_itself_and_half_a_batch_is_not_read(spark, tmp_path):
    path = str(tmp_path)
    land(spark, path, "1", ['{"a": 1}'])
    land(spark, path, "1", ['{"a": 2, "it\'s": 3, "OBJECT<": 4}', '{"a": 5}'])
    rows = spark.createDataFrame([("x", 0, "{}")], "night string, n int, doc string")
    drift.parsed(rows, "doc").write.parquet(f"{path}/rows/batch={drift.PREFIX}2")
    assert sorted(tuple(r) for r in read(spark, path).select("a", "it_s", "object_").collect()) == [(2, 3, 4), (5, None, None)]


def test_empty_batch_and_unreachable_name(spark, tmp_path):
    land(spark, str(tmp_path), "1", [])
    assert read(spark, str(tmp_path)).columns == ["night", "n"] and read(spark, str(tmp_path)).count() == 0
    with pytest.raises(ValueError, match="cannot name"):
        drift.columns([(("a\"'b",), T.LongType())])


def test_common_type():
    long, text, real = T.LongType(), T.StringType(), T.DoubleType()
    assert drift.common_type([long, long]) == long
    assert drift.common_type([long, T.DecimalType(4, 2)]) == T.DecimalType(21, 2)
    assert drift.common_type([T.DecimalType(38, 0), T.DecimalType(38, 30)]) == real
    assert drift.common_type([long, real]) == real
    assert drift.common_type([T.ArrayType(T.NullType()), T.ArrayType(text)]) == T.ArrayType(text)
    assert drift.common_type([T.BooleanType(), long]) == text
