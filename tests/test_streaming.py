from datetime import date, datetime

from signalflow.streaming import counts as ops

SCHEMA = "uri string, event_time timestamp_ntz, keyword string, langs array<string>"


def land(spark, path, *rows):
    spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.mode("append").parquet(path)


def source(spark, path):
    return spark.readStream.schema(SCHEMA).parquet(path)


def test_incremental_counts(spark, tmp_path, rows):
    landed, table, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    land(spark, landed, ("a", datetime(2024, 1, 1, 10), "k", ["fr"]), ("b", datetime(2024, 1, 1, 11), "k", ["fr"]))
    ops.stream_counts(source(spark, landed), table, ckpt)
    assert rows(spark.read.parquet(table), "period_start", "post_count") == [(date(2024, 1, 1), 2)]
    # the next run reads only the new file and adds to the kept state
    land(spark, landed, ("c", datetime(2024, 1, 1, 23), "k", ["fr"]), ("d", datetime(2024, 1, 4), "k", ["fr"]))
    ops.stream_counts(source(spark, landed), table, ckpt)
    assert rows(spark.read.parquet(table), "period_start", "post_count") == [(date(2024, 1, 1), 3), (date(2024, 1, 4), 1)]
    # later than the watermark: dropped and reported
    land(spark, landed, ("e", datetime(2024, 1, 1, 12), "k", ["fr"]))
    query = ops.stream_counts(source(spark, landed), table, ckpt)
    assert rows(spark.read.parquet(table), "period_start", "post_count") == [(date(2024, 1, 1), 3), (date(2024, 1, 4), 1)]
    assert ops.dropped_rows(query) == 1


def test_weeks_start_on_monday(spark, tmp_path, rows):
    landed, table, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    land(spark, landed, ("a", datetime(2024, 1, 7, 23, 59), "k", ["fr"]), ("b", datetime(2024, 1, 8), "k", ["fr"]))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        ops.stream_counts(source(spark, landed), table, ckpt, unit="week")
        assert rows(spark.read.parquet(table), "period_start", "post_count") == [(date(2024, 1, 1), 1), (date(2024, 1, 8), 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_dedup_across_runs(spark, tmp_path, rows):
    landed, table, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    for _ in range(2):
        land(spark, landed, ("a", datetime(2024, 1, 1, 10), "k", ["fr"]), ("a", datetime(2024, 1, 1, 10), "k2", ["fr"]))
        ops.append_stream(ops.unique_posts(source(spark, landed)), table, ckpt)
    got = spark.read.parquet(table)
    assert rows(got, "uri", "event_time") == [("a", datetime(2024, 1, 1, 10))]


def test_post_merge(spark, tmp_path, rows):
    landed, table, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    for hour, word in ((10, "first"), (12, "latest"), (11, "latest")):
        land(spark, landed, ("a", datetime(2024, 1, 1, hour), word, []))
        ops.stream_posts(source(spark, landed).drop("langs"), table, ckpt, order="event_time", created="event_time")
    got = rows(spark.read.parquet(table), "uri", "keyword", "event_time")
    assert got == [("a", "first", datetime(2024, 1, 1, 10)), ("a", "latest", datetime(2024, 1, 1, 12))]


def test_late_posts_are_kept_and_repaired(spark, tmp_path, rows):
    landed, base, table, ckpt = (str(tmp_path / n) for n in ("in", "late", "out", "ckpt"))

    def run():
        ops.stream_counts_with_late(source(spark, landed), base, table, ckpt)
        return rows(spark.read.parquet(table), "period_start", "post_count")

    def at(day, hour=10):
        return ("u", datetime(2024, 1, day, hour), "k", ["fr"])

    land(spark, landed, at(1), at(1), at(5))
    assert run() == [(date(2024, 1, 1), 2), (date(2024, 1, 5), 1)]
    land(spark, landed, at(1, 23), at(2), at(4, 12), at(5, 1), ("x", None, "k", None))
    # more than a day behind the newest of the batches before: kept aside
    first = run()
    assert first == sorted([(None, 1), (date(2024, 1, 1), 2), (date(2024, 1, 4), 1), (date(2024, 1, 5), 2)], key=lambda t: (t[0] is None, str(t[0])))
    assert spark.read.parquet(f"{base}/late").count() == 2
    for _ in range(2):
        assert {r.period_start for r in ops.repair_late_days(spark, base, table).collect()} == {date(2024, 1, 1), date(2024, 1, 2)}
        got = rows(spark.read.parquet(table), "period_start", "post_count")
        assert [r for r in got if r[0]] == [(date(2024, 1, 1), 3), (date(2024, 1, 2), 1), (date(2024, 1, 4), 1), (date(2024, 1, 5), 2)]
    # days that were repaired keep their late posts when more comes in
    land(spark, landed, at(4, 13), at(1))
    run()
    assert {r.period_start for r in ops.repair_late_days(spark, base, table).collect()} == {date(2024, 1, 1), date(2024, 1, 2)}
    land(spark, landed, at(4, 14))
    assert [r for r in run() if r[0]] == [(date(2024, 1, 1), 4), (date(2024, 1, 2), 1), (date(2024, 1, 4), 3), (date(2024, 1, 5), 2)]
