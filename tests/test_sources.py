import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from signalflow.sources import flatten, pages, sinks, surveillance, tables


def page(path, keyword, name, posts, **extra):
    folder = path / f"keyword={keyword}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps({"posts": posts, **extra}))


def post(uri, created=None, indexed=None, **record):
    out = {"uri": uri, "author": {"did": "d1"}, "record": {"text": "a\u0000b", **record}}
    if created:
        out["record"]["createdAt"] = created
    if indexed:
        out["indexedAt"] = indexed
    return out


def test_post_pages(spark, tmp_path, rows):
    page(tmp_path, "grippe", "1.json", [
        post("u1", "2025-03-14T10:00:00.000Z", "2025-03-14T09:00:00Z", langs=["fr", "de"]),
        post("u2", None, "2025-03-14T08:00:00Z", langs=[]),
    ], until="2025-03-14T23:59:59Z")
    page(tmp_path, "rhume", "1.json", [post("u3", "nonsense")], page_id="p9")
    got = pages.read_post_pages(spark, str(tmp_path))
    assert rows(got, "uri", "keyword", "event_time", "text", "langs") == [
        ("u1", "grippe", datetime(2025, 3, 14, 9), "ab", ["fr", "de"]),
        ("u2", "grippe", datetime(2025, 3, 14, 8), "ab", []),
        ("u3", "rhume", None, "ab", []),
    ]
    ids = dict(rows(got, "uri", "page_id"))
    assert ids["u3"] == "p9" and ids["u1"] == ids["u2"] and ids["u1"].endswith("keyword=grippe/1.json")
    assert rows(pages.staged_posts(got), "uri", "record__langs") == [("u1", "fr,de"), ("u2", ""), ("u3", "")]


def test_who(spark, tmp_path, rows):
    f = tmp_path / "fluid.csv"
    f.write_text('ISO_WEEKSTARTDATE,COUNTRY_CODE,ILI_CASE,COMMENTS\n2024-01-01,FRA,5,"a, b"\n2024-01-08,DEU,,x\n')
    got = surveillance.read_who(spark, str(f), "fluid", lower=True)
    assert got.columns == ["iso_weekstartdate", "country_code", "ili_case"]
    assert rows(got) == [(date(2024, 1, 1), "FRA", 5), (date(2024, 1, 8), "DEU", None)]
    assert surveillance.country_rows(got, "FRA", "country_code").count() == 1
    with pytest.raises(ValueError):
        surveillance.read_who(spark, str(f), "fluview")


def test_rki_and_cdc(spark, tmp_path, rows):
    f = tmp_path / "rki.tsv"
    f.write_text("Kalenderwoche\tWert\n2025-W01\t3\nx\t4\n")
    assert rows(surveillance.read_rki(spark, str(f), "sentinel"), "Wert", "ISO_WEEKSTARTDATE") == [(3, date(2024, 12, 30)), (4, None)]
    assert surveillance.read_rki(spark, str(f), "sentinel", legacy_weeks=True).first().ISO_WEEKSTARTDATE == date(2025, 1, 6)
    g = tmp_path / "cdc.json"
    g.write_text('{"epiweek": 202501, "num_ili": 7}\n')
    assert surveillance.read_cdc(spark, str(g), "fluview_clinical", "epiweek int, num_ili int").first().num_ili == 7
    for call in (lambda: surveillance.read_rki(spark, str(f), "x"), lambda: surveillance.read_cdc(spark, str(g), "x")):
        with pytest.raises(ValueError):
            call()


def test_preambles(spark, tmp_path, rows):
    labs = tmp_path / "labs.csv"
    labs.write_text('"*Made-up note, one line"\nREGION TYPE,REGION,YEAR,WEEK,TOTAL A\nDistrict,Nowhere,2031,7,12\n')
    assert rows(surveillance.read_labs(spark, str(labs)), "REGION TYPE", "YEAR", "TOTAL A", "week_start") == [("District", 2031, 12, date(2031, 2, 9))]
    sentinel = tmp_path / "inc.csv"
    sentinel.write_text('# {"a": 1}\n"week","geo_insee","indicator","inc","inc100","inc_up","inc_low","inc100_up","inc100_low"\n203107,"ZZ",99,500,5,600,400,6,4\n')
    assert rows(surveillance.read_sentinel(spark, str(sentinel)), "week", "inc", "inc100_low", "week_start") == [(203107, 500, 4, date(2031, 2, 10))]
    for kw, n in (("meteo", 1), ("travail", 2)):
        (tmp_path / f"baseline_{kw}.csv").write_text(f"period_start,post_count\n2022-01-04,{n}\n")
    assert rows(surveillance.read_baseline(spark, str(tmp_path / "baseline_*.csv"))) == [("meteo", date(2022, 1, 4), 1), ("travail", date(2022, 1, 4), 2)]


def test_registry_and_corpus(spark, tmp_path):
    df = spark.createDataFrame([(date(2024, 1, 1), 1, 2), (date(2023, 8, 7), 3, 4)], "date date, grippe_posts int, rest_posts int")
    df.write.parquet(str(tmp_path / "w"))
    registry = tables.signal_registry({"fr": str(tmp_path / "w")}, {"fr": str(tmp_path / "w")})
    weekly = registry.load(spark, "grippe_posts_fr")
    assert weekly.columns == ["date", "ili_posts", "control_posts", "year", "month", "week", "season"]
    assert registry.load(spark, "upsampled_fr").columns[-1] == "day"
    with pytest.raises(ValueError):
        registry.load(spark, "grippe_posts_it")
    with pytest.raises(ValueError):
        tables.text_corpus(spark)
    (tmp_path / "c.csv").write_text('uri,record__text\nu1,"two\nlines, ""quoted"""\n')
    assert tables.text_corpus(spark, input_file=str(tmp_path / "c.csv")).first().record__text == 'two\nlines, "quoted"'


def test_flatten(spark, rows):
    data = [(1, (("x", 2), ["a", "b"]), [(1, ("q",))]), (2, None, None)]
    df = spark.createDataFrame(data, "rowId int, record struct<innerPart:struct<createdAt:string,n:int>,langs:array<string>>, items array<struct<k:int,sub:struct<v:string>>>")
    assert flatten.flatten_struct(df).columns == ["row_id", "record__inner_part__created_at", "record__inner_part__n", "record__langs", "items"]
    assert rows(flatten.child_rows(df, "items", ["rowId"])) == [(1, 0, 1, "q")]
    assert flatten.child_rows(df, "items", ["rowId"], outer=True).count() == 2
    assert flatten.child_rows(df, "record.langs", ["rowId"]).columns == ["rowId", "list_idx", "value"]
    assert flatten.snake_case("XMLHttpName 2") == "xml_http_name_2"


COUNTS = "period_start date, langs string, query string, post_count bigint"


def test_upsert(spark, tmp_path, rows):
    path = str(tmp_path / "counts")
    first = spark.createDataFrame([(date(2024, 1, 1), "fr", "a", 1), (date(2024, 2, 1), "fr", "a", 2)], COUNTS)
    sinks.upsert_counts(spark, path, first)
    untouched = {f.name for f in (tmp_path / "counts" / "period_month=2024-01-01").iterdir()}
    second = spark.createDataFrame([(date(2024, 2, 1), "fr", "a", 9), (date(2024, 2, 2), "fr", "b", 3)], COUNTS)
    want = [(date(2024, 1, 1), 1), (date(2024, 2, 1), 9), (date(2024, 2, 2), 3)]
    for _ in range(2):
        sinks.upsert_counts(spark, path, second)
        assert rows(spark.read.parquet(path), "period_start", "post_count") == want
    assert {f.name for f in (tmp_path / "counts" / "period_month=2024-01-01").iterdir()} == untouched


def test_posts_are_stored_per_keyword(spark, tmp_path, rows):
    path, schema = str(tmp_path / "posts"), "keyword string, uri string, seen int"

    def put(*data):
        sinks.upsert_posts(spark, path, spark.createDataFrame(list(data), schema), "seen", created=None)
        return rows(spark.read.parquet(path), "keyword", "uri", "seen")

    assert put(("grippe", "u", 5), ("fievre", "u", 4), ("grippe", "u", 3)) == [("fievre", "u", 4), ("grippe", "u", 5)]
    assert put() == [("fievre", "u", 4), ("grippe", "u", 5)]
    for _ in range(2):
        assert put(("grippe", "u", 4), ("fievre", "u", 6)) == [("fievre", "u", 6), ("grippe", "u", 5)]


def test_merge_touches_only_what_a_key_can_hit(spark, tmp_path, rows):
    path, schema = tmp_path / "posts", "keyword string, uri string, record__created_at timestamp_ntz, v int"

    def files():
        return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}

    def night(month, first, last, v):
        batch = spark.createDataFrame([("k", f"u{i}", datetime(2024, month, 1 + i % 28), v) for i in range(first, last)], schema)
        before = files()
        sinks.upsert_posts(spark, str(path), batch, buckets=4)
        after = files()
        gone = {f for f in before if f not in after or after[f] != before[f]}
        return gone, {f for f in after if f not in before}

    stored = {}
    for month in (1, 2, 3):
        gone, new = night(month, month * 100, month * 100 + 60, month)
        assert not gone and all(f"post_month=2024-0{month}-01" in f for f in new)
        stored |= {f"u{i}": month for i in range(month * 100, month * 100 + 60)}
    gone, new = night(3, 300, 360, 7)  # the same night again, with other values
    assert gone and all("post_month=2024-03-01" in f for f in gone | new)
    gone, new = night(4, 150, 151, 8)  # a key of January found again, dated otherwise: it stays where it is
    assert len({f.rsplit("/", 1)[0] for f in gone | new}) == 1 and all("post_month=2024-01-01" in f for f in gone | new)
    stored |= {f"u{i}": 7 for i in range(300, 360)} | {"u150": 8}
    for _ in range(2):
        night(4, 340, 380, 9)  # known and new keys in one batch, twice
    stored |= {f"u{i}": 9 for i in range(340, 380)}
    got = spark.read.parquet(str(path))
    assert {r.uri: r.v for r in got.collect()} == stored and got.count() == len(stored)
    filters = spark.read.parquet(f"{path}_keys").groupBy("post_month", "post_bucket", "word").count()
    assert filters.filter("post_month < '2024-04-01' and count > 1").count() == 0


def test_upsert_joins_partitions_beyond_the_list(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr(sinks, "LISTED_PARTITIONS", 3)
    path, schema = str(tmp_path / "t"), "k int, v int"
    for v in (1, 2):
        batch = spark.createDataFrame([(k, v) for k in range(0, 12, v)], schema)
        sinks.upsert(spark, path, batch, ("k",), ("part", F.pmod("k", F.lit(6))))
    assert rows(spark.read.parquet(path), "k", "v") == sorted(((k, 2 if k % 2 == 0 else 1) for k in range(12)), key=lambda t: (str(t[0]), t[1]))


def test_a_folder_without_data_is_no_table(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "_SUCCESS").write_text("")
    assert not sinks.table_exists(spark, str(tmp_path / "t"))
    assert sinks.read_table(spark, str(tmp_path / "t"), "a int").count() == 0


def test_keep_latest_handles_a_hot_key(spark):
    df = spark.range(50_000).select((F.col("id") * 0).alias("k"), F.col("id").alias("seen"), F.lit(None).cast("string").alias("t"))
    assert [tuple(r) for r in sinks.keep_latest(df, ["k"], ["seen"]).collect()] == [(0, 49_999, None)]


def test_materialize_and_export(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, s string")
    assert sinks.materialize(df, "some_view", "view").count() == 2
    assert sinks.materialize(df, "some_table", "table", str(tmp_path / "t")).count() == 2
    with pytest.raises(ValueError):
        sinks.materialize(df, "x", "index")
    sinks.export_csv(df.repartition(2), str(tmp_path / "csv"), single_file=True)
    assert len(list((tmp_path / "csv").glob("part-*"))) == 1
