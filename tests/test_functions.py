import datetime as dt

import pytest
from conftest import values
from postflow.functions import calendar, ids, phrases, variations
from postflow.schemas import POST_PUBLISH, POST_RAW, POST_RAW_CLASSIFIED, POST_STORED, POST_STREAM, conform, table
from pyspark.sql import functions as F

DAY = dt.date(2024, 3, 10)


def at(text):
    return int(dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc).timestamp())


def test_publish_window_includes_both_ends(spark):
    low, high = at("2024-03-08"), at("2024-03-11")
    df = spark.createDataFrame([(low - 1,), (low,), (high,), (high + 1,), (None,)], "t long")
    assert values(df.filter(calendar.in_publish_window(F.col("t"), DAY))) == [(low,), (high,)]


def test_publish_window_reaches_the_scan(spark, tmp_path):
    spark.range(10).withColumnRenamed("id", "t").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t")).filter(calendar.in_publish_window(F.col("t"), DAY))
    assert f"GreaterThanOrEqual(t,{at('2024-03-08')})" in df._jdf.queryExecution().toString()


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_stored_on_is_half_open_after_the_shift(spark, kind, tmp_path):
    rows = ["2024-03-10 06:59:59", "2024-03-10 07:00:00", "2024-03-11 06:59:59", "2024-03-11 07:00:00"]
    df = spark.createDataFrame([(r,) for r in rows], "s string").select("s", F.col("s").cast(kind).alias("createdAt"))
    assert [r.s for r in calendar.stored_on(df, "createdAt", DAY).orderBy("s").collect()] == rows[1:3]
    df.write.parquet(str(tmp_path / kind))
    plan = calendar.stored_on(spark.read.parquet(str(tmp_path / kind)), "createdAt", DAY)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(createdAt" in plan


def test_stamp_and_default_day(spark):
    row = spark.range(1).select(
        calendar.stored_stamp(DAY).cast("string").alias("a"),
        calendar.stored_stamp(dt.datetime(2024, 3, 10, 20, 30)).cast("string").alias("b"),
        (calendar.as_of_day() == F.current_date()).alias("c"),
        (calendar.stored_stamp() > F.current_timestamp()).alias("d"),
    ).first()
    assert tuple(row) == ("2024-03-10 07:00:00", "2024-03-11 03:30:00", True, True)


def test_post_id_skips_null(spark):
    df = spark.createDataFrame([("u", 1), (None, 7), ("u", None), (None, None)], "url string, org_id int")
    assert [r[0] for r in df.select(ids.post_id()).collect()] == ["u-1", "7", "u", ""]


def test_uids(spark):
    df = spark.createDataFrame([("u", 1)], "url string, org_id int")
    one, two = (df.select(ids.keyed_uid(["url", "org_id"])).first()[0] for _ in range(2))
    assert one == two and len(one) == 16
    drawn = [r[0] for r in spark.range(50).select(ids.random_uid()).collect()]
    assert len(set(drawn)) == 50 and all(len(x) == 16 and int(x, 16) >= 0 for x in drawn)


def test_phrases(spark):
    text = "[{match_phrase={content=AAA}}, {match_phrase={content= bbb c }}, {match_phrase={content=}}]"
    row = spark.createDataFrame([(text, "[a, b,]", "[{x=1}, {y=2}]")], "p string, l string, o string").select(
        phrases.phrases_from_text(F.col("p")), phrases.bracket_list(F.col("l")), phrases.bracket_objects(F.col("o"))
    ).first()
    assert list(row) == [["AAA", "bbb c"], ["a", " b", ""], ["{x=1", "y=2}"]]


def test_phrases_from_structs(spark):
    df = spark.createDataFrame([([(("a",),), ((None,),)],)], "s array<struct<match_phrase:struct<content:string>>>")
    assert df.select(phrases.phrases_from_structs(F.col("s"))).first()[0] == ["a", None]


VARIATIONS = [None, "", " ", "a", "a, b", "a,", ",", "a,b,c", "\ta\n,  b\t", " a ", "a , b　", "x\x1f,y"]


def test_variations_equal_plain_python(spark):
    def plain(s):
        return [(f"name{i}", v.strip()) for i, v in enumerate(s.split(","), 1)] if s else []

    df = spark.createDataFrame([(i, v) for i, v in enumerate(VARIATIONS)], "i int, v string")
    df = df.withColumn("p", variations.split_variations(F.col("v")))
    rows = df.select("i", "p", variations.variation_names("p"), variations.variation_values("p")).collect()
    for i, pairs, names, vals in rows:
        want = plain(VARIATIONS[i])
        assert [tuple(p) for p in pairs] == want
        assert names == ",".join(n for n, _ in want) and vals == ", ".join(v for _, v in want)


def test_variation_pair(spark):
    df = spark.createDataFrame([(v,) for v in [None, "", "a", "a, b", "a,b,c", "a,"]], "v string")
    got = [tuple(r[0]) for r in df.select(variations.split_variation_pair(F.col("v"))).collect()]
    assert got == [(None, None), (None, None), ("a", None), ("a", " b"), ("a,b,c", None), ("a", "")]


def test_lenient_casts(spark):
    df = spark.createDataFrame([("12", 5), ("x", 2**40), (None, None), ("", -1)], "level string, views long")
    assert [tuple(r) for r in conform(df, table("views INT, level INT")).collect()] == [(5, 12), (None, None), (None, None), (-1, None)]


def test_schema_sizes():
    sizes = [len(s) for s in (POST_RAW, POST_RAW_CLASSIFIED, POST_STORED, POST_PUBLISH, POST_STREAM)]
    assert sizes == [31, 33, 34, 35, 31]
    assert POST_RAW_CLASSIFIED["level"].dataType.simpleString() == "string"
