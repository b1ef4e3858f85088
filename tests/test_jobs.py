import datetime as dt
import json

import pytest
from conftest import values
from postflow.operators import dedupe, sales
from postflow.plans import classify, daily, publish
from postflow.schemas import (
    ORG_DICT, POST_PUBLISH, POST_RAW, POST_RAW_CLASSIFIED, POST_STORED, POST_STREAM, PROPERTY_EVENT, PROPERTY_OUT, table,
)
from postflow.session import build_session, cache_static
from postflow.sources import specs
from postflow.sources.readers import read_source, read_stream
from postflow.sources.writers import check_target, read_target, write, write_if_any, write_stream
from postflow.streaming import jobs, parse
from pyspark.sql import functions as F

DAY = dt.date(2024, 3, 10)
NOON = int(dt.datetime(2024, 3, 10, 12, tzinfo=dt.timezone.utc).timestamp())


def frame(spark, schema, rows):
    """Rows given as dicts; absent columns are NULL."""
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)


@pytest.fixture(scope="module")
def orgs(spark):
    spam = json.dumps({"match_phrase": {"content": "Casino"}})
    return frame(spark, ORG_DICT, [
        {"code": "A1", "org_id": 1, "keywords": ["Bank", "loan"], "spamwords": [spam, "not json"]},
        {"code": "B2", "org_id": 2, "keywords": ["BANK", None, " "], "spamwords": None},
    ])


def post(**kw):
    return {"pub_time": NOON, "crawl_time": NOON, "url": "u", "content": "the bank", "id": "0", **kw}


@pytest.fixture(scope="module")
def posts(spark):
    return frame(spark, POST_RAW, [
        post(url="u1", content="a BANK loan", crawl_time=1, id="1"),
        post(url="u1", content="new bank", crawl_time=2, id="2"),
        post(url="u2", content="bank casino"),
        post(url="u3", content=""), post(url="u3", content=None),
        post(url="u4", pub_time=NOON + 2 * 86400), post(url="u5", pub_time=None),
        post(url=None), post(url=None, id="9"),
        post(url="u6", content="mortgage loans", views=2**40, level=3),
        post(url="u7", content="no match"),
    ])


def test_classify_posts(posts, orgs):
    out = classify.classify_posts(posts, orgs, DAY)
    assert out.schema.names == POST_STORED.names
    assert [f.dataType for f in out.schema] == [f.dataType for f in POST_STORED]
    assert values(out.select("post_id", "content", "views", "level")) == [
        ("u1-1", "new bank", None, None), ("u1-2", "new bank", None, None), ("u6-1", "mortgage loans", None, 3)]
    assert {r.pg_sync for r in out.collect()} == {False}


def test_null_urls_collapse_on_request(posts, orgs):
    ids = {r.post_id for r in classify.classify_posts(posts, orgs, DAY, null_url="collapse").collect()}
    assert ids == {"u1-1", "u1-2", "u6-1", "1", "2"}
    with pytest.raises(ValueError):
        classify.to_stored(posts, DAY, null_url="?")


def test_texts_are_repeated_for_organisations_after_the_last_shuffle(posts, orgs):
    plan = classify.classify_posts(posts, orgs, DAY)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate explode(org_ids") < plan.index("Exchange")


def test_an_older_post_stays_for_the_organisations_the_newer_one_lacks(spark):
    dictionary = frame(spark, ORG_DICT, [{"code": "A", "org_id": 1, "keywords": ["bank"]}, {"code": "B", "org_id": -1, "keywords": ["loan"]}])
    rows = [post(url="u", content="bank loan", crawl_time=1), post(url="u", content="bank", crawl_time=2),
            post(url="u-", content="bank", crawl_time=3), post(url="u-", content="bank", crawl_time=None)]
    out = classify.classify_posts(frame(spark, POST_RAW, rows), dictionary, DAY)
    # "u" with organisation -1 and "u-" with organisation 1 share an id
    assert values(out.select("post_id", "crawl_time")) == [("u--1", 3), ("u-1", 2)]


def test_normalise_keeps_spam_and_empty_texts(spark):
    rows = frame(spark, POST_RAW_CLASSIFIED, [
        post(org_id=3, level="7"), post(org_id=3, level="x", crawl_time=NOON + 1), post(org_id=4, content=None, level=None),
        post(org_id=5, url=None),
    ])
    out = classify.normalise_classified(rows, DAY)
    assert values(out.select("post_id", "level", "content")) == [("u-3", None, "the bank"), ("u-4", None, None)]


def test_classify_all_keeps_unmatched_and_repeats(posts, orgs):
    plain = orgs.withColumn("spamwords", F.array(F.lit("casino")))
    got = classify.classify_all(posts, plain).groupBy("url", "org_id").count()
    counts = {(r.url, r.org_id): r["count"] for r in got.collect()}
    assert counts["u1", 1] == 3 and counts["u1", 2] == 2 and counts["u7", None] == 1
    assert not any(u == "u2" for u, _ in counts) and ("u3", None) not in counts


def test_collapsed_posts_shuffle_each_text_once(spark, posts, orgs):
    plain = orgs.withColumn("spamwords", F.array(F.lit("casino")))
    given = posts.withColumn("post_id", F.col("url"))
    got = classify.classify_collapsed(given, plain)
    old = dedupe.collapse_orgs(classify.classify_all(given, plain).select("post_id", "content", "crawl_time", "org_id"))
    columns = ["post_id", "content", "crawl_time", "org_ids"]
    assert values(got.select(*columns)) == values(old.select(*columns))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and plan.count("Exchange hashpartitioning") == 1
    with pytest.raises(ValueError, match="content"):
        classify.classify_collapsed(given, plain, ("post_id",))


def test_publish(spark, orgs):
    stamp = dt.datetime(2024, 3, 10, 7, 0)
    stored = frame(spark, POST_STORED, [
        {"url": "u", "org_id": 1, "crawl_source_code": "web", "source_type": 2, "doc_type": 4, "createdAt": stamp},
        {"url": "u", "org_id": 9, "createdAt": stamp},
        {"url": "old", "org_id": 1, "createdAt": stamp - dt.timedelta(seconds=1)},
    ])
    twice = orgs.union(orgs)
    out = publish.publish_posts(stored, twice, DAY)
    assert out.schema.names == POST_PUBLISH.names
    (row,) = out.collect()
    assert row.id.startswith("A1-web-2-4-") and (row.is_sent, row.spam, row.completed, row.bot_id) == (0, 0, 0, "bot_cron")
    assert publish.publish_posts(stored, orgs, DAY).collect() == [row]
    assert publish.publish_posts(stored, orgs, DAY, random_ids=True).first().id != row.id


def test_daily_run(spark, posts, orgs, tmp_path):
    def save(df, name):
        df.write.parquet(str(tmp_path / name))
        return specs.files("parquet", str(tmp_path / name), df.schema)

    classified = frame(spark, POST_RAW_CLASSIFIED, [post(url="k", org_id=1, level="1")])
    config = daily.DailyConfig(
        save(posts, "raw"), save(classified, "classified"), save(orgs, "orgs"),
        specs.files("parquet", str(tmp_path / "store")), specs.SinkSpec("parquet", path=str(tmp_path / "store")),
        specs.SinkSpec("parquet", path=str(tmp_path / "publish")),
    )
    first = daily.daily_run(spark, config, DAY)
    assert [first[s].n_missing for s in ("classify", "normalise", "publish")] == [3, 1, 4]
    again = daily.daily_run(spark, config, DAY)
    assert [again[s].n_missing for s in ("classify", "normalise", "publish")] == [0, 0, 0]


def test_daily_run_stops_at_the_first_failure(spark, orgs, tmp_path):
    missing = specs.files("parquet", str(tmp_path / "absent"), POST_RAW)
    orgs.write.parquet(str(tmp_path / "orgs"))
    sink = specs.SinkSpec("parquet", path=str(tmp_path / "out"))
    config = daily.DailyConfig(missing, missing, specs.files("parquet", str(tmp_path / "orgs"), ORG_DICT), missing, sink, sink)
    with pytest.raises(Exception):
        daily.daily_run(spark, config, DAY)
    assert not (tmp_path / "out").exists()


# --- sales windows

def sold(spark, rows):
    base = dt.datetime(2024, 3, 10, 12, 0)
    return frame(spark, PROPERTY_EVENT, [
        {"product_id": p, "property_id": 1, "property_sold": n, "property_price": 10, "crawl_time": base + dt.timedelta(seconds=s)}
        for p, s, n in rows
    ])


def test_gap_is_not_bridged(spark):
    events = sold(spark, [(1, 0, 3), (1, 30, 5), (1, 70, 9), (1, 190, 20), (2, 60, 1)])
    gmv = sales.property_gmv(events).orderBy("product_id", "window_start")
    assert [(r.product_id, r.total_sales, r.prev_total_sales, r.quantity, r.gmv) for r in gmv.collect()] == [
        (1, 5, None, 0, 0), (1, 9, 5, 4, 40), (1, 20, None, 0, 0), (2, 1, None, 0, 0)]
    no_key = sales.property_gmv(sold(spark, [(None, 0, 3), (None, 70, 9)]))
    assert [r.prev_total_sales for r in no_key.collect()] == [None, None]
    attached = sales.attach_gmv(events, gmv)
    assert sorted(r.quantity for r in attached.collect()) == [0, 0, 0, 0, 4]


def test_no_per_key_window_frame(spark):
    plan = sales.property_gmv(sold(spark, [(1, 0, 1)]))._jdf.queryExecution().executedPlan().toString()
    assert "Window [" not in plan


def test_events_of_a_hot_product_stay_in_place(spark):
    rows = [(1, s % 50, s) for s in range(3000)] + [(2 + s % 700, s % 1000, s) for s in range(6000)] + [(None, 3, 1)]
    events = sold(spark, rows).repartition(8)
    plain = sorted((r.product_id or 0, r.property_sold, r.quantity) for r in events.join(sales.property_gmv(events), ["product_id", "property_id"], "left").where(
        "window_start is null or (crawl_time >= window_start and crawl_time < window_start + interval 1 minute)").fillna({"quantity": 0}).collect())
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = sales.attach_gmv(events, sales.property_gmv(events)).withColumn("part", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted((r.product_id or 0, r.property_sold, r.quantity) for r in found) == plain
    parts = [r.part for r in found if r.product_id == 1]
    assert len(parts) == 3000 and len(set(parts)) == 8


# --- streams

def drain(stream, tmp_path, name, each=None):
    spec = specs.StreamSinkSpec("parquet", str(tmp_path / f"{name}-state"), path=str(tmp_path / name), available_now=True)
    write_stream(stream, spec, each).awaitTermination()
    return spec.path


def test_stream_delta_equals_batch_on_closed_windows(spark, tmp_path):
    rows = [(1, 0, 3), (1, 30, 5), (1, 70, 9), (1, 190, 20), (2, 60, 1), (2, 130, 4), (1, 2000, 30)]
    sold(spark, rows).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = read_stream(spark, specs.files("parquet", str(tmp_path / "in"), PROPERTY_EVENT))
    out = spark.read.parquet(drain(jobs.windowed_delta(stream), tmp_path, "delta"))
    batch = sales.property_gmv(sold(spark, rows)).filter("window_start < '2024-03-10 12:20'")
    columns = ["product_id", "total_sales", "price", "prev_total_sales", "quantity", "gmv"]
    assert values(out.select(*columns)) == values(batch.select(*columns))


def test_stream_delta_drops_late_rows(spark, tmp_path):
    source = tmp_path / "in"
    sold(spark, [(1, 0, 3), (1, 3600, 9)]).coalesce(1).write.mode("append").parquet(str(source))
    stream = read_stream(spark, specs.files("parquet", str(source), PROPERTY_EVENT))
    drain(jobs.windowed_last(stream), tmp_path, "last")
    sold(spark, [(1, 30, 99), (1, 7200, 12)]).coalesce(1).write.mode("append").parquet(str(source))
    out = spark.read.parquet(drain(jobs.windowed_last(stream), tmp_path, "last"))
    assert values(out.select("total_sales")) == [(3,), (9,)]


def test_properties(spark):
    rows = frame(spark, PROPERTY_EVENT, [{"product_id": 1, "property_name": "Red, XL", "shop_id": 5}, {"product_id": 2}])
    out = jobs.properties(rows)
    assert out.schema.names == PROPERTY_OUT.names
    assert values(out.select("product_id", "name", "value")) == [(1, "name1,name2", "Red, XL"), (2, "", "")]


def test_parse_json(spark):
    texts = ['{"a":1,"b":"x"}', "broken", '{"b":"y"}', '{"a":"text"}', '{"a":99999999999}', None]
    df = spark.createDataFrame([(t,) for t in texts], "value string").select(F.col("value").cast("binary").alias("value"))
    got = [tuple(r) for r in parse.parse_json(df, table("a INT, b STRING")).collect()]
    assert got == [(1, "x"), (None, None), (None, "y"), (None, None), (None, None), (None, None)]
    kept = parse.parse_json(df, table("a INT, b STRING"), keep_bad=True)
    assert values(parse.bad_messages(kept)) == [("broken",), ('{"a":"text"}',), ('{"a":99999999999}',)]
    assert parse.good_messages(kept).count() == 3


def test_classify_stream_equals_batch_and_each_batch(spark, posts, orgs, tmp_path):
    plain = cache_static(orgs.withColumn("spamwords", F.array(F.lit("casino"))))
    names = [n for n in POST_STREAM.names if n in POST_RAW.names]
    posts.select(F.to_json(F.struct(*names)).alias("value")).coalesce(1).write.text(str(tmp_path / "in"))
    source = read_stream(spark, specs.files("text", str(tmp_path / "in")))
    stream = parse.parse_json(source, POST_STREAM)
    batch = classify.classify_all(posts, plain, how="inner").select("url", "org_id")
    out = spark.read.parquet(drain(jobs.classify_stream(stream, plain), tmp_path, "out"))
    assert values(out.select("url", "org_id")) == values(batch)
    sink = specs.SinkSpec("parquet", path=str(tmp_path / "each"))
    drain(stream, tmp_path, "each-state", jobs.classify_each_batch(lambda: plain, sink))
    assert values(spark.read.parquet(sink.path).select("url", "org_id")) == values(batch)
    plain.unpersist()


def test_replayed_stream(spark, tmp_path):
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = read_stream(spark, specs.files("parquet", str(tmp_path / "in"), table("id BIGINT")))
    once, each = specs.SinkSpec("parquet", path=str(tmp_path / "once")), specs.SinkSpec("parquet", path=str(tmp_path / "each"))
    for run in "ab":
        drain(stream, tmp_path, run, jobs.append_missing_each_batch(once, ["id"]))
        drain(stream, tmp_path, run + "x", jobs.append_each_batch(each))
    assert spark.read.parquet(once.path).count() == 5 and spark.read.parquet(each.path).count() == 10


# --- sources

def test_json_array_and_single_object(spark, tmp_path):
    rows = [{"code": "A", "org_id": 1, "keywords": ["x"], "spamwords": []}, {"code": "B", "org_id": 2}]
    (tmp_path / "many.json").write_text(json.dumps(rows, indent=1))
    (tmp_path / "one.json").write_text(json.dumps(rows[0], indent=1))
    assert values(read_source(spark, specs.json_documents(str(tmp_path / "many.json"), ORG_DICT)).select("code")) == [("A",), ("B",)]
    assert values(read_source(spark, specs.json_documents(str(tmp_path / "one.json"), ORG_DICT)).select("code")) == [("A",)]


def test_columns_narrow_the_scan(spark, tmp_path):
    spark.range(3).withColumn("b", F.lit("x")).write.parquet(str(tmp_path / "t"))
    df = read_source(spark, specs.SourceSpec("parquet", path=str(tmp_path / "t"), columns=("id",)))
    assert df.columns == ["id"] and "ReadSchema: struct<id:bigint>" in df._jdf.queryExecution().toString()


def test_specs_name_the_missing_value():
    with pytest.raises(ValueError, match="password"):
        specs.jdbc_table("jdbc:x", "t", "u", None, "d")
    with pytest.raises(ValueError, match="es.port"):
        specs.search_index("h", None, "i", "u", "p", POST_RAW)
    with pytest.raises(ValueError, match="upperBound"):
        specs.jdbc_table("jdbc:x", "t", "u", "p", "d", partition_column="id", lower=0, partitions=4)
    with pytest.raises(ValueError, match="checkpoint"):
        specs.StreamSinkSpec("console", None).validate()


def test_spec_options():
    jdbc = specs.jdbc_table("jdbc:x", "t", "u", "p", "d", partition_column="id", lower=0, upper=9, partitions=4)
    assert jdbc.options["partitionColumn"] == "id" and jdbc.options["numPartitions"] == "4"
    assert specs.jdbc_sink("jdbc:x", "s", "t", "u", "p", "d").label == "s.t"
    store = specs.document_store("m://x", "db", "posts", partitioner="P", partitions=2)
    assert store.options["partitioner"] == "P" and store.options["partitionerOptions.numPartitions"] == "2"
    assert specs.document_sink("m://x", "db", "posts").label == "posts"
    assert "startingOffsets" not in specs.broker_topic("h:1", "t").options
    assert specs.broker_topic("h:1", "t", "earliest").options["startingOffsets"] == "earliest"


def test_secrets_are_not_shown():
    spec = specs.jdbc_table("jdbc:x://u:secret@h", "t", "u", "secret", "d")
    assert "secret" not in repr(spec)


def test_targets(spark, tmp_path):
    sink = specs.SinkSpec("parquet", path=str(tmp_path / "t"))
    check_target(spark, sink)
    assert read_target(spark, sink) is None
    assert write_if_any(spark.range(0), sink) is False and read_target(spark, sink) is None
    assert write_if_any(spark.range(2), sink) is True
    write(spark.range(3), sink, "overwrite")
    assert read_target(spark, sink).count() == 3
    with pytest.raises(ConnectionError):
        check_target(spark, specs.SinkSpec("no_such_format", {"dbtable": "t"}))


def test_session_settings(spark):
    again = build_session("other", conf={"spark.sql.shuffle.partitions": "4"}, log_level="ERROR")
    assert again is spark or again.sparkContext is spark.sparkContext
    assert again.conf.get("spark.sql.session.timeZone") == "UTC"
