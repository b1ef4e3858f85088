import pytest
from conftest import values
from postflow.operators import dedupe, incremental, quality
from postflow.session import shared_folder
from postflow.sources.specs import SinkSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

KV = "url string, org_id int, v string"


@pytest.fixture
def incoming(spark):
    rows = [("a", 1, "x"), ("a", 2, "x"), ("b", 1, "x"), ("b", 1, "y"), (None, 1, "n"), ("c", None, "n")]
    return spark.createDataFrame(rows, KV)


@pytest.fixture
def target(spark):
    return spark.createDataFrame([("a", 1, "old"), (None, 1, "old"), (None, 1, "old")], KV)


def test_missing_by_key(incoming, target):
    got = values(incremental.insert_missing(incoming, target, ["url", "org_id"]))
    assert got == [("a", 2, "x"), ("b", 1, "x"), ("b", 1, "y")]


def test_missing_with_null_keys_as_values(incoming, target):
    got = values(incremental.insert_missing(incoming, target, ["url", "org_id"], null_keys="insert"))
    assert got == [("a", 2, "x"), ("b", 1, "x"), ("b", 1, "y"), ("c", None, "n")]
    with pytest.raises(ValueError):
        incremental.insert_missing(incoming, target, ["url"], null_keys="?")


def test_missing_whole_rows(spark):
    new = spark.createDataFrame([(1, None), (1, None), (2, "b"), (3, "c")], "k int, v string")
    held = spark.createDataFrame([("b", 2, 9), (None, 7, 8)], "v string, k int, sid int")
    got = {(r.k, r.v) for r in incremental.insert_missing_rows(new, held, surrogate="sid").collect()}
    assert got == {(1, None), (3, "c")}
    assert incremental.insert_missing_rows(new, held, surrogate="sid").count() == 2


def test_append_missing_twice_adds_nothing(spark, incoming, tmp_path):
    sink = SinkSpec("parquet", path=str(tmp_path / "t"))
    first = incremental.append_missing(incoming.filter("url = 'a'"), sink, ["url", "org_id"])
    assert (first.n_target, first.n_incoming, first.n_missing, first.counts_equal) == (0, 2, 2, False)
    second = incremental.append_missing(incoming, sink, ["url", "org_id"], preview=1)
    assert (second.n_target, second.n_incoming, second.n_missing) == (2, 6, 2)
    third = incremental.append_missing(incoming, sink, ["url", "org_id"])
    assert third.n_missing == 0
    assert spark.read.parquet(sink.path).count() == 4


def test_append_missing_large_keys_take_the_shuffled_way(spark, incoming, tmp_path):
    sink = SinkSpec("parquet", path=str(tmp_path / "t"))
    incremental.append_missing(incoming.filter("url = 'a'"), sink, ["url", "org_id"])
    assert incremental.append_missing(incoming, sink, ["url", "org_id"], key_rows=1).n_missing == 2


def test_append_missing_writes_incoming_rows_to_no_second_place(spark, incoming, tmp_path, monkeypatch):
    sink, widths, of = SinkSpec("parquet", path=str(tmp_path / "t")), [], incremental.Staged.of
    monkeypatch.setattr(incremental.Staged, "of", lambda df, sized=(): widths.append(len(df.columns)) or of(df, sized))
    incremental.append_missing(incoming.filter("url = 'a'"), sink, ["url", "org_id"])
    assert incremental.append_missing(incoming, sink, ["url", "org_id"]).n_missing == 2
    assert widths == [len(incoming.columns)] * 2 + [2]  # of the second load the shared keys


def test_append_missing_rows(spark, tmp_path):
    sink = SinkSpec("parquet", path=str(tmp_path / "t"))
    new = spark.createDataFrame([(1, None), (1, None), (2, "b")], "k int, v string")
    incremental.append_missing(new, sink)
    assert incremental.append_missing(new.union(spark.createDataFrame([(3, "c")], new.schema)), sink).n_missing == 1


def test_random_values_are_drawn_once(spark, tmp_path):
    """What is counted is what is written."""
    sink = SinkSpec("parquet", path=str(tmp_path / "t"))
    rows = spark.range(1000).filter(F.rand() < 0.5).withColumn("k", F.col("id"))
    report = incremental.append_missing(rows, sink, ["k"])
    assert spark.read.parquet(sink.path).count() == report.n_missing == report.n_incoming


def test_reconcile(incoming, target):
    row = incremental.reconcile(incoming, target, incremental.insert_missing(incoming, target, ["url", "org_id"])).first()
    assert tuple(row) == (3, 6, 3, False)


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == shared_folder(spark)


def test_keep_latest_is_deterministic(spark):
    rows = [("u", 1, "5", "a"), ("u", 2, "1", "b"), ("u", 2, "3", "c"), ("u", None, "9", "d"), (None, 1, "1", "e"), (None, 2, "1", "f")]
    df = spark.createDataFrame(rows, "url string, crawl_time long, id string, v string")
    assert values(dedupe.latest_crawl(df, ["url"]).select("url", "v")) == [(None, "f"), ("u", "c")]
    same = df.withColumns({"crawl_time": F.lit(1), "id": F.lit("1")})
    one = values(dedupe.latest_crawl(same, ["url"]))
    assert one == values(dedupe.latest_crawl(same.repartition(7).orderBy("v"), ["url"]))


def test_keep_latest_reduces_before_the_shuffle(spark):
    df = spark.range(1000).select(F.concat(F.lit("hot"), F.floor(F.col("id") / 1000)).alias("url"), F.col("id").alias("crawl_time"))
    plan = dedupe.latest_crawl(df, ["url"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_collapse_orgs(spark):
    rows = [("p", "c", 3, 1, "a"), ("p", "c", 1, 2, "b"), ("p", "c", 3, 0, "z"), ("q", "c", None, 5, "d")]
    df = spark.createDataFrame(rows, "post_id string, content string, org_id int, crawl_time long, url string")
    got = {r.post_id: (r.org_ids, r.crawl_time, r.url) for r in dedupe.collapse_orgs(df).collect()}
    assert got == {"p": ([1, 3], 2, "b"), "q": ([], 5, "d")}


def test_posts_that_differ_by_a_microsecond_stay_apart(spark):
    rows = [("2024-01-01 00:00:00.123456", 0.0, 1, 1), ("2024-01-01 00:00:00.123999", 0.0, 2, 1), ("2024-01-01 00:00:00.123999", -0.0, 3, 1), (None, None, 4, 1)]
    df = spark.createDataFrame(rows, "at string, v double, org_id int, crawl_time long").withColumn("at", F.to_timestamp("at"))
    assert sorted(r.org_ids for r in dedupe.collapse_orgs(df, ("at", "v")).collect()) == [[1], [2, 3], [4]]


def test_newest_is_a_total_order(spark):
    df = spark.createDataFrame([(1, 5), (2, 7), (3, 7), (4, 1)], "k int, t int")
    assert [r.k for r in dedupe.newest(df, "t", 3, ["k"]).collect()] == [2, 3, 1]


# --- quality

def test_check_and_split(spark):
    rows = [("a", "u", 1, 5, "x" * 500), ("a", None, 1, 40000, "x" * 501), (None, "u", None, None, None)]
    df = spark.createDataFrame(rows, "post_id string, url string, org_id int, doc_type int, title string")
    bad = {(r.rule, r.column): r.n_bad for r in quality.check(df, quality.PUBLISH_CONTRACT).collect() if r.n_bad}
    assert bad == {
        ("not_null", "post_id"): 1, ("not_null", "url"): 1, ("not_null", "org_id"): 1,
        ("smallint", "doc_type"): 1, ("max_length", "title"): 1, ("primary_key", "post_id"): 1,
    }
    valid, invalid = quality.split(df, quality.PUBLISH_CONTRACT)
    assert valid.count() == 1
    assert sorted(len(r.violations) for r in invalid.collect()) == [2, 3]


def test_schema_faults(spark):
    df = spark.createDataFrame([("a", 1)], "post_id string, org_id long")
    faults = quality.schema_faults(df, quality.STORE_CONTRACT)
    assert ("type", "org_id") in faults and ("type", "post_id") not in faults
    assert not [c for rule, c in faults if rule == "required"]  # only these two must be there
    assert ("required", "org_id") in quality.schema_faults(df.drop("org_id"), quality.STORE_CONTRACT)
    rules = {(r.rule, r.column): r.n_bad for r in quality.check(df, quality.STORE_CONTRACT).collect()}
    assert rules["type", "org_id"] == 1 and rules["not_null", "post_id"] == 0


def test_defaults(spark):
    df = spark.createDataFrame([(None,), (2,)], T.StructType([T.StructField("sentiment", T.IntegerType())]))
    got = values(quality.apply_defaults(df, quality.PUBLISH_CONTRACT).select("sentiment", "is_sent", "spam"))
    assert got == [(0, 0, 0), (2, 0, 0)]


def test_require_table(spark):
    spark.range(3).createOrReplaceTempView("known")
    quality.require_table(spark, "known", F.col("id") == 2)
    with pytest.raises(ValueError, match="not found"):
        quality.require_table(spark, "known", F.col("id") == 9)
    with pytest.raises(ValueError, match="missing table"):
        quality.require_table(spark, "unknown_table")
