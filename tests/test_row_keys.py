import datetime as dt
import decimal

import pytest
from conftest import values
from postflow.operators import incremental
from postflow.operators.compaction import BucketedTable
from postflow.operators.row_keys import KeyFilter, common_schema, row_digest
from postflow.session import scratch_folder, staging_scope
from postflow.sources.ranges import equal_depth_ranges
from postflow.sources.readers import read_source
from postflow.sources.specs import SinkSpec, SourceSpec, jdbc_table
from pyspark.sql import functions as F

NAN = float("nan")
EVERY_TYPE = (
    "k int, l long, f float, d double, dec decimal(10,2), b boolean, s string, bin binary, day date, at timestamp, plain timestamp_ntz, "
    "arr array<string>, st struct<x:int,y:string>, deep array<struct<x:double,y:array<int>>>"
)


def row(k, **other):
    base = {
        "k": k, "l": 5, "f": 0.5, "d": 1.5, "dec": decimal.Decimal("1.10"), "b": True, "s": "a", "bin": b"\x00\xff", "day": dt.date(2024, 1, 2),
        "at": dt.datetime(2024, 1, 2, 3, 4, 5, 123456), "plain": dt.datetime(2024, 1, 2, 3, 4, 5, 123456), "arr": ["a", None], "st": (1, "x"), "deep": [(1.0, [1, 2])],
    }
    return tuple({**base, **other}.values())


def test_rows_are_those_of_except_for_every_type(spark):
    changes = [
        {}, {"l": 6}, {"f": 0.25}, {"d": NAN}, {"d": -0.0}, {"dec": decimal.Decimal("1.11")}, {"b": False}, {"s": "a "}, {"s": ""}, {"s": None}, {"s": "~"},
        {"bin": b"\x00\xfe"}, {"bin": None}, {"day": dt.date(2024, 1, 3)}, {"at": dt.datetime(2024, 1, 2, 3, 4, 5, 123457)},
        {"plain": dt.datetime(2024, 1, 2, 3, 4, 5, 123999)}, {"arr": ["a"]}, {"arr": ["a", ""]}, {"arr": []}, {"arr": None}, {"st": (1, None)}, {"st": None},
        {"deep": [(1.0, [1]), (1.0, [2])]}, {"deep": [(-0.0, [1, 2])]}, {"deep": [(NAN, None)]},
    ]
    new = spark.createDataFrame([row(k, **c) for k, c in enumerate(changes)], EVERY_TYPE)
    held = spark.createDataFrame([row(k, **c) for k, c in enumerate(changes) if k % 3] + [row(0, l=None)], EVERY_TYPE)
    # signed zeros in whose place the other one is held
    held = held.withColumn("d", F.when(F.col("d") == 0, F.lit(0.0)).otherwise(F.col("d")))
    got = incremental.insert_missing_rows(new, held).select("k")
    assert values(got) == values(new.exceptAll(held).select("k").distinct()) == [(k,) for k in sorted(range(0, len(changes), 3), key=str)]


def test_microseconds_and_signed_zeros(spark):
    at = [dt.datetime(2024, 1, 1, 0, 0, 0, us) for us in (123456, 123999, 123000)]
    new = spark.createDataFrame([(at[0], 0.0), (at[1], -0.0), (at[2], -0.0), (at[2], NAN)], "at timestamp, v double")
    held = spark.createDataFrame([(at[2], 0.0), (at[2], NAN)], "at timestamp, v double")
    assert incremental.insert_missing_rows(new, held).count() == 2 == new.subtract(held).count()


def test_values_compare_in_the_common_type(spark):
    new = spark.createDataFrame([(1, 1.0), (2, 2.5)], "k int, v float")
    held = spark.createDataFrame([(1.0, 1), (2.5, 2**40)], "v double, k long")
    assert [(r.k, r.v) for r in incremental.insert_missing_rows(new, held).collect()] == [(2, 2.5)]
    assert common_schema(new, held)["k"].dataType.simpleString() == "bigint"


def test_values_that_run_into_each_other_differ(spark):
    df = spark.createDataFrame([("1:a", None, "1"), ("1", "a", "1"), (None, "1:a", "1"), ("~", "~", "~"), (None, None, None), ("", "", "")], "a string, b string, c string")
    assert df.select(row_digest(df.schema)).distinct().count() == 6
    maps = spark.createDataFrame([({"a": 1, "b": 2},), ({"b": 2, "a": 1},), ({"a": 1},)], "m map<string,int>")
    assert maps.select(row_digest(maps.schema)).distinct().count() == 2


# --- Bloom filter of keys

def test_no_key_is_missed_and_few_others_pass(spark):
    keys = spark.range(0, 40_000, 2).select(F.col("id").alias("k"), F.col("id").cast("string").alias("s"))
    held = KeyFilter.of(keys, 20_000)
    assert held.n_blocks == 10
    all_keys = spark.range(40_000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("s"), F.lit("x" * 10).alias("payload"))
    passed = held.passing(all_keys)
    assert passed.columns == all_keys.columns
    odd, even = passed.where("k % 2 = 1").count(), passed.where("k % 2 = 0").count()
    assert even == 20_000 and odd < 20_000 * 0.01
    plan = passed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_null_keys_and_other_types(spark):
    keys = spark.createDataFrame([(None, 1), ("a", None)], "s string, n int")
    target = spark.createDataFrame([(None, 1), ("a", None), ("b", 2)], "s string, n long")
    held = KeyFilter.of(keys, 2, common_schema(keys, target))
    assert {tuple(r) for r in held.passing(target).collect()} >= {(None, 1), ("a", None)}
    assert KeyFilter.of(keys.limit(0), 0).passing(target).count() == 0


@pytest.mark.parametrize("null_keys", ["skip", "insert"])
def test_large_loads_shuffle_little_of_the_target(spark, tmp_path, null_keys):
    sink = SinkSpec("parquet", path=str(tmp_path / "t"))
    spark.range(200_000).select(F.when(F.col("id") != 5, F.col("id")).alias("k")).write.parquet(sink.path)
    incoming = spark.range(199_000, 201_000).select(F.when(F.col("id") != 199_500, F.col("id")).alias("k"))
    held = KeyFilter.of(incoming, 2000).passing(spark.read.parquet(sink.path))
    assert 999 <= held.count() <= 2 * 1000
    report = incremental.append_missing(incoming, sink, ["k"], key_rows=1, null_keys=null_keys)
    assert report.n_missing == 1000
    assert spark.read.parquet(sink.path).count() == 201_000


# --- ranges of equal depth

def sizes(df, ranges):
    return [df.where(r).count() for r in ranges]


@pytest.mark.parametrize("kind", ["long", "double", "date", "timestamp"])
def test_ranges_are_disjoint_cover_all_and_are_alike(spark, kind):
    skewed = spark.range(20_000).select(F.col("id"), F.floor(F.exp(F.rand(3) * 12) * 1000).alias("v"))
    key = {"long": F.col("v"), "double": F.col("v") / 7, "date": F.date_add(F.lit("2000-01-01"), (F.col("v") / 20_000).cast("int")), "timestamp": F.timestamp_micros(F.col("v") * 1001)}[kind]
    df = skewed.select("id", F.when(F.col("id") % 10 != 0, key).alias("k")).cache()
    ranges = equal_depth_ranges(df, "k", 8)
    found = sizes(df, ranges)
    assert sum(found) == 20_000 and found[-1] == 2000
    if kind != "date":  # many rows share a day
        assert len(ranges) == 9 and max(found[:-1]) <= 1.2 * min(found[:-1])
    df.unpersist()


def test_ranges_hold_for_rows_outside_the_sample(spark):
    ranges = equal_depth_ranges(spark.range(100, 200), "id", 4)
    df = spark.range(-50, 400)
    assert sum(sizes(df, ranges)) == 450
    assert equal_depth_ranges(spark.range(0), "id", 4) == ["id IS NOT NULL", "id IS NULL"]
    assert equal_depth_ranges(spark.range(9), "id", 1) == ["id IS NOT NULL", "id IS NULL"]
    with pytest.raises(ValueError):
        equal_depth_ranges(spark.range(9), "id", 0)
    same = spark.createDataFrame([(1,)] * 50 + [(None,)], "id int")
    assert sum(sizes(same, equal_depth_ranges(same, "id", 4))) == 51


def test_reads_in_ranges_push_their_conditions_down(spark, tmp_path):
    spark.range(1000).withColumn("x", F.lit("y")).write.parquet(str(tmp_path / "t"))
    ranges = tuple(equal_depth_ranges(spark.range(1000), "id", 4))
    df = read_source(spark, SourceSpec("parquet", path=str(tmp_path / "t"), columns=("x",), predicates=ranges))
    assert df.columns == ["x"] and df.count() == 1000
    assert "PushedFilters: [IsNotNull(id)" in df._jdf.queryExecution().executedPlan().toString()
    spec = jdbc_table("jdbc:x", "t", "u", "p", "d", predicates=ranges)
    assert spec.predicates == ranges
    with pytest.raises(ValueError, match="either"):
        jdbc_table("jdbc:x", "t", "u", "p", "d", partition_column="id", lower=0, upper=9, partitions=4, predicates=ranges)


# --- compaction by bucket

def test_runs_rewrite_only_changed_buckets(spark, tmp_path):
    store = BucketedTable(spark, str(tmp_path / "t"), n_buckets=32)
    rows = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") % 7).cast("double").alias("v"))
    first = store.add(rows.union(rows))
    assert (first.version, first.n_incoming, first.n_added, len(first.rewritten)) == (1, 4000, 2000, 32)
    before = store.manifest()[1]
    new = spark.range(2000, 2003).select(F.col("id").alias("k"), F.lit(0.0).alias("v"))
    second = store.add(rows.limit(1500).union(new))
    assert second.n_added == 3 and 1 <= len(second.rewritten) <= 3
    after = store.manifest()[1]
    assert {b for b in after if after[b] != before[b]} == set(second.rewritten)
    assert values(store.read()) == values(rows.union(new))
    third = store.add(rows.withColumn("v", F.when(F.col("v") == 0, -0.0).otherwise(F.col("v"))))
    assert (third.version, third.n_added, third.rewritten) == (2, 0, ())
    assert len(store.vacuum()) == 0 and store.read().count() == 2003  # the first run still holds most buckets


def test_readers_keep_what_they_began_with(spark, tmp_path):
    store = BucketedTable(spark, str(tmp_path / "t"), n_buckets=1)
    store.add(spark.range(10).toDF("k"))
    seen = store.read()
    store.add(spark.range(20).toDF("k"))
    assert seen.count() == 10 and store.read().count() == 20
    assert len(store.vacuum()) == 1 and store.read().count() == 20
    with pytest.raises(RuntimeError, match="another writer"):
        store._commit(2, {}, "`k` bigint")
    with pytest.raises(ValueError, match="columns"):
        store.add(spark.range(3).toDF("other"))
    with pytest.raises(ValueError, match="buckets"):
        BucketedTable(spark, str(tmp_path / "t"), n_buckets=2).read()


def test_empty_tables(spark, tmp_path):
    store = BucketedTable(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        store.read()
    assert store.add(spark.range(0).toDF("k")).version == 1
    assert store.read().count() == 0 and store.add(spark.range(2).toDF("k")).n_added == 2


# --- scopes

def test_a_scope_deletes_what_is_staged_in_it(spark):
    import os

    with staging_scope():
        folder = scratch_folder(spark, "inside")
        spark.range(1).write.parquet(folder)
        with staging_scope():
            inner = scratch_folder(spark, "inner")
            spark.range(1).write.parquet(inner)
        assert os.path.exists(folder) and not os.path.exists(inner)
    assert not os.path.exists(folder)


def test_a_bucketed_table_holds_the_rows_alone(spark, tmp_path):
    store = BucketedTable(spark, str(tmp_path / "t"), n_buckets=2)
    for n in (10, 20, 20):
        store.add(spark.range(n).toDF("k"))
    folders = [f"{store.folder}/data/{run}/_bucket={b}" for b, run in store.manifest()[1].items()]
    assert spark.read.parquet(*folders).columns == ["k"] and values(store.read()) == [(k,) for k in sorted(range(20), key=str)]
