"""Streams with late rows, hot keys and replays."""

import os

import pytest
from conftest import values
from postflow.schemas import PROPERTY_EVENT, table
from postflow.session import scratch_folder
from postflow.sources import specs
from postflow.sources.readers import read_stream
from postflow.sources.writers import write_stream
from postflow.streaming import jobs
from postflow.streaming.ledger import EpochLedger
from test_jobs import sold


def drain(stream, tmp_path, name, each=None):
    spec = specs.StreamSinkSpec("parquet", str(tmp_path / f"{name}-state"), path=str(tmp_path / name), available_now=True)
    query = write_stream(stream, spec, each)
    query.awaitTermination()
    return spec.path, query


def staged(spark):
    """Folders that are staged at the moment."""
    root = os.path.dirname(scratch_folder(spark, "none").removeprefix("file:"))
    return set(os.listdir(root))


def events_in(spark, tmp_path, parts):
    """A stream that delivers one part after the other, in batches of their own."""
    for rows in parts:
        sold(spark, rows).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = specs.files("parquet", str(tmp_path / "in"), PROPERTY_EVENT, maxFilesPerTrigger="1")
    return read_stream(spark, source)


def test_a_late_row_does_not_change_the_previous_window(spark, tmp_path):
    # 5 in the first minute, 9 in the second; an 8 of the first minute comes when that is out (rows are late against the
    # watermark of the batch before)
    stream = events_in(spark, tmp_path, [[(1, 0, 5), (1, 700, 5)], [(1, 701, 5)], [(1, 10, 8), (1, 70, 9), (1, 1400, 5)], [(1, 2100, 5)]])
    rows = spark.read.parquet(drain(jobs.windowed_delta(stream), tmp_path, "delta")[0])
    found = {r["time_window"]["start"].minute: (r["total_sales"], r["prev_total_sales"], r["quantity"]) for r in rows.collect()}
    assert found[0] == (5, None, 0) and found[1] == (9, 5, 4)


def test_previous_window_emitted_in_an_earlier_batch(spark, tmp_path):
    stream = events_in(spark, tmp_path, [[(1, 0, 3), (1, 61, 4)], [(1, 660, 1)], [(1, 125, 9)], [(1, 3000, 1)]])
    rows = spark.read.parquet(drain(jobs.windowed_delta(stream), tmp_path, "delta")[0])
    found = {r["time_window"]["start"].minute: (r["total_sales"], r["prev_total_sales"]) for r in rows.collect()}
    assert found == {0: (3, None), 1: (4, 3), 2: (9, 4), 11: (1, None)}


def test_a_hot_product_fills_all_state_partitions(spark, tmp_path):
    rows = [(1, s % 50, s) for s in range(400)] + [(2 + s, s % 50, 1) for s in range(400)]
    stream = events_in(spark, tmp_path, [rows])  # no window is closed: all events wait in the state of the join
    seen = []

    def each(batch, epoch):
        seen.append(batch.count())

    _, query = drain(jobs.property_sales_stream(stream, salts=16), tmp_path, "sales", each)
    state = f"{tmp_path}/sales-state"
    metadata = spark.read.format("state-metadata").load(state).where("operatorName = 'symmetricHashJoin'").select("operatorId").distinct().collect()
    side = spark.read.format("statestore").option("operatorId", metadata[0][0]).option("joinSide", "left").load(state)
    waiting = side.where("value.product_id = 1").groupBy("partition_id").count().collect()
    per_part = [r["count"] for r in waiting]
    assert sum(per_part) == 400 and len(per_part) == 4 and max(per_part) <= 200  # all state partitions, none with most of them


def test_salted_join_equals_the_plain_one(spark, tmp_path):
    rows = [(1, s, s) for s in range(0, 300, 7)] + [(2, s, 2 * s) for s in range(0, 300, 11)] + [(3, 4000, 1)]
    stream = events_in(spark, tmp_path, [rows])
    one, many = (values(spark.read.parquet(drain(jobs.property_sales_stream(stream, salts=n), tmp_path, f"s{n}")[0])) for n in (1, 16))
    assert one == many and len(one) == len(rows) - 1


def test_ledger_skips_what_is_committed(spark, tmp_path):
    spark.range(6).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = read_stream(spark, specs.files("parquet", str(tmp_path / "in"), table("id BIGINT")))
    ledger = EpochLedger(str(tmp_path / "ledger"), "ids")
    plain, keyed = specs.SinkSpec("parquet", path=str(tmp_path / "plain")), specs.SinkSpec("parquet", path=str(tmp_path / "keyed"))
    drain(stream, tmp_path, "a", jobs.append_each_batch(plain, ledger=ledger))
    drain(stream, tmp_path, "b", jobs.append_each_batch(plain, ledger=ledger))  # a replay: epoch 0 once more
    assert spark.read.parquet(plain.path).count() == 6
    other = EpochLedger(str(tmp_path / "ledger"), "keyed")
    drain(stream, tmp_path, "c", jobs.append_missing_each_batch(keyed, ["id"], ledger=other))
    entries = [tuple(r) for r in other.entries(spark).collect()]
    assert entries == [("keyed", 0, 6)] and other.committed(spark, 0) and not other.committed(spark, 1)

    def read_target_no_more(*_):
        raise AssertionError("the target was read")

    jobs_append, jobs.append_missing = jobs.append_missing, read_target_no_more
    try:
        drain(stream, tmp_path, "d", jobs.append_missing_each_batch(keyed, ["id"], ledger=other))
    finally:
        jobs.append_missing = jobs_append


def test_a_failed_batch_is_not_committed(spark, tmp_path):
    ledger = EpochLedger(str(tmp_path / "ledger"), "x")

    def fails(batch, epoch):
        raise RuntimeError("no")

    with pytest.raises(RuntimeError):
        ledger.guarded(fails)(spark.range(1), 3)
    assert not ledger.committed(spark, 3)
    ledger.guarded(lambda batch, epoch: 7)(spark.range(1), 3)
    ledger.commit(spark, 3, 7)  # a second writer of the same entry changes nothing
    assert [tuple(r) for r in ledger.entries(spark).collect()] == [("x", 3, 7)]


def test_batches_leave_nothing_staged(spark, tmp_path):
    spark.range(4).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = read_stream(spark, specs.files("parquet", str(tmp_path / "in"), table("id BIGINT")))
    before = staged(spark)
    sink = specs.SinkSpec("parquet", path=str(tmp_path / "t"))
    drain(stream, tmp_path, "a", jobs.append_missing_each_batch(sink, ["id"], key_rows=1))
    drain(stream, tmp_path, "b", jobs.append_missing_each_batch(sink, ["id"], key_rows=1))
    assert staged(spark) == before and spark.read.parquet(sink.path).count() == 4



@pytest.mark.parametrize("way", ["automaton", "store"])
def test_an_unchanged_dictionary_is_prepared_once(spark, tmp_path, way):
    from postflow.operators.matching import DictionaryCache, MatchLimits
    from postflow.schemas import ORG_DICT

    limits = MatchLimits(literal_terms=0) if way == "automaton" else MatchLimits(literal_terms=0, automaton_terms=0)
    state = {"words": ["alpha"]}

    def read_orgs():
        return spark.createDataFrame([{"code": "A", "org_id": 1, "keywords": state["words"], "spamwords": ["junk"]}], ORG_DICT)

    cache = DictionaryCache()
    sink = specs.SinkSpec("parquet", path=str(tmp_path / "out"))
    run = jobs.classify_each_batch(read_orgs, sink, limits=limits, cache=cache)
    sizes, prepared = [], []
    for epoch, text in enumerate(["alpha one", "alpha two", "beta junk", "beta alpha"]):
        if epoch == 3:
            state["words"] = ["beta"]
        run(spark.createDataFrame([(str(epoch), text)], "post_id string, content string"), epoch)
        sizes.append(len(staged(spark)))
        prepared.append(cache.prepared)
    assert sorted((r["post_id"], r["org_id"]) for r in spark.read.parquet(sink.path).collect()) == [("0", 1), ("1", 1), ("3", 1)]
    assert prepared[0] == prepared[1] == prepared[2] and prepared[3] == 2 * prepared[0]
    assert sizes[1] == sizes[2] == sizes[3]
