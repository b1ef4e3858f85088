"""Ids of 64 bits stay as they are, beside NULLs too."""

import zlib

from pyspark.sql import functions as F

from postflow.llm.cuckoo import CuckooIndex, digests, exact_duplicates
from postflow.llm.language_model import score_texts
from postflow.llm.tiling import contaminated
from postflow.llm.warc import archive_round_trip

IDS = [2**53 + 1, 2**53 + 3, 2**63 - 1, -(2**63), None, 7]


def test_exact_duplicates(spark):
    docs = spark.createDataFrame([(i, f"text {k}") for k, i in enumerate(IDS)] + [(2**53 + 5, "text 0"), (2**53 + 7, "text 4")], "doc_id long, text string")
    found = {(r["id"], r["keep_id"]) for r in exact_duplicates(docs).collect()}
    assert found == {(i, i) for i in IDS if i is not None} | {(2**53 + 5, 2**53 + 1), (None, 2**53 + 7), (2**53 + 7, 2**53 + 7)}


def test_index_after_a_second_insert(spark):
    def rows(ids):
        docs = spark.createDataFrame([(i, f"text {i}", r) for r, i in ids], "doc_id long, text string, row_no long")
        return digests(docs, "doc_id", "text", "row_no", 3)

    index = CuckooIndex.empty(spark, 3).insert(rows(enumerate(IDS[:3]))).insert(rows(enumerate(IDS[3:], 3)))
    assert sorted(map(str, (r["id"] for r in index.entries().collect()))) == sorted(map(str, IDS))
    assert {r["row"] for r in index.entries().collect()} == set(range(6))


def test_language_model(spark):
    docs = spark.createDataFrame([(i, f"one two {k} three") for k, i in enumerate(IDS)], "doc_id long, text string")
    found = {r["id"]: r["held_out"] for r in score_texts(docs).collect()}
    assert found == {i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1 for i in IDS}


def test_decontamination(spark):
    text = "one two three four five six seven"
    docs = spark.createDataFrame([(i, text) for i in IDS], "doc_id long, text string")
    items = spark.createDataFrame([(2**53 + 9, text), (None, text)], "item_id long, text string")
    found = {(r["id"], r["item_id"]) for r in contaminated(docs, items).collect()}
    assert found == {(i, j) for i in IDS for j in (2**53 + 9, None)}


def test_archives(spark):
    pages = spark.createDataFrame([(i, f"http://a/{k}", f"<p>{k % 4}</p>") for k, i in enumerate(IDS)], "page_id long, url string, html string")
    found = {(r["page_id"], r["refers_to"]) for r in archive_round_trip(pages).collect()}
    # pages 0 and 4, 1 and 5 have equal payloads; the smallest id is the response and NULL comes last
    assert found == {(2**53 + 1, None), (2**53 + 3, 7), (2**63 - 1, None), (-(2**63), None), (None, 2**53 + 1), (7, None)}


def test_revisits_are_found_without_adaptive_plans(spark):
    pages = spark.createDataFrame([(i, f"http://a/{i}", "<p>same</p>" if i % 3 == 0 else f"<p>{i}</p>") for i in range(300)], "page_id long, url string, html string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = archive_round_trip(pages).withColumn("part", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {r["page_id"]: r["refers_to"] for r in found} == {i: 0 if i % 3 == 0 and i else None for i in range(300)}
    revisits = [r["part"] for r in found if r["refers_to"] is not None]
    assert len(set(revisits)) > 1  # all point at one response, and are not one task's rows
