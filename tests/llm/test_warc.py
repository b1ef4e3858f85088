import base64
import hashlib
import time

import pytest
from helpers import clashing, ordered

from postflow.llm.warc import MAGIC, archive_round_trip, candidates, read_warc, reachable, split_header, write_warc
from postflow.session import run_folder

PAGES = "page_id long, url string, html string, lang string"
FAKE = "pay\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <x>\r\nContent-Length: 2\r\n\r\nab\r\n\r\nmore WARC/1.0\r\n"


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def plain(rows, least):
    first, out = {}, []
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    for i in order:
        page, _, html, _ = rows[i]
        size = len((html or "").encode())
        known = size >= least and first.setdefault(html or "", i) != i
        out.append((page, size, digest(html), "revisit" if known else "response", rows[first[html or ""]][0] if known else None))
    return out


@pytest.fixture(scope="module")
def rows():
    return [
        (3, "u", "x" * 5, "l"), (1, "a b\r\nc", "x" * 5, "l"), (2, None, None, None), (None, "z", "", "l"), (5, "q", FAKE, "l"), (5, "q", FAKE, "l"), (6, "m", MAGIC, "l"),
        (7, "e", "é😀", "l"), (8, "big", "<p>" + "long page " * 200_000, "l"), (9, "big", MAGIC * 3000, "l"), (10, "u", "x" * 5, "l"), (-4, "neg", "y", "l"),
    ]


@pytest.mark.parametrize(("least", "each", "compression"), [(0, 4, "gzip"), (0, 100, "none"), (6, 3, "none")])
def test_archives_read_back(spark, rows, least, each, compression):
    pages = spark.createDataFrame(rows, PAGES)
    got = archive_round_trip(clashing(pages), min_bytes=least, records_each=each, compression=compression).collect()
    assert ordered((r.page_id, r.payload_bytes, r.payload_digest, r.warc_type, r.refers_to) for r in got) == ordered(plain(rows, least))
    texts = [bytes(r.payload).decode() for r in got if r.warc_type == "response"]
    assert sorted(texts) == sorted({r[2] or "" for r in rows} if least == 0 else [bytes(r.payload).decode() for r in got if r.payload is not None])


def test_large_files_are_read_in_splits(spark, rows):
    folder = run_folder(spark, "warc-test")
    write_warc(spark.createDataFrame(rows, PAGES).coalesce(1), folder, records_each=100, compression="none")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        assert spark.read.option("lineSep", MAGIC).text(folder).rdd.getNumPartitions() > 5
        got = read_warc(spark, folder, bin_bytes=4096).collect()
        assert ordered((r.page_id, r.payload_digest) for r in got) == ordered((r[0], digest(r[2])) for r in rows)
        # offsets are those in the file
        data = b"".join(bytes(r.content) for r in spark.read.format("binaryFile").load(folder).collect())
        assert all(data[r.offset : r.offset + 10] == MAGIC.encode() for r in got)
        assert all(data[r.offset + r.span - 4 : r.offset + r.span] == b"\r\n\r\n" for r in got)
        assert candidates(spark, folder).where("offset >= 0").count() == data.count(MAGIC.encode())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_broken_ends_and_foreign_bytes(spark):
    whole = "WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <a>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    cut = "WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <b>\r\nContent-Length: 30\r\n\r\nabc"
    folder = run_folder(spark, "warc-broken")
    spark.createDataFrame([(whole + whole + cut,)], "value string").coalesce(1).write.text(folder)
    assert [(r.record_id, bytes(r.payload)) for r in read_warc(spark, folder).collect()] == [("<a>", b"abc")] * 2
    other = run_folder(spark, "warc-none")
    spark.createDataFrame([("no archive " + whole,)], "value string").coalesce(1).write.text(other)
    assert read_warc(spark, other).count() == 0  # the chain starts at the start of the file


def test_urls_of_any_length(spark):
    long = "data:text/html," + "a" * 100_000
    rows = [(1, "u", "one", "l"), (2, long, "two", "l"), (3, "v", "three", "l"), (4, long + ":b", FAKE, "l"), (5, "w", "two", "l"), (6, long, "three", "l")]
    got = archive_round_trip(spark.createDataFrame(rows, PAGES).coalesce(1)).collect()
    assert ordered((r.page_id, r.payload_bytes, r.payload_digest, r.warc_type, r.refers_to) for r in got) == ordered(plain(rows, 0))
    assert {r.page_id: r.uri for r in got} == {r[0]: r[1] for r in rows}


def test_long_stretches_take_linear_time():
    start = time.perf_counter()
    for text in (b"x" * 3_000_000, b"a:" + b"x" * 3_000_000, b"x\r" * 1_000_000, b"a:b\r\n" * 500_000):
        split_header(text + b"\r\n\r\n")
    assert time.perf_counter() - start < 10


def test_no_pages(spark):
    assert archive_round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_pointer_jumping_marks_chains_only(spark):
    chain = [("f", 7 * i, 7 * (i + 1)) for i in range(200)] + [("f", 3 + 7 * i, 3 + 7 * (i + 1)) for i in range(200)] + [("g", 5, 9), ("h", 0, None), ("i", 0, 4)]
    got = {(r.path, r.offset) for r in reachable(spark.createDataFrame(chain, "path string, offset long, next long")).collect()}
    assert got == {("f", 7 * i) for i in range(200)} | {("h", 0), ("i", 0)}


def test_headers_must_be_headers():
    assert split_header(b"A: b\r\nContent-Length: 3\r\n\r\nabc")[1:] == (27, 3)
    for bad in (b"", b"Content-Length: x\r\n\r\n", b"text\r\nContent-Length: 3\r\n\r\n", b"Content-Length: 3", b"A: b\r\n\r\n"):
        assert split_header(bad) is None
