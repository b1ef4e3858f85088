"""WARC archives: writing with revisit records, and reading with boundary-chain verification."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from postflow.llm.common import stage
from postflow.operators.skew import join_isolated
from postflow.session import scratch_folder

# fixed values of the format
MAGIC = "WARC/1.0\r\n"
RECORD_END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

_HEADER = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)\r\n")

#: What a record's header and block say; ``payload_at`` is where the payload starts behind the magic (NULL in revisits).
FIELDS = "warc_type string, record_id string, refers_to_id string, uri string, page_id long, payload_bytes long, payload_digest string, payload_at int"


def sha1_base32(sha: Column) -> Column:
    """Bare upper-case base32 of a SHA-1 in hex: eight times 20 bits, four letters each."""
    groups = [F.conv(F.substring(sha, 5 * g + 1, 5), 16, 10).cast("int") for g in range(8)]
    letters = [
        F.substring(F.lit(BASE32), F.shiftright(group, shift).bitwiseAND(31) + 1, F.lit(1)) for group in groups for shift in (15, 10, 5, 0)
    ]
    return F.concat(*letters)


def _record_id(*key: Column) -> Column:
    """A record id that a retried task builds again: a UUID from a hash of the key."""
    h = F.md5(F.concat_ws(":", *[F.coalesce(k.cast("string"), F.lit("none")) for k in key]).cast("binary"))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def plan_records(pages: DataFrame, id_col: str, url_col: str, html_col: str, min_bytes: int) -> DataFrame:
    """(page_id, uri, html, n_bytes, sha, copy_no, first_id, revisit): which pages revisit which.

    The first page with a payload is that with the smallest id, NULL last; of rows with one id and payload the one
    with ``copy_no`` 1. Ids and digests alone are grouped (a payload that a third of all pages share is reduced before the
    shuffle); payloads stay where they are unless the revisits are too many to be sent to them. Only rows with
    one id and payload are brought together, to number them. All follows from the rows themselves, so
    that a retried task decides alike.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    source = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.regexp_replace(F.col(url_col).cast("string"), r"[\x00-\x20\x7f]", "%20").alias("uri"),
        html.alias("html"), F.octet_length(html).cast("long").alias("n_bytes"), F.sha1(html.cast("binary")).alias("sha"),
        F.col(id_col).isNull().alias("none"), F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("number"),
    )
    key = ["none", "number", "sha"]
    pairs = stage(source.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")), "payloads")
    first = pairs.groupBy("sha").agg(F.min(F.struct("none", "number")).alias("first"))
    odd = join_isolated(pairs, first, ["sha"]).where((F.col("rows") > 1) | (F.struct("none", "number") != F.col("first")))
    odd = stage(odd.select(*key, "rows", (F.struct("none", "number") != F.col("first")).alias("later"), F.when(~F.col("first.none"), F.col("first.number")).alias("first_id")), "odd")
    joined = source.join(odd, key, "left")
    single = joined.where("rows is null or rows = 1").withColumn("copy_no", F.lit(1))
    order = Window.partitionBy(*key).orderBy(F.xxhash64("uri"))
    several = source.join(odd.where("rows > 1"), key).withColumn("copy_no", F.row_number().over(order))
    known = single.unionByName(several).withColumn("revisit", (F.coalesce("later", F.lit(False)) | (F.col("copy_no") > 1)) & (F.col("n_bytes") >= min_bytes))
    return known.withColumn("first_id", F.when(F.col("rows").isNull(), F.col("page_id")).otherwise(F.col("first_id"))).drop("none", "number", "rows", "later")


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for NULL."""
    return F.coalesce(F.concat(F.lit(name + ": "), value, F.lit("\r\n")), F.lit(""))


def record_text(date: str) -> Column:
    """A whole record but for its end mark, from the columns of ``plan_records``."""
    revisit, digest = F.col("revisit"), sha1_base32(F.col("sha"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n_bytes").cast("string"), F.lit("\r\n\r\n"),
        F.when(revisit, F.lit("")).otherwise(F.col("html")),
    )
    own, other = _record_id(F.col("page_id"), F.col("sha"), F.col("copy_no")), _record_id(F.col("first_id"), F.col("sha"), F.lit(1))
    return F.concat(
        F.lit(MAGIC),
        F.when(revisit, F.lit("WARC-Type: revisit\r\n")).otherwise(F.lit("WARC-Type: response\r\n")),
        _line("WARC-Record-ID", own),
        F.lit(f"WARC-Date: {date}\r\n"),
        _line("WARC-Target-URI", F.col("uri")),
        F.when(revisit, F.concat(_line("WARC-Refers-To", other), F.lit(f"WARC-Profile: {REVISIT_PROFILE}\r\n"))).otherwise(F.lit("")),
        _line("X-Page-ID", F.col("page_id").cast("string")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _line("Content-Length", F.octet_length(http).cast("string")),
        F.lit("\r\n"),
        http,
    )


def write_warc(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    *, min_bytes: int = 0, records_each: int = 8192, date: str = "2000-01-01T00:00:00Z", compression: str = "gzip",
) -> None:
    """Write one record per row of ``pages`` as WARC files below ``folder``.

    A row whose payload (the html in UTF-8; NULL is empty) equals that of an earlier page, by id, becomes a
    revisit of it if it has at least ``min_bytes``; all else are responses. Spark's own text writer puts the
    records down, with the record end mark as line end, so failed tasks leave no half files. A NULL url
    leaves its header line out, as does a NULL id; white space and control characters in urls are
    escaped. An empty table gives a folder without records.
    """
    records = plan_records(pages, id_col, url_col, html_col, min_bytes).select(record_text(date).alias("value"))
    records.write.option("lineSep", RECORD_END).option("maxRecordsPerFile", records_each).option("compression", compression).text(folder)


def parse_record(head: dict[bytes, bytes], data: bytes, skip: int, length: int) -> tuple:
    """FIELDS of a record from its header lines and its block, which is ``data[skip : skip + length]``."""
    text = lambda name: head[name].decode("utf-8", "replace") if name in head else None
    kind, at, told = text(b"warc-type"), skip, None
    if head.get(b"content-type", b"").startswith(b"application/http"):
        at = data.find(b"\r\n\r\n", skip, skip + length) + 4
        at = skip + length if at < 4 else at
        http = data[skip : at - 2]
        told = next((v for k, v in _HEADER.findall(http) if k.lower() == b"content-length"), None)
    page = text(b"x-page-id")
    if kind == "revisit":  # its payload is elsewhere; what the headers say of it stands
        digest = (text(b"warc-payload-digest") or "").removeprefix("sha1:") or None
        size, at = (int(told) if told and told.isdigit() else None), None
    else:
        payload = data[at : skip + length]
        digest, size = base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)
    return kind, text(b"warc-record-id"), text(b"warc-refers-to"), text(b"warc-target-uri"), int(page) if page and re.fullmatch(r"-?\d+", page) else None, size, digest, at


def split_header(data: bytes) -> tuple[dict[bytes, bytes], int, int] | None:
    """(header lines, header bytes, content length) of what follows a magic, or None if it is no header.

    A header may be of any length (it holds the whole url); it is looked at line by line, in linear time.
    """
    end = data.find(b"\r\n\r\n")
    if end < 0:
        return None
    head = {}
    for line in data[:end].split(b"\r\n"):
        colon = line.find(b":")
        if colon < 1 or b"\r" in line or b"\n" in line:
            return None
        head[line[:colon].strip().lower()] = line[colon + 1 :].strip()
    length = head.get(b"content-length", b"")
    return (head, end + 4, int(length)) if length.isdigit() else None


_NONE = (None,) * 8
#: Whole numbers that may be missing; a plain pandas column would round them to 53 bits.
_NULLABLE = {"span": "Int64", "page_id": "Int64", "payload_bytes": "Int64", "payload_at": "Int32"}


def _framed(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    """Rows of the named columns and FIELDS."""
    names = [*names, *[f.split()[0] for f in FIELDS.split(", ")]]
    columns = zip(*rows) if rows else [()] * len(names)
    return pd.DataFrame({n: pd.array(list(c), _NULLABLE[n]) if n in _NULLABLE else pd.Series(c, dtype=object) for n, c in zip(names, columns)})


def _candidates(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every stretch that follows a magic, with its place in its split and, if it starts with a header, the
    bytes from the magic to the successor; parsed if the record ends within the stretch."""
    place, at = None, 0
    for frame in frames:
        out = []
        for path, start, data in zip(frame["path"], frame["start"], frame["value"]):
            if (path, start) != place:
                place, at = (path, start), 0
            found = split_header(data)
            span, fields, whole = None, _NONE, False
            if found:
                head, skip, length = found
                span = len(MAGIC) + skip + length + len(RECORD_END)
                whole = len(data) == skip + length + len(RECORD_END)
                if whole and data.endswith(RECORD_END.encode()):
                    fields = parse_record(head, data, skip, length)
            out.append((path, start, at, len(data), span, whole, data, *fields))
            at += len(data) + len(MAGIC)
        yield _framed(out, ["path", "start", "at", "size", "span", "whole", "raw"])


def candidates(spark: SparkSession, folder: str) -> DataFrame:
    """All stretches between magics in the archives of a folder, with their byte offset in their file.

    The reader takes the magic as line end: large files are split, and every split yields its stretches in
    order. A split knows offsets from its own start only; the sizes of the splits before it are added (one row per
    split). Offsets count uncompressed bytes. The offset is that of the magic; what stands before the first
    magic has offset -len(magic).
    """
    lines = spark.read.option("lineSep", MAGIC).text(folder)
    source = lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("value"))
    found = stage(source.mapInPandas(_candidates, f"path string, start long, at long, size long, span long, whole boolean, raw binary, {FIELDS}"), "stretches")
    size = found.groupBy("path", "start").agg(F.sum(F.col("size") + len(MAGIC)).alias("bytes"))
    before = F.sum("bytes").over(Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    base = stage(size.select("path", "start", F.coalesce(before, F.lit(0)).alias("base")), "splits")
    return found.join(base, ["path", "start"]).withColumn("offset", F.col("base") + F.col("at") - len(MAGIC)).drop("base", "at", "start")


def reachable(links: DataFrame) -> DataFrame:
    """(path, offset, next) -> (path, offset) of what a chain from offset 0 of its file reaches.

    Pointer jumping: in each round every reached record marks its pointer's target, and every pointer is
    replaced by its target's pointer, so the marked stretch doubles: as many rounds as the logarithm of the longest
    chain, each over narrow rows, written to the shared folder.
    """
    state = stage(links.select("path", "offset", F.col("next").alias("jump"), (F.col("offset") == 0).alias("reached")), "chain")
    n = state.where("reached").count()
    while n:
        aim = state.select(F.col("path"), F.col("offset").alias("jump"), F.col("jump").alias("next_jump"))
        marks = state.where("reached and jump is not null").select("path", F.col("jump").alias("offset")).distinct().withColumn("mark", F.lit(True))
        state = stage(
            state.join(aim, ["path", "jump"], "left")
            .join(marks, ["path", "offset"], "left")
            .select("path", "offset", F.col("next_jump").alias("jump"), (F.col("reached") | F.coalesce("mark", F.lit(False))).alias("reached")),
            "chain",
        )
        before, n = n, state.where("reached").count()
        if n == before:
            break
    return state.where("reached").select("path", "offset")


def _assemble(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Records whose block holds the magic, put together from their stretches."""
    for frame in frames:
        out = []
        for path, offset, span, parts in zip(frame["path"], frame["offset"], frame["span"], frame["parts"]):
            data = MAGIC.encode().join(bytes(p["raw"]) for p in sorted(parts, key=lambda p: p["at"]))
            head, skip, length = split_header(data)
            complete = data[skip + length : skip + length + len(RECORD_END)] == RECORD_END.encode()
            fields = parse_record(head, data, skip, length) if complete else _NONE
            out.append((path, offset, span, data, *fields))
        yield _framed(out, ["path", "offset", "span", "raw"])


def read_warc(spark: SparkSession, folder: str, *, bin_bytes: int = 1 << 20) -> DataFrame:
    """The records of all WARC files in a folder: (path, offset, span), FIELDS and ``payload``.

    A magic counts only if a chain of record lengths from the start of its file leads to it; magics inside payloads,
    even with a whole header behind them, are rejected and stay part of the payload. Truncated records and
    whatever follows a broken one give no row. Revisits have no payload; ``payload_bytes`` and ``payload_digest``
    are those their headers state. Files are split; a task holds one stretch at a time.
    """
    found = candidates(spark, folder)
    starts = found.where("offset >= 0 and span is not null")
    reached = reachable(starts.select("path", "offset", (F.col("offset") + F.col("span")).alias("next")))
    columns = ["path", "offset", "span", "raw", *[f.split()[0] for f in FIELDS.split(", ")]]
    records = found.join(reached, ["path", "offset"])
    whole = records.where("whole and record_id is not null").select(*columns)
    cut = records.where("not whole").select("path", F.col("offset").alias("first"), "span", F.explode(F.sequence(F.floor(F.col("offset") / bin_bytes), F.floor((F.col("offset") + F.col("span") - 1) / bin_bytes))).alias("bin"))
    stretches = found.where("offset >= 0").select("path", "offset", F.floor(F.col("offset") / bin_bytes).alias("bin"))
    # as a written table its size is known: few cut records are sent to the stretches, many are shuffled
    owned = stage(stretches.join(cut, ["path", "bin"]).where("offset >= first and offset < first + span").select("path", "offset", "first", "span"), "cut")
    parts = (
        found.select("path", "offset", "raw").join(owned, ["path", "offset"])
        .groupBy("path", F.col("first").alias("offset"), "span").agg(F.collect_list(F.struct(F.col("offset").alias("at"), "raw")).alias("parts"))
    )
    joined = parts.mapInPandas(_assemble, f"path string, offset long, span long, raw binary, {FIELDS}").where("record_id is not null")
    payload = F.substring("raw", F.col("payload_at") + 1, F.col("payload_bytes").cast("int"))
    return whole.unionByName(joined.select(*columns)).withColumn("payload", payload).drop("raw", "payload_at")


def with_responses(records: DataFrame) -> DataFrame:
    """Each record with ``refers_to``, the page id of the response that a revisit points at (else NULL).

    Only records that point at one are joined; the others, all responses among them, do not move. Of a response that very many
    point at there is one row, so its revisits are dealt over parts and the responses repeated for each.
    """
    parts = 8
    aims = records.where("warc_type = 'response'").select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"))
    aims = aims.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    pointing = records.where("refers_to_id is not null").withColumn("part", F.pmod(F.xxhash64("record_id"), F.lit(parts)).cast("int"))
    joined = pointing.join(aims, ["refers_to_id", "part"], "left").drop("part")
    return joined.unionByName(records.where("refers_to_id is null").withColumn("refers_to", F.lit(None).cast("long")))


def archive_round_trip(pages: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write ``pages`` as WARC and read the archives back; one row per page (see ``write_warc``, ``read_warc``)."""
    folder = folder or scratch_folder(pages.sparkSession, "warc")
    write_warc(pages, folder, **options)
    return with_responses(read_warc(pages.sparkSession, folder))
