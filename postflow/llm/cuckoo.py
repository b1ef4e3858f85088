"""Exact duplicates through an index of cuckoo filters over live content digests."""

from __future__ import annotations

import io
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postflow.llm.common import free_name, keep_marked, stage, text_mark

#: Characters that do not count when texts are compared: space and U+0009 to U+000D.
BLANKS = " \t\n\x0b\f\r"


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (multiply and shift), so that tag and slot depend on all bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


class CuckooFilter:
    """Approximate set of 32-byte digests: four 16-bit tags per slot, two slots per digest.

    The second slot follows from the first and the tag, so an entry can move and be deleted without its key.
    ``insert`` returns False when no place is found after ``kicks`` moves; the caller then resizes with
    ``rebuilt`` from the keys it stores. No false negatives; the false positive rate is about 8 / 65536.
    """

    def __init__(self, slots: int, kicks: int = 256):
        self.slots = 1 << max(2, int(slots - 1).bit_length())
        self.kicks = kicks
        self.table = np.zeros((self.slots, 4), np.uint16)

    @classmethod
    def for_keys(cls, n: int) -> CuckooFilter:
        return cls(max(4, int(n / 4 / 0.8) + 1))

    @classmethod
    def rebuilt(cls, keys: Iterable[bytes], slots: int) -> CuckooFilter:
        """A filter with at least ``slots`` slots that holds all keys; doubled as often as needed."""
        keys = list(keys)
        while True:
            made = cls(slots)
            if all(made.insert(*p) for p in zip(*made.places(keys))):
                return made
            slots = made.slots * 2

    def places(self, keys: list[bytes]) -> tuple[list[int], list[int], list[int]]:
        """Tag, first and second slot of each key."""
        words = np.frombuffer(b"".join(keys), "<u8").reshape(len(keys), -1) if keys else np.zeros((0, 4), np.uint64)
        with np.errstate(over="ignore"):
            h = _mix(words[:, 0] ^ words[:, 1])
            tag = (h & np.uint64(0xFFFF)).astype(np.uint16)
            tag[tag == 0] = 1
            one = ((h >> np.uint64(16)) & np.uint64(self.slots - 1)).astype(np.int64)
            two = one ^ self._other(tag)
        return tag.tolist(), one.tolist(), two.tolist()

    def _other(self, tag):
        with np.errstate(over="ignore"):
            return (_mix(np.atleast_1d(tag).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) & np.uint64(self.slots - 1)).astype(np.int64)

    def holds(self, keys: list[bytes]) -> np.ndarray:
        tag, one, two = (np.array(x, np.int64) for x in self.places(keys))
        if not len(tag):
            return np.zeros(0, bool)
        tag = tag[:, None]
        return (self.table[one] == tag).any(axis=1) | (self.table[two] == tag).any(axis=1)

    def insert(self, tag: int, one: int, two: int) -> bool:
        for slot in (one, two):
            free = np.flatnonzero(self.table[slot] == 0)
            if len(free):
                self.table[slot, free[0]] = tag
                return True
        slot, moves = one, []
        for kick in range(self.kicks):
            place = kick & 3
            moves.append((slot, place))
            tag, self.table[slot, place] = int(self.table[slot, place]), tag
            slot ^= int(self._other(np.uint16(tag))[0])
            free = np.flatnonzero(self.table[slot] == 0)
            if len(free):
                self.table[slot, free[0]] = tag
                return True
        for slot, place in reversed(moves):  # leave the filter as it was
            tag, self.table[slot, place] = int(self.table[slot, place]), tag
        return False

    def delete(self, tag: int, one: int, two: int) -> bool:
        for slot in (one, two):
            there = np.flatnonzero(self.table[slot] == tag)
            if len(there):
                self.table[slot, there[0]] = 0
                return True
        return False

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.save(out, self.table)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> CuckooFilter:
        made = cls(4)
        made.table = np.load(io.BytesIO(data))
        made.slots = len(made.table)
        return made


#: Bucket content: live digest, its keeper (code points, id, row) and number of live rows; or the bucket's filter. No number
#: is NULL, because pandas would round the other ids of its column to 53 bits; a row without an id is marked instead.
CONTENT = "bucket int, digest binary, n_chars long, no_id boolean, id long, row long, size long, filter binary"
_ENTRY = "bucket int, digest binary, n_chars long, no_id boolean, id long, row long, size long"


def _better(a: tuple, b: tuple) -> bool:
    """Does member ``a`` (n_chars, id, row) stay before ``b``? Most code points, smallest id (NULL last), row."""
    key = lambda m: (-m[0], m[1] is None, m[1] or 0, m[2])
    return key(a) < key(b)


def _thin(frames):
    """Copies within one batch become one entry, before the shuffle."""
    for frame in frames:
        frame = frame.sort_values(["digest", "n_chars", "no_id", "id", "row"], ascending=[True, False, True, True, True], kind="stable")
        size = frame.groupby("digest", sort=True)["row"].transform("size")
        first = ~frame["digest"].duplicated()
        yield frame[first].assign(size=size[first])[["bucket", "digest", "n_chars", "no_id", "id", "row", "size"]]


def _members(rows: pd.DataFrame) -> list[list]:
    """(n_chars, id, row) and size of each entry; the id of a marked row is None."""
    columns = (rows[c].tolist() for c in ("n_chars", "no_id", "id", "row", "size"))
    return [[(n, None if none else i, r), s] for n, none, i, r, s in zip(*columns)]


def _insert(key, stored: pd.DataFrame, incoming: pd.DataFrame) -> pd.DataFrame:
    """Bring entries into one bucket.

    The filter is asked first; what it does not hold is new. A hit is verified against the stored digests:
    equal ones join the stored entry, false positives are inserted. A full filter is rebuilt from the stored
    digests with twice the slots.
    """
    old = stored[stored["filter"].isna()]
    held = dict(zip(map(bytes, old["digest"]), _members(old)))
    kept = [f for f in stored["filter"] if f is not None and f == f]
    live = CuckooFilter.load(bytes(kept[0])) if kept else CuckooFilter.for_keys(len(held) + len(incoming) // 2)
    rows = list(zip(map(bytes, incoming["digest"]), _members(incoming)))
    for at in range(0, len(rows), 4096):
        piece = rows[at : at + 4096]
        maybe = live.holds([r[0] for r in piece])
        added: set[bytes] = set()  # inserted since the filter was asked
        for hit, (digest, (member, s)) in zip(maybe, piece):
            entry = held.get(digest) if hit or digest in added else None
            if entry is not None:
                entry[1] += s
                if _better(member, entry[0]):
                    entry[0] = member
                continue
            held[digest] = [member, s]
            added.add(digest)
            if not live.insert(*(p[0] for p in live.places([digest]))):
                live = CuckooFilter.rebuilt(held, live.slots * 2)
    return _frame(key, held, live)


def _frame(key, held: dict, live: CuckooFilter) -> pd.DataFrame:
    n = len(held)
    columns = list(zip(*[(m[0], m[1] is None, m[1] or 0, m[2], size) for m, size in held.values()])) or [()] * 5
    kinds = {"n_chars": "int64", "no_id": "bool", "id": "int64", "row": "int64", "size": "int64"}
    out = pd.DataFrame({"bucket": [key[0]] * (n + 1), "digest": [*held, None]})
    for (name, kind), values in zip(kinds.items(), columns):
        out[name] = np.array([*values, 0], kind)
    out["filter"] = [None] * n + [live.dump()]
    return out


def _remove(key, stored: pd.DataFrame, gone: pd.DataFrame) -> pd.DataFrame:
    """Take digests that have no live row left out of the filter and the content of one bucket."""
    old = stored[stored["filter"].isna()]
    held = dict(zip(map(bytes, old["digest"]), _members(old)))
    kept = [f for f in stored["filter"] if f is not None and f == f]
    live = CuckooFilter.load(bytes(kept[0])) if kept else CuckooFilter.for_keys(len(held))
    for digest in map(bytes, gone["digest"]):
        if digest in held:  # never delete a tag that another digest may own
            del held[digest]
            live.delete(*(p[0] for p in live.places([digest])))
    return _frame(key, held, live)


def normalised(text) -> F.Column:
    """The text without blanks; NULL is empty."""
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def digests(docs: DataFrame, id_col: str, text_col: str, row_col: str, buckets: int) -> DataFrame:
    """(bucket, digest, n_chars, id, row, mark) of every row; the bucket comes from the digest."""
    text = F.col(text_col).cast("string")
    return docs.select(
        F.unhex(F.sha2(normalised(text).cast("binary"), 256)).alias("digest"), F.length(F.coalesce(text, F.lit(""))).cast("long").alias("n_chars"),
        F.col(id_col).cast("long").alias("id"), F.col(row_col).cast("long").alias("row"), text_mark(text).alias("mark"),
    ).select(F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int").alias("bucket"), "*")


@dataclass(frozen=True)
class CuckooIndex:
    """Live digests, bucketed by digest: per bucket the stored entries and one cuckoo filter over them.

    Every change gives a new index over a newly written table, so a failed job leaves the old one intact. A
    bucket is one task's work; choose ``buckets`` so that one holds about 100,000 distinct texts.
    """

    content: DataFrame
    buckets: int

    @classmethod
    def empty(cls, spark, buckets: int) -> CuckooIndex:
        return cls(spark.createDataFrame([], CONTENT), buckets)

    def entries(self) -> DataFrame:
        """(digest, n_chars, id, row, size): the row that stays and the number of live rows of each text."""
        return self.content.where("digest is not null").select("digest", "n_chars", F.when(~F.col("no_id"), F.col("id")).alias("id"), "row", "size")

    def insert(self, rows: DataFrame) -> CuckooIndex:
        """Add rows from ``digests``."""
        marked = rows.select("bucket", "digest", "n_chars", F.col("id").isNull().alias("no_id"), F.coalesce("id", F.lit(0)).alias("id"), "row")
        thin = marked.mapInPandas(_thin, _ENTRY)
        return self._changed(thin, _insert)

    def lookup(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``live``: is the text in the index? The filters sort out most of the rest; hits are
        verified against the bucketed digests."""

        def ask(key, stored, asked):
            if not len(stored):
                return asked.assign(live=False)
            keys = [bytes(d) for d in asked["digest"]]
            live = CuckooFilter.load(bytes(stored["filter"].dropna().iat[0])).holds(keys)
            own = {bytes(d) for d in stored["digest"].dropna()}
            return asked.assign(live=[bool(h) and k in own for h, k in zip(live, keys)])

        asked = rows.select("bucket", "digest").distinct()
        found = self.content.groupBy("bucket").cogroup(asked.groupBy("bucket")).applyInPandas(ask, "bucket int, digest binary, live boolean")
        return rows.join(found.select("digest", "live"), "digest")

    def delete(self, members: DataFrame, gone: DataFrame) -> CuckooIndex:
        """Delete rows: ``members`` are all live rows (from ``digests``), ``gone`` those of them that go (by row).

        Texts without a live row leave filter and content; of the others size and keeper are settled anew from
        the rows that are left.
        """
        touched = gone.select("digest").distinct()
        left = members.join(gone.select("row"), "row", "left_anti").join(touched, "digest", "left_semi")
        without = self._changed(touched.select(F.pmod(F.xxhash64("digest"), F.lit(self.buckets)).cast("int").alias("bucket"), "digest"), _remove)
        return without.insert(left.select("bucket", "digest", "n_chars", "id", "row"))

    def _changed(self, rows: DataFrame, step) -> CuckooIndex:
        spark = rows.sparkSession
        n = max(self.buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
        parts = [x.repartition(n, "bucket").groupBy("bucket") for x in (self.content, rows)]
        changed = parts[0].cogroup(parts[1]).applyInPandas(step, CONTENT)
        return CuckooIndex(stage(changed, "cuckoo"), self.buckets)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, bucket_rows: int = 100_000, least_buckets: int = 64) -> DataFrame:
    """Which rows have the same text, blanks aside, and which one of them stays.

    Returns (row, id, mark, keep_id, group_size, kept, text_sha256) for every row of ``docs``; ``row`` numbers the
    rows, ``mark`` is a hash of the text. Equal texts: identical after deleting space and U+0009 to U+000D; NULL counts
    as empty, so all NULL, empty and blank texts are one group. The row with the most code points stays, then
    the smallest id (NULL last), then the first row, so of repeated rows exactly one stays. A group whose rows
    all have a NULL id has a NULL keep_id. Other columns are not read. An empty table gives no rows.

    Rows are inserted in a ``CuckooIndex``: copies collapse within each batch before the shuffle, and what
    reaches a bucket is at most one entry per text and batch, whatever the size of a group.
    """
    row = free_name(docs.columns, "row_no")
    buckets = max(least_buckets, -(-docs.count() // bucket_rows))
    rows = stage(digests(docs.withColumn(row, F.monotonically_increasing_id()), id_col, text_col, row, buckets), "digests")
    entries = CuckooIndex.empty(docs.sparkSession, buckets).insert(rows).entries()
    keep = entries.select("digest", F.col("id").alias("keep_id"), F.col("row").alias("keep_row"), "size")
    return rows.join(keep, "digest").select(
        "row", "id", "mark", "keep_id", F.col("size").alias("group_size"), (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay (see ``exact_duplicates``), with all their columns."""
    stay = exact_duplicates(docs, id_col, text_col, **options).where("kept")
    return keep_marked(docs, stay.select("id", "mark"), id_col, text_col)
