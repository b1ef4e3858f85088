"""Token ids in binary files: Simple-8b words in blocks that decode on their own."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from postflow.llm.chunks import byte_bpe, pieces
from postflow.session import scratch_folder

# fixed values of the format: (values, bits of each) by selector. The selector is in the top four bits of a word, the
# first value in the lowest bits. Selector 0 escapes: the word holds a place in the block's list of wide values.
# Selector 1: a run of zeros.
LAYOUT = ((1, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))

_POWERS = np.uint64(1) << np.arange(64, dtype=np.uint64)
_COUNT = np.array([n for n, _ in LAYOUT], np.int64)
#: A place in the index for every so many words of a block.
INDEX_EVERY = 256


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, wide values): each word takes as many of the next values as any selector allows.

    What fits is worked out for every place at once; only the walk from word to word is sequential. The last
    word is filled up with zeros, so the number of values must be kept beside the words.
    """
    values = np.asarray(values, np.uint64)
    n = len(values)
    need = np.append(np.searchsorted(_POWERS, values, "right"), np.zeros(240, np.int64)).astype(np.uint8)  # bits of each
    most, choice = {1: need}, np.zeros(n, np.uint8)
    for selector in range(len(LAYOUT) - 1, 0, -1):  # fewer values first, so that more values win
        count, bits = LAYOUT[selector]
        if count not in most:  # the most bits in a window, from two overlapping shorter windows
            half = min(c for c in most if 2 * c >= count)
            most[count] = np.maximum(most[half][: len(need) - count + 1], most[half][count - half : len(need) - half + 1])
        choice[most[count][:n] <= bits] = selector
    step = _COUNT[choice].tolist()
    at, places = 0, []
    while at < n:
        places.append(at)
        at += step[at]
    places = np.array(places, np.int64)
    chosen = choice[places]
    padded = np.append(values, np.zeros(240, np.uint64))
    words = chosen.astype(np.uint64) << np.uint64(60)
    for selector, (count, bits) in enumerate(LAYOUT[2:], 2):
        own = np.flatnonzero(chosen == selector)
        for k in range(count if len(own) else 0):
            words[own] |= padded[places[own] + k] << np.uint64(bits * k)
    escaped = np.flatnonzero(chosen == 0)
    words[escaped] |= np.arange(len(escaped), dtype=np.uint64)
    return words, values[places[escaped]]


def unpack(words: np.ndarray, n: int, wide: np.ndarray = ()) -> np.ndarray:
    """The first ``n`` values of some words; all words with one selector are decoded together."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    ends = np.cumsum(_COUNT[selector])
    starts = ends - _COUNT[selector]
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    for which, (count, bits) in enumerate(LAYOUT):
        own = np.flatnonzero(selector == which)
        if not len(own) or which == 1:
            continue
        if which == 0:
            out[starts[own]] = np.asarray(wide, np.uint64)[(words[own] & np.uint64((1 << 60) - 1)).astype(np.int64)]
            continue
        for k in range(count):
            out[starts[own] + k] = (words[own] >> np.uint64(bits * k)) & np.uint64((1 << bits) - 1)
    return out[:n]


def index_of(words: np.ndarray) -> np.ndarray:
    """Number of values before every ``INDEX_EVERY``-th word."""
    ends = np.cumsum(_COUNT[(words >> np.uint64(60)).astype(np.int64)])
    return np.concatenate([[0], ends])[:-1][::INDEX_EVERY] if len(words) else np.zeros(0, np.int64)


def unpack_range(words: np.ndarray, index: np.ndarray, first: int, n: int, wide: np.ndarray = ()) -> np.ndarray:
    """Values ``first`` to ``first + n``, decoding only from the index place before them."""
    place = max(int(np.searchsorted(index, first, "right")) - 1, 0)
    end = int(np.searchsorted(index, first + n, "left"))
    before = int(index[place]) if len(index) else 0
    return unpack(words[place * INDEX_EVERY : end * INDEX_EVERY], first + n - before, wide)[first - before :]


#: One block: ids of whole documents. ``start``: ids before it in its file; ``ends``: where its documents end within it.
BLOCK = pa.schema([
    ("file", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())),
    ("words", pa.binary()), ("index", pa.list_(pa.int64())), ("wide", pa.binary()),
])
_BLOCK_SQL = "file int, block int, start long, doc_ids array<long>, ends array<long>, words binary, index array<long>, wide binary"


def _blocks(path: str, end_id: int, block_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, file, block, start = byte_bpe(path), TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            doc_ids, texts = batch.column(0), batch.column(1).to_pylist()
            texts = [t or "" for t in texts]
            for a, b in pieces(texts, block_chars):
                count, ids = encoder.encode_with_special(texts[a:b])
                ends = np.cumsum(count + 1)
                full = np.full(int(ends[-1]), end_id, np.int64)
                mask = np.ones(len(full), bool)
                mask[ends - 1] = False
                full[mask] = ids
                words, wide = pack(full)
                row = [[file], [block], [start], [doc_ids.slice(a, b - a).to_pylist()], [ends], [words.astype("<u8").tobytes()], [index_of(words)], [wide.astype("<u8").tobytes()]]
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(row, BLOCK)], schema=BLOCK)
                block, start = block + 1, start + len(full)

    return run


def write_token_files(
    docs: DataFrame, folder: str, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
    *, end_id: int = 0, files: int | None = None, block_chars: int = 1 << 19,
) -> None:
    """Encode the texts, end each document with ``end_id``, and write the ids in ascending id order.

    The documents are dealt to ``files`` files by ranges of their id (NULL ids last; rows with one id in the order
    of a hash of their text) and sorted within; a file is a sequence of blocks of whole documents. Blocks hold
    about ``block_chars`` characters of text, or one longer document. NULL texts count as empty: only the end
    id. An empty table gives an empty folder. Blocks stand in Parquet, so that retried tasks leave no half
    files and any store that Spark reaches will do.
    """
    key = [F.col("id").asc_nulls_last(), F.xxhash64("text")]
    files = files or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    placed = source.repartitionByRange(files, *key).sortWithinPartitions(*key)
    placed.mapInArrow(_blocks(vocabulary, end_id, block_chars), _BLOCK_SQL).write.parquet(folder)


_DOC = pa.schema([("file", pa.int32()), ("id", pa.int64()), ("start", pa.int64()), ("ids", pa.list_(pa.int64())), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def _documents(with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                file, _, start, doc_ids, ends, words, _, wide = (batch.column(i)[row] for i in range(8))
                ends = np.array(ends.as_py(), np.int64)
                ids = unpack(np.frombuffer(words.as_py(), "<u8"), int(ends[-1]), np.frombuffer(wide.as_py(), "<u8")).astype("<u4")
                first = np.concatenate([[0], ends[:-1]])
                data = memoryview(ids.tobytes())
                crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(first.tolist(), ends.tolist())]
                n = len(ends)
                own = pa.ListArray.from_arrays(pa.array(np.append(first, ends[-1]), pa.int32()), pa.array(ids.astype(np.int64))) if with_ids else pa.nulls(n, pa.list_(pa.int64()))
                columns = [pa.array([file.as_py()] * n, pa.int32()), pa.array(doc_ids.as_py(), pa.int64()), pa.array(first + start.as_py()), own, pa.array(ends - first), pa.array(crc, pa.int64())]
                made = pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, _DOC)], schema=_DOC)
                yield made if with_ids else made.drop_columns(["ids"])

    return run


def read_token_files(spark: SparkSession, folder: str, *, with_ids: bool = False) -> DataFrame:
    """(id, start, n_tokens, ids_crc32[, ids]) of every document in the files of a folder.

    ``start`` counts the ids of all documents before it, over all files; a block knows its place in its file,
    and the sizes of the files before are added (one row per file). ``n_tokens`` includes the end id, and
    ``ids_crc32`` is over the ids as little-endian unsigned 32-bit integers.
    """
    blocks = spark.read.schema(_BLOCK_SQL).parquet(folder)
    size = blocks.groupBy("file").agg(F.max(F.col("start") + F.element_at("ends", -1)).alias("n"))
    before = F.sum("n").over(W.orderBy("file").rowsBetween(W.unboundedPreceding, -1))
    base = size.select("file", F.coalesce(before, F.lit(0)).alias("base"))
    kept = "ids array<long>, " if with_ids else ""
    docs = blocks.mapInArrow(_documents(with_ids), f"file int, id long, start long, {kept}n_tokens long, ids_crc32 long")
    columns = ["id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])]
    return docs.join(base, "file").select(*columns)


def token_file_round_trip(docs: DataFrame, vocabulary: str, folder: str | None = None, **options) -> DataFrame:
    """Write the ids of all documents and read the files back (see ``write_token_files``, ``read_token_files``)."""
    folder = folder or scratch_folder(docs.sparkSession, "token-files")
    write_token_files(docs, folder, vocabulary, **options)
    return read_token_files(docs.sparkSession, folder)
