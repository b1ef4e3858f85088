"""Stretches of texts that may be terms of a dictionary of any size.

The bytes of a whole Arrow batch are hashed from every place at once, and only what a bitmap of the dictionary lets pass becomes
a row. The bitmap is built by Spark's bitmap aggregate and bounded (64 MB), so a larger dictionary lets more rows pass that are no
term, and never fewer that are one. The join that follows decides.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE = "_block"
#: What a key of the bitmap stands for: how terms begin, a block of a long term, or (its length) a whole term.
KIND, BEGINNING, IN_BLOCK = "_kind", 0, -1
#: Bits of one value of Spark's bitmap aggregate, and of the bitmap per key and altogether.
_BUCKET, _LEAST_BITS, _BITS_EACH, _MOST_BITS = 32_768, 1 << 18, 24, 1 << 29
_FACTOR = np.uint64(0x100000001B3)
_TURNS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]
#: Places of a batch that are hashed at once.
_AT_ONCE = 1 << 18
#: Text keys a task remembers, so that copies of a text are searched once.
_REMEMBERED = 100_000


def _bit(hashes: np.ndarray, kind: int, turn: np.uint64, n_bits: int) -> np.ndarray:
    """Numbers of one bit of each key; ``n_bits`` is a power of two."""
    mixed = hashes ^ (hashes >> np.uint64(29)) ^ np.uint64(kind + 1 << 56)
    return (mixed * turn) >> np.uint64(65 - n_bits.bit_length())


def _passes(bitmap: np.ndarray, hashes: np.ndarray, kind: int) -> np.ndarray:
    """Indices of the hashes whose bits are all set."""
    at = np.arange(len(hashes))
    for turn in _TURNS:
        bit = _bit(hashes[at], kind, turn, 8 * len(bitmap))
        at = at[(bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & np.uint8(1)).astype(bool)]
    return at


def _hashes(data: np.ndarray, places: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the ``n`` bytes from each place."""
    found = np.zeros(len(places), np.uint64)
    for k in range(n):
        found *= _FACTOR
        found += data[places + k]
    return found


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes of a column without NULLs, where each row begins, and the last ends)."""
    column = column.cast(pa.large_binary())
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[ends[0] : ends[-1]], ends - ends[0]


def _key_bits(n_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = _bytes_of(batch.column(0))
            length, kind = np.diff(ends), batch.column(1).to_numpy()
            for n, k in {*zip(length.tolist(), kind.tolist())}:
                hashes = _hashes(data, ends[:-1][(length == n) & (kind == k)], n)
                for turn in _TURNS:
                    yield pa.RecordBatch.from_arrays([pa.array(_bit(hashes, k, turn, n_bits).astype(np.int64))], ["bit"])

    return run


def bitmap_of(keys: DataFrame, n_keys: int) -> bytes:
    """Bitmap of keys (bytes, kind): three bits for each, in at most 64 MB."""
    n_bits = min(max(_LEAST_BITS, 1 << (n_keys * _BITS_EACH).bit_length()), _MOST_BITS)
    bits = keys.select(PIECE, KIND).mapInArrow(_key_bits(n_bits), "bit long")
    bucket, inside = F.expr(f"bit div {_BUCKET}"), F.col("bit") % _BUCKET
    held = np.zeros((n_bits // _BUCKET, _BUCKET // 8), np.uint8)
    for row in bits.groupBy(bucket.alias("bucket")).agg(F.bitmap_construct_agg(inside).alias("bitmap")).toLocalIterator():
        held[row["bucket"]] = np.frombuffer(row["bitmap"], np.uint8)
    return held.tobytes()


def _found(data: np.ndarray, ends: np.ndarray, bitmap: np.ndarray, lengths: Sequence[int], block: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(rows, places, length) of what passes: stretches of ``lengths`` bytes from every place, and blocks laid end to end from a row's begin."""
    padded = np.append(data, np.zeros(max([block, *lengths]), np.uint8))

    def whole(places: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, int]:
        rows = np.searchsorted(ends, places, "right") - 1
        inside = places + n <= ends[rows + 1]
        return rows[inside], places[inside], n

    least = min(lengths, default=0)
    for a in range(0, len(data), _AT_ONCE):
        size = min(_AT_ONCE, len(data) - a)
        if least:
            # a place goes on only if some term begins with its first bytes
            hashes = np.zeros(size, np.uint64)
            for k in range(least):
                hashes *= _FACTOR
                hashes += padded[a + k : a + k + size]
            at = _passes(bitmap, hashes, BEGINNING)
            hashes, at = hashes[at], at + a
            for n in range(least, max(lengths) + 1):
                if n > least:
                    hashes *= _FACTOR
                    hashes += padded[at + n - 1]
                if n in lengths:
                    yield whole(at[_passes(bitmap, hashes, n)], n)
        if block:
            places = np.arange(a, a + size)
            rows = np.searchsorted(ends, places, "right") - 1
            places = places[(places - ends[rows]) % block == 0]
            yield whole(places[_passes(bitmap, _hashes(padded, places, block), IN_BLOCK)], block)


def _searched(shared, lengths: list[int], block: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(shared.value, np.uint8)
        seen: set[bytes] = set()
        for batch in batches:
            new = []
            for key in batch.column(0).to_pylist():
                new.append(key not in seen)
                if new[-1] and len(seen) < _REMEMBERED:
                    seen.add(key)
            batch = batch.filter(pa.array(new, pa.bool_()))
            data, ends = _bytes_of(batch.column(1))
            for rows, places, n in _found(data, ends, bitmap, lengths, block):
                order = np.lexsort((_hashes(data, places, n), rows))
                rows, made = rows[order], data[places[order][:, None] + np.arange(n)]
                first = np.ones(len(rows), bool)
                first[1:] = (rows[1:] != rows[:-1]) | (made[1:] != made[:-1]).any(axis=1)
                rows, made = rows[first], made[first]
                if len(rows):
                    pieces = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(np.arange(len(rows) + 1, dtype=np.int32) * np.int32(n)), pa.py_buffer(made.tobytes())])
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pieces], names)

    return run


def passing(texts: DataFrame, key: str, text: Column, bitmap: bytes, lengths: list[int], block: int) -> DataFrame:
    """(key, piece) of the texts' stretches that may be keys of the bitmap; texts are not shuffled, NULL is no text.

    Any number of bytes from ``lengths`` counts from every place, ``block`` bytes (0: none) only from multiples of it. A piece of a text may
    come more than once.
    """
    shared = texts.sparkSession.sparkContext.broadcast(bitmap)
    some = texts.select(key, text.alias("_text")).where(F.col("_text").isNotNull())
    return some.mapInArrow(_searched(shared, lengths, block, [key, PIECE]), f"{key} binary, {PIECE} binary")
