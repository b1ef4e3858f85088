"""Whole rows as comparable digests, and Bloom filters over keys."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postflow.session import Staged

#: Bits of one block of a Bloom filter: what Spark's bitmap aggregate holds.
BLOCK_BITS = 32_768


def _body(value: Column, kind: T.DataType) -> Column:
    """Text of a value that is not NULL; equal for equal values, different for different ones of the same type."""
    if isinstance(kind, T.StringType):
        return value
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(value == 0, F.lit("0")).otherwise(value.cast("string"))  # -0.0 is 0.0; every NaN reads NaN
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.hex(value)
    if isinstance(kind, T.ArrayType):
        return F.array_join(F.transform(value, lambda x: encoded(x, kind.elementType)), "")
    if isinstance(kind, T.StructType):
        return F.concat(F.lit(""), *[encoded(value.getField(f.name), f.dataType) for f in kind])
    if isinstance(kind, T.MapType):
        entry = T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])
        return F.array_join(F.array_sort(F.transform(F.map_entries(value), lambda x: encoded(x, entry))), "")
    return value.cast("string")


def encoded(value: Column, kind: T.DataType) -> Column:
    """The value with its length before it, so that values may follow each other; NULL is ``~``."""
    body = _body(value, kind)
    return F.when(value.isNull(), F.lit("~")).otherwise(F.concat(F.octet_length(body).cast("string"), F.lit(":"), body))


def row_digest(schema: T.StructType) -> Column:
    """SHA-256 of a row's values in the order and types of ``schema``.

    Rows have equal digests when ``EXCEPT`` takes them for equal: NULL equals NULL and nothing else, NaN equals NaN, -0.0
    equals 0.0; timestamps count to the microsecond. Arrays and structs compare by their parts, maps by their entries.
    """
    return F.sha2(_encoded_row(schema), 256)


def _encoded_row(schema: T.StructType) -> Column:
    return F.concat(F.lit(""), *[encoded(F.col(f"`{f.name}`").cast(f.dataType), f.dataType) for f in schema])


def common_schema(a: DataFrame, b: DataFrame) -> T.StructType:
    """Types in which the equally named columns of both can be compared."""
    return a.limit(0).unionByName(b.limit(0)).schema


@dataclass(frozen=True)
class KeyFilter:
    """A Bloom filter in blocks: a key has one block and some bits in it.

    Blocks are built by Spark's bitmap aggregate, at most ``most_blocks`` of 4 KB, so their total is bounded whatever the number of
    keys; they are staged as arrays of 64-bit words. No key is ever missed; of other keys a small part passes, growing
    when the keys outnumber what the blocks are made for.
    """

    blocks: Staged
    n_blocks: int
    n_bits: int
    schema: T.StructType

    @classmethod
    def of(cls, keys: DataFrame, n_keys: int, schema: T.StructType | None = None, *, bits_each: int = 16, n_bits: int = 6, most_blocks: int = 16_384) -> KeyFilter:
        """``schema``: key columns and the types in which they are compared, those of ``keys`` by default."""
        schema = schema or keys.schema
        n_blocks = min(most_blocks, max(1, math.ceil(n_keys * bits_each / BLOCK_BITS)))
        block, bits = _positions(schema, n_blocks, n_bits)
        spread = keys.select(block.alias("block"), F.explode(F.array(*bits)).alias("bit"))
        bitmaps = spread.groupBy("block").agg(F.bitmap_construct_agg(F.col("bit").cast("long")).alias("bitmap"))
        # eight bytes are one word, the first byte lowest, as getbit counts from the lowest bit
        words = F.expr(
            "transform(sequence(0, 511), i -> "
            + " | ".join(f"shiftleft(cast(conv(hex(substring(bitmap, 8 * i + {k + 1}, 1)), 16, 10) as bigint), {8 * k})" for k in range(8))
            + ")"
        )
        return cls(Staged.of(bitmaps.select("block", words.alias("words"))), n_blocks, n_bits, schema)

    def passing(self, df: DataFrame) -> DataFrame:
        """Rows of ``df`` whose key columns may be among the keys; no shuffle of ``df``."""
        block, bits = _positions(self.schema, self.n_blocks, self.n_bits)
        marked = df.select("*", F.struct(block.alias("block"), F.array(*bits).alias("bits")).alias("_bloom"))
        held = self.blocks.table.select(F.col("block").alias("_block"), F.col("words").alias("_words"))
        tests = [F.getbit(F.col("_words")[F.shiftright(F.col("_bloom.bits")[i], 6)], F.col("_bloom.bits")[i] % 64) == 1 for i in range(self.n_bits)]
        both = F.col("_bloom.block") == F.col("_block")
        for test in tests:
            both = both & test
        return marked.join(F.broadcast(held), both, "left_semi").drop("_bloom")


def _positions(schema: T.StructType, n_blocks: int, n_bits: int) -> tuple[Column, list[Column]]:
    """Block of a key, and its bits within the block: two hashes, stepped."""
    key = _encoded_row(schema)
    first, step = F.xxhash64(key, F.lit(1)), F.xxhash64(key, F.lit(2)).bitwiseOR(F.lit(1))
    bits = [F.pmod(F.pmod(first, F.lit(1 << 40)) + F.lit(i) * F.pmod(step, F.lit(1 << 40)), F.lit(BLOCK_BITS)).cast("int") for i in range(n_bits)]
    return F.pmod(F.xxhash64(key, F.lit(3)), F.lit(n_blocks)), bits
