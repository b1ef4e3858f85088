"""Search dictionaries that are too large for one automaton: bounded shards, one pass over the texts for each.

The distinct needles are cut by their bytes and number into shards that are written once below the shared folder. A pass
fetches one shard (its size is bounded, and measured before), sends it to the executors, searches every text with the
shard's automaton in Arrow batches, joins what is found with the shard's entries, and writes (text key, entry). Texts are
never shuffled; driver, broadcast and workers hold one shard at a time, whatever the size of the dictionary.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postflow.session import Staged, scratch_folder

NEEDLE = "_needle"
KEY = "_text_key"
LOWER = "_text_lower"
_SHARD = "_shard"
#: Text keys a task remembers, so that copies of a text are searched once.
_REMEMBERED = 100_000
#: About how many (text key, needle) a task holds before they leave.
_FOUND = 8192


@dataclass(frozen=True)
class TermStore:
    """``entries`` holds the needle, any payload, and the shard; written in files by shard."""

    entries: Staged
    n_shards: int

    @classmethod
    def of(cls, entries: DataFrame, n_rows: int, n_bytes: int, shard_terms: int, shard_bytes: int) -> TermStore:
        """Cut ``entries`` (measured: ``n_rows``, ``n_bytes``) so that a shard holds about ``shard_terms`` and ``shard_bytes``.

        A shard is chosen by a hash of the needle, so all entries of a needle share it.
        """
        n_shards = shards_needed(n_rows, n_bytes, shard_terms, shard_bytes)
        cut = entries.withColumn(_SHARD, F.pmod(F.xxhash64(NEEDLE), F.lit(n_shards)).cast("int"))
        return cls(Staged.of(cut.repartition(min(n_shards, 200), _SHARD).sortWithinPartitions(_SHARD)), n_shards)

    def hits(self, texts: DataFrame, columns: list[str]) -> DataFrame:
        """(key, ``columns`` of an entry) of all texts, given as (key, lower-cased text).

        Copies of a text that lie in different tasks are found by each of them, so a pair may come more than once.
        """
        spark = texts.sparkSession
        folder = scratch_folder(spark, "term-hits")
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.entries.table.select(*columns).schema)
        for number in range(self.n_shards):
            shard = self.entries.table.filter(F.col(_SHARD) == number).drop(_SHARD)
            needles = [r[NEEDLE] for r in shard.select(NEEDLE).distinct().collect()]
            if not needles:
                continue
            shared = spark.sparkContext.broadcast(needles)
            found = texts.select(KEY, LOWER).mapInArrow(_needles_found(shared), f"{KEY} binary, {NEEDLE} string")
            # a needle may have any number of entries, so they are measured before they are sent out
            held = Staged.of(shard, sized=shard.columns)
            small = held.n_bytes <= 64 * 1024 * 1024
            joined = found.join(F.broadcast(held.table) if small else held.table, NEEDLE)
            joined.select(KEY, *columns).write.mode("append").parquet(folder)
            held.delete()
            shared.destroy()
        try:
            written = spark.read.schema(f"{KEY} binary" + (f", {kinds}" if kinds else "")).parquet(folder)
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            written = spark.createDataFrame([], f"{KEY} binary" + (f", {kinds}" if kinds else ""))
        return written


def shards_needed(n_rows: int, n_bytes: int, shard_terms: int, shard_bytes: int) -> int:
    return max(1, -(-n_rows // shard_terms), -(-n_bytes // shard_bytes))


def _needles_found(shared):
    """Arrow batches of (text key, lower-cased text) -> (text key, needle of the shard); nothing for a text this task has had before.

    Texts become Python strings one at a time, and what is found leaves in batches of bounded size, however many rows come in one.
    """
    kinds = pa.schema([(KEY, pa.binary()), (NEEDLE, pa.string())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = ahocorasick.Automaton()
        for needle in shared.value:
            automaton.add_word(needle, needle)
        automaton.make_automaton()
        seen: set[bytes] = set()
        found: list[tuple[bytes, str]] = []
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                key, text = key.as_py(), text.as_py()
                if key in seen or not text:
                    continue
                if len(seen) < _REMEMBERED:
                    seen.add(key)
                found += [(key, needle) for needle in {needle for _, needle in automaton.iter(text)}]
                if len(found) >= _FOUND:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds.types)], schema=kinds)
                    found = []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds.types)], schema=kinds)

    return find
