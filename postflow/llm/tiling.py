"""Benchmark decontamination by greedy string tiling with running Karp-Rabin matching."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postflow.llm.common import stage

_WORD = re.compile(r"\w+")
#: Base of the rolling hash; arithmetic is modulo 2**64. Equal hashes are always verified word by word.
_BASE = np.uint64(0x9E3779B97F4A7C15)

HITS = "row long, id long, item_id long, item_words int, covered int, coverage double, tiles array<struct<item_word:int,doc_word:int,words:int>>"


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters, digits and underscores; punctuation and spacing do not count."""
    return _WORD.findall(text.lower()) if text else []


def rolling(ids: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of ``length`` ids: prefix hashes, shifted and subtracted."""
    if len(ids) < length:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        # sum of (id + 1) * base**(n - i) over a window, from prefix sums with the inverse powers of the base
        powers = np.cumprod(np.full(len(ids), _BASE, np.uint64))
        inverse = np.cumprod(np.full(len(ids), np.uint64(pow(int(_BASE), -1, 1 << 64)), np.uint64))
        prefix = np.concatenate([[np.uint64(0)], np.cumsum((ids.astype(np.uint64) + np.uint64(1)) * inverse)])
        ends = np.arange(length, len(ids) + 1)
        return (prefix[ends] - prefix[ends - length]) * powers[ends - 1]


def _runs(open_: np.ndarray) -> np.ndarray:
    """How many open places follow one another from each place on."""
    closed = np.flatnonzero(~open_)
    following = np.searchsorted(closed, np.arange(len(open_)))
    return np.append(closed, len(open_))[following] - np.arange(len(open_))


def _matches(item, doc, item_open, doc_open, length) -> list[tuple[int, int]]:
    """Places in item and document where ``length`` unmarked words agree, by item place, then document place."""
    a = np.flatnonzero(_runs(item_open) >= length)
    b = np.flatnonzero(_runs(doc_open) >= length)
    if not len(a) or not len(b):
        return []
    ha, hb = rolling(item, length)[a], rolling(doc, length)[b]
    order = np.argsort(hb, kind="stable")
    lo, hi = np.searchsorted(hb[order], ha, "left"), np.searchsorted(hb[order], ha, "right")
    return [
        (int(i), int(j)) for i, x, y in zip(a, lo, hi) for j in b[order[x:y]]
        if np.array_equal(item[i : i + length], doc[j : j + length])
    ]


def tiles(item: np.ndarray, doc: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (item place, document place, words), longest first, none overlapping.

    The longest length at which unmarked words agree is found by bisection (a match contains all shorter
    ones), all its matches are marked in order unless an earlier one took a place, and so on down to
    ``min_match`` words. ``doc`` places below zero match nothing.
    """
    item_open, doc_open, found = np.ones(len(item), bool), doc >= 0, []
    most = len(item)
    while most >= min_match:
        low, high, best = min_match, most, []
        while low <= high:
            middle = (low + high) // 2
            here = _matches(item, doc, item_open, doc_open, middle)
            if here:
                low, best, length = middle + 1, here, middle
            else:
                high = middle - 1
        if not best:
            break
        for i, j in best:
            if item_open[i : i + length].all() and doc_open[j : j + length].all():
                found.append((i, j, length))
                item_open[i : i + length] = False
                doc_open[j : j + length] = False
        most = length
    return found


@dataclass(frozen=True)
class Slice:
    """Benchmark items that are matched together: their words as numbers, and the hashes of their seeds."""

    min_match: int
    vocabulary: dict[str, int]
    items: list[np.ndarray]
    item_ids: list[int]
    seeds: np.ndarray
    seed_item: np.ndarray
    seed_at: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[int, str | None]], min_match: int) -> Slice:
        vocabulary: dict[str, int] = {}
        items, ids, seeds, item_of, at = [], [], [], [], []
        for item_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
            words = np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words_of(text)], np.int64)
            hashes = rolling(words, min_match)
            seeds.append(hashes)
            item_of.append(np.full(len(hashes), len(items)))
            at.append(np.arange(len(hashes)))
            items.append(words)
            ids.append(item_id)
        flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (seeds, item_of, at)]
        order = np.argsort(flat[0], kind="stable")
        return cls(min_match, vocabulary, items, ids, flat[0][order].astype(np.uint64), flat[1][order], flat[2][order])

    @classmethod
    def all_of(cls, rows: list[tuple[int, str | None]], min_match: int) -> list[Slice]:
        """Slices by seed length: ``min_match`` words, or the whole of an item that has fewer."""
        by_seed: dict[int, list] = {}
        for row in rows:
            by_seed.setdefault(min(len(words_of(row[1])), min_match), []).append(row)
        return [cls.of(own, seed) for seed, own in sorted(by_seed.items()) if seed]

    def hits(self, text: str | None, threshold: float) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
        """(item number, words covered, tiles) of each item of which the text covers enough."""
        return self.hits_of(words_of(text), threshold)

    def hits_of(self, words: list[str], threshold: float) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
        """The same for a text that is cut into words already."""
        get = self.vocabulary.get
        doc = np.array([get(w, -1) for w in words], np.int64)
        k = self.min_match
        known = np.flatnonzero(_runs(doc >= 0) >= k) if len(doc) >= k else np.zeros(0, np.int64)
        if not len(known) or not len(self.seeds):
            return
        hashes = rolling(doc, k)[known]
        lo, hi = np.searchsorted(self.seeds, hashes, "left"), np.searchsorted(self.seeds, hashes, "right")
        n = hi - lo
        if not n.any():
            return
        place = np.repeat(known, n)
        seed = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        number = self.seed_item[seed]
        for which in np.unique(number):
            own = number == which
            item = self.items[which]
            need = threshold * len(item)
            could = np.zeros(len(item), bool)
            for step in range(k):
                could[self.seed_at[seed[own]] + step] = True
            if could.sum() < need:  # tiles consist of seeds, so they cannot cover more than this
                continue
            inside = np.zeros(len(doc), bool)
            for step in range(k):
                inside[place[own] + step] = True
            # words outside every seed match nothing; runs of them shrink to one
            wanted = np.flatnonzero(inside | np.append(inside[1:], False))
            found = tiles(item, np.where(inside, doc, -1)[wanted], k)
            covered = sum(t[2] for t in found)
            if covered >= need:
                yield int(which), covered, [(i, int(wanted[j]), n) for i, j, n in found]


_HITS = pa.schema([
    ("row", pa.int64()), ("id", pa.int64()), ("item_id", pa.int64()), ("item_words", pa.int32()), ("covered", pa.int32()), ("coverage", pa.float64()),
    ("tiles", pa.list_(pa.struct([("item_word", pa.int32()), ("doc_word", pa.int32()), ("words", pa.int32())]))),
])


def _search(parts: list[Slice], threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row, doc_id, text in zip(*(batch.column(i) for i in range(3))):
                words = words_of(text.as_py())
                for part in parts:
                    for which, covered, found in part.hits_of(words, threshold):
                        n = len(part.items[which])
                        made = [{"item_word": i, "doc_word": j, "words": k} for i, j, k in found]
                        rows.append((row.as_py(), doc_id.as_py(), part.item_ids[which], n, covered, covered / n, made))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_HITS)], schema=_HITS)

    return run


def _slices(items: DataFrame, item_col: str, text_col: str, words: int) -> Iterator[list]:
    """The items, a bounded part at a time; items without text cannot be covered and are left out."""
    used = items.select(F.col(item_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t")).where("t is not null").distinct()
    chars = used.agg(F.sum(F.length("t"))).first()[0] or 0
    n = -(-chars // (words * 6)) or 1
    for k in range(n):
        yield used.where(F.pmod(F.xxhash64("t"), F.lit(n)) == k).collect()


def contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    *, min_match: int = 5, threshold: float = 0.8, slice_words: int = 1_000_000,
) -> DataFrame:
    """Pairs of a row of ``docs`` and a benchmark item of which it covers at least ``threshold``.

    Words are lower-cased runs of letters and digits. A pair is looked at if it shares ``min_match`` words in
    a row (a seed); greedy string tiling then covers the item with non-overlapping common runs, longest first,
    so reordered passages count as well. Returns (row, id, item_id, item_words, covered, coverage, tiles).

    The benchmark is taken in slices of about ``slice_words`` words, each of which goes out with the tasks of
    one pass over the documents: what is sent is bounded, documents are never shuffled, and the rows do not
    depend on the number of slices. Each slice's hits are staged before the next one is fetched. An item with fewer words than
    ``min_match`` is found where it stands as a whole; NULL and empty items cannot be matched; texts that are NULL or empty match nothing. Repeated rows and repeated items are reported each
    (equal items with one id once). A NULL id stays NULL. Other columns are not read.
    """
    narrow = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = None
    for rows in _slices(items, item_col, item_text_col, slice_words):
        part = narrow.mapInArrow(_search(Slice.all_of([tuple(r) for r in rows], min_match), threshold), HITS)
        if found is None:
            found, only = part, True
        else:
            found, only = (stage(found, "tiles") if only else found).unionByName(stage(part, "tiles")), False
    return found


def _clean(parts: list[Slice], threshold: float, text_at: int):
    """Rows that cover no item of a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (words_of(t.as_py()) for t in batch.column(text_at))
            keep = [not any(next(part.hits_of(words, threshold), None) for part in parts) for words in texts]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return run


def drop_contaminated(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    *, min_match: int = 5, threshold: float = 0.8, slice_words: int = 1_000_000,
) -> DataFrame:
    """The rows of ``docs`` that cover no benchmark item (see ``contaminated``), with all their columns and as often as they come.

    NULL and empty texts stay. Each slice of the benchmark is one filter on the way, and nothing is shuffled; after four
    slices what is left is staged, so that no more than four are held at once.
    """
    at = docs.columns.index(text_col)
    for number, rows in enumerate(_slices(items, item_col, item_text_col, slice_words)):
        if number and number % 4 == 0:
            docs = stage(docs, "uncovered")
        docs = docs.mapInArrow(_clean(Slice.all_of([tuple(r) for r in rows], min_match), threshold, at), docs.schema)
    return docs
