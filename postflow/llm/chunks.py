"""Encoding of texts chunk by chunk, with a bounded memory of the chunks seen before.

A tokenizer that never joins characters across certain places may encode the stretches between them
one by one; in natural text most stretches repeat, so a worker encodes each of them once. The ids are
those of the whole text.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

#: Unicode White_Space, as the tokenizers' pattern counts it (Python's \s has four characters more).
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


class ChunkMemory:
    """Rows of numbers for chunks seen before: ids, and as many other columns as the encoder gives.

    ``encode`` takes new chunks and gives (the chunks in its order, rows of each, columns of all rows). Over
    ``most_chunks`` chunks or ``most_chars`` characters everything is forgotten and learned again, so memory is
    bounded; what comes out is the same.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[list[str], np.ndarray, list[np.ndarray]]], columns: int, most_chunks: int = 800_000, most_chars: int = 1 << 24):
        self._encode, self._columns = encode, columns
        self._most_chunks, self._most_chars = most_chunks, most_chars
        self._forget()

    def _forget(self) -> None:
        self._place: dict[str, int] = {}
        self._ends = np.zeros(1024, np.int64)
        self._flat = [np.zeros(1024, np.int32) for _ in range(self._columns)]
        self._rows = self._chars = 0

    @staticmethod
    def _put(held: np.ndarray, at: int, values: np.ndarray) -> np.ndarray:
        if at + len(values) > len(held):
            held = np.concatenate([held[:at], np.zeros(max(at, len(values)) + 1024, held.dtype)])
        held[at : at + len(values)] = values
        return held

    def rows(self, chunks: list[str], at: np.ndarray | None = None) -> tuple[np.ndarray, list[np.ndarray]]:
        """(number of rows of each chunk, the columns of all rows in order); of ``chunks[at]`` where ``at`` is given."""
        new = set(chunks).difference(self._place)
        if new:
            if len(self._place) > self._most_chunks or self._chars > self._most_chars:
                self._forget()
                new = set(chunks)
            order, count, columns = self._encode(list(new))
            known = len(self._place)
            self._place.update(zip(order, range(known, known + len(order))))
            self._ends = self._put(self._ends, known + 1, self._rows + np.cumsum(count))
            self._flat = [self._put(flat, self._rows, values) for flat, values in zip(self._flat, columns)]
            self._rows += int(count.sum())
            self._chars += sum(map(len, order))
        which = np.fromiter(map(self._place.__getitem__, chunks), np.int64, len(chunks))
        if at is not None:
            which = which[at]
        count = self._ends[which + 1] - self._ends[which]
        total = int(count.sum())
        places = np.repeat(self._ends[which] - (np.cumsum(count) - count), count) + np.arange(total)
        return count, [flat[places] for flat in self._flat]


def parts(sizes: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of items with a total size of about ``most`` each."""
    first, held, i = 0, 0, -1
    for i, size in enumerate(sizes):
        held += size
        if held >= most:
            yield first, i + 1
            first, held = i + 1, 0
    if first <= i:
        yield first, i + 1


def pieces(texts: list[str], most_chars: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``most_chars`` characters each, so that a batch of long texts is taken in parts."""
    return parts(map(len, texts), most_chars)


def text_parts(column: pa.Array, most_chars: int = 1 << 20) -> Iterator[tuple[int, int, list[str]]]:
    """(first, end, texts) of ranges of a column of texts, as ``pieces`` cuts them; NULL is empty.

    Only the texts of one range are Python strings at a time.
    """
    sizes = pc.fill_null(pc.utf8_length(column), 0)
    for a, b in parts(sizes.to_pylist(), most_chars):
        yield a, b, [t or "" for t in column.slice(a, b - a).to_pylist()]


class ByteBpe:
    """A byte-level BPE of the tokenizers library; special tokens in a text are ordinary text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        size = self.tokenizer.get_vocab_size()
        names = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.n_bytes = np.array([len(n) for n in names], np.int64)  # one letter of the byte alphabet per byte
        self.opens = np.array([n.startswith("Ġ") for n in names])  # the letter of the space
        self.ids = ChunkMemory(self._ids, 1)
        self.spans = ChunkMemory(self._spans, 3)

    def _ids(self, chunks: list[str]) -> tuple[list[str], np.ndarray, list[np.ndarray]]:
        """The library's ids of each chunk. Words with a space before them are encoded five hundred at a time, as
        one text; the space tells where the next begins."""
        order = [c for c in chunks if c[0] == " " and len(c) > 1 and not c.isspace()]
        others = [c for c in chunks if not (c[0] == " " and len(c) > 1 and not c.isspace())]
        ids, count = [], []
        lines = ["".join(order[a : a + 500]) for a in range(0, len(order), 500)]
        for found in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False):
            own = np.array(found.ids, np.int32)
            ids.append(own)
            count.append(np.diff(np.append(np.flatnonzero(self.opens[own]), len(own))))
        for found in self.tokenizer.encode_batch_fast(others, add_special_tokens=False):
            ids.append(np.array(found.ids, np.int32))
            count.append([len(found.ids)])
        return order + others, np.concatenate(count), [np.concatenate(ids)]

    def _spans(self, chunks: list[str]) -> tuple[list[str], np.ndarray, list[np.ndarray]]:
        """Ids with the first character and the end of each token; a token that holds part of a character
        counts as having it."""
        order, count, (ids,) = self._ids(chunks)
        octets = np.frombuffer("".join(order).encode("utf-8"), np.uint8)
        number = np.cumsum((octets & 0xC0) != 0x80) - 1  # of the character each byte belongs to
        ends = np.cumsum(self.n_bytes[ids])
        starts = ends - self.n_bytes[ids]
        width = np.fromiter(map(len, order), np.int64, len(order))
        shift = np.repeat(np.cumsum(width) - width, count)
        return order, count, [ids, number[starts] - shift, number[ends - 1] + 1 - shift]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each text, all ids)."""
        cut = stretches(texts)
        count, (ids,) = self.ids.rows(cut.distinct, cut.which)
        return _summed(count, cut.parts), ids

    def encode_with_special(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same, but what spells a special token becomes that token, as the library does by itself."""
        count, ids = self.encode(texts)
        spelt = [i for i, t in enumerate(texts) if any(name in t for name in self.special)]
        if spelt:
            parts = np.split(ids, np.cumsum(count)[:-1])
            self.tokenizer.encode_special_tokens = False
            try:
                for i in spelt:
                    parts[i] = np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, np.int32)
            finally:
                self.tokenizer.encode_special_tokens = True
            count, ids = np.array([len(x) for x in parts], np.int64), np.concatenate(parts)
        return count, ids

    def encode_spans(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(number of ids of each text, all ids, their first characters, their ends), in characters of the text."""
        cut = stretches(texts)
        count, (ids, start, end) = self.spans.rows(cut.distinct, cut.which)
        before = np.cumsum(cut.width) - cut.width
        first = np.cumsum(cut.parts) - cut.parts
        shift = before - np.repeat(before[np.minimum(first, max(len(before) - 1, 0))], cut.parts) if len(before) else before
        shift = np.repeat(shift, count)
        return _summed(count, cut.parts), ids, start + shift, end + shift


@dataclass(frozen=True)
class Stretches:
    """Texts cut where the byte-level pattern never joins: ``distinct[which]`` are the stretches in order."""

    parts: np.ndarray  # stretches of each text
    which: np.ndarray
    width: np.ndarray  # characters of each stretch
    distinct: list[str]


_IS_SPACE, _IS_LETTER, _IS_MARK = 1, 2, 4
#: Multiplier of the stretches' hashes, and its inverse modulo 2**64.
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """White space, letter and ASCII punctuation bits of every character."""
    kinds = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, range(0xD800))) + "\0" * 0x800 + "".join(map(chr, range(0xE000, 0x110000)))
    for bit, pattern in ((_IS_SPACE, f"[{_SPACE}]+"), (_IS_LETTER, r"[^\W\d_]+"), (_IS_MARK, r"[!-/:-@\[-`{-~]+")):
        for found in re.finditer(pattern, every):
            kinds[found.start() : found.end()] |= bit
    return kinds


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    found = []
    for step in (_STEP, _BACK):
        power = np.full(size + 1, step, np.uint64)
        power[0] = 1
        found.append(np.cumprod(power, dtype=np.uint64))
    return tuple(found)


def _borders(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """First characters of all stretches of texts that start at ``starts``, all at once.

    A run of characters other than white space takes the one space before it along; of the white space before it the last
    character stands apart from the rest. Letters at the beginning of such a run stand apart from a mark behind them.
    """
    kinds = _kinds()[codes]
    space = (kinds & _IS_SPACE) > 0
    turns = np.empty(len(codes), bool)
    turns[0] = True
    np.not_equal(space[1:], space[:-1], out=turns[1:])
    turns[starts] = True
    opens = np.zeros(len(codes), bool)
    opens[starts] = True
    border = turns.copy()
    words = np.flatnonzero(turns & ~space)
    led = words[~opens[words]]
    border[led - 1] = True
    border[led[codes[led - 1] == 32]] = False
    # letters from the beginning of a run up to a mark
    mark = np.flatnonzero((kinds[1:] & _IS_MARK > 0) & (kinds[:-1] & _IS_LETTER > 0)) + 1
    mark = mark[~turns[mark]]
    if len(mark):
        run = words[np.searchsorted(words, mark, "right") - 1]
        others = np.cumsum((kinds & _IS_LETTER) == 0)
        border[mark[(kinds[run] & _IS_LETTER > 0) & (others[mark - 1] == others[run])]] = True
    return np.flatnonzero(border)


def stretches(texts: list[str]) -> Stretches:
    """All stretches of some texts. Borders are found on the characters' kinds, equal stretches by a hash of their characters that
    is checked character by character; only distinct stretches become strings."""
    joined = "".join(texts)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    if not joined:
        none = np.zeros(0, np.int64)
        return Stretches(np.zeros(len(texts), np.int64), none, none, [])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    ends = np.cumsum(lengths)
    starts = _borders(codes, (ends - lengths)[lengths > 0])
    width = np.diff(np.append(starts, len(codes)))
    forth, back = _powers(1 << (len(codes)).bit_length())
    with np.errstate(over="ignore"):
        summed = np.concatenate([np.zeros(1, np.uint64), np.cumsum((codes + np.uint64(1)) * forth[: len(codes)])])
        mixed = (summed[starts + width] - summed[starts]) * back[starts]
    which, values = pd.factorize(mixed)
    first = np.empty(len(values), np.int64)
    first[which[::-1]] = np.arange(len(which) - 1, -1, -1)
    alike = codes[np.repeat(starts[first][which] - starts, width) + np.arange(len(codes))]
    if (width[first][which] == width).all() and (alike == codes).all():
        distinct = [joined[a:b] for a, b in zip(starts[first].tolist(), (starts + width)[first].tolist())]
    else:  # two stretches share a hash
        number: dict[str, int] = {}
        which = np.array([number.setdefault(joined[a:b], len(number)) for a, b in zip(starts.tolist(), (starts + width).tolist())])
        distinct = list(number)
    parts = np.searchsorted(starts, ends) - np.searchsorted(starts, ends - lengths)
    return Stretches(parts, which, width, distinct)


def _summed(count: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Sums of ``count`` over runs of the given lengths."""
    total = np.concatenate([[0], np.cumsum(count)])
    ends = np.cumsum(parts)
    return total[ends] - total[ends - parts]


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    """One encoder per worker; its memory outlives a task."""
    return ByteBpe(path)
