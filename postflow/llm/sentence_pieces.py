"""SentencePiece encoding and decoding with a suffix array over the text of a batch."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postflow.llm.chunks import ChunkMemory, _summed, pieces, text_parts
from postflow.llm.common import free_name

#: What the normaliser writes for a space.
MARK = "▁"
#: Symbols per packed key; a symbol takes 16 bits.
_PER_KEY = 4
#: Characters whose suffixes are sorted at once; their edges take some 400 bytes for each.
_AT_ONCE = 1 << 17
#: Pairs of pieces a worker remembers.
_PAIRS = 200_000


def merged(symbols: list[str], rank: dict[str, int]) -> tuple[list[str], tuple[str, str] | None]:
    """Byte-pair merges as the model defines them: the best-ranked adjacent pair first, the leftmost among equals.
    Returns the symbols left and the last pair merged."""
    last = None
    while len(symbols) > 1:
        best = min(range(len(symbols) - 1), key=lambda i: (rank.get(symbols[i] + symbols[i + 1], len(rank)), i))
        if symbols[best] + symbols[best + 1] not in rank:
            break
        last = (symbols[best], symbols[best + 1])
        symbols[best : best + 2] = ["".join(last)]
    return symbols, last


class PieceLattice:
    """Finds a BPE model's segmentation of many short strings at once. Every piece must rank behind its two parts, as
    in any vocabulary that merging has made.

    The strings are laid end to end and a suffix array is built over them; every piece's occurrences are a range of
    it, found by binary search. The occurrences are the edges of a lattice, sorted by where they end. An edge is
    taken if its start is reached and the piece that ends there may stand before it, that is, if merging the two
    pieces' characters gives just these two again. A BPE segmentation is the only one in which all neighbours
    may stand together, so one edge at most is taken for each place; no scores need be added up.

    Numbers: the symbols of the model's alphabet come first, then longer pieces by rank.
    """

    def __init__(self, names: list[str], scores: list[float]):
        """``names`` and ``scores`` of the pieces that match text; a higher score merges first."""
        self.alphabet = sorted({c for name in names for c in name})
        score = dict(zip(names, scores))
        longer = sorted((n for n in score if len(n) > 1), key=lambda n: -score[n])
        rank = {name: i for i, name in enumerate(longer)}
        splits = {name: pair for name in longer for left, pair in [merged(list(name), rank)] if left == [name]}
        if any(rank.get(part, -1) > rank[name] for name, pair in splits.items() for part in pair):
            raise ValueError("a piece that merges before its parts is no byte-pair vocabulary")
        self.names = [*self.alphabet, *(n for n in longer if n in splits)]
        self.number = {name: i for i, name in enumerate(self.names)}
        base = len(self.alphabet)
        # both parts of a piece's last merge; a symbol is its own part
        self.left = np.array([*range(base), *(self.number[splits[n][0]] for n in self.names[base:])], np.int64)
        self.right = np.array([*range(base), *(self.number[splits[n][1]] for n in self.names[base:])], np.int64)
        pairs = sorted(
            (self.number[n[:k]] * len(self.names) + self.number[n[k:]], self.number[n])
            for n in self.names[base:] for k in range(1, len(n)) if n[:k] in self.number and n[k:] in self.number
        )
        self.pair_key = np.array([k for k, _ in pairs] or [-1], np.int64)
        self.pair_made = np.array([m for _, m in pairs] or [0], np.int64)
        self.width = np.array([len(n) for n in self.names], np.int64)
        self.longest = int(self.width.max(initial=1))
        self.keys = -(-self.longest // _PER_KEY)
        # symbols as numbers from 1; 0 stands for the end of a string
        code = {c: i + 1 for i, c in enumerate(self.alphabet)}
        spelled = np.zeros((len(self.names), self.keys * _PER_KEY), np.uint64)
        for i, name in enumerate(self.names):
            spelled[i, : len(name)] = [code[c] for c in name]
        self.lowest = self._packed(spelled)
        inside = np.arange(spelled.shape[1]) < self.width[:, None]
        self.highest = self._packed(np.where(inside, spelled, np.uint64(0xFFFF)))
        points = np.array([ord(c) for c in self.alphabet], np.int64)
        self._points = points
        self._forget_pairs()

    def _forget_pairs(self) -> None:
        self._pairs, self._pair_fits = np.zeros(0, np.int64), np.zeros(0, bool)  # sorted

    @staticmethod
    def _packed(symbols: np.ndarray) -> list[np.ndarray]:
        shift = np.uint64(16) * np.arange(_PER_KEY - 1, -1, -1, dtype=np.uint64)
        return [(symbols[:, i : i + _PER_KEY] << shift).sum(axis=1, dtype=np.uint64) for i in range(0, symbols.shape[1], _PER_KEY)]

    def _suffixes(self, symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The suffixes in order, as far as the longest piece reaches, and their packed symbols in that order."""
        n = len(symbols)
        padded = np.append(symbols, np.zeros(self.keys * _PER_KEY, np.uint64))
        four = np.zeros(n + self.keys * _PER_KEY, np.uint64)
        for k in range(_PER_KEY):
            four[: n + self.keys * _PER_KEY - k] |= padded[k:] << np.uint64(16 * (_PER_KEY - 1 - k))
        keys = [four[_PER_KEY * i : _PER_KEY * i + n] for i in range(self.keys)]
        order = np.lexsort(keys[::-1])
        return order, [k[order] for k in keys]

    @staticmethod
    def _search(table: list[np.ndarray], wanted: list[np.ndarray], after: bool) -> np.ndarray:
        """Binary search of all wanted keys at once: how many entries are smaller (``after``: or equal)."""
        low, high = np.zeros(len(wanted[0]), np.int64), np.full(len(wanted[0]), len(table[0]), np.int64)
        while (open_ := low < high).any():
            middle = (low + high) // 2
            at = np.minimum(middle, len(table[0]) - 1)
            less, same = np.zeros(len(low), bool), np.ones(len(low), bool)
            for have, want in zip(table, wanted):
                value = have[at]
                less |= same & (value < want)
                same &= value == want
            go = (less | same if after else less) & open_
            low = np.where(go, middle + 1, low)
            high = np.where(open_ & ~go, middle, high)
        return low

    def fits(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """May piece ``two`` follow piece ``one``? Undoes the later of the two last merges, again and again, and asks
        whether the parts that then touch would have merged before it."""
        n = len(self.names)
        a, b = one.copy(), two.copy()
        limit = np.full(len(a), np.iinfo(np.int64).max)
        good, todo = np.ones(len(a), bool), np.arange(len(a))
        while len(todo):
            x, y = a[todo], b[todo]
            key = x * n + y
            at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
            clash = (self.pair_key[at] == key) & (self.pair_made[at] < limit[todo])
            good[todo[clash]] = False
            todo, x, y = todo[~clash], x[~clash], y[~clash]
            # parts of a piece: those of the later merge are looked at first, among equals the right piece's
            left_later = x > y
            part_x, part_y = self.right[x], self.left[y]
            new_x = np.where(left_later, part_x, np.where(part_y == y, part_x, x))
            new_y = np.where(left_later, np.where(part_x == x, part_y, y), part_y)
            undone_left = np.where(left_later, part_x != x, part_y == y)
            new_limit = np.where(undone_left, x, y + 1)
            stuck = (new_x == x) & (new_y == y)
            a[todo], b[todo] = new_x, new_y
            limit[todo] = new_limit
            todo = todo[~stuck]
        return good

    def _may_follow(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """``fits``, worked out once for each different pair."""
        key = one * len(self.names) + two
        unique, back = np.unique(key, return_inverse=True)
        at = np.searchsorted(self._pairs, unique)
        held = np.zeros(len(unique), bool)
        inside = np.flatnonzero(at < len(self._pairs))
        held[inside] = self._pairs[at[inside]] == unique[inside]
        good = np.zeros(len(unique), bool)
        good[held] = self._pair_fits[at[held]]
        new = np.flatnonzero(~held)
        if len(new):
            good[new] = self.fits(unique[new] // len(self.names), unique[new] % len(self.names))
            if len(self._pairs) > _PAIRS:
                self._forget_pairs()
            at = np.searchsorted(self._pairs, unique[new])
            self._pairs, self._pair_fits = np.insert(self._pairs, at, unique[new]), np.insert(self._pair_fits, at, good[new])
        return good[back]

    def segment(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(pieces of each string, their numbers), for strings over the model's alphabet."""
        width = np.fromiter(map(len, strings), np.int64, len(strings))
        codes = np.frombuffer("\0".join([*strings, ""]).encode("utf-32-le"), np.uint32).astype(np.int64)
        ends_at = np.cumsum(width + 1) - 1  # the zero behind each string
        symbols = np.searchsorted(self._points, codes).astype(np.uint64) + np.uint64(1)
        symbols[ends_at] = 0
        order, table = self._suffixes(symbols)
        low, high = self._search(table, self.lowest, False), self._search(table, self.highest, True)
        count = high - low
        piece = np.repeat(np.arange(len(self.names)), count)
        place = order[np.repeat(low - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))]
        start_of = np.repeat(ends_at - width, width + 1)
        finish = place + self.width[piece]
        relative = finish - start_of[place]
        edges = np.argsort(relative, kind="stable")
        piece, place, finish, relative = piece[edges], place[edges], finish[edges], relative[edges]
        taken = np.full(len(codes) + 1, -1, np.int64)  # the piece that ends before a place
        taken[ends_at - width] = -2
        bounds = np.searchsorted(relative, np.arange(1, int(width.max(initial=0)) + 2))
        for a, b in zip(bounds, bounds[1:]):
            before = taken[place[a:b]]
            good = before == -2
            inner = np.flatnonzero(before >= 0)
            if len(inner):
                good[inner] = self._may_follow(before[inner], piece[a:b][inner])
            taken[finish[a:b][good]] = piece[a:b][good]
        at, live, back = ends_at.copy(), np.flatnonzero(width > 0), []
        owner = []
        while len(live):  # from the ends to the starts, all strings side by side
            own = taken[at[live]]
            back.append(own)
            owner.append(live)
            at[live] -= self.width[own]
            live = live[at[live] > (ends_at - width)[live]]
        if not back:
            return np.zeros(len(strings), np.int64), np.zeros(0, np.int64)
        depth = np.repeat(np.arange(len(back)), [len(x) for x in back])
        flat, whose = np.concatenate(back), np.concatenate(owner)
        return np.bincount(whose, minlength=len(strings)), flat[np.lexsort((-depth, whose))]


class Pieces:
    """Encoder and decoder of one BPE model file with byte fallback.

    The library reads the model file and normalises texts; segmentation is done by ``PieceLattice``, for
    stretches between places that no piece crosses, each different stretch once per worker.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.names = [model.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))]
        if any(MARK in self.names[i].lstrip(MARK) for i in plain):
            raise ValueError("pieces that hold a space behind other characters are not supported")
        self.id_of = {self.names[i]: i for i in plain}
        self.byte_id = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        self.lattice = PieceLattice([self.names[i] for i in plain], [model.get_score(i) for i in plain])
        # symbols without a piece of their own fall back to their bytes
        spelled = [[self.id_of[n]] if n in self.id_of else self.byte_id[list(n.encode("utf-8"))].tolist() for n in self.lattice.names]
        self._width = np.array([len(s) for s in spelled], np.int64)
        self._spelled = np.array([i for s in spelled for i in s], np.int32)
        known = "".join(re.escape(c) for c in self.lattice.alphabet if c != MARK)
        # marks with what follows them, other known characters, and characters of no piece one by one
        self._stretch = re.compile(f"{MARK}+[{known}]*|[{known}]+|.", re.DOTALL)
        self._alphabet = set(self.lattice.alphabet)
        self._memory = ChunkMemory(self._encode, 1, most_chunks=300_000)
        spell = {i: bytes([b]) for b, i in enumerate(self.byte_id.tolist())}
        own = set(plain)
        self._bytes = [spell[i] if i in spell else (n.replace(MARK, " ").encode("utf-8") if i in own else b"") for i, n in enumerate(self.names)]

    def _encode(self, chunks: list[str]) -> tuple[list[str], np.ndarray, list[np.ndarray]]:
        inside = [c for c in chunks if c[0] in self._alphabet]
        outside = [c for c in chunks if c[0] not in self._alphabet]
        numbers, counts = [], []
        for a, b in pieces(inside, _AT_ONCE):
            count, found = self.lattice.segment(inside[a:b])
            numbers.append(found)
            counts.append(count)
        count = np.concatenate([*counts, np.ones(len(outside), np.int64)])
        base = len(self._width)
        flat = np.concatenate([*numbers, base + np.arange(len(outside))]) if len(count) else np.zeros(0, np.int64)
        fallen = [self.byte_id[list(c.encode("utf-8"))] for c in outside]
        width = np.append(self._width, [len(s) for s in fallen]).astype(np.int64)
        ids = np.concatenate([self._spelled, *fallen])
        ends = np.cumsum(width)
        each = width[flat]
        at = np.repeat(ends[flat] - width[flat] - (np.cumsum(each) - each), each) + np.arange(int(each.sum()))
        return inside + outside, _summed(each, count), [ids[at]]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each text, all ids)."""
        parts, chunks = [], []
        for text in self.model.normalize(texts):
            own = self._stretch.findall(text)
            parts.append(len(own))
            chunks.extend(own)
        count, (ids,) = self._memory.rows(chunks)
        return _summed(count, np.array(parts, np.int64)), ids

    def decode(self, ids: list[int]) -> str:
        """The text of some ids: bytes that are no UTF-8 become replacement characters, and the space that the
        normaliser puts first is taken off."""
        spelled = self._bytes
        text = b"".join([spelled[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=2)
def piece_model(path: str) -> Pieces:
    """One model per worker."""
    return Pieces(path)


_OUT = pa.schema([("row", pa.int64()), ("id", pa.int64()), ("n_ids", pa.int64()), ("ids", pa.list_(pa.int32())), ("same", pa.bool_())])


def _encoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in batches:
            for a, b, texts in text_parts(batch.column(2)):
                count, ids = model.encode(texts)
                ends = np.cumsum(count)
                flat = ids.tolist()
                same = [model.decode(flat[e - n : e]) == t for t, n, e in zip(texts, count.tolist(), ends.tolist())]
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(count), lists, pa.array(same)], schema=_OUT
                )

    return run


def _decoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in batches:
            lists = batch.column(2).to_pylist()
            texts = [None if ids is None else model.decode([i for i in ids if i is not None]) for ids in lists]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["row", "id", "text"])

    return run


def encode_pieces(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", *, row_col: str | None = None) -> DataFrame:
    """Ids of every text under a SentencePiece BPE model: (row, id, n_ids, ids, same).

    ``same`` says whether decoding the ids gives the text back (it does but for texts that hold the space mark
    U+2581 itself, or that the model's normaliser changes). NULL and empty texts have no ids. A NULL id stays
    NULL, repeated rows are encoded each, other columns are not read. Long texts are taken in
    parts of the batch; nothing is shuffled.
    """
    row = row_col or free_name(docs.columns, "row_no")
    source = docs if row_col else docs.withColumn(row, F.monotonically_increasing_id())
    narrow = source.select(F.col(row).alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(_encoded(model), "row long, id long, n_ids long, ids array<int>, same boolean")


def decode_pieces(encoded: DataFrame, model: str, row_col: str = "row", id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """(row, id, text) of lists of ids; control ids are dropped, NULL lists give NULL, empty ones empty texts."""
    narrow = encoded.select(F.col(row_col).alias("row"), F.col(id_col).cast("long").alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return narrow.mapInArrow(_decoded(model), "row long, id long, text string")
