"""Toxicity scores by a bidirectional gated recurrent network with attention, trained and run in numpy."""

from __future__ import annotations

import string
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postflow.llm.chunks import text_parts
from postflow.llm.common import free_name

#: Marks that may stand around a word.
_MARKS = string.punctuation + "\u00a1\u00bf\u00ab\u00bb\u2013\u2014\u2018\u2019\u201c\u201d\u201e\u2026"


@dataclass(frozen=True)
class Shape:
    """Sizes of the network, in words and numbers. The word table holds words that ``least_docs`` training
    documents have, the most frequent ones if it is too small for all."""

    window: int = 32
    stride: int = 16
    word_slots: int = 8192
    least_docs: int = 5
    char_slots: int = 4096
    word_size: int = 8
    char_size: int = 8
    hidden: int = 8
    attention: int = 8


def bare(word: str) -> str:
    """A word with case folded, without the marks around it."""
    return word.lower().strip(_MARKS)


def word_inputs(words: list[str], vocabulary: dict[str, int], shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of each word in the word table, rows of the character triples of all words, triples of each word).

    ``words`` are bare. Words outside the vocabulary share row 0; triples include a word's start and end.
    """
    slot = np.fromiter((vocabulary.get(w, 0) for w in words), np.int64, len(words))
    codes = np.frombuffer(("^" + "$^".join([*words, "^"])).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    mixed = codes[:-2] * np.uint64(0x9E3779B1) + codes[1:-1] * np.uint64(0x85EBCA77) + codes[2:] * np.uint64(0xC2B2AE3D)
    mixed = ((mixed ^ (mixed >> np.uint64(15))) % np.uint64(shape.char_slots)).astype(np.int64)
    width = np.fromiter(map(len, words), np.int64, len(words))
    count = np.maximum(width, 1)
    first = np.cumsum(width + 2) - (width + 2)
    at = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    return slot, mixed[at], count


def tokens(text: str | None) -> list[str]:
    """The words of a text, all of them."""
    return (text or "").split()


def windows(n: int, shape: Shape) -> list[int]:
    """Starts of overlapping windows that cover ``n`` words; a text without words has one empty window."""
    return [0] if n <= shape.window else [*range(0, n - shape.window, shape.stride), n - shape.window]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * (np.tanh(np.float32(0.5) * x) + np.float32(1))


@dataclass
class Network:
    """Two gated recurrent layers (one per direction) over word and character inputs, pooled by attention.

    A step has update, reset and candidate gates; places behind a window's last word leave the state as it is and
    get no attention. All numbers are 32-bit.
    """

    shape: Shape
    weights: dict[str, np.ndarray] = field(default_factory=dict)
    vocabulary: dict[str, int] = field(default_factory=dict)

    @classmethod
    def fresh(cls, shape: Shape, vocabulary: dict[str, int] | None = None, seed: int = 11) -> Network:
        rng = np.random.default_rng(seed)
        s, h, size = shape, shape.hidden, shape.word_size + shape.char_size
        draw = lambda *d, scale: (rng.standard_normal(d) * scale).astype(np.float32)
        weights = {
            "word": draw(s.word_slots, s.word_size, scale=0.3), "char": draw(s.char_slots, s.char_size, scale=0.3),
            "input": draw(2, size, 3 * h, scale=size**-0.5), "state": draw(2, h, 3 * h, scale=h**-0.5), "bias": np.zeros((2, 1, 3 * h), np.float32),
            "look": draw(2 * h, s.attention, scale=(2 * h) ** -0.5), "weigh": draw(s.attention, scale=s.attention**-0.5),
            "out": draw(2 * h, scale=(2 * h) ** -0.5), "offset": np.zeros(1, np.float32),
        }
        weights["word"][0] = 0
        return cls(shape, weights, vocabulary or {})

    def embed(self, word_slot: np.ndarray, char_slot: np.ndarray, char_count: np.ndarray) -> np.ndarray:
        """Inputs of words: the word's own vector and the mean of its character triples' vectors."""
        ends = np.cumsum(char_count)
        total = np.add.reduceat(self.weights["char"][char_slot], ends - char_count, axis=0) if len(char_slot) else np.zeros((0, self.shape.char_size), np.float32)
        return np.concatenate([self.weights["word"][word_slot], total / char_count[:, None].astype(np.float32)], axis=1)

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows. ``x``: (places, windows, size); ``mask``: (places, windows), 1 where a word is."""
        w, h = self.weights, self.shape.hidden
        steps, n = mask.shape
        both = np.stack([x, x[::-1]])
        m = np.stack([mask, mask[::-1]])[..., None].astype(np.float32)
        drive = (both.reshape(2, steps * n, -1) @ w["input"] + w["bias"]).reshape(2, steps, n, 3 * h)
        state, states, kept = np.zeros((2, n, h), np.float32), np.empty((2, steps, n, h), np.float32), []
        for t in range(steps):
            back = state @ w["state"]
            gates = _sigmoid(drive[:, t, :, : 2 * h] + back[..., : 2 * h])
            z, r = gates[..., :h], gates[..., h:]
            c = np.tanh(drive[:, t, :, 2 * h :] + r * back[..., 2 * h :])
            if keep:
                kept.append((state, back, z, r, c))
            state = state + m[:, t] * (np.float32(1) - z) * (c - state)
            states[:, t] = state
        joint = np.concatenate([states[0], states[1][::-1]], axis=2)
        seen = np.tanh(joint @ w["look"])
        score = np.where(mask > 0, seen @ w["weigh"], np.float32(-1e9))
        weight = np.exp(score - score.max(axis=0)) * mask
        weight = (weight / np.maximum(weight.sum(axis=0), np.float32(1e-9))).astype(np.float32)
        pooled = np.einsum("tn,tnh->nh", weight, joint)
        logit = pooled @ w["out"] + w["offset"]
        return (logit, (both, m, kept, joint, seen, weight, pooled)) if keep else logit

    def backward(self, error: np.ndarray, kept, mask: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of all weights but the embeddings, and of the inputs, from the error of the logits."""
        w, h = self.weights, self.shape.hidden
        both, m, steps_kept, joint, seen, weight, pooled = kept
        steps, n = mask.shape
        grad = {"out": pooled.T @ error, "offset": np.array([error.sum()], np.float32)}
        d_pooled = error[:, None] * w["out"]
        d_weight = np.einsum("nh,tnh->tn", d_pooled, joint)
        d_joint = weight[..., None] * d_pooled
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        grad["weigh"] = np.einsum("tn,tna->a", d_score, seen)
        d_seen = d_score[..., None] * w["weigh"] * (1 - seen * seen)
        grad["look"] = np.einsum("tnh,tna->ha", joint, d_seen)
        d_joint = d_joint + d_seen @ w["look"].T
        d_states = np.stack([d_joint[..., :h], d_joint[::-1, :, h:]])
        d_drive, d_state = np.empty((2, steps, n, 3 * h), np.float32), np.zeros((2, n, h), np.float32)
        grad["state"] = np.zeros_like(w["state"])
        for t in range(steps - 1, -1, -1):
            before, back, z, r, c = steps_kept[t]
            d = d_state + d_states[:, t]
            moved = m[:, t] * d
            d_c = moved * (1 - z) * (1 - c * c)
            d_z = -moved * (c - before) * z * (1 - z)
            d_r = d_c * back[..., 2 * h :] * r * (1 - r)
            d_drive[:, t] = np.concatenate([d_z, d_r, d_c], axis=2)
            d_back = np.concatenate([d_z, d_r, d_c * r], axis=2)
            grad["state"] += before.transpose(0, 2, 1) @ d_back
            d_state = d - moved * (1 - z) + d_back @ w["state"].transpose(0, 2, 1)
        flat = d_drive.reshape(2, steps * n, 3 * h)
        grad["bias"] = flat.sum(axis=1, keepdims=True)
        grad["input"] = both.reshape(2, steps * n, -1).transpose(0, 2, 1) @ flat
        d_both = (flat @ w["input"].transpose(0, 2, 1)).reshape(both.shape)
        return grad, d_both[0] + d_both[1][::-1]


class _Adam:
    """Adam with decaying moments; of tables only the touched rows move."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float):
        self.weights, self.rate, self.t = weights, rate, 0
        self.first = {k: np.zeros_like(v) for k, v in weights.items()}
        self.second = {k: np.zeros_like(v) for k, v in weights.items()}

    def step(self, grad: dict[str, np.ndarray], rows: dict[str, np.ndarray]) -> None:
        self.t += 1
        for name, g in grad.items():
            at = rows.get(name, slice(None))
            a = self.first[name][at] = 0.9 * self.first[name][at] + 0.1 * g
            b = self.second[name][at] = 0.999 * self.second[name][at] + 0.001 * g * g
            move = self.rate * (a / (1 - 0.9**self.t)) / (np.sqrt(b / (1 - 0.999**self.t)) + 1e-8)
            self.weights[name][at] -= move.astype(np.float32)


def _grid(numbers: np.ndarray, starts: np.ndarray, ends: np.ndarray, shape: Shape) -> np.ndarray:
    """(places, windows) of word numbers, 0 behind the end of a window's text; ``numbers`` end with a 0 of no word."""
    at = starts + np.arange(shape.window)[:, None]
    return np.where(at < ends, numbers[np.minimum(at, len(numbers) - 1)], 0)


def _numbered(examples: Iterable[tuple[int, str, int]]) -> tuple[dict[str, int], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(number of each bare word, from 1; numbers of all words and a 0; words, document and label of each example).

    Each distinct word is held once, and every other one is four bytes.
    """
    known: dict[str, int] = {}
    numbers, length, doc, label = array("i"), array("q"), array("q"), array("f")
    for number, text, y in examples:
        before = len(numbers)
        numbers.extend(known.setdefault(bare(w), len(known) + 1) for w in text.split())
        length.append(len(numbers) - before)
        doc.append(number)
        label.append(y)
    numbers.append(0)
    return known, np.frombuffer(numbers, np.int32), np.array(length, np.int64), np.array(doc, np.int64), np.array(label, np.float32)


def _documents_with(numbers: np.ndarray, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray, words: int) -> np.ndarray:
    """In how many documents each word is, by its number."""
    found, order = np.zeros(words + 1, np.int64), np.argsort(doc, kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(doc[order])) + 1) if len(order) else []:
        found[np.unique(np.concatenate([numbers[starts[i] : ends[i]] for i in own]))] += 1
    return found


def train(examples: Iterable[tuple[int, str, int]], shape: Shape = Shape(), *, passes: int = 7, batch: int = 512, steps: int = 100, rate: float = 0.01, seed: int = 11) -> Network:
    """Fit on (document number, window text, document label).

    A label says that some window of the document is toxic, not which. At first every window takes its document's label;
    after three passes, only the highest-scoring window of a toxic document keeps it, and the others are left out.
    Windows of other documents are examples of 0 all the time. Small sets are taken in smaller batches than ``batch``, so
    that a pass has about ``steps`` steps. Examples are read once, and their texts are not kept.
    """
    known, numbers, length, doc, label = _numbered(examples)
    ends = np.cumsum(length)
    starts = ends - length
    in_docs = _documents_with(numbers, starts, ends, doc, len(known))
    frequent = sorted((w for w, i in known.items() if in_docs[i] >= shape.least_docs), key=lambda w: (-in_docs[known[w]], w))
    net = Network.fresh(shape, {w: i for i, w in enumerate(frequent[: shape.word_slots - 1], 1)}, seed)
    word_slot, char_slot, char_count = word_inputs(["", *known], net.vocabulary, shape)
    char_end = np.cumsum(char_count)
    adam, rng = _Adam(net.weights, rate), np.random.default_rng(seed)

    def gather(columns: np.ndarray):
        grid = _grid(numbers, starts[columns], ends[columns], shape)
        used, back = np.unique(grid, return_inverse=True)
        count = char_count[used]
        at = np.repeat(char_end[used] - count - (np.cumsum(count) - count), count) + np.arange(count.sum())
        return used, back.reshape(grid.shape), char_slot[at], count, (grid > 0).astype(np.float32)

    def logits(columns: np.ndarray) -> np.ndarray:
        used, place, chars, count, mask = gather(columns)
        return net.forward(net.embed(word_slot[used], chars, count)[place], mask)

    for turn in range(passes if len(doc) else 0):
        chosen = np.arange(len(doc))
        if turn >= 3:
            score = np.concatenate([logits(chosen[a : a + batch]) for a in range(0, len(chosen), batch)])
            order = np.lexsort((-score, doc))
            top = np.zeros(len(chosen), bool)
            top[order[np.unique(doc[order], return_index=True)[1]]] = True
            chosen = chosen[(label == 0) | top]
        rng.shuffle(chosen)
        size = max(16, min(batch, len(chosen) // steps))
        for a in range(0, len(chosen), size):
            columns = chosen[a : a + size]
            used, place, chars, count, mask = gather(columns)
            logit, kept = net.forward(net.embed(word_slot[used], chars, count)[place], mask, keep=True)
            error = ((_sigmoid(logit) - label[columns]) / len(columns)).astype(np.float32)
            grad, d_x = net.backward(error, kept, mask)
            flat, at = d_x.reshape(-1, d_x.shape[2]), place.ravel()
            by_word = np.stack([np.bincount(at, flat[:, k], len(used)) for k in range(flat.shape[1])], axis=1)
            rows = {}
            for name, slots, parts in (
                ("word", word_slot[used], by_word[:, : shape.word_size]),
                ("char", chars, np.repeat(by_word[:, shape.word_size :] / count[:, None], count, axis=0)),
            ):
                rows[name], where = np.unique(slots, return_inverse=True)
                grad[name] = np.stack([np.bincount(where, parts[:, k], len(rows[name])) for k in range(parts.shape[1])], axis=1)
                if name == "word":
                    grad[name][rows[name] == 0] = 0  # words outside the vocabulary have no vector of their own
            adam.step(grad, rows)
    return net


class Scorer:
    """A trained network with the input vectors of the words a worker has met; bounded, and forgotten when full."""

    def __init__(self, net: Network, most_words: int = 200_000):
        self.net, self.most_words = net, most_words
        self._forget()

    def _forget(self) -> None:
        size = self.net.shape.word_size + self.net.shape.char_size
        self.number: dict[str, int] = {}
        self.table, self.used = np.zeros((4096, size), np.float32), 1  # row 0: no word

    def _numbers(self, words: list[str]) -> np.ndarray:
        new = set(words).difference(self.number)
        if new:
            if len(self.number) > self.most_words:
                self._forget()
                new = set(words)
            order = list(new)
            vectors = self.net.embed(*word_inputs([bare(w) for w in order], self.net.vocabulary, self.net.shape))
            end = self.used + len(order)
            if end > len(self.table):
                self.table = np.concatenate([self.table[: self.used], np.zeros((max(end, self.used), self.table.shape[1]), np.float32)])
            self.table[self.used : end] = vectors
            self.number.update(zip(order, range(self.used, end)))
            self.used = end
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))

    def scores(self, texts: list[str], at_once: int = 2048) -> np.ndarray:
        """Probability of each text: that of its most toxic window."""
        shape, words, starts, ends, owner = self.net.shape, [], [], [], []
        for i, text in enumerate(texts):
            own = tokens(text)
            base = len(words)
            words += own
            for start in windows(len(own), shape):
                starts.append(base + start)
                ends.append(base + min(start + shape.window, len(own)))
                owner.append(i)
        numbers = np.append(self._numbers(words), 0)
        starts, ends, owner = np.array(starts, np.int64), np.array(ends, np.int64), np.array(owner, np.int64)
        best = np.full(len(texts), -np.inf)
        for a in range(0, len(starts), at_once):
            grid = _grid(numbers, starts[a : a + at_once], ends[a : a + at_once], shape)
            logit = self.net.forward(self.table[grid], (grid > 0).astype(np.float32))
            np.maximum.at(best, owner[a : a + at_once], logit)
        return 1 / (1 + np.exp(-best.astype(np.float64)))


def held_out(id_col: Column, folds: int = 4, fold: int = 2) -> Column:
    """Rows whose crc32 of the id as text leaves ``fold``; a NULL id never does."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == fold, F.lit(False))


def _cut(shape: Shape, most: int):
    """Windows of training documents, side by side; of very long ones ``most``, evenly spread."""

    def run(frames):
        import pandas as pd

        for frame in frames:
            out = []
            for number, text, label in zip(frame["number"], frame["text"], frame["label"]):
                words = tokens(text)
                starts = [*range(0, max(len(words), 1), shape.window)]
                for k in np.unique(np.linspace(0, len(starts) - 1, min(most, len(starts))).astype(int)):
                    out.append((number, " ".join(words[starts[k] : starts[k] + shape.window]), label))
            yield pd.DataFrame(out, columns=["number", "text", "label"])

    return run


def _in_order(rows: pa.Table, at_once: int = 1024) -> Iterator[tuple[int, str, int]]:
    """(number, text, label) by number and text; only a few at a time are Python objects."""
    order = pc.sort_indices(rows, [("number", "ascending"), ("text", "ascending")])
    for a in range(0, len(order), at_once):
        part = rows.take(order[a : a + at_once])
        yield from zip(*(part[name].to_pylist() for name in ("number", "text", "label")))


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    *, shape: Shape = Shape(), most_toxic: int = 1200, most_clean: int = 3600, most_windows: int = 32, **training,
) -> Network:
    """Train on a bounded sample of the labelled rows that are not held out.

    The sample: the ``most_toxic`` and ``most_clean`` labelled ids with the smallest hash, ``most_windows`` windows of
    each at most; that is all that reaches the driver, and it is the only thing in this operator that does not
    cover all rows. Ids without a label, NULL ids and NULL labels are not used; an id labelled twice counts
    as toxic if one label says so, and of several texts with one id the one with the smallest hash is taken. Without labels the network is untrained and scores are near one half.
    """
    known = labels.where(~held_out(F.col(id_col)) & F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    known = known.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
    order = F.xxhash64("id")
    sample = known.where("label = 1").orderBy(order, "id").limit(most_toxic).unionByName(known.where("label = 0").orderBy(order, "id").limit(most_clean))
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    chosen = source.join(F.broadcast(sample), "id").groupBy("id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    chosen = chosen.select(F.col("id").alias("number"), "text", "label")
    rows = chosen.mapInPandas(_cut(shape, most_windows), "number long, text string, label int")
    return train(_in_order(rows.toArrow()), shape, **training)


def _scored(net: Network):
    holder: list[Scorer] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not holder:
            holder.append(Scorer(net))
        for batch in batches:
            found = [holder[0].scores(texts) for _, _, texts in text_parts(batch.column(2), 1 << 19)]
            score = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score)], ["row", "id", "score"])

    return run


def toxicity(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text", *, threshold: float = 0.3, row_col: str | None = None) -> DataFrame:
    """(row, id, held_out, score, predicted) of every row: the score of the text's most toxic window.

    Windows overlap and cover the whole text; only the text is looked at. NULL and empty texts are one
    window without words and have the network's base score. A NULL id is kept and not held out. Repeated rows
    get equal scores. Other columns are not read. Nothing is shuffled; the network (under 1 MB) goes out with
    the tasks.
    """
    row = row_col or free_name(docs.columns, "row_no")
    source = docs if row_col else docs.withColumn(row, F.monotonically_increasing_id())
    narrow = source.select(F.col(row).alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    scored = narrow.mapInArrow(_scored(net), "row long, id long, score double")
    return scored.select("row", "id", held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def _harmless(net: Network, threshold: float, text_at: int):
    holder: list[Scorer] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not holder:
            holder.append(Scorer(net))
        for batch in batches:
            score = np.concatenate([holder[0].scores(texts) for _, _, texts in text_parts(batch.column(text_at), 1 << 19)] or [np.zeros(0)])
            yield batch.filter(pa.array(score < threshold))

    return run


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, threshold: float = 0.3, **options) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns and as often as they come; nothing is shuffled.

    NULL and empty texts have the network's base score (see :func:`toxicity`), which decides about them too.
    """
    net = fit(docs, labels, id_col, text_col, **options)
    return docs.mapInArrow(_harmless(net, threshold, docs.columns.index(text_col)), docs.schema)
