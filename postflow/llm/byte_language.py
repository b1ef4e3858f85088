"""Language of texts by a bidirectional gated recurrent network over bytes, trained and run in numpy."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What is returned for texts without a language.
UNKNOWN = "und"
#: Input number of places behind the end of a text.
NOTHING = 256


def _softmax(logits: np.ndarray) -> np.ndarray:
    """Over the last axis. Logits are sums of few bounded states, so they are limited instead of shifted by their largest."""
    grown = np.exp(np.clip(logits, -40, 40, out=logits), out=logits)
    return np.divide(grown, grown @ np.ones((grown.shape[-1], 1), np.float32), out=grown)


@dataclass
class ByteNetwork:
    """One gated recurrent layer per direction over the bytes of a window; every place gets a label.

    ``drive`` holds what each byte adds to the update gate, the reset gate and the candidate state of each direction
    (two directions, 257 inputs, 3 * hidden), ``state`` what the state before adds (two, hidden, 3 * hidden); ``out``
    and ``offset`` turn both states of a place into logits of the languages. All numbers are 32-bit.
    """

    languages: list[str]
    weights: dict[str, np.ndarray]
    window: int = 64

    @classmethod
    def fresh(cls, languages: Sequence[str], hidden: int = 8, window: int = 64, seed: int = 5) -> ByteNetwork:
        rng = np.random.default_rng(seed)
        draw = lambda *d, scale: (rng.standard_normal(d) * scale).astype(np.float32)
        weights = {
            "drive": draw(2, 257, 3 * hidden, scale=0.5), "state": draw(2, hidden, 3 * hidden, scale=hidden**-0.5),
            "out": draw(2 * hidden, len(languages), scale=(2 * hidden) ** -0.5), "offset": np.zeros(len(languages), np.float32),
        }
        net = cls(list(languages), weights, window)
        net.close()
        return net

    def close(self) -> None:
        """Places behind the end leave the state as it is: their update gate is shut, whatever the state adds."""
        hidden = self.weights["state"].shape[1]
        self.weights["drive"][:, NOTHING] = 0
        self.weights["drive"][:, NOTHING, :hidden] = 60

    def states(self, places: np.ndarray, keep: list | None = None) -> np.ndarray:
        """(places, windows, 2 * hidden) of byte numbers (places, windows): both directions, each at its place."""
        w = self.weights
        hidden, (steps, n) = w["state"].shape[1], places.shape
        # sigmoid(x) = (1 + tanh(x / 2)) / 2: the halving is done once, in the weights of the two gates
        half = np.repeat(np.float32([0.5, 0.5, 1]), hidden)
        drive, back_by = w["drive"] * half, w["state"] * half
        state, out = np.zeros((2, n, hidden), np.float32), np.empty((steps, n, 2 * hidden), np.float32)
        into = np.empty((2, n, 3 * hidden), np.float32)
        for t in range(steps):
            np.take(drive[0], places[t], axis=0, out=into[0], mode="clip")
            np.take(drive[1], places[steps - 1 - t], axis=0, out=into[1], mode="clip")
            back = state @ back_by
            gates = np.tanh(into[..., : 2 * hidden] + back[..., : 2 * hidden])
            gates += np.float32(1)
            gates *= np.float32(0.5)
            shut, reset = gates[..., :hidden], gates[..., hidden:]
            fresh = reset * back[..., 2 * hidden :]
            fresh += into[..., 2 * hidden :]
            np.tanh(fresh, out=fresh)
            if keep is not None:
                keep.append((state, back[..., 2 * hidden :], shut, reset, fresh))
            state = fresh + shut * (state - fresh)
            out[t, :, :hidden] = state[0]
            out[steps - 1 - t, :, hidden:] = state[1]
        return out

    def labels(self, places: np.ndarray) -> np.ndarray:
        """(places, windows, languages): probabilities of every place; 0 behind the end of a text."""
        found = _softmax(self.states(places) @ self.weights["out"] + self.weights["offset"])
        return found * (places != NOTHING)[..., None]

    def gradients(self, places: np.ndarray, language: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy over all places of windows that have one language each, and its gradients."""
        w, steps_kept = self.weights, []
        hidden, (steps, n) = w["state"].shape[1], places.shape
        joint = self.states(places, steps_kept)
        real = (places != NOTHING)[..., None]
        found = _softmax(joint @ w["out"] + w["offset"])
        total = max(int(real.sum()), 1)
        loss = -np.log(np.maximum(found[:, np.arange(n), language], 1e-30))[real[..., 0]].sum() / total
        error = found
        error[:, np.arange(n), language] -= 1
        error = (error * real / total).astype(np.float32)
        grad = {"out": np.einsum("tnh,tnl->hl", joint, error), "offset": error.sum(axis=(0, 1))}
        d_joint = error @ w["out"].T
        d_states = np.stack([d_joint[..., :hidden], d_joint[::-1, :, hidden:]])
        d_drive, d_state = np.empty((2, steps, n, 3 * hidden), np.float32), np.zeros((2, n, hidden), np.float32)
        grad["state"] = np.zeros_like(w["state"])
        for t in range(steps - 1, -1, -1):
            before, back, shut, reset, fresh = steps_kept[t]
            d = d_state + d_states[:, t]
            d_fresh = d * (1 - shut) * (1 - fresh * fresh)
            d_shut = d * (before - fresh) * shut * (1 - shut)
            d_reset = d_fresh * back * reset * (1 - reset)
            d_drive[:, t] = np.concatenate([d_shut, d_reset, d_fresh], axis=2)
            d_back = np.concatenate([d_shut, d_reset, d_fresh * reset], axis=2)
            grad["state"] += before.transpose(0, 2, 1) @ d_back
            d_state = d * shut + d_back @ w["state"].transpose(0, 2, 1)
        grad["drive"] = np.zeros_like(w["drive"])
        for way, read in enumerate((places, places[::-1])):
            order = np.argsort(read, axis=None, kind="stable")
            inputs, first = np.unique(read.ravel()[order], return_index=True)
            grad["drive"][way, inputs] = np.add.reduceat(d_drive[way].reshape(-1, 3 * hidden)[order], first, axis=0)
        grad["drive"][:, NOTHING] = 0
        return float(loss), grad


def grid(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, window: int) -> np.ndarray:
    """(places, windows) of byte numbers, ``NOTHING`` behind the end of a window."""
    at = starts + np.arange(window)[:, None]
    found = text[np.minimum(at, max(len(text) - 1, 0))].astype(np.int64) if len(text) else np.zeros(at.shape, np.int64)
    return np.where(at < ends, found, NOTHING)


def train(examples: list[tuple[str, bytes]], *, hidden: int = 8, window: int = 64, passes: int = 5, batch: int = 128, rate: float = 0.01, seed: int = 5) -> ByteNetwork:
    """Fit on (language, window of bytes) by backpropagation through time, with Adam; every place is an example."""
    languages = sorted({language for language, _ in examples})
    net = ByteNetwork.fresh(languages, hidden, window, seed)
    if not examples:
        return net
    number = {language: i for i, language in enumerate(languages)}
    label = np.array([number[language] for language, _ in examples])
    lengths = np.array([len(b) for _, b in examples])
    ends = np.cumsum(lengths)
    places = grid(np.frombuffer(b"".join(b for _, b in examples), np.uint8), ends - lengths, ends, window)
    rng = np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in net.weights.items()}
    second = {k: np.zeros_like(v) for k, v in net.weights.items()}
    step = 0
    for _ in range(passes):
        order = rng.permutation(len(label))
        for a in range(0, len(order), batch):
            chosen = order[a : a + batch]
            _, grad = net.gradients(places[:, chosen], label[chosen])
            step += 1
            for name, g in grad.items():
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.999 * second[name] + 0.001 * g * g
                net.weights[name] -= (rate * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
            net.close()
    return net


def pooled(net: ByteNetwork, text: np.ndarray, offsets: np.ndarray, at_once: int = 2048) -> np.ndarray:
    """(texts, languages): mean over all places of each text; texts lie one behind the other in ``text``.

    Windows lie side by side, so every byte is labelled once, with what its window holds before and behind it.
    """
    window, n_texts = net.window, len(offsets) - 1
    lengths = np.diff(offsets)
    per_text = -(-lengths // window)
    owner = np.repeat(np.arange(n_texts), per_text)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    starts = offsets[owner] + within * window
    ends = np.minimum(starts + window, offsets[owner + 1])
    total = np.zeros((n_texts, len(net.languages)))
    for a in range(0, len(owner), at_once):
        found = net.labels(grid(text, starts[a : a + at_once], ends[a : a + at_once], window)).sum(axis=0, dtype=np.float64)
        np.add.at(total, owner[a : a + at_once], found)
    return total / np.maximum(lengths, 1)[:, None]


def held_out(id_col: Column, folds: int = 5, fold: int = 0) -> Column:
    """Rows whose crc32 of the id as text leaves ``fold``; a NULL id never does."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == fold, F.lit(False))


def _cut(window: int, most: int):
    def run(frames):
        import pandas as pd

        for frame in frames:
            out = []
            for mark, language, text in zip(frame["mark"], frame["language"], frame["text"]):
                raw = text.encode("utf-8", "replace")
                starts = np.unique(np.linspace(0, max(len(raw) - window, 0), min(most, max(-(-len(raw) // window), 1))).astype(int))
                out.append((mark, language, b"".join(raw[a : a + window].ljust(window, b"\0") for a in starts), len(raw)))
            yield pd.DataFrame(out, columns=["mark", "language", "windows", "n_bytes"])

    return run


def fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    *, window: int = 64, per_language: int = 240, most_windows: int = 16, most_languages: int = 256, **training,
) -> ByteNetwork:
    """Train on a bounded sample of the rows that are not held out and have an id, a text with a letter and a language.

    The sample: of each of the ``most_languages`` most frequent languages the ``per_language`` distinct (id, text)
    with the smallest hash, of each ``most_windows`` windows evenly spread over the text. That is all that reaches the driver,
    and the only thing in this operator that does not cover all rows. Repeated rows count once. Without any such row the network has
    no languages and every text gets ``und``.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("language"))
    rows = rows.where(F.col("id").isNotNull() & ~held_out(F.col("id")) & F.col("language").isNotNull() & has_letter(F.col("text")))
    rows = rows.withColumn("mark", F.xxhash64("id", "text"))
    marks = rows.select("language", "mark").distinct()
    common = marks.groupBy("language").count().orderBy(F.desc("count"), "language").limit(most_languages)
    # hashes are spread evenly, so what lies in the lowest part of their range is some eight times what is taken
    low = F.col("mark").cast("double") / 2.0**64 + 0.5 <= 8 * per_language / F.col("count")
    rank = F.row_number().over(Window.partitionBy("language").orderBy("mark"))
    chosen = marks.join(F.broadcast(common), "language").where(low).withColumn("rank", rank).where(F.col("rank") <= per_language)
    picked = rows.join(F.broadcast(chosen.select("language", "mark")), ["language", "mark"]).select("mark", "language", "text")
    cut = picked.mapInPandas(_cut(window, most_windows), "mark long, language string, windows binary, n_bytes long")
    examples = []
    for r in sorted(cut.dropDuplicates(["language", "mark"]).collect(), key=lambda r: (r["language"], r["mark"])):
        for a in range(0, len(r["windows"]), window):
            examples.append((r["language"], bytes(r["windows"][a : a + min(window, r["n_bytes"])])))
    return train(examples, window=window, **training)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def _predicted(net: ByteNetwork):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(1).cast(pa.large_binary()).fill_null(b"")
            offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
            data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)
            found = pooled(net, data, offsets) if net.languages else np.zeros((len(raw), 1))
            known = batch.column(2).to_numpy(zero_copy_only=False).astype(bool) & (len(net.languages) > 0)
            best = found.argmax(axis=1)
            names = [net.languages[k] if ok else UNKNOWN for k, ok in zip(best, known)]
            score = np.where(known, np.clip(found[np.arange(len(best)), best], 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(score)], ["id", "lang_pred", "score"])

    return run


def predict_languages(docs: DataFrame, net: ByteNetwork, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, lang_pred, score) of every row: the language whose probability, averaged over all bytes, is highest.

    Only the text is looked at, all of it, in windows that lie side by side. NULL texts and texts without a letter (empty and
    blank ones too) get ``und`` and score 0; of equal probabilities the first language in sorted order wins. Repeated rows get
    equal results (scores up to the rounding of 32-bit sums), NULL ids are kept and not held out, other columns are not read, an empty table gives no rows. Nothing is
    shuffled; the network (under 1 MB) goes out with the tasks, and memory is bounded by a batch of texts.
    """
    text = F.col(text_col).cast("string")
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), has_letter(text).alias("letter"))
    found = narrow.mapInArrow(_predicted(net), "id long, lang_pred string, score double")
    return found.select("id", held_out(F.col("id")).alias("held_out"), "lang_pred", "score")
