"""N-gram language model by deleted interpolation, counted and applied in packed blocks."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postflow.llm.chunks import parts
from postflow.llm.common import free_name, partitions_for, stage

_BEGIN = np.uint64(0x5851F42D4C957F2D)
#: Compression of the packed arrays; they are written and shuffled.
_LEVEL = 6
_END_WORD = b"\n"  # white space, so no word is equal to it
#: Context-frequency buckets: 0 for an unseen context, then one per power of two.
N_BUCKETS = 48


def squeeze(values: np.ndarray) -> bytes:
    """Unsigned numbers, byte plane by byte plane, compressed."""
    values = np.asarray(values, np.uint64)
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + zstandard.ZstdCompressor(level=_LEVEL).compress(np.ascontiguousarray(planes).tobytes())


def expand(data: bytes) -> np.ndarray:
    width = data[0]
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8)
    octets = np.zeros((len(flat) // width, 8), np.uint8)
    octets[:, :width] = flat.reshape(width, -1).T
    return octets.view("<u8").ravel()


def fold(doc_id: str) -> int:
    """crc32 of the id as text; a NULL id is empty text."""
    return zlib.crc32(doc_id.encode())


def is_held_out(crc: np.ndarray) -> np.ndarray:
    """Documents that nothing is learned from."""
    return crc % 5 == 1


def is_deleted(crc: np.ndarray) -> np.ndarray:
    """Training documents whose counts are kept apart to learn the mixture weights on."""
    return ~is_held_out(crc) & (crc // 5 % 5 == 0)


def tokens_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case, then the end."""
    return [*(text or "").encode("utf-8").lower().split(), _END_WORD]


#: Ids are kept as text, NULL as empty text: as numbers beside NULLs they would be rounded to 53 bits.
_BLOCK = "block long, rows array<long>, ids array<string>, ends array<long>, words binary, tokens binary, n_train long, n_kept long"


def _blocks(block_chars: int):
    """Documents as blocks: distinct words by frequency, and all tokens as numbers of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            rows, ids = batch.column(0).to_pylist(), ["" if i is None else str(i) for i in batch.column(1).to_pylist()]
            sizes = pc.fill_null(pc.utf8_length(batch.column(2)), 0).to_pylist()
            for a, b in parts(sizes, block_chars):
                words, count = [], []
                for text in batch.column(2).slice(a, b - a):
                    own = tokens_of(text.as_py())
                    words += own
                    count.append(len(own))
                first = {w: i for i, w in enumerate(dict.fromkeys(words))}
                number_of = np.fromiter(map(first.__getitem__, words), np.int64, len(words))
                order = np.argsort(-np.bincount(number_of), kind="stable")
                rank = np.empty(len(order), np.int64)
                rank[order] = np.arange(len(order))
                distinct = list(first)
                del words, first
                spelled = zstandard.ZstdCompressor(level=_LEVEL).compress(b" ".join(distinct[i] for i in order))
                crc = np.array([fold(i) for i in ids[a:b]], np.int64)
                count = np.array(count, np.int64)
                block = TaskContext.get().partitionId() << 32 | number
                number += 1
                made = [[block], [rows[a:b]], [ids[a:b]], [np.cumsum(count)], [spelled], [squeeze(rank[number_of])], [count[~is_held_out(crc)].sum()], [count[~is_held_out(crc) & ~is_deleted(crc)].sum()]]
                kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(made, kinds)], [c.split()[0] for c in _BLOCK.split(", ")])

    return run


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(28))


def gram_keys(block, order: int) -> list[np.ndarray]:
    """For n = 1 to ``order``: a 64-bit key of the n-gram that ends at each token; histories start with begin marks.

    The lowest two bits of a key are its n. Keys are hashes of the words, so two n-grams share a count with
    probability 2**-62 a pair.
    """
    words = zstandard.ZstdDecompressor().decompress(bytes(block["words"])).split(b" ")
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
    word = hashes[expand(bytes(block["tokens"])).astype(np.int64)]
    starts = np.concatenate([[0], np.asarray(block["ends"], np.int64)[:-1]])
    keys, history = [], np.zeros(len(word), np.uint64)
    with np.errstate(over="ignore"):
        for n in range(1, order + 1):
            gram = _mix(history * np.uint64(0xD6E8FEB86659FD93) + word)
            keys.append(gram & ~np.uint64(3) | np.uint64(n))
            history = np.empty_like(gram)
            history[1:] = gram[:-1]
            history[starts] = _mix(np.array([_BEGIN + np.uint64(n)]))[0]
    return keys


def _unique(block, order: int):
    """(sorted distinct keys of a block, place of every token's keys among them by n, crc of every token's document)."""
    keys = gram_keys(block, order)
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    ends = np.asarray(block["ends"], np.int64)
    crc = np.repeat([fold(i) for i in block["ids"]], np.diff(np.concatenate([[0], ends])))
    return distinct, place.reshape(order, -1), crc


def _shares(distinct: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """(share, first, end): sorted keys cut by their top bits."""
    top = (distinct >> np.uint64(64 - bits)).astype(np.int64)
    first = np.flatnonzero(np.diff(top, prepend=-1))
    return list(zip(top[first].tolist(), first.tolist(), [*first[1:].tolist(), len(top)]))


def _spread(order: int, bits: int):
    """A block's distinct n-grams and their training counts, one row per share of the key space."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for _, block in frame.iterrows():
                distinct, place, crc = _unique(block, order)
                deleted = is_deleted(crc)
                kept = ~is_held_out(crc) & ~deleted
                counts = [sum(np.bincount(p[part], minlength=len(distinct)) for p in place) for part in (kept, deleted)]
                rows = [
                    (share, block["block"], squeeze(np.diff(distinct[a:b], prepend=np.uint64(0))), squeeze(counts[0][a:b]), squeeze(counts[1][a:b]))
                    for share, a, b in _shares(distinct, bits)
                ]
                yield pd.DataFrame(rows, columns=["share", "block", "keys", "kept", "deleted"])

    return run


def _total(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    """Counts of one share of the key space over all blocks, sent back to each block for its own keys."""
    keys = [np.cumsum(expand(bytes(k)), dtype=np.uint64) for k in frame["keys"]]
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    kept, deleted = (np.bincount(place, np.concatenate([expand(bytes(c)) for c in frame[name]]), len(distinct)).astype(np.int64) for name in ("kept", "deleted"))
    single = (distinct & np.uint64(3)) == 1
    ends = np.cumsum([len(k) for k in keys])
    rows = [
        # counts without the deleted documents are of use only for what these hold
        (block, key[0], squeeze((kept + deleted)[own]), squeeze(kept[own[expand(bytes(gone)) > 0]]), int((single & (kept + deleted > 0)).sum()), int((single & (kept > 0)).sum()))
        for block, gone, own in zip(frame["block"], frame["deleted"], np.split(place, ends[:-1]))
    ]
    return pd.DataFrame(rows, columns=["block", "share", "total", "kept", "words", "kept_words"])


_COUNTED = "block long, rows array<long>, ids array<string>, ends array<long>, counts array<binary>, kept array<binary>, shares array<struct<share:int,words:long,kept_words:long>>"


def _attach(order: int):
    """Every token's n-gram counts: over all training text, and for deleted documents over the kept part."""

    def run(key: tuple, blocks: pd.DataFrame, totals: pd.DataFrame) -> pd.DataFrame:
        block = blocks.iloc[0]
        distinct, place, crc = _unique(block, order)
        totals = totals.sort_values("share")
        total, known = (np.concatenate([expand(bytes(x)) for x in totals[name]]) for name in ("total", "kept"))
        deleted = is_deleted(crc)
        kept = np.zeros(len(distinct), np.uint64)
        kept[np.unique(place[:, deleted])] = known
        shares = [{"share": int(s), "words": int(w), "kept_words": int(k)} for s, w, k in zip(totals["share"], totals["words"], totals["kept_words"])]
        return pd.DataFrame({
            "block": [key[0]], "rows": [block["rows"]], "ids": [block["ids"]], "ends": [block["ends"]], "counts": [[squeeze(total[p]) for p in place]],
            "kept": [[squeeze(kept[p[deleted]]) for p in place]], "shares": [shares],
        })

    return run


def _estimates(counts: list[np.ndarray], starts: np.ndarray, n_docs: int, n_tokens: int, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(maximum-likelihood estimates by n from 0 on, context bucket) of every token.

    n = 0 is uniform over the known words and one unknown. The context of an n-gram is the (n-1)-gram that ends
    one token before; at a document's start, that is the number of documents. The bucket is that of the longest
    context.
    """
    size = len(counts[0])
    out = np.zeros((len(counts) + 1, size))
    out[0] = 1 / (n_words + 1)
    context = np.full(size, n_tokens, np.float64)
    for n, count in enumerate(counts, 1):
        np.divide(count, context, out=out[n], where=context > 0)
        if n < len(counts):
            context = np.empty(size)
            context[1:] = count[:-1]
            context[starts] = n_docs
    bucket = np.where(context > 0, np.floor(np.log2(np.maximum(context, 1))).astype(np.int64) + 1, 0)
    return out, np.minimum(bucket, N_BUCKETS - 1)


def _held_cells(sizes: tuple[int, int, int]):
    """Deleted tokens as a histogram over context bucket and quarter powers of two of the estimates."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for _, block in frame.iterrows():
                ends = np.asarray(block["ends"], np.int64)
                width = np.diff(np.concatenate([[0], ends]))
                deleted = is_deleted(np.array([fold(i) for i in block["ids"]], np.int64))
                width = width[deleted]
                counts = [expand(bytes(c)).astype(np.float64) for c in block["kept"]]
                if not width.sum():
                    continue
                estimate, bucket = _estimates(counts, np.cumsum(width) - width, *sizes)
                level = np.where(estimate[1:] > 0, np.rint(-4 * np.log2(np.where(estimate[1:] > 0, estimate[1:], 1))), -1).astype(np.int64)
                cell = bucket
                for one in level:
                    cell = cell * 512 + np.minimum(one + 1, 511)
                used, back = np.unique(cell, return_inverse=True)
                made = {"cell": used, "n": np.bincount(back)} | {f"sum_{n}": np.bincount(back, e) for n, e in enumerate(estimate[1:], 1)}
                yield pd.DataFrame(made)

    return run


def learn_weights(bucket: np.ndarray, n: np.ndarray, estimate: np.ndarray, *, rounds: int = 100, prior: float = 0.5) -> np.ndarray:
    """Expectation-maximisation of the mixture weights (bucket, n) on held-out counts.

    ``estimate``: (n, cells). Each weight gets ``prior`` extra counts, so none becomes zero, but for the longest
    n-gram after an unseen context, which always is. Buckets without held-out counts have the pooled weights.
    """
    orders = len(estimate)

    def fit(n: np.ndarray, estimate: np.ndarray, open_: np.ndarray) -> np.ndarray:
        weight = open_ / open_.sum()
        for _ in range(rounds):
            share = weight[:, None] * estimate
            got = (n * share / np.maximum(share.sum(axis=0), 1e-300)).sum(axis=1) + prior * open_
            moved, weight = np.abs(got / got.sum() - weight).max(), got / got.sum()
            if moved < 1e-9:
                break
        return weight

    every = np.ones(orders)
    seen = np.append(np.ones(orders - 1), 0.0) if orders > 2 else every
    pooled = fit(n, estimate, every) if len(n) else every / orders
    out = np.tile(pooled, (N_BUCKETS, 1))
    out[0] = pooled * seen / (pooled * seen).sum()
    for b in np.unique(bucket):
        own = bucket == b
        out[b] = fit(n[own], estimate[:, own], seen if b == 0 else every)
    return out


def _scores(sizes: tuple[int, int, int], weights: np.ndarray):
    n_docs, n_tokens, n_words = sizes

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for _, block in frame.iterrows():
                ends = np.asarray(block["ends"], np.int64)
                starts = np.concatenate([[0], ends[:-1]])
                counts = [expand(bytes(c)).astype(np.float64) for c in block["counts"]]
                estimate, bucket = _estimates(counts, starts, *sizes)
                mixed = (weights[bucket].T * estimate).sum(axis=0)
                base = np.log10((counts[0] + 0.5) / (n_tokens + 0.5 * (n_words + 1)))
                known = (counts[0] > 0).astype(np.int64)
                add = lambda x: np.add.reduceat(x, starts)  # noqa: E731  every document has its end
                yield pd.DataFrame({
                    "row": block["rows"], "id": block["ids"], "n_tokens": ends - starts,
                    "n_known": add(known), "train_tokens": n_tokens, "base_score": add(base), "score": add(np.log10(mixed)),
                })

    return run


def score_texts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, order: int = 2, block_chars: int = 1 << 23, share_keys: int = 2_000_000, row_col: str | None = None
) -> DataFrame:
    """log10 probability of every text under an n-gram model learned from the documents that are not held out.

    Returns (row, id, held_out, n_tokens, n_known, train_tokens, base_score, score). The model mixes the
    maximum-likelihood estimates for n = ``order`` down to 1 and a uniform one, with weights by the frequency of the
    context; the weights are learned by expectation-maximisation on the counts of the deleted fifth of the
    training documents, against estimates from the rest, and applied to estimates from all of them. NULL
    texts are empty (only the end is scored). A NULL id counts as empty text for the folds; rows with one id share a
    fold, repeated rows are counted and scored each. Without training text the model is the uniform one over
    the one unknown word. Other columns are not read.

    Texts are cut into blocks of whole documents of about ``block_chars`` characters. A block sends each of its distinct
    n-grams once, with its counts, to the share of the key space it belongs to, in packed arrays, and gets the
    totals back the same way: no n-gram is a row, a hot one is one entry per block, and both sides of the
    exchange are bounded. All n-grams are counted; only a histogram of bounded size reaches the driver.
    """
    if not 1 <= order <= 3:
        raise ValueError("order must be 1, 2 or 3")
    spark = docs.sparkSession
    row = row_col or free_name(docs.columns, "row_no")
    source = docs if row_col else docs.withColumn(row, F.monotonically_increasing_id())
    narrow = source.select(F.col(row).alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    blocks = stage(narrow.mapInArrow(_blocks(block_chars), _BLOCK), "lm-blocks")
    last = F.element_at("ends", -1)
    found = blocks.agg(F.sum("n_train"), F.sum("n_kept"), F.sum(last), F.count(F.lit(1))).first()
    n_tokens, n_kept, n_all, n_blocks = (int(x or 0) for x in found)
    bits = max(6, int(order * n_all // share_keys).bit_length())
    tasks = partitions_for(spark, n_blocks, 2)
    spread = blocks.mapInPandas(_spread(order, bits), "share int, block long, keys binary, kept binary, deleted binary")
    totals = spread.repartition(1 << bits, "share").groupBy("share").applyInPandas(_total, "block long, share int, total binary, kept binary, words long, kept_words long")
    counted = stage(blocks.repartition(tasks, "block").groupBy("block").cogroup(totals.repartition(tasks, "block").groupBy("block")).applyInPandas(_attach(order), _COUNTED), "lm-counted")
    n_docs, kept_docs = _documents(counted)
    words = counted.select(F.explode("shares").alias("s")).select("s.*").distinct().agg(F.sum("words"), F.sum("kept_words")).first()
    n_words, kept_words = (int(x or 0) for x in words)
    sums = [f"sum_{n}" for n in range(1, order + 1)]
    cells = counted.select("ids", "ends", "kept").mapInPandas(_held_cells((kept_docs, n_kept, kept_words)), ", ".join(["cell long", "n long", *[f"{s} double" for s in sums]]))
    cells = cells.groupBy("cell").agg(*[F.sum(c).alias(c) for c in ("n", *sums)]).toPandas()
    estimate = np.stack([np.full(len(cells), 1 / (kept_words + 1)), *[cells[s] / cells["n"] for s in sums]])
    weights = learn_weights(cells["cell"].to_numpy() // 512**order, cells["n"].to_numpy(), estimate)
    if not n_tokens:
        weights = np.zeros_like(weights)
        weights[:, 0] = 1
    scored = counted.select("rows", "ids", "ends", "counts").mapInPandas(
        _scores((n_docs, n_tokens, n_words), weights), "row long, id string, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    crc = F.crc32(F.col("id").cast("binary"))
    return scored.select("row", F.when(F.col("id") != "", F.col("id").cast("long")).alias("id"), (crc % 5 == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def _documents(counted: DataFrame) -> tuple[int, int]:
    """Numbers of training documents, and of those not deleted."""
    crc = F.crc32(F.col("id").cast("binary"))
    ids = counted.select(F.explode("ids").alias("id")).select(crc.alias("crc")).where("crc % 5 <> 1")
    found = ids.agg(F.count(F.lit(1)), F.count_if(F.expr("floor(crc / 5) % 5 <> 0"))).first()
    return int(found[0]), int(found[1])
