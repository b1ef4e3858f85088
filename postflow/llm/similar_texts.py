"""Near duplicates by the similarity of shingle sets: SimHash fingerprints, a forest of vantage-point trees, exact verification.

Two sets with a Jaccard similarity of 0.8 differ in 15 % of their SimHash bits, unrelated ones in half of them. Over 64 bits these
two spread too much to be told apart, so fingerprints here have 256 bits in sixteen blocks, each with a vantage-point tree of its
own. Two fingerprints meet where one block differs in at most one bit, which two such sets miss in all sixteen about once in
200 times; those that meet and are within reach on the whole fingerprint link into candidate classes, and within these every pair is
verified on the whole sets.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postflow.llm.common import keep_marked, partitions_for, stage, text_mark
from postflow.llm.components import components
from postflow.llm.simhash import Tree, _merge, block_masks, build_tree
from postflow.operators.row_keys import KeyFilter

#: Multipliers of the min-hashes, one after another.
_MIX = [0x9E3779B97F4A7C15 * (2 * k + 1) % (1 << 64) | 1 for k in range(32)]
#: 64-bit words of a fingerprint.
WORDS = 4


def shingle_hashes(text: str | None, words_each: int) -> np.ndarray:
    """Hashes of all shingles, repeats included: A-Z lower-cased, words between ASCII white space. Fewer words than a shingle
    are one shingle; without words (or NULL) there is none."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = memoryview(b" ".join(words))
    width = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(width + 1) - 1
    k = min(words_each, len(words))
    first, last = (ends - width)[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b]) for a, b in zip(first, last)), np.uint64, len(first))


def _mixed(hashes: np.ndarray, mix: int) -> np.ndarray:
    """Other hashes of the same shingles."""
    with np.errstate(over="ignore"):
        x = hashes * np.uint64(mix)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def simhash(hashes: np.ndarray) -> int:
    """Bit set where over half of the hashes have it."""
    return int(_majority(hashes[:, None])[0])


def wide_simhash(distinct: np.ndarray) -> np.ndarray:
    """``WORDS`` SimHashes of a set, each over other hashes of its elements."""
    return _majority(np.stack([distinct, *(_mixed(distinct, mix) for mix in _MIX[1:WORDS])], axis=1))


def _majority(hashes: np.ndarray) -> np.ndarray:
    """Of each column of hashes, a word with the bits that over half of them have."""
    n, words = hashes.shape
    total = np.zeros(64 * words, np.int64)
    for at in range(0, n, 255):  # so many bits add up to a byte
        part = np.ascontiguousarray(hashes[at : at + 255], "<u8").view(np.uint8)
        total += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * total > n, bitorder="little").view("<u8")


def min_hashes(distinct: np.ndarray, n: int) -> list[int]:
    """The least of the set's hashes under ``n`` mixings, as signed numbers; none for an empty set."""
    if not len(distinct):
        return []
    return [int(_mixed(distinct, mix).min().view(np.int64)) for mix in _MIX[:n]]


def _node(distinct: np.ndarray) -> int:
    """A 64-bit hash that stands for a set."""
    return int(np.uint64(xxhash.xxh64_intdigest(distinct.tobytes(), 7)).view(np.int64))


_PRINT = [f"p{w}" for w in range(WORDS)]
_SKETCH = "row long, id long, mark long, node long, n long, " + "".join(f"{p} long, " for p in _PRINT) + "mins array<long>"


def _sketches(words_each: int, n_mins: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, size, prints, mins = [], [], np.zeros((batch.num_rows, WORDS), np.uint64), []
            for k, text in enumerate(batch.column(3)):
                distinct = np.unique(shingle_hashes(text.as_py(), words_each))
                node.append(_node(distinct))
                size.append(len(distinct))
                prints[k] = wide_simhash(distinct)
                mins.append(min_hashes(distinct, n_mins))
            columns = [pa.array(node, pa.int64()), pa.array(size, pa.int64()), *(pa.array(p) for p in prints.view(np.int64).T.copy()), pa.array(mins, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], ["row", "id", "mark", "node", "n", *_PRINT, "mins"])

    return run


def _sets(words_each: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [np.unique(shingle_hashes(text.as_py(), words_each)) for text in batch.column(0)]
            columns = [pa.array([_node(m) for m in made], pa.int64()), pa.array([m.astype("<u8").tobytes() for m in made], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["node", "members"])

    return run


def _forest(sample: np.ndarray, leaves: int) -> list[tuple[int, int, Tree]]:
    """(word, first bit, tree) of every block of sixteen bits; a tree is searched with a reach of one bit."""
    return [(w, mask.bit_length() - 16, build_tree(sample[:, w], mask, 1, leaves)) for w in range(WORDS) for mask in block_masks(4)]


def _prints(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(p).to_numpy() for p in _PRINT], axis=1).view(np.uint64)


def _shards(forest: list[tuple[int, int, Tree]], prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(leaf, row, at home?) of every tree: each fingerprint in its leaf and, as a query, in later leaves its ball overlaps."""
    for number, (word, _, tree) in enumerate(forest):
        found = [(np.full(len(rows), number << 32 | leaf), rows, home) for leaf, rows, home in tree.shards(prints[:, word])]
        if found:
            yield tuple(np.concatenate(x) for x in zip(*found))


def _counted(forest: list[tuple[int, int, Tree]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[int] = Counter()
        for batch in batches:
            for leaf, _, _ in _shards(forest, _prints(batch)):
                found.update(dict(zip(*(x.tolist() for x in np.unique(leaf, return_counts=True)))))
        yield pa.RecordBatch.from_arrays([pa.array([*found], pa.int64()), pa.array([*found.values()], pa.int64())], ["leaf", "k"])

    return run


def _routed(forest: list[tuple[int, int, Tree]], parts: dict[int, int]):
    """Rows by leaf; those of a leaf cut into parts once for each part they are compared with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column("node").to_numpy().view(np.uint64)
            for leaf, row, home in _shards(forest, _prints(batch)):
                n = np.array([parts.get(x, 1) for x in leaf.tolist()]) if parts else np.ones(len(leaf), np.int64)
                part = (nodes[row] % n.astype(np.uint64)).astype(np.int32)
                for other in range(n.max(initial=0)):
                    own = n > other
                    low, high = np.minimum(part[own], other), np.maximum(part[own], other)
                    made = [pa.array(x) for x in (home[own], leaf[own], part[own], low.astype(np.int32), high.astype(np.int32))]
                    yield pa.RecordBatch.from_arrays([*batch.take(pa.array(row[own])).columns, *made], [*batch.schema.names, "home", "leaf", "part", "p", "q"])

    return run


def _block_pairs(values: np.ndarray, most: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of all 16-bit values that differ in at most one bit, each pair once, about ``most`` at a time."""
    order = np.argsort(values, kind="stable")
    held = values[order].astype(np.int64)
    starts = np.searchsorted(held, np.arange((1 << 16) + 1))
    for flip in (0, *(1 << b for b in range(16))):
        low = np.flatnonzero(held & flip == 0)
        first = starts[held[low] | flip] if flip else low + 1
        count = starts[(held[low] | flip) + 1] - first
        low, first, count = (x[count > 0] for x in (low, first, count))
        ends = np.cumsum(count)
        a = 0
        while a < len(low):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, "right")))
            own = count[a:b]
            step = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
            yield order[np.repeat(low[a:b], own)], order[np.repeat(first[a:b], own) + step]
            a = b


def _met(blocks: list[tuple[int, int]], similarity: float, max_bits: int):
    """Links, as stars, of the fingerprints of a leaf that meet in its tree's block and are within reach.

    Of a leaf cut into parts, a task gets two parts and takes the pairs across them.
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("node", kind="stable")
        word, bit = blocks[int(frame["leaf"].iat[0]) >> 32]
        prints, sizes, part, home = frame[_PRINT].to_numpy().view(np.uint64), frame["n"].to_numpy(), frame["part"].to_numpy(), frame["home"].to_numpy()
        label, same = np.arange(len(frame)), frame["p"].iat[0] == frame["q"].iat[0]
        for i, j in _block_pairs((prints[:, word] >> np.uint64(bit)).astype(np.uint16)):
            open_ = (label[i] != label[j]) & (home[i] | home[j])
            if not same:
                open_ &= part[i] != part[j]
            i, j = i[open_], j[open_]
            near = (np.minimum(sizes[i], sizes[j]) >= similarity * np.maximum(sizes[i], sizes[j])) & (np.bitwise_count(prints[i] ^ prints[j]).sum(axis=1) <= max_bits)
            if near.any():
                _merge(label, i[near], j[near])
        nodes = frame["node"].to_numpy()
        linked = np.flatnonzero(label != np.arange(len(label)))
        return pd.DataFrame({"u": nodes[linked], "v": nodes[label[linked]]})

    return run


def print_links(
    points: DataFrame, similarity: float, max_bits: int, *, leaf_rows: int = 1 << 18, least_leaves: int = 4, max_leaves: int = 4096, sample: int = 16384, part_rows: int = 1 << 19
) -> DataFrame:
    """(node, n, p0, ...) -> (u, v): links that connect what pairs connect that meet in one block and are within ``max_bits`` on all.

    The trees are fitted on at most ``sample`` fingerprints; all are routed and searched. Every split of a tree sends about a third
    more rows, so leaves are large, and within one the rows are sorted by their block. A leaf over ``part_rows`` is cut into parts
    and every two parts are compared in a task of their own, so a task's memory is bounded.
    """
    spark = points.sparkSession
    n = points.count()
    if not n:
        return spark.createDataFrame([], "u long, v long")
    fitted = points.select(*_PRINT).orderBy(F.xxhash64("p0"), *_PRINT).limit(sample).toPandas().to_numpy().view(np.uint64)
    forest = _forest(fitted, min(max(n // leaf_rows, least_leaves), max_leaves))
    columns = "node long, n long, " + "".join(f"{p} long, " for p in _PRINT) + "home boolean, leaf long, part int, p int, q int"
    spread = points.select("node", "n", *_PRINT).repartition(partitions_for(spark, n, 65536))
    # at most 16 * max_leaves rows, and of these the few large ones
    large = spread.mapInArrow(_counted(forest), "leaf long, k long").groupBy("leaf").agg(F.sum("k").alias("k")).where(F.col("k") > part_rows)
    parts = {r["leaf"]: -(-r["k"] // part_rows) for r in large.collect()}
    placed = spread.mapInArrow(_routed(forest, parts), columns).repartition(partitions_for(spark, n, 4096), "leaf", "p", "q")
    return placed.groupBy("leaf", "p", "q").applyInPandas(_met([(w, bit) for w, bit, _ in forest], similarity, max_bits), "u long, v long")


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Elements that two sorted sets share."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def similar_links(prints: np.ndarray, sets: list[np.ndarray], part: np.ndarray, same: bool, similarity: float, max_bits: int) -> np.ndarray:
    """Class label (an index) of each set: classes connect what similar pairs within reach connect.

    Pairs that a class holds already need no verification. With ``same`` false only pairs across the two parts count.
    """
    n = len(prints)
    label, sizes = np.arange(n), np.array([len(s) for s in sets])
    for a in range(n - 1):
        others = np.arange(a + 1, n)
        close = (sizes[others] >= similarity * sizes[a]) & (sizes[a] >= similarity * sizes[others]) & (label[others] != label[a])
        if not same:
            close &= part[others] != part[a]
        others = others[close]
        for b in others[np.bitwise_count(prints[others] ^ prints[a]).sum(axis=1) <= max_bits]:
            if label[a] != label[b]:
                both = _common(sets[a], sets[b])
                if both >= similarity * (sizes[a] + sizes[b] - both):
                    low, high = sorted((label[a], label[b]))
                    label[label == high] = low
    return label


def _verified(similarity: float, max_bits: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("node", kind="stable")
        nodes, prints = frame["node"].to_numpy(), frame[_PRINT].to_numpy().view(np.uint64)
        sets = [np.frombuffer(bytes(m), "<u8") for m in frame["members"]]
        label = similar_links(prints, sets, frame["part"].to_numpy(), bool(frame["same"].iat[0]), similarity, max_bits)
        linked = np.flatnonzero(label != np.arange(len(label)))
        return pd.DataFrame({"u": nodes[linked], "v": nodes[label[linked]], "whole": bool(frame["parts"].iat[0] == 1)})

    return run


def similar_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, words_each: int = 5, similarity: float = 0.8,
    max_bits: int = 64, n_mins: int = 0, part_bytes: int = 1 << 24, **search,
) -> DataFrame:
    """(row, id, mark, component_id, leader) of every row: classes of texts with similar shingle sets.

    Two texts are linked if the Jaccard similarity of their sets of ``words_each`` words is at least ``similarity``, and their
    fingerprints differ in at most ``max_bits`` of 256 bits and were found in one candidate class by the forest (see
    ``print_links``; at 0.8 this misses about 1 pair in 200, fewer above). ``n_mins`` adds candidates: texts that share one of so
    many min-hashes. Only what is similar on the whole sets is linked. ``component_id`` is the smallest id reachable, ``leader``
    is true for one row of each class: that with the smallest (id, row), NULL ids last. NULL, empty and blank texts have empty sets
    and are one class; texts with equal sets are one class; repeated rows too. A NULL id is kept. Other columns are not read; an
    empty table gives no rows.

    Rows with equal sets are collapsed first. Sets travel only for texts of candidate classes, once for each; the texts they are
    made from are picked by a Bloom filter, so other texts are not shuffled. Candidate classes are cut into parts of
    ``part_bytes`` and every two parts compared in a task of their own, so a large class fills no task.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), text_mark(F.col(text_col)).alias("mark"), F.col(text_col).cast("string").alias("text"))
    rows = stage(narrow.mapInArrow(_sketches(words_each, n_mins), _SKETCH), "sketches")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row", "mark")).alias("first")
    sketch = [F.first(c).alias(c) for c in ("n", *_PRINT, "mins")]
    nodes = stage(rows.groupBy("node").agg(first, *sketch), "sets")
    met = print_links(nodes.where("n > 0"), similarity, max_bits, **search)
    if n_mins:
        keyed = nodes.select("node", F.posexplode("mins").alias("turn", "least"))
        least = keyed.groupBy("turn", "least").agg(F.min("node").alias("v"))
        met = met.unionByName(keyed.join(least, ["turn", "least"]).select(F.col("node").alias("u"), "v"))
    near = components(met).withColumnRenamed("root", "class")
    sized = near.join(nodes.select("node", "n", *_PRINT), "node")
    parts = sized.groupBy("class").agg(F.ceil(F.sum(F.col("n") * 8) / part_bytes).cast("int").alias("parts"))
    members = stage(sized.drop("n").join(parts, "class"), "members")
    wanted = stage(nodes.join(members.select("node"), "node").select(F.col("first.none").alias("none"), F.coalesce("first.id", F.lit(0)).alias("number"), F.col("first.mark").alias("mark")), "wanted")
    held = KeyFilter.of(wanted, wanted.count())
    text = F.col(text_col).cast("string")
    source = docs.select(F.col(id_col).isNull().alias("none"), F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("number"), text_mark(F.col(text_col)).alias("mark"), text.alias("text"))
    picked = held.passing(source).join(wanted, ["none", "number", "mark"], "left_semi").select("text")
    sets = stage(picked.mapInArrow(_sets(words_each), "node long, members binary").dropDuplicates(["node"]), "shingle-sets")
    held.blocks.delete()
    placed = (
        members.join(sets, "node")
        .withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("class", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), "part", "parts", "node", *_PRINT, "members")
        .withColumn("same", F.col("p") == F.col("q"))
    )
    tasks = partitions_for(spark, members.count(), 4096)
    links = stage(placed.repartition(tasks, "class", "p", "q").groupBy("class", "p", "q").applyInPandas(_verified(similarity, max_bits), "u long, v long, whole boolean"), "links")
    # of a class that was verified in one task the links are stars around its smallest node already
    stars = links.where("whole").select("u", "v")
    roots = stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(components(links.where("not whole").select("u", "v")))
    rooted = stage(nodes.select("node", "first").join(roots, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root")), "rooted")
    best = rooted.groupBy("root").agg(F.min("first").alias("best"))
    by_node = rooted.join(best, "root").select("node", "best")
    return rows.join(by_node, "node").select("row", "id", "mark", F.col("best.id").alias("component_id"), (F.col("row") == F.col("best.row")).alias("leader"))


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that lead their class (see ``similar_classes``), with all their columns.

    Of repeated rows one stays, of NULL, empty and blank texts one.
    """
    leaders = similar_classes(docs, id_col, text_col, **options).where("leader")
    return keep_marked(docs, leaders.select("id", "mark"), id_col, text_col)
