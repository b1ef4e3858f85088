"""Near duplicates by SimHash fingerprints, found with a forest of vantage-point trees."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postflow.llm.common import keep_marked, partitions_for, stage, text_mark
from postflow.llm.components import components
from postflow.operators.skew import join_isolated

#: Shingles hashed before their bits are added up; bounds the memory a long text takes.
_PIECE = 1 << 16


def fingerprint(text: str | None, words_each: int) -> int:
    """SimHash of a text: bit set where over half of the shingle hashes have it.

    A-Z is lower-cased, words are separated by ASCII white space, shingles are counted with repeats. Fewer
    words than a shingle: the whole sequence is the one shingle. No words (or NULL): zero.
    """
    words = (text or "").encode("utf-8").lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    width = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(width + 1) - 1
    starts = ends - width
    k = min(words_each, len(words))
    first, last = starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
    total = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(first), _PIECE):
        hashes = [digest(joined[a:b], 42) for a, b in zip(first[at : at + _PIECE], last[at : at + _PIECE])]
        octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(first)).view("<u8")[0])


def _fingerprints(words_each: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), words_each) for t in batch.column(2)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), pa.array(prints.view(np.int64))], ["row", "id", "mark", "fp"])

    return run


@dataclass(frozen=True)
class Tree:
    """A vantage-point tree over one block of fingerprint bits.

    ``vantage``/``radius`` by inner node, ``child`` the nodes inside and outside the radius; a leaf is
    written as its negative number minus one. Distances are Hamming distances on ``mask`` only.
    """

    mask: int
    reach: int
    vantage: np.ndarray
    radius: np.ndarray
    child: np.ndarray
    root: int

    def _walk(self, points: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, indexes of the points whose ball of ``reach`` meets it)."""
        todo = [(self.root, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if node < 0:
                yield -node - 1, rows
                continue
            far = np.bitwise_count((points[rows] ^ self.vantage[node]) & np.uint64(self.mask)).astype(np.int64)
            # triangle bounds: a point within reach of p is at most far + reach and at least far - reach away
            todo.append((int(self.child[node, 0]), rows[far - reach <= self.radius[node]]))
            todo.append((int(self.child[node, 1]), rows[far + reach > self.radius[node]]))

    def home(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int64)
        for leaf, rows in self._walk(points, 0):
            out[rows] = leaf
        return out

    def shards(self, points: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(leaf, rows, at home?): each point in its own leaf and, as a query, in later leaves it overlaps."""
        home = self.home(points)
        for leaf, rows in self._walk(points, self.reach):
            rows = rows[home[rows] <= leaf]
            yield leaf, rows, home[rows] == leaf


def build_tree(sample: np.ndarray, mask: int, reach: int, leaves: int, seed: int = 7) -> Tree:
    """Split the sample at the median distance from a vantage point until ``leaves`` leaves are there.

    The vantage point is the one of a few candidates from which the distances spread most. A set that no
    candidate can split (equal values) stays a leaf.
    """
    rng = np.random.default_rng(seed)
    most = max(1, -(-len(sample) // max(leaves, 1)))
    vantage, radius, child, n_leaves = [], [], [], 0

    def grow(points: np.ndarray) -> int:
        nonlocal n_leaves
        best = None
        if len(points) > most:
            for v in rng.choice(points, min(8, len(points)), replace=False):
                far = np.bitwise_count((points ^ v) & np.uint64(mask)).astype(np.int64)
                cut = int(np.median(far))
                cut = cut - 1 if cut == far.max() else cut
                inside = far <= cut
                if 0 < inside.sum() < len(points) and (best is None or far.var() > best[0]):
                    best = (far.var(), v, cut, inside)
        if best is None:
            n_leaves += 1
            return -n_leaves
        node = len(vantage)
        vantage.append(best[1])
        radius.append(best[2])
        child.append((0, 0))
        child[node] = (grow(points[best[3]]), grow(points[~best[3]]))
        return node

    root = grow(sample)
    return Tree(mask, reach, np.array(vantage, np.uint64), np.array(radius, np.int64), np.array(child, np.int64).reshape(-1, 2), root)


def block_masks(blocks: int) -> list[int]:
    """Bit masks that cut 64 bits into ``blocks`` runs of nearly equal length."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]


def build_forest(sample: np.ndarray, max_bits: int, leaves: int, blocks: int) -> list[Tree]:
    """One tree per block of bits. Two fingerprints within ``max_bits`` are within ``max_bits // blocks`` in one
    block at least, so searching every tree with that reach misses no pair."""
    return [build_tree(sample, m, max_bits // blocks, leaves) for m in block_masks(blocks)]


def _shards(forest: list[Tree]):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            points = frame["fp"].to_numpy().view(np.uint64)
            for number, tree in enumerate(forest):
                for leaf, rows, home in tree.shards(points):
                    yield pd.DataFrame({"leaf": np.int64(number << 32 | leaf), "fp": points[rows].view(np.int64), "home": home})

    return run


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the classes of a[i] and b[i]; ``label`` holds a class's smallest index for each point."""
    while True:
        x, y = label[a], label[b]
        low = np.minimum(x, y)
        if np.array_equal(x, y):
            return
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        while not np.array_equal(label, label[label]):
            label[:] = label[label]


def _links(max_bits: int):
    """Compare the points at home in a shard with one another and with the queries; links as stars.

    Points are ordered by their distance from one vantage point; only shells within ``max_bits`` of each
    other are compared, 512 points at a time. A class of k points leaves k - 1 links, not k * k. Of a shard
    cut into parts, a task gets two parts and compares across them.
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(~frame["home"].to_numpy(), kind="stable")
        points = frame["fp"].to_numpy()[order].view(np.uint64)
        part = frame["part"].to_numpy()[order]
        n_home = int(frame["home"].sum())
        label = np.arange(len(points))
        if n_home:
            far = np.bitwise_count(points ^ points[0]).astype(np.int64)
            rank = np.argsort(far, kind="stable")
            sorted_far, sorted_points = far[rank], points[rank]
            home = np.argsort(far[:n_home], kind="stable")
            for at in range(0, n_home, 512):
                rows = home[at : at + 512]
                lo = np.searchsorted(sorted_far, far[rows[0]] - max_bits, "left")
                hi = np.searchsorted(sorted_far, far[rows[-1]] + max_bits, "right")
                for c in range(lo, hi, 1 << 13):
                    d = min(hi, c + (1 << 13))
                    near = np.bitwise_count(points[rows][:, None] ^ sorted_points[None, c:d]) <= max_bits
                    i, j = np.nonzero(near)
                    a, b = rows[i], rank[c + j]
                    other = (a != b) & ((part[a] != part[b]) | bool(frame["same"].iat[0]))
                    if other.any():
                        _merge(label, a[other], b[other])
        linked = np.nonzero(label != np.arange(len(points)))[0]
        signed = points.view(np.int64)
        return pd.DataFrame({"u": signed[linked], "v": signed[label[linked]]})

    return run


def fingerprint_links(
    prints: DataFrame, max_bits: int = 4, *, blocks: int = 4, leaf_rows: int = 4096, max_leaves: int = 4096, sample: int = 16384, part_rows: int = 32768
) -> DataFrame:
    """(fp) distinct -> (u, v): links that connect exactly what pairs within ``max_bits`` connect.

    The trees are fitted on at most ``sample`` fingerprints (those with the smallest hash; bounded, so they may
    be at the driver and go out with the tasks); all fingerprints are routed and searched, so the fit
    decides only how evenly the shards are filled. A shard over ``part_rows`` is cut into parts by hash and
    every two parts are compared in a task of their own: a task's memory is bounded for any data.
    """
    spark = prints.sparkSession
    n = prints.count()
    if not n:
        return spark.createDataFrame([], "u long, v long")
    fitted = prints.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(sample).toPandas()["fp"].to_numpy().view(np.uint64)
    forest = build_forest(fitted, max_bits, max(1, min(n // leaf_rows, max_leaves)), blocks)
    tasks = partitions_for(spark, n, leaf_rows)
    routed = stage(prints.select("fp").repartition(partitions_for(spark, n, 65536)).mapInPandas(_shards(forest), "leaf long, fp long, home boolean"), "shards")
    # one row per leaf, at most blocks * max_leaves of them
    size = routed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).withColumn("parts", F.ceil(F.col("n") / part_rows).cast("int"))
    placed = (
        routed.join(F.broadcast(size), "leaf")
        .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("leaf", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), "part", "fp", "home")
        .withColumn("same", F.col("p") == F.col("q"))
    )
    return placed.repartition(tasks, "leaf", "p", "q").groupBy("leaf", "p", "q").applyInPandas(_links(max_bits), "u long, v long")


def simhash_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, words_each: int = 5, max_bits: int = 4, **search) -> DataFrame:
    """Fingerprint and near-duplicate class of every row.

    Returns (row, id, mark, fingerprint, component_id, leader): ``row`` numbers the rows of ``docs``, ``mark`` is a hash
    of the text, ``component_id`` is the smallest id reachable over links of at most ``max_bits`` bits, itself
    included, and ``leader`` is true for one row of each class: that with the smallest (id, row), NULL ids
    last. NULL texts count as empty; texts without words have fingerprint zero and link like any other. Rows
    with a NULL id are kept; a class of such rows only has a NULL component_id. Repeated rows are one class.
    Other columns are not read. An empty table gives no rows.

    Equal fingerprints are collapsed before the search, so copies cost one row each; see ``fingerprint_links``.
    """
    narrow = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), text_mark(F.col(text_col)).alias("mark"))
    rows = stage(narrow.mapInArrow(_fingerprints(words_each), "row long, id long, mark long, fp long"), "fingerprints")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first")
    prints = stage(rows.groupBy("fp").agg(first), "prints")
    roots = components(fingerprint_links(prints, max_bits, **search))
    rooted = stage(prints.join(roots, prints.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "rooted")
    best = rooted.groupBy("root").agg(F.min("first").alias("best"))
    # rows of a class or a print that holds much of the table stay where they are
    by_print = join_isolated(rooted, best, ["root"]).select("fp", "best")
    return join_isolated(rows, by_print, ["fp"]).select(
        "row", "id", "mark", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("best.id").alias("component_id"), (F.col("row") == F.col("best.row")).alias("leader"),
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that lead their class (see ``simhash_classes``), with all their columns."""
    leaders = simhash_classes(docs, id_col, text_col, **options).where("leader")
    return keep_marked(docs, leaders.select("id", "mark"), id_col, text_col)
