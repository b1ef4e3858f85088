"""Exact centroid clustering of integer vectors by bit planes and popcounts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postflow.llm.common import stage

#: Components of a vector: the bits of one 64-bit word.
WIDTH = 64
#: Integers beyond this would not have squared distances that fit into 64 bits.
MOST = 1 << 26


def planes_needed(least: int, most: int) -> int:
    """Bit planes of two's complement that hold all integers from ``least`` to ``most``."""
    return max(int(most).bit_length(), (-int(least) - 1).bit_length() if least < 0 else 0) + 1


def pack(numbers: np.ndarray, n_planes: int) -> np.ndarray:
    """(planes, vectors) of 64-bit words: bit i of word (j, v) is bit j of component i of vector v."""
    planes = np.empty((n_planes, len(numbers)), np.uint64)
    for j in range(n_planes):
        bits = ((numbers >> j) & 1).astype(np.uint8)
        planes[j] = np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()
    return planes


def plane_weights(n_planes: int) -> np.ndarray:
    """What a bit of each plane counts: powers of two, the last one negative (two's complement)."""
    weights = np.left_shift(np.int64(1), np.arange(n_planes, dtype=np.int64))
    weights[-1] = -weights[-1]
    return weights


def dots(planes: np.ndarray, centre: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Exact dot products of all vectors with one: weighted popcounts of the AND of every pair of planes."""
    by_plane = np.zeros(planes.shape, np.int64)
    for word, weight in zip(centre, weights):
        if word:
            by_plane += np.bitwise_count(planes & word) * weight
    return weights @ by_plane


def squares(planes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Exact squared lengths, by the popcounts of a vector's own planes."""
    total = np.zeros(planes.shape[1], np.int64)
    for j, row in enumerate(planes):
        total += weights[j] * (weights @ np.bitwise_count(planes & row).astype(np.int64))
    return total


def nearest(planes: np.ndarray, centres: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centre, squared distance); of equally near centres the smaller number."""
    own = squares(planes, weights)
    words = pack(centres, len(weights))
    far = np.stack([own - 2 * dots(planes, words[:, k], weights) + int((c * c).sum()) for k, c in enumerate(centres)])
    at = far.argmin(axis=0)
    return at, far[at, np.arange(len(at))]


def component_sums(planes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Componentwise sum of vectors: how often each bit of each plane is set, weighted."""
    bits = np.unpackbits(np.ascontiguousarray(planes).view(np.uint8).reshape(*planes.shape, 8), axis=2, bitorder="little")
    return weights @ bits.sum(axis=1, dtype=np.int64)


def _words(column: pa.Array, n_planes: int, at_once: int = 4096) -> Iterator[np.ndarray]:
    """(planes, vectors) pieces of a column of packed vectors."""
    whole = np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(len(column), n_planes)
    for a in range(0, len(whole), at_once):
        yield np.ascontiguousarray(whole[a : a + at_once].T)


def usable(vector: Column) -> Column:
    """The vector has 64 components, none of them NULL or not finite."""
    fine = F.forall(vector, lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    return F.coalesce((F.size(vector) == WIDTH) & fine, F.lit(False))


def _packed(n_planes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)
            rows = np.ascontiguousarray(pack(numbers, n_planes).T).view(np.uint8).reshape(len(numbers), n_planes * 8)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in rows], pa.binary())], ["id", "planes"])

    return run


def _gathered(centres: np.ndarray, n_planes: int):
    """One row per centre and task: how many vectors are nearest to it, and their componentwise sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = plane_weights(n_planes)
        count, total = np.zeros(len(centres), np.int64), np.zeros((len(centres), WIDTH), np.int64)
        for batch in batches:
            for planes in _words(batch.column(0), n_planes):
                at, _ = nearest(planes, centres, weights)
                for k in np.unique(at):
                    mine = planes[:, at == k]
                    count[k] += mine.shape[1]
                    total[k] += component_sums(mine, weights)
        found = np.flatnonzero(count)
        columns = [pa.array(found, pa.int32()), pa.array(count[found]), pa.array(list(total[found]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", "sums"])

    return run


def _assigned(centres: np.ndarray, n_planes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = plane_weights(n_planes)
        for batch in batches:
            found = [nearest(planes, centres, weights) for planes in _words(batch.column(1), n_planes)]
            cluster, distance = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], ["id", "cluster", "distance"])

    return run


def cluster_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, k: int = 8, rounds: int = 10, scale: int = 1024, seed: int = 3
) -> tuple[DataFrame, np.ndarray]:
    """(id, cluster, distance) of every usable vector, and the final centres as integers (centres, components).

    A component x counts as floor(scale * x). Vectors that do not have 64 components, or have a NULL, NaN or infinite one,
    are left out, as the method has no distance for them. The first centres are the ``k`` usable vectors with the
    smallest sha256 of ``seed:id``, in that order (then by their components; NULL ids come last); with fewer
    vectors there are fewer centres. Each of ``rounds`` rounds assigns every vector and moves every centre that has
    vectors to the floor of their mean; then all are assigned once more. Equally near: smaller number. Repeated
    rows and ids count and are returned as often as they come; other columns are not read; an empty table gives
    no rows. Components beyond 2^26 after scaling raise ``OverflowError``: their distances need not fit into 64 bits.

    The packed vectors are staged once; a round reads them, shuffles one row per centre and task, and brings
    ``k`` times 64 sums to the driver.
    """
    spark = vectors.sparkSession
    numbers = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * scale))
    kept = vectors.where(usable(F.col(vector_col))).select(F.col(id_col).cast("long").alias("id"), numbers.alias("numbers"))
    low, high = kept.agg(F.min(F.array_min("numbers")), F.max(F.array_max("numbers"))).first()
    low, high = low or 0, high or 0
    if max(-low, high) > MOST:
        raise OverflowError(f"components from {low} to {high} after scaling; at most {MOST} in size can be clustered exactly")
    n_planes = planes_needed(low, high)
    packed = stage(kept.mapInArrow(_packed(n_planes), "id long, planes binary"), "bit-planes")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = kept.orderBy(order.asc_nulls_last(), "numbers").limit(k).collect()
    centres = np.array([r["numbers"] for r in first], np.int64).reshape(len(first), WIDTH)
    for _ in range(rounds if len(centres) else 0):
        parts = packed.select("planes").mapInArrow(_gathered(centres, n_planes), "cluster int, n long, sums array<long>")
        each = parts.select("cluster", "n", F.posexplode("sums").alias("place", "part"))
        for r in each.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum("part").alias("total")).collect():
            centres[r["cluster"], r["place"]] = r["total"] // r["n"]
    if not len(centres):
        return spark.createDataFrame([], "id long, cluster int, distance long"), centres
    return stage(packed.mapInArrow(_assigned(centres, n_planes), "id long, cluster int, distance long"), "clusters"), centres


def with_inertia(assigned: DataFrame) -> DataFrame:
    """``assigned`` with the distances summed over its cluster and over all; ``k`` sums are sent to the tasks."""
    sums = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()
    by_cluster = F.create_map(*[F.lit(x) for r in sums for x in (r["cluster"], r["cluster_inertia"])]) if sums else F.create_map().cast("map<int,bigint>")
    return assigned.select("*", by_cluster[F.col("cluster")].cast("long").alias("cluster_inertia"), F.lit(sum(r["cluster_inertia"] for r in sums)).cast("long").alias("inertia"))
