import hashlib
import math
import random

import numpy as np
import pytest

from postflow.llm import bit_planes as B
from postflow.llm.bit_planes import cluster_vectors, with_inertia

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain_clusters(rows, k=8, rounds=10):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))[:k]
    centres = [list(v) for _, v in first]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for n, members in groups.items():
            centres[n] = [sum(column) // len(members) for column in zip(*members)]
    return sorted(((i, near(v)[1], near(v)[0]) for i, v in kept), key=str), centres


def drawn(n, seed, spread=0.3):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, spread) for _ in range(64)] for _ in range(5)]
    return [(i, [m + rng.gauss(0, 0.1) for m in rng.choice(middles)]) for i in range(n)]


@pytest.mark.parametrize("n, spread", [(300, 0.3), (40, 30.0), (5, 0.3)])
def test_equals_brute_force(spark, n, spread):
    rows = drawn(n, n, spread)
    rows += [(rows[0][0], rows[0][1])] * 20 + [(None, rows[1][1]), (2**53 + 1, rows[2][1]), (2**63 - 1, rows[3][1])]
    bad = [(900, None), (901, [0.5] * 63), (902, [None] + [0.5] * 63), (903, [math.nan] + [0.5] * 63), (904, [math.inf] + [0.5] * 63), (905, [])]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows + bad], SCHEMA).selectExpr("*", "label AS id", "label AS cluster", "label AS planes")
    found, centres = cluster_vectors(table)
    wanted, wanted_centres = plain_clusters(rows)
    assert sorted((tuple(r) for r in found.collect()), key=str) == wanted
    assert centres.tolist() == wanted_centres
    sums = with_inertia(found).collect()
    assert {r["inertia"] for r in sums} == {sum(r[2] for r in wanted)}
    assert all(r["cluster_inertia"] == sum(w[2] for w in wanted if w[1] == r["cluster"]) for r in sums)


def test_equally_near_takes_the_smaller_number(spark):
    rows = [(i, [float(i % 2)] * 64) for i in range(12)] + [(50, [0.5] * 64)]
    found, _ = cluster_vectors(spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA))
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain_clusters(rows)[0]


def test_popcounts_are_exact():
    rng = np.random.default_rng(4)
    numbers = rng.integers(-B.MOST, B.MOST, (50, 64))
    numbers[0], numbers[1] = -B.MOST, B.MOST
    n = B.planes_needed(numbers.min(), numbers.max())
    planes, weights = B.pack(numbers, n), B.plane_weights(n)
    for centre in numbers[:5]:
        assert B.dots(planes, B.pack(centre[None], n)[:, 0], weights).tolist() == [sum(int(a) * int(b) for a, b in zip(v, centre)) for v in numbers]
    assert B.squares(planes, weights).tolist() == [sum(int(a) ** 2 for a in v) for v in numbers]
    assert B.component_sums(planes, weights).tolist() == numbers.sum(axis=0).tolist()


def test_empty_table_and_too_large_components(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert with_inertia(cluster_vectors(empty)[0]).count() == 0
    with pytest.raises(OverflowError, match="at most"):
        cluster_vectors(spark.createDataFrame([(1, [1e9] * 64, 1)], SCHEMA))
