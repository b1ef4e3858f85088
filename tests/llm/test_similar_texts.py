import random

import numpy as np
import pytest
from helpers import awkward, clashing

from postflow.llm import similar_texts as S
from postflow.llm.similar_texts import drop_similar, similar_classes


def shingles(text, k=5):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ")
    words = [w for w in words if w]
    return frozenset(tuple(words[i : i + k]) for i in range(max(len(words) - k + 1, 1))) if words else frozenset()


def plain_classes(texts, similarity=0.8):
    """Smallest index reachable over pairs that are similar, all pairs tried."""
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    by_first = {}
    for i, s in enumerate(sets):
        others = set().union(*(by_first.get(x, ()) for x in s)) if s else {j for j in range(i) if not sets[j]}
        for j in others:
            both = len(s & sets[j])
            if both >= similarity * (len(s) + len(sets[j]) - both):
                a, b = sorted((top(i), top(j)))
                root[b] = a
        for x in s:
            by_first.setdefault(x, set()).add(i)
    return [top(i) for i in range(len(texts))]


def variants(seed, n_groups=25, words=120):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(500)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    texts = []
    for g in range(n_groups):
        base = [rng.choice(vocabulary) for _ in range(words)]
        if g % 3 == 0:
            base[20:60] = passage  # shared by texts that are not similar
        for _ in range(rng.choice((1, 2, 6))):
            copy = list(base)
            for _ in range(rng.choice((0, 1, 2, 4, 9))):
                copy[rng.randrange(words)] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    return texts


@pytest.mark.parametrize("part_bytes", [1 << 24, 3000])
def test_classes_equal_all_pairs(spark, part_bytes):
    texts = variants(1)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["id"]: r["component_id"] for r in similar_classes(docs, n_mins=12, part_bytes=part_bytes).collect()}
    assert found == dict(enumerate(plain_classes(texts)))


def test_a_large_group_of_variants_is_one_class(spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(900)}" for _ in range(200)]
    texts = []
    for _ in range(600):
        copy = list(base)
        copy[rng.randrange(200)] = "x"
        texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["component_id"] for r in similar_classes(docs, part_bytes=200_000).collect()} == {0}


def test_awkward_rows(spark):
    docs, rows = awkward(spark, ["one two three four five six", "ONE two three\tfour five six", "other words", "other words here"])
    found = similar_classes(clashing(docs)).collect()
    assert len(found) == len(rows)
    of = {r["id"]: r["component_id"] for r in found}
    assert of[0] == of[1] == 0 and of[2] == 2 and of[3] == 3 and of[4] == of[5] == of[6] == 4
    left = drop_similar(clashing(docs)).collect()
    assert sorted(r["doc_id"] for r in left if r["doc_id"] is not None) == [0, 2, 3, 4, 7, 8] and sum(r["doc_id"] is None for r in left) == 1
    assert similar_classes(docs.limit(0)).count() == 0 and drop_similar(docs.limit(0)).columns == docs.columns


def test_sketches():
    hashes = S.shingle_hashes("a b c d e f a b c d e f a b c d e f", 5)
    distinct = np.unique(hashes)
    assert len(hashes) == 14 and len(distinct) == 6 and S.shingle_hashes("a b", 5).shape == (1,) and not len(S.shingle_hashes(" \n", 5))
    assert S.simhash(hashes) == sum(1 << b for b in range(64) if 2 * sum(int(h) >> b & 1 for h in hashes) > 14)
    assert len(set(S.min_hashes(distinct, 8))) == 8 and S.min_hashes(distinct[:0], 8) == []
    a, b = np.array([1, 4, 9, 11], np.uint64), np.array([4, 5, 11], np.uint64)
    assert S._common(a, b) == S._common(b, a) == 2 and S._common(a[:0], b) == 0


def test_recall_on_the_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").select("doc_id", "text")
    texts = [r["text"] for r in docs.collect()]
    wanted = plain_classes(texts)
    found = {r["id"]: r["component_id"] for r in similar_classes(docs).collect()}
    together = [i for i, root in enumerate(wanted) if root != i]
    assert all(wanted[i] == wanted[k] for i, k in found.items())
    assert sum(found[i] == wanted[i] for i in together) >= 0.9 * len(together)


def test_the_fingerprints_alone_decide_which_texts_meet(spark):
    rng = random.Random(3)
    base, texts = [f"w{rng.randrange(900)}" for _ in range(150)], []
    for first in range(40):
        copy = list(base)
        copy[first * 3] = "other"
        texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["component_id"] for r in similar_classes(docs, n_mins=0).collect()} == {0}


def test_prints_that_meet_in_a_block_are_linked_whatever_the_leaves_and_parts(spark):
    rng = np.random.default_rng(4)
    prints = rng.integers(0, 1 << 63, (300, S.WORDS), np.int64)
    near = prints[:100].copy()
    for k in range(100):
        for bit in rng.choice(256, k % 40, replace=False):
            near[k, bit // 64] ^= np.int64(1) << np.int64(bit % 64 if bit % 64 < 63 else 0)
    every = np.concatenate([prints, near]).view(np.uint64)
    halves = every.view("<u2")
    met = {(a, b) for a in range(400) for b in range(a) if (np.bitwise_count(halves[a] ^ halves[b]) <= 1).any() and np.bitwise_count(every[a] ^ every[b]).sum() <= 64}
    points = spark.createDataFrame([(i, 10, *map(int, p)) for i, p in enumerate(every.view(np.int64))], "node long, n long, " + ", ".join(f"p{w} long" for w in range(S.WORDS)))
    for options in ({}, {"leaf_rows": 20, "part_rows": 15}):
        found = {(max(r), min(r)) for r in S.print_links(points, 0.8, 64, **options).collect()}
        assert found == met and len(met) > 90


def test_pairs_of_near_copies_are_taken_few_at_a_time():
    """Four thousand prints with one block make eight million pairs; what is held at once stays small."""
    import tracemalloc

    import pandas as pd

    prints = np.repeat(np.array([[5, 6, 7, 8]], np.int64), 4000, axis=0)
    prints[:, 1] ^= 1 << (np.arange(4000) % 60)
    frame = pd.DataFrame({"node": np.arange(4000), "n": 100, **{f"p{w}": prints[:, w] for w in range(4)}, "home": True, "leaf": 0, "part": 0, "p": 0, "q": 0})
    met = S._met([(0, 0)], 0.8, 64)
    tracemalloc.start()
    found = met(frame)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 3999 and set(found["v"]) == {0}
    assert most < 40 << 20
