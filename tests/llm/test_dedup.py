import hashlib
import itertools
import random

import numpy as np
import pytest
import xxhash
from helpers import DOCS, awkward, clashing, ordered

from postflow.llm.components import components
from postflow.llm.cuckoo import CuckooFilter, CuckooIndex, digests, drop_exact_duplicates, exact_duplicates
from postflow.llm.simhash import build_forest, drop_near_duplicates, fingerprint, fingerprint_links, simhash_classes


def plain_fingerprint(text, k):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in words.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(prints, most):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(prints)), 2):
        if bin(prints[a] ^ prints[b]).count("1") <= most:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return [find(i) for i in range(len(prints))]


def near_texts(seed=3):
    rng = random.Random(seed)
    base = [" ".join(rng.choice("alpha beta gamma delta Épsilon zeta ETA theta iota kappa".split()) for _ in range(120)) for _ in range(12)]
    out = list(base)
    for text in base[:6]:
        words = text.split()
        words[rng.randrange(len(words))] = "changed"
        out.append(" ".join(words))
    return out + ["one two", "One  TWO", "three", "a\x0bb c\x1cd"]


def test_fingerprints_equal_plain_ones():
    for text in [*near_texts(), None, "", "x", "a b c", "word " * 500]:
        for k in (4, 5):
            assert fingerprint(text, k) == plain_fingerprint(text, k)


def test_classes_equal_all_pairs(spark):
    docs, rows = awkward(spark, near_texts())
    got = simhash_classes(clashing(docs), words_each=4, max_bits=4).collect()
    prints = [fingerprint(r[1], 4) for r in rows]
    root = plain_classes(prints, 4)
    groups = {}
    for r, k in zip(rows, root):
        groups.setdefault(k, []).append(r[0])
    least = {k: min((i for i in ids if i is not None), default=None) for k, ids in groups.items()}
    want = [(r[0], format(p, "016x"), least[k]) for r, p, k in zip(rows, prints, root)]
    assert ordered((r.id, r.fingerprint, r.component_id) for r in got) == ordered(want)
    assert sum(r.leader for r in got) == len(groups)


@pytest.mark.parametrize("blocks", [1, 2, 4])
def test_links_of_a_forest_connect_what_pairs_connect(spark, blocks):
    rng = np.random.default_rng(5)
    prints = rng.integers(0, 1 << 62, 60).tolist()
    for p in list(prints[:20]):
        for _ in range(3):
            prints.append(p ^ sum(1 << int(b) for b in rng.choice(62, rng.integers(1, 7), replace=False)))
    chain = [(1 << (4 * i)) - 1 for i in range(15)]
    prints = sorted(set(prints + chain + [0]))
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    # small leaves and parts, so that shards overlap and are cut
    links = fingerprint_links(frame, 4, blocks=blocks, leaf_rows=8, part_rows=16)
    found = {r.node: r.root for r in components(links).collect()}
    root = plain_classes(prints, 4)
    pairs = {(found.get(a, a) == found.get(b, b)) == (root[i] == root[j]) for (i, a), (j, b) in itertools.combinations(enumerate(prints), 2)}
    assert pairs == {True}


def test_tree_queries_reach_every_close_leaf():
    rng = np.random.default_rng(1)
    points = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    for tree in build_forest(points, 4, 16, 4):
        near = points ^ np.uint64(1 << 5) ^ np.uint64(1 << 37)
        home = tree.home(points)
        met = [set() for _ in points]
        for leaf, rows in tree._walk(near, tree.reach):
            for r in rows:
                met[r].add(leaf)
        close = np.bitwise_count((points ^ near) & np.uint64(tree.mask)) <= tree.reach
        assert all(home[i] in met[i] for i in np.flatnonzero(close))


def test_near_duplicates_keep_all_columns(spark):
    docs, rows = awkward(spark, near_texts())
    kept = drop_near_duplicates(clashing(docs), words_each=4, max_bits=4)
    assert kept.columns == clashing(docs).columns
    assert kept.count() == len(set(plain_classes([fingerprint(r[1], 4) for r in rows], 4)))
    assert drop_near_duplicates(docs.limit(0)).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201), (201, 200), (200, 201)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def strip(text):
    return (text or "").translate({ord(c): None for c in " \t\n\x0b\f\r"})


def test_exact_duplicates_equal_grouping(spark):
    docs, rows = awkward(spark, ["a b", "ab", "a b", "ab\n", "é", "A b", "ab  "])
    got = exact_duplicates(clashing(docs), least_buckets=3).collect()
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(strip(r[1]), []).append((-len(r[1] or ""), r[0] is None, r[0] or 0, i))
    want = []
    for i, r in enumerate(rows):
        first = min(groups[strip(r[1])])
        want.append((r[0], rows[first[3]][0], len(groups[strip(r[1])]), hashlib.sha256(strip(r[1]).encode()).hexdigest()))
    assert ordered((r.id, r.keep_id, r.group_size, r.text_sha256) for r in got) == ordered(want)
    assert sum(r.kept for r in got) == len(groups)
    kept = drop_exact_duplicates(clashing(docs))
    assert kept.count() == len(groups) and kept.columns == clashing(docs).columns
    assert exact_duplicates(docs.limit(0)).count() == 0


def test_filter_inserts_deletes_and_resizes():
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    small = CuckooFilter(4)
    fits = [small.insert(*(p[0] for p in small.places([k]))) for k in keys[:60]]
    assert not all(fits)  # overflow is reported, and what went in stays
    assert small.holds([k for k, f in zip(keys, fits) if f]).all()
    grown = CuckooFilter.rebuilt(keys, small.slots)
    assert grown.holds(keys).all()
    again = CuckooFilter.load(grown.dump())
    for k in keys[:1500]:
        assert again.delete(*(p[0] for p in again.places([k])))
    assert again.holds(keys[1500:]).all() and again.holds(keys[:1500]).mean() < 0.01


def test_index_takes_and_gives_up_live_digests(spark):
    docs = spark.createDataFrame([(1, "x"), (2, "x "), (3, "y"), (4, "z")], "doc_id long, text string").withColumn("r", __import__("pyspark").sql.functions.col("doc_id"))
    rows = digests(docs, "doc_id", "text", "r", 4)
    index = CuckooIndex.empty(spark, 4).insert(rows)
    live = lambda ix: sorted((r.id, r.size) for r in ix.entries().collect())
    assert live(index) == [(2, 2), (3, 1), (4, 1)]
    index = index.delete(rows, rows.where("id in (2, 3)"))
    assert live(index) == [(1, 1), (4, 1)]
    found = {r.id: r.live for r in index.lookup(rows).collect()}
    assert found == {1: True, 2: True, 3: False, 4: True}
    more = digests(spark.createDataFrame([(9, "y", 9), (10, "x\n\n", 10)], "doc_id long, text string, r long"), "doc_id", "text", "r", 4)
    assert live(index.insert(more)) == [(4, 1), (9, 1), (10, 2)]


def test_a_hot_group_among_few_others(spark):
    rows = [(i, "copy of one text" if i % 3 else f"text {i}", "en", "s", 1) for i in range(600)]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r.id: (r.keep_id, r.group_size) for r in exact_duplicates(docs).collect()}
    assert got[599] == (1, 400) and got[3] == (3, 1)
    assert {r.component_id for r in simhash_classes(docs).collect() if r.id % 3} == {1}
