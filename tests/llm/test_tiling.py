import random

import numpy as np
from helpers import awkward, clashing, frame, ordered

from postflow.llm.tiling import Slice, contaminated, drop_contaminated, rolling, tiles, words_of

ITEMS = "item_id long, text string"
WORDS = [f"w{i}" for i in range(400)]


def plain_tiles(item, doc, least):
    """Greedy string tiling by comparing every place with every place."""
    a, b, found = [True] * len(item), [True] * len(doc), []
    while True:
        best, at = least - 1, []
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and a[i + n] and b[j + n] and item[i + n] == doc[j + n]:
                    n += 1
                if n > best:
                    best, at = n, []
                if n == best and n >= least:
                    at.append((i, j))
        if not at:
            return found
        for i, j in at:
            if all(a[i : i + best]) and all(b[j : j + best]):
                found.append((i, j, best))
                a[i : i + best] = [False] * best
                b[j : j + best] = [False] * best


def test_rolling_hashes_agree_with_windows():
    ids = np.array(random.Random(1).choices(range(5), k=300))
    for k in (1, 3, 7):
        seen = {}
        for i, h in enumerate(rolling(ids, k).tolist()):
            assert seen.setdefault(tuple(ids[i : i + k].tolist()), h) == h
        assert len(set(seen.values())) == len(seen)


def test_tiles_equal_plain_tiling():
    rng = random.Random(2)
    for _ in range(150):
        item = [rng.randrange(4) for _ in range(rng.randint(0, 25))]
        doc = [rng.randrange(4) for _ in range(rng.randint(0, 40))]
        for least in (2, 3, 5):
            assert tiles(np.array(item, np.int64), np.array(doc, np.int64), least) == plain_tiles(item, doc, least)


def plain_hits(docs, items, threshold=0.8):
    out = set()
    for row in docs:
        for item_id, text in items:
            item, doc = words_of(text), words_of(row[1])
            if len(item) >= 5:
                covered = sum(t[2] for t in plain_tiles(item, doc, 5))
                if covered >= threshold * len(item):
                    out.add((row[0], item_id, covered))
    return out


def planted(seed=3):
    rng = random.Random(seed)
    pick = lambda n: [rng.choice(WORDS) for _ in range(n)]
    items = [(i, " ".join(pick(rng.randint(12, 40)))) for i in range(8)] + [(50, "too short here"), (51, None), (52, "")]
    texts = []
    for _, text in items[:8]:
        words = text.split()
        half = len(words) // 2
        texts += [
            " ".join(pick(20) + words + pick(5)),  # whole
            " ".join(words[half:] + pick(9) + words[:half]),  # reordered
            " ".join(w.upper() + "," for w in words),  # other case and marks
            " ".join(pick(20) + words[: int(0.6 * len(words))]),  # too little of it
            " ".join(w if i % 4 else "other" for i, w in enumerate(words)),  # no run of five
        ]
    return items, texts


def test_hits_equal_plain_tiling_for_any_slicing(spark):
    items, texts = planted()
    docs = frame(spark, [*enumerate(texts), (None, texts[0]), (900, None), (901, ""), (902, texts[1]), (902, texts[1])])
    want = plain_hits([*enumerate(texts), (None, texts[0]), (902, texts[1])], items)
    table = spark.createDataFrame(items + items[:1], ITEMS)
    for words in (1_000_000, 60):
        got = contaminated(clashing(docs.withColumn("lang", docs.text)), table, slice_words=words).collect()
        assert {(r.id, r.item_id, r.covered) for r in got} == want
        assert len(got) == len(want) + sum(1 for w in want if w[0] == 902)
        assert all(sum(t.words for t in r.tiles) == r.covered for r in got)
    assert {k % 5 for k in (w[0] for w in want) if k is not None and k < 900} == {0, 1, 2}


def test_contaminated_documents_go(spark):
    items, texts = planted()
    docs, rows = awkward(spark, texts)
    kept = drop_contaminated(clashing(docs), spark.createDataFrame(items, ITEMS))
    bad = {r[0] for r in plain_hits(rows[: len(texts)], items)}
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(r[0] for r in rows if r[0] is not None and r[0] not in bad)
    assert kept.columns == clashing(docs).columns
    none = spark.createDataFrame([], ITEMS)
    assert drop_contaminated(docs, none).count() == len(rows)
    assert contaminated(docs.limit(0), spark.createDataFrame(items, ITEMS)).count() == 0


def test_a_long_text_of_one_seed_is_cheap():
    part = Slice.of([(1, "a b c d e f g h i j")], 5)
    assert list(part.hits("a b c d e " * 20_000, 0.8)) == []
    assert [h[1] for h in part.hits("a b c d e " * 2000 + "f g h i j", 0.8)] == [10]


def test_short_items_are_found_whole(spark):
    docs = spark.createDataFrame([(1, "it says: The Answer, is FOUR."), (2, "answer is the four"), (3, None), (4, "four")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "the answer is four"), (2, "Four!"), (3, ""), (4, None), (None, "the answer")], "item_id long, text string")
    found = {(r["id"], r["item_id"], r["coverage"]) for r in contaminated(docs, items).collect()}
    assert found == {(1, 1, 1.0), (1, 2, 1.0), (2, 2, 1.0), (4, 2, 1.0), (1, None, 1.0)}
    assert [r["doc_id"] for r in drop_contaminated(docs, items).collect()] == [3]


def test_many_slices_are_taken_one_after_another(spark):
    items = spark.createDataFrame([(k, " ".join(f"w{k}x{j}" for j in range(12))) for k in range(40)] + [(None, None)], "item_id long, text string")
    docs = spark.createDataFrame([(k, "before " + " ".join(f"w{k}x{j}" for j in range(12))) for k in range(0, 60, 2)], "doc_id long, text string")
    assert {(r["id"], r["item_id"]) for r in contaminated(docs, items, slice_words=80).collect()} == {(k, k) for k in range(0, 40, 2)}
    assert sorted(r["doc_id"] for r in drop_contaminated(docs, items, slice_words=80).collect()) == list(range(40, 60, 2))
