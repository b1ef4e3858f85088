import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import awkward, clashing, frame, ordered

from postflow.llm.language_model import N_BUCKETS, expand, learn_weights, score_texts, squeeze
from postflow.llm.toxicity import Network, Scorer, Shape, bare, drop_toxic, fit, held_out, tokens, toxicity, train, windows, word_inputs

# ---- language model


def crc(i):
    return zlib.crc32(b"" if i is None else str(i).encode())


def plain_tokens(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\f\r":
        lower = lower.replace(c, " ")
    return [w for w in lower.split(" ") if w] + ["</s>"]


def plain_model(rows, order):
    """Scores with dictionaries of n-grams; weights by the same rule from all held-out events."""
    docs = [(i, plain_tokens(t)) for i, t in rows]
    training = [d for d in docs if crc(d[0]) % 5 != 1]
    kept = [d for d in training if crc(d[0]) // 5 % 5 != 0]

    def counts(part):
        grams = Counter()
        for _, words in part:
            padded = ["<s>"] * (order - 1) + words
            for t in range(len(words)):
                for n in range(1, order + 1):
                    grams[tuple(padded[t + order - n : t + order])] += 1
        begin = Counter({("<s>",) * n: len(part) for n in range(1, order)})
        return grams, begin, sum(len(w) for _, w in part), len({w for _, words in part for w in words})

    def events(words, model):
        grams, begin, n_tokens, n_words = model
        padded = ["<s>"] * (order - 1) + words
        for t in range(len(words)):
            got = [1 / (n_words + 1)]
            for n in range(1, order + 1):
                gram = tuple(padded[t + order - n : t + order])
                context = (grams + begin)[gram[:-1]] if n > 1 else n_tokens
                got.append(grams[gram] / context if context else 0.0)
            longest = context if order > 1 else n_tokens
            yield got, min(int(math.log2(longest)) + 1, N_BUCKETS - 1) if longest else 0

    small = counts(kept)
    small = (small[0], small[1], small[2], small[3])
    held = [e for d in training if crc(d[0]) // 5 % 5 == 0 for e in events(d[1], small)]
    weights = learn_weights(np.array([b for _, b in held]), np.ones(len(held)), np.array([e for e, _ in held]).T if held else np.zeros((order + 1, 0)))
    full = counts(training)
    out = []
    for i, words in docs:
        base = sum(math.log10((full[0][(w,)] + 0.5) / (full[2] + 0.5 * (full[3] + 1))) for w in words)
        score = sum(math.log10(float(weights[b] @ np.array(e))) for e, b in events(words, full))
        out.append((i, crc(i) % 5 == 1, len(words), sum(full[0][(w,)] > 0 for w in words), full[2], base, score))
    return out


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return [r.text[:400] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(50).collect()]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_a_plain_model(spark, texts, order):
    rows = [*enumerate(texts), (700, None), (701, ""), (None, "no id the"), (702, "the the THE\x0bof"), (702, "the the THE\x0bof")]
    docs = frame(spark, rows)
    got = score_texts(clashing(docs.withColumn("lang", docs.text)), order=order, block_chars=2000, share_keys=500).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    got = sorted(((r.id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got), key=key)
    want = sorted(plain_model(rows, order), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], rel=1e-9)
        assert g[6] == pytest.approx(w[6], rel=2e-2)  # held-out events are grouped by quarter powers of two


def test_model_beats_base_on_held_out_texts(spark, sf_dir):
    got = score_texts(spark.read.parquet(f"{sf_dir}/documents.parquet")).where("held_out").collect()
    assert got and sum(r.score for r in got) > sum(r.base_score for r in got)


def test_nothing_to_learn_from(spark):
    only = next(i for i in range(100) if crc(i) % 5 == 1)
    (r,) = score_texts(frame(spark, [(only, "a b")])).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (3, 0, 0, True) and r.score == pytest.approx(0)
    assert r.base_score == pytest.approx(0)
    assert score_texts(frame(spark, [])).count() == 0
    docs, rows = awkward(spark, [])
    assert score_texts(docs).count() == len(rows)


def test_numbers_are_squeezed_without_loss():
    for values in ([], [0], [1, 255, 256], [2**64 - 1, 0, 7], list(range(5000))):
        assert expand(squeeze(np.array(values, np.uint64))).tolist() == values


def test_weights_follow_the_better_estimate():
    good = learn_weights(np.full(200, 5), np.ones(200), np.array([np.full(200, 0.001), np.full(200, 0.01), np.full(200, 0.5)]))
    assert good[5].argmax() == 2 and good.sum(axis=1) == pytest.approx(1) and good[0][2] == 0 and (good[1:] > 0).all()


# ---- toxicity


SMALL = Shape(window=8, stride=4, least_docs=2)


def test_gradients_equal_differences():
    shape = Shape(window=5, stride=2, word_slots=20, char_slots=20, word_size=3, char_size=2, hidden=3, attention=4)
    net = Network.fresh(shape)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    rng = np.random.default_rng(0)
    x, mask, y = rng.standard_normal((5, 4, 5)), np.ones((5, 4)), np.array([0, 1, 1, 0.0])
    mask[3:, 1] = 0
    loss = lambda: float(np.sum(np.log1p(np.exp(net.forward(x, mask))) - y * net.forward(x, mask)))
    logit, kept = net.forward(x, mask, keep=True)
    grad, d_x = net.backward(1 / (1 + np.exp(-logit)) - y, kept, mask)
    for array, g in [*((net.weights[k], np.asarray(g).reshape(net.weights[k].shape)) for k, g in grad.items()), (x, d_x)]:
        for _ in range(4):
            at = tuple(rng.integers(0, d) for d in array.shape)
            old = array[at]
            array[at] = old + 1e-3
            up = loss()
            array[at] = old - 1e-3
            down = loss()
            array[at] = old
            assert g[at] == pytest.approx((up - down) / 2e-3, rel=0.05, abs=2e-4)


def test_windows_overlap_and_cover():
    for n in (0, 1, 8, 9, 30, 1001):
        starts = windows(n, SMALL)
        assert set(range(n)) <= {i for s in starts for i in range(s, s + SMALL.window)}
        assert all(b - a <= SMALL.stride for a, b in zip(starts, starts[1:])) and max(starts) + SMALL.window <= max(n, SMALL.window)


def corpus(n=500):
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abdehilmnorst"), rng.integers(2, 8))) for _ in range(300)]
    rows = []
    for i in range(n):
        text = list(rng.choice(words, rng.integers(5, 60)))
        if i % 4 == 0:
            text.insert(rng.integers(0, len(text)), rng.choice(["vile", "Vilest!", "scumbag", "scumbags,"]))
        rows.append((i, " ".join(text), int(i % 4 == 0)))
    return rows


@pytest.fixture(scope="module")
def scored(spark):
    rows = corpus()
    docs, labels = frame(spark, [r[:2] for r in rows]), spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    net = fit(docs, labels, shape=SMALL, passes=12)
    return rows, docs, labels, net


def test_held_out_documents_are_told_apart(scored):
    rows, docs, _, net = scored
    got = toxicity(clashing(docs.withColumn("lang", docs.text)), net).collect()
    label = {r[0]: r[2] for r in rows}
    own = [r for r in got if r.held_out]
    assert {r.id for r in own} == {i for i in label if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([r.predicted == label[r.id] for r in own]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)


def test_scores_do_not_depend_on_batches_or_memory(scored):
    rows, _, _, net = scored
    texts = [r[1] for r in rows[:60]]
    whole = Scorer(net).scores(texts)
    small = Scorer(net, most_words=20)
    assert np.allclose([small.scores([t], at_once=1)[0] for t in texts], whole, atol=1e-5)
    assert Scorer(net).scores([texts[1] + " filler words" * 3000 + " vile " + "more filler" * 300])[0] > 0.5  # anywhere in a long text


def test_awkward_rows_are_scored(spark, scored):
    docs, rows = awkward(spark, ["fine words", "a scumbag here"])
    got = toxicity(docs, scored[3]).collect()
    assert len(got) == len(rows) and not [r for r in got if r.id is None and r.held_out]
    by_id = {r.id: r.score for r in got}
    assert by_id[2] == by_id[3] == by_id[4]  # NULL, empty and blank
    assert toxicity(docs.limit(0), scored[3]).count() == 0
    untrained = fit(docs, spark.createDataFrame([(None, 1), (3, None)], "doc_id long, toxic int"), shape=SMALL)
    assert toxicity(docs, untrained).count() == len(rows)


def test_toxic_documents_go(spark, scored):
    rows, docs, labels, _ = scored
    kept = {r.doc_id for r in drop_toxic(clashing(docs.withColumn("lang", docs.text)), labels, shape=SMALL, passes=12).collect()}
    clean = {r[0] for r in rows if not r[2]}
    assert len(kept & clean) > 0.97 * len(clean) and len(kept - clean) < 0.05 * (len(rows) - len(clean))


def test_repeated_words_count_each():
    """Windows are cut from all words of a text, repeats in a row included."""
    assert tokens("a a a b b a") == ["a", "a", "a", "b", "b", "a"] and tokens(None) == []


def plain_probability(net, words):
    """The network's probability of one window, word by word and gate by gate."""
    w, h = {k: v.astype(float) for k, v in net.weights.items()}, net.shape.hidden
    places = []
    for word in words:
        slot, triples, _ = word_inputs([bare(word)], net.vocabulary, net.shape)
        places.append(np.concatenate([w["word"][slot[0]], w["char"][triples].mean(axis=0)]))

    def sigmoid(x):
        return 1 / (1 + math.exp(-x))

    def walk(way, order):
        state, out = [0.0] * h, {}
        for at in order:
            given = [sum(places[at][i] * w["input"][way, i, j] for i in range(len(places[at]))) + w["bias"][way, 0, j] for j in range(3 * h)]
            back = [sum(state[i] * w["state"][way, i, j] for i in range(h)) for j in range(3 * h)]
            new = []
            for j in range(h):
                z, r = sigmoid(given[j] + back[j]), sigmoid(given[h + j] + back[h + j])
                new.append(z * state[j] + (1 - z) * math.tanh(given[2 * h + j] + r * back[2 * h + j]))
            state = out[at] = new
        return out

    ahead, behind = walk(0, range(len(words))), walk(1, range(len(words) - 1, -1, -1))
    joint = [ahead[t] + behind[t] for t in range(len(words))]
    score = [sum(math.tanh(sum(x * w["look"][i, a] for i, x in enumerate(j))) * w["weigh"][a] for a in range(net.shape.attention)) for j in joint]
    grown = [math.exp(s - max(score)) for s in score]
    pooled = [sum(g * j[i] for g, j in zip(grown, joint)) / sum(grown) for i in range(2 * h)]
    return sigmoid(sum(p * o for p, o in zip(pooled, w["out"])) + w["offset"][0])


def test_scores_equal_brute_force():
    shape = Shape(window=6, stride=3, word_slots=16, char_slots=64, hidden=3, attention=4, word_size=3, char_size=2)
    net = Network.fresh(shape, {"bad": 1, "word": 2, "so": 3}, seed=2)
    for text in ("bad", "So bad a word!", "kill kill kill x", "one two three four five six seven eight nine ten so bad", "x" * 300 + " word"):
        words = text.split()
        wanted = max(plain_probability(net, words[a : a + 6]) for a in windows(len(words), shape))
        assert Scorer(net).scores([text])[0] == pytest.approx(wanted, abs=1e-5)


def test_training_windows_hold_whole_words():
    from postflow.llm.toxicity import _cut
    import pandas as pd

    text = "a " * 40 + "y" * 500
    (made,) = _cut(Shape(), 4)([pd.DataFrame({"number": [1], "text": [text], "label": [1]})])
    assert " ".join(made["text"]) == text


def test_training_takes_no_examples():
    assert Scorer(train([], SMALL)).scores(["x", ""]).shape == (2,)


def test_training_holds_a_few_bytes_a_word():
    """Most of the driver's memory were the words of all windows, each a string, and their pairs with documents."""
    words = [f"word{i}" for i in range(2000)]
    rng = np.random.default_rng(5)
    examples = [(i // 8, " ".join(words[k] for k in rng.integers(0, len(words), 32)), i // 8 % 2) for i in range(1600)]

    def most(n):
        tracemalloc.start()
        train(examples[:n], batch=32, steps=1, passes=4)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return peak

    most(100)
    assert most(1600) - most(400) < 20 * 32 * 1200


def test_vocabulary_has_words_of_enough_documents():
    texts = ["a b b ... c", "a (b) zz", "a c c", "b ,a c", "", "... d d d d"]
    examples = [(doc, texts[k], k % 2) for doc in (9, -3, 9, 4, 2**40) for k in (doc % 6, (doc + 2) % 6, 0)]
    docs = {}
    for doc, text, _ in examples:
        docs.setdefault(doc, set()).update(bare(w) for w in text.split())
    count = Counter(w for own in docs.values() for w in own)
    for least in (1, 2, 4):
        wanted = sorted((w for w in count if count[w] >= least), key=lambda w: (-count[w], w))
        shape = Shape(window=2, stride=1, least_docs=least, word_slots=6)
        assert train(iter(examples), shape, passes=0).vocabulary == {w: i for i, w in enumerate(wanted[:5], 1)}
