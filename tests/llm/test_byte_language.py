import math

import numpy as np
import pytest

from helpers import awkward, clashing
from postflow.llm import byte_language as B


def plain_labels(net, raw):
    """Probabilities of every byte of one window, gate by gate and number by number."""
    w = {k: v.astype(float) for k, v in net.weights.items()}
    hidden = w["state"].shape[1]

    def sigmoid(x):
        return 1 / (1 + math.exp(-x))

    def walk(way, order):
        state, out = [0.0] * hidden, {}
        for at in order:
            given = w["drive"][way, raw[at]]
            back = [sum(state[i] * w["state"][way, i, j] for i in range(hidden)) for j in range(3 * hidden)]
            new = []
            for j in range(hidden):
                shut, reset = sigmoid(given[j] + back[j]), sigmoid(given[hidden + j] + back[hidden + j])
                fresh = math.tanh(given[2 * hidden + j] + reset * back[2 * hidden + j])
                new.append(shut * state[j] + (1 - shut) * fresh)
            state = out[at] = new
        return out

    ahead, behind = walk(0, range(len(raw))), walk(1, range(len(raw) - 1, -1, -1))
    found = []
    for at in range(len(raw)):
        joint = ahead[at] + behind[at]
        logits = [sum(x * w["out"][i, k] for i, x in enumerate(joint)) + w["offset"][k] for k in range(len(net.languages))]
        grown = [math.exp(x) for x in logits]
        found.append([g / sum(grown) for g in grown])
    return np.array(found)


def lettered(spark, n=60):
    """Two languages told apart by their letters."""
    rows = []
    for i in range(n):
        rows.append((i, "aba bab abba ba " * (1 + i % 4) if i % 2 else "éçé çéç ççé éé " * (1 + i % 4), "xx" if i % 2 else "yy", "s", 1))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_pooled_scores_equal_brute_force():
    net = B.ByteNetwork.fresh(["a", "b", "c"], hidden=5, window=16, seed=3)
    texts = [b"", b"x", bytes(range(200, 256)) * 2, b"exactly 16 bytes", b"a little longer than one window"]
    offsets = np.cumsum([0, *map(len, texts)])
    found = B.pooled(net, np.frombuffer(b"".join(texts), np.uint8), offsets, at_once=3)
    for row, raw in zip(found, texts):
        parts = [plain_labels(net, raw[a : a + 16]) for a in range(0, len(raw), 16)]
        wanted = np.concatenate(parts).mean(axis=0) if parts else np.zeros(3)
        assert np.allclose(row, wanted, atol=1e-5)


def test_gradients_equal_differences():
    net = B.ByteNetwork.fresh(["a", "b"], hidden=3, window=6, seed=1)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    text = np.frombuffer(b"abcadbcabcda", np.uint8)
    places = B.grid(text, np.array([0, 6]), np.array([6, 10]), 6)
    label = np.array([0, 1])
    _, grad = net.gradients(places, label)
    for name, at in (("drive", (0, 97, 1)), ("drive", (1, 98, 4)), ("drive", (0, 99, 8)), ("state", (0, 1, 2)), ("state", (1, 2, 7)), ("out", (4, 1)), ("offset", (0,))):
        held = net.weights[name][at]
        loss = []
        for move in (1e-3, -1e-3):
            net.weights[name][at] = held + move
            found = net.labels(places)[:, np.arange(2), label]
            loss.append(-np.log(found[places != B.NOTHING]).mean())
        net.weights[name][at] = held
        assert grad[name][at] == pytest.approx((loss[0] - loss[1]) / 2e-3, rel=0.05, abs=2e-4)


def test_learns_languages_and_takes_awkward_rows(spark):
    docs = lettered(spark)
    net = B.fit(docs, passes=8)
    assert net.languages == ["xx", "yy"]
    found = {r["id"]: r for r in B.predict_languages(docs, net).collect()}
    assert all(found[i]["lang_pred"] == ("xx" if i % 2 else "yy") and 0.5 < found[i]["score"] <= 1 for i in range(60))
    odd, rows = awkward(spark, ["abba", "123 !?", "ab" * 200_000, "é"])
    rows_found = B.predict_languages(clashing(odd), net).collect()
    assert len(rows_found) == len(rows)
    by_text = {i: [(r["lang_pred"], r["score"]) for r in rows_found if r["id"] == i] for i in {r[0] for r in rows}}
    assert by_text[0][0][0] == by_text[2][0][0] == "xx" and by_text[3][0][0] == "yy"
    assert by_text[1] == by_text[4] == by_text[5] == by_text[6] == [("und", 0.0)]
    (first, score), (second, again) = by_text[7]
    assert first == second and score == pytest.approx(again, abs=1e-5) and by_text[None][0][0] in ("xx", "yy")
    assert not next(r for r in rows_found if r["id"] is None)["held_out"]


def test_held_out_rows_are_not_learnt_from(spark):
    docs = lettered(spark)
    changed = docs.selectExpr("doc_id", "text", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 THEN 'zz' ELSE lang END AS lang")
    a, b = B.fit(docs.where("crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 <> 0"), passes=1), B.fit(changed, passes=1)
    assert a.languages == b.languages and all((a.weights[k] == b.weights[k]).all() for k in a.weights)


def test_large_ids_and_repeated_rows(spark):
    rows = [(2**53 + 1, "aba"), (2**63 - 1, "aba"), (None, "aba")]
    docs = lettered(spark).select("doc_id", "text", "lang")
    net = B.fit(docs.unionByName(docs).unionByName(docs.selectExpr("doc_id", "NULL AS text", "lang")), passes=1)
    found = B.predict_languages(spark.createDataFrame(rows, "doc_id long, text string"), net).collect()
    assert sorted((r["id"] for r in found), key=str) == sorted((r[0] for r in rows), key=str)


def test_nothing_to_learn_from(spark):
    empty = lettered(spark).limit(0)
    net = B.fit(empty)
    assert net.languages == [] and B.predict_languages(empty, net).count() == 0
    assert {(r["lang_pred"], r["score"]) for r in B.predict_languages(lettered(spark), net).collect()} == {("und", 0.0)}


def test_held_out_accuracy(spark):
    """On the larger tables nearly all held-out documents get their language."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = B.predict_languages(docs, B.fit(docs)).join(docs.selectExpr("doc_id AS id", "lang"), "id").where("held_out")
    right = found.selectExpr("avg(CAST(lang_pred = lang AS DOUBLE)) AS right").first()["right"]
    assert right >= 0.97
