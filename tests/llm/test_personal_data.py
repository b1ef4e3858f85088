import hashlib
import random
import re
import time

import pytest
from helpers import awkward, clashing, frame, ordered

from postflow.llm.personal_data import KINDS, base_spans, listed, luhn, personal_data, span_report

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, found):
    digits = re.sub("[^0-9]", "", found)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in found.split(".")), "card": lambda: 13 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]()


def plain(text):
    return {k: [m.span() for m in re.finditer(p, text or "") if passes(k, m[0])] for k, p in PATTERNS.items()}


def test_base_spans_equal_the_patterns():
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab1205.@-+ ()%é") for _ in range(rng.randint(0, 60))) for _ in range(20_000)]
    texts += ["".join(rng.choice("12.") for _ in range(rng.randint(0, 40))) for _ in range(8000)]
    texts += ["".join(rng.choice("0123456789 -") for _ in range(rng.randint(13, 30))) for _ in range(8000)]
    for text in [*texts, "", "4111 1111-1111 1111", "😀 a@b.c"]:
        assert base_spans(text) == plain(text)


def test_luhn():
    assert luhn("4111111111111111") and luhn("79927398713") and not luhn("79927398710")


def test_long_runs_take_linear_time():
    start = time.perf_counter()
    base_spans("1" * 300_000 + "a@" * 100_000 + "+1" * 100_000 + "1." * 100_000 + "a" * 300_000)
    assert time.perf_counter() - start < 10


def digest(text):
    found = plain(text)
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in found[k]).encode()).hexdigest()


@pytest.fixture(scope="module")
def taught():
    rows = [(k, f"Please write to my badge number user{k}@ex{k}.org ok then, {k}") for k in range(8)]
    rows += [(100 + k, f"please write to my badge number (QX-{k}77-A) ok then") for k in range(5)]  # the context alone tells
    rows += [(200 + k, f"the version number 2.0.1{k} ok fine and the number 12345{k} in a row") for k in range(20)]
    return rows + [(300, "my badge number plate99x ok then")] + [(400 + k, f"number word ok then and so on user{k}@ex{k}.org") for k in range(3)]


def test_contexts_find_unseen_identifiers(spark, taught):
    docs = frame(spark, taught)
    for most in (200_000, 3):  # in one pass or many
        got = {r.doc_id: r for r in span_report(personal_data(clashing(docs.withColumn("lang", docs.text)), most_at_once=most)).collect()}
        for i, text in taught:
            row, base = got[i], plain(text)
            assert row.base_sha256 == digest(text) and [row[f"n_{k}"] for k in KINDS] == [len(base[k]) for k in KINDS]
            own = [f"{k}:{a}:{b}" for k in KINDS for a, b in base[k]]
            found = [s for s in row.spans.split(",") if s]
            assert set(own) <= set(found)
            extra = [text[int(s.split(":")[1]) : int(s.split(":")[2])] for s in found if s not in own]
            assert extra == ([f"QX-{i - 100}77-A"] if 100 <= i < 200 else ["plate99x"] if i == 300 else [])


def test_contexts_of_spaced_and_letter_only_seeds(spark):
    names = "ann bob cleo dora egon fay gus hal".split()
    rows = [(k, f"call her mobile line +1 (743) 555-38{k:02} after nine today") for k in range(8)]
    rows += [(10, "call her mobile line (743) 555-3899 after nine today"), (11, "call her mobile line 743 555 3898 after nine today")]
    rows += [(20 + k, f"send it to mailbox {name}.doe@mail.com before noon please") for k, name in enumerate(names)]
    rows += [(30, "send it to mailbox jane.doe[at]mail.com before noon please"), (31, "nothing 555 3898 here")]
    got = {r.doc_id: r.spans for r in span_report(personal_data(frame(spark, rows))).collect()}
    want = {10: ("phone", "(743) 555-3899"), 11: ("phone", "743 555 3898"), 30: ("email", "jane.doe[at]mail.com")}
    for i, text in rows:
        own = [f"{k}:{a}:{b}" for k in KINDS for a, b in plain(text)[k]]
        if i in want:
            kind, value = want[i]
            own.append(f"{kind}:{text.index(value)}:{text.index(value) + len(value)}")
        assert got[i] == ",".join(own)


def test_contexts_of_long_words(spark):
    wide = "w" * 500
    rows = [(k, f"{wide} mark user{k}@ex{k}.org{' ' * 500}{wide} end") for k in range(8)] + [(9, f"{wide} mark QX-77-A {wide} end")]
    got = {r.doc_id: r.spans for r in span_report(personal_data(frame(spark, rows))).collect()}
    assert got[9] == "email:506:513" and all(got[k] == listed([("email", *plain(rows[k][1])["email"][0])]) for k in range(8))


def test_awkward_rows(spark):
    docs, rows = awkward(spark, ["mail a@b.c now", "nothing"])
    got = span_report(personal_data(docs)).collect()
    assert ordered((r.doc_id, r.base_sha256, r.spans) for r in got) == ordered((r[0], digest(r[1]), listed([(k, a, b) for k, s in plain(r[1]).items() for a, b in s])) for r in rows)
    assert span_report(personal_data(docs.limit(0))).count() == 0
