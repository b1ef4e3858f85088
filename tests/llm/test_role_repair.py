import hashlib
import heapq
import random
import re
import zlib

import pytest

from postflow.llm import role_repair as R
from postflow.llm.queries import QUERIES
from postflow.llm.role_repair import damage_report, damaged, repair_conversations, repair_report

SCHEMA = "conv_id long, turn long, role string, text string"
EMPTY = hashlib.sha256(b"").hexdigest()


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        as_text = [" " if x is None else str(x) for x in (conv, turn)]
        role, text = (" " if x is None else x for x in (role, text))
        case = zlib.crc32(":".join(as_text).encode()) % 20
        if case == 0:
            continue
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        out += [(conv, turn, "user" if case == 4 else role, text)] * (2 if case == 3 else 1)
    return out


def plain_repair(rows):
    """Faults and the cheapest edits by trying edit after edit, the least (cost, audit) first."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    faults, seen = [], set()
    for _, _, role, text in rows:
        bare = text.rstrip(" \t\n\v\f\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    may_start = re.compile("s?(ua)*u?")
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, read, out = heapq.heappop(heap)
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", read):
            break
        if (at, read) in done:
            continue
        done.add((at, read))
        steps = [(5, "I", 0, r, (r + "ser:" if r == "u" else "assistant:",)) for r in "ua"]
        if at < len(rows):
            _, _, role, text = rows[at]
            steps.append((2, "D", 1, "", ()))
            if faults[at] not in ("blank", "duplicate"):
                more = 5 if faults[at] == "truncated" else 0
                if role:
                    steps.append((more, "K", 1, role[0], (f"{role}:{text}",)))
                steps += [(1 + more, "R", 1, r, (f"{'user' if r == 'u' else 'assistant'}:{text}",)) for r in "ua"]
        for price, mark, forth, symbol, line in steps:
            if may_start.fullmatch(read + symbol):
                heapq.heappush(heap, (cost + price, audit + mark, at + forth, read + symbol, out + line))
    digest = hashlib.sha256("\n".join(out).encode()).hexdigest()
    return gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, digest


def plain_report(rows):
    found = {}
    for conv in {r[0] for r in rows}:
        mine = [r for r in plain_damage(rows) if r[0] == conv]
        found[conv] = plain_repair(mine) if mine else (0, 0, 0, 0, 0, 0, "", EMPTY)
    return found


def drawn(seed, n_conv=60, most=7):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "So?", " ", "", None, "a b!\n", "long and cut of", "é!"]
    return [
        (conv, rng.choice([t, t, t, None, t + 2]), rng.choice(["user", "assistant", "assistant", "user", "system", "tool", None]), rng.choice(texts))
        for conv in [*range(n_conv), None]
        for t in range(rng.randint(1, most))
    ]


def asked(found):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r["id"]: tuple(r[n] for n in names) for r in found.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_report_equals_brute_force(spark, seed):
    rows = drawn(seed)
    extra = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "role AS conv", "text AS chunk", "turn AS part", "1 AS dealt")
    assert asked(damage_report(extra)) == plain_report(rows)


def test_pieces_give_what_whole_conversations_give(spark):
    rows = drawn(3, n_conv=12, most=40)
    given = spark.createDataFrame(rows, SCHEMA).fillna(" ")
    whole = repair_report(repair_conversations(given)).drop("n_rows")
    cut = repair_conversations(given, rows_each=50, most_rows=3)
    assert cut.where("not alone").count() > 50
    pieces = repair_report(cut).drop("n_rows")
    assert sorted(map(str, pieces.collect())) == sorted(map(str, whole.collect()))


def test_one_long_conversation_goes_through_in_pieces(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"text {i}.") for i in range(9000)] + [(1, 9000, "user", "text 5."), (2, 0, "user", "text 5.")]
    found = repair_conversations(spark.createDataFrame(rows, SCHEMA))
    pieces = {r["chunk"]: r for r in found.where("conv = 1").collect()}
    assert len(pieces) > 2 and max(len(r["turns"]) for r in pieces.values()) <= 4096
    report = {r["conv"]: r for r in repair_report(found).collect()}
    assert report[1]["duplicate"] == 0 and report[1]["truncated"] == 0
    assert report[1]["audit"] == "K" * 9000 + "D" and report[2]["audit"] == "D"
    text = "\n".join(f"{r}:{t}" for _, _, r, t in rows[:9000])
    assert report[1]["repaired_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_rows_said_before_in_another_piece_are_duplicates(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"text {i % 10}.") for i in range(100)]
    found = repair_report(repair_conversations(spark.createDataFrame(rows, SCHEMA), most_rows=7)).first()
    assert found["duplicate"] == 90 and found["audit"] == "K" * 10 + "D" * 90


def test_identical_rows_are_spread_over_pieces(spark):
    rows = [(1, 0, "user", "same.")] * 3000
    found = repair_conversations(spark.createDataFrame(rows, SCHEMA).repartition(8), rows_each=500, most_rows=100)
    assert found.count() >= 30
    report = repair_report(found).first()
    assert report["n_rows"] == 3000 and report["duplicate"] == 2999 and report["illegal"] == 2999


def test_repaired_rows_say_which_edit_made_them(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "assistant", "There.")]
    pieces = repair_conversations(spark.createDataFrame(rows, SCHEMA)).orderBy("chunk").collect()
    assert [tuple(t) for p in pieces for t in p["turns"]] == [("R", "user", "Hello."), ("K", "assistant", "There.")]


def test_grammar_of_the_stack():
    for text in ("", "ua", "uaua", "sua", "suaua"):
        node = R._ROOT
        for symbol in text:
            node = R.shifted(node, symbol)
        assert node[0] in R._ACCEPT
    assert R.shifted(R._ROOT, "a") is None and R.shifted(R.ENTRIES[3], "s") is None and R.ENTRIES[1][0] not in R._ACCEPT


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert damage_report(empty).count() == 0 and repair_conversations(empty).count() == 0


def test_damage_drops_a_whole_conversation(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    given = spark.createDataFrame([(conv, 0, "user", "Hi.")], SCHEMA)
    assert damaged(given).count() == 0
    assert asked(damage_report(given)) == {conv: (0, 0, 0, 0, 0, 0, "", EMPTY)}


def test_query_equals_brute_force_on_the_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = {r["conv_id"]: tuple(r)[1:] for r in QUERIES["op11_conversation_repair"](spark, sf_dir).collect()}
    assert found == plain_report(rows)
