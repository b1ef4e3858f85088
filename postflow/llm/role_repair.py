"""Repair of conversations whose roles are out of order, by a generalised LR parser with weighted edits."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postflow.llm.common import free_name, partitions_for, stage

# The role grammar: C -> empty | B | s B ; B -> B P | P ; P -> u a. Its LR states:
#   0 nothing read, 1 after s, 2 after u, 3 pairs, 4 first pair, 5 s and pairs, 6 u a, 7 pairs and a pair.
_SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (5, "u"): 2, (2, "a"): 6}
_REDUCE = {4: ("B", 1), 6: ("P", 2), 7: ("B", 2)}
_GOTO = {(0, "P"): 4, (1, "P"): 4, (3, "P"): 7, (5, "P"): 7, (0, "B"): 3, (1, "B"): 5}
_ACCEPT = (0, 3, 5)

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
#: What a truncated row that is not deleted adds.
CUT_COST = 5
ROLES = {"u": "user", "a": "assistant"}
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
_SPACE = " \t\n\v\f\r"

#: A node of the stack: (state, node below). Tails are shared between all stacks that grew from them.
_ROOT = (0, None)
#: One stack for every state that can be on top between two rows; what may follow depends on the top alone.
ENTRIES = {0: _ROOT, 1: (1, _ROOT), 2: (2, (3, _ROOT)), 3: (3, _ROOT), 5: (5, (1, _ROOT))}


def shifted(node: tuple, symbol: str) -> tuple | None:
    """The stack after ``symbol`` and all reductions it allows; None where the grammar has no such symbol."""
    state = _SHIFT.get((node[0], symbol))
    if state is None:
        return None
    node = (state, node)
    while node[0] in _REDUCE:
        left, length = _REDUCE[node[0]]
        for _ in range(length):
            node = node[1]
        node = (_GOTO[node[0], left], node)
    return node


def _merge(tops: dict, cost: int, audit: str, node: tuple) -> bool:
    """Of stacks with equal tops the one with the least (cost, audit) stays."""
    held = tops.get(node[0])
    if held is None or cost < held[0] or (cost == held[0] and audit < held[1]):
        tops[node[0]] = (cost, audit, node)
        return True
    return False


def with_inserts(tops: dict) -> dict:
    """All tops reachable by inserted rows; each state has one role that may be inserted."""
    tops, waiting = dict(tops), sorted(tops.values(), key=lambda x: x[0])
    while waiting:
        cost, audit, node = waiting.pop(0)
        if tops[node[0]][1] != audit:
            continue
        after = shifted(node, "u") or shifted(node, "a")
        if _merge(tops, cost + COST[INSERT], audit + INSERT, after):
            waiting.append(tops[after[0]])
    return tops


def advanced(tops: dict, role: str, fault: int) -> dict:
    """Tops after one more row: inserted rows before it, then the row kept, given another role, or deleted."""
    found: dict = {}
    extra = CUT_COST if fault == TRUNCATED else 0
    for cost, audit, node in with_inserts(tops).values():
        _merge(found, cost + COST[DELETE], audit + DELETE, node)
        if fault in (BLANK, DUPLICATE):
            continue
        kept = shifted(node, role[:1])
        if kept:
            _merge(found, cost + extra, audit + KEEP, kept)
        for symbol in ROLES:
            other = shifted(node, symbol)
            if other:
                _merge(found, cost + COST[REROLE] + extra, audit + REROLE, other)
    return found


def closed(tops: dict) -> tuple[int, str]:
    """Least (cost, audit) that ends a conversation, inserted rows behind its last one included."""
    return min((cost, audit) for cost, audit, node in with_inserts(tops).values() if node[0] in _ACCEPT)


def replayed(node: tuple, audit: str, rows: list[tuple[str, str]]) -> tuple[list[tuple[str, str, str]], tuple]:
    """(edit, role, text) of the rows that are left or inserted, and the stack behind them."""
    out, at = [], iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == INSERT else next(at)
        if edit == DELETE:
            continue
        symbol = role[:1] if edit == KEEP else next(s for s in ROLES if shifted(node, s))
        node = shifted(node, symbol)
        out.append((edit, role if edit == KEEP else ROLES[symbol], text))
    return out, node


def _digest(role: str, text: str) -> bytes:
    return hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()


def fault_of(role: str, text: str, seen: set) -> int:
    """First fault of a row; ``seen`` holds the digests of the conversation's rows so far and takes in this one's."""
    bare = text.rstrip(_SPACE)
    if not bare:
        return BLANK
    key = _digest(role, text)
    if key in seen:
        return DUPLICATE
    seen.add(key)
    return 0 if bare[-1] in ".!?" else TRUNCATED


class _Counts:
    """What a report counts; parts of a conversation are added up in order."""

    def __init__(self):
        self.n = self.illegal = self.turns = 0
        self.faults = [0, 0, 0, 0]
        self.first = self.last = None  # role initials
        self.low = self.high = None  # turns

    def add(self, turn: int | None, role: str, fault: int) -> None:
        mark = role[:1]
        if self.n:
            self.illegal += self.last + mark not in ("su", "ua", "au")
        else:
            self.first = mark
        self.n, self.last = self.n + 1, mark
        self.faults[fault] += 1
        if turn is not None:
            self.turns += self.high is None or turn != self.high
            self.low, self.high = (turn if self.low is None else self.low), turn

    def join(self, later: _Counts) -> None:
        if self.n and later.n:
            self.illegal += self.last + later.first not in ("su", "ua", "au")
        self.illegal += later.illegal
        self.first = self.first if self.n else later.first
        self.last = later.last if later.n else self.last
        self.n += later.n
        self.faults = [a + b for a, b in zip(self.faults, later.faults)]
        if later.high is not None:
            self.turns += later.turns - (self.high == later.low)
            self.low, self.high = (later.low if self.low is None else self.low), later.high

    def packed(self) -> dict:
        return {"n": self.n, "illegal": self.illegal, "turns": self.turns, "faults": self.faults, "first": self.first, "last": self.last, "low": self.low, "high": self.high}

    @classmethod
    def of(cls, packed: dict) -> _Counts:
        out = cls()
        out.__dict__.update(packed)
        return out

    def report(self, cost: int, audit: str) -> dict:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {"n_rows": self.n, "gaps": gaps, "blank": self.faults[BLANK], "duplicate": self.faults[DUPLICATE], "truncated": self.faults[TRUNCATED],
                "illegal": self.illegal, "cost": cost, "audit": audit}


_START = {0: (0, "", _ROOT)}
_REPORT = pa.struct([(n, pa.int64()) for n in ("n_rows", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", pa.string())])
_COUNTS = pa.struct([("n", pa.int64()), ("illegal", pa.int64()), ("turns", pa.int64()), ("faults", pa.list_(pa.int64())), ("first", pa.string()), ("last", pa.string()), ("low", pa.int64()), ("high", pa.int64())])
_TURNS = pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]))
_ROWS = pa.list_(pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]))
_PATHS = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_REPORT_SQL = "struct<n_rows:long,gaps:long,blank:long,duplicate:long,truncated:long,illegal:long,cost:long,audit:string>"
_COUNTS_SQL = "struct<n:long,illegal:long,turns:long,faults:array<long>,first:string,last:string,low:long,high:long>"
_TURNS_SQL = "array<struct<edit:string,role:string,text:string>>"
_ROWS_SQL = "array<struct<turn:long,role:string,text:string>>"
_PATHS_SQL = "array<struct<entry:int,exit:int,cost:long,audit:string>>"


def _named(kind: pa.DataType, rows: list[tuple]) -> list[dict]:
    names = [f.name for f in kind.value_type]
    return [dict(zip(names, r)) for r in rows]


def _whole(rows: list[tuple]) -> tuple[dict, list[dict]]:
    """Report and repaired rows of one whole conversation."""
    tops, counts, seen = _START, _Counts(), set()
    for turn, role, text in rows:
        fault = fault_of(role, text, seen)
        counts.add(turn, role, fault)
        tops = advanced(tops, role, fault)
    cost, audit = closed(tops)
    return counts.report(cost, audit), _named(_TURNS, replayed(_ROOT, audit, [r[1:] for r in rows])[0])


def _cut(most: int, conv_type: pa.DataType):
    """Sorted rows of a partition -> whole conversations, repaired, and pieces of those that may go on elsewhere.

    The first and the last conversation of a partition may reach into its neighbours, and one of over ``most`` rows is not
    held at once: these leave as pieces, each with the digests of its rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = seq = 0
        conv, rows, first, split = None, [], True, False
        out: dict[str, list] = {}

        def clear():
            out.update({n: [] for n in ("conv", "chunk", "report", "turns", "rows", "keys")})

        def emit(open_: bool) -> None:
            nonlocal seq, rows
            report, turns = (None, None) if open_ else _whole(rows)
            out["conv"].append(conv)
            out["chunk"].append((part << 32) + seq)
            out["report"].append(report)
            out["turns"].append(turns)
            out["rows"].append(_named(_ROWS, rows) if open_ else None)
            out["keys"].append(sorted({_digest(r, t) for _, r, t in rows if t.rstrip(_SPACE)}) if open_ else None)
            seq, rows = seq + 1, []

        def batch_out() -> pa.RecordBatch:
            kinds = (conv_type, pa.int64(), _REPORT, _TURNS, _ROWS, pa.list_(pa.binary()))
            made = pa.RecordBatch.from_arrays([pa.array(out[n], k) for n, k in zip(out, kinds)], list(out))
            clear()
            return made

        clear()
        for batch in batches:
            for part, c, turn, role, text in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if rows and c != conv:
                    emit(first or split)
                    first = split = False
                elif len(rows) >= most:
                    emit(True)
                    split = True
                elif not rows and split and c != conv:  # the one before ended with its last full piece
                    first = split = False
                conv = c
                rows.append((turn, role, text))
            yield batch_out()
        if rows:
            emit(True)
            yield batch_out()

    return run


def _paths(conv_type: pa.DataType):
    """A piece of a conversation parsed from every top it may be entered with; rows seen in earlier pieces are duplicates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for conv, chunk, rows, earlier in zip(*(batch.column(i).to_pylist() for i in range(4))):
                seen, counts = set(earlier or ()), _Counts()
                tops = {entry: {entry: (0, "", node)} for entry, node in ENTRIES.items()}
                for r in rows:
                    fault = fault_of(r["role"], r["text"], seen)
                    counts.add(r["turn"], r["role"], fault)
                    tops = {entry: advanced(t, r["role"], fault) for entry, t in tops.items()}
                paths = [(entry, node[0], cost, audit) for entry, t in tops.items() for cost, audit, node in t.values()]
                found.append((conv, chunk, rows, counts.packed(), _named(_PATHS, paths)))
            kinds = (conv_type, pa.int64(), _ROWS, _COUNTS, _PATHS)
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], k) for i, k in enumerate(kinds)], ["conv", "chunk", "rows", "counts", "paths"])

    return run


def _fold(conv_type: pa.DataType):
    """Pieces of conversations in order -> what the best parse does in each piece, and the report with the last one.

    Between two pieces only the best (cost, audit) of every top is held, and of each piece the top it was entered by.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, chunks, tops, counts = None, [], {}, _Counts()
        kinds = (conv_type, pa.int64(), pa.int32(), pa.int32(), pa.string(), _REPORT)

        def done() -> pa.RecordBatch:
            # each top's best end; the best of all tells the top behind the last row and what is inserted after it
            ends = [(*closed({state: (c, a, ENTRIES[state])}), state, a) for state, (c, a) in tops.items()]
            cost, audit, exit_, before = min(ends)
            tail, rows = audit[len(before) :], []
            for at in range(len(chunks) - 1, -1, -1):
                entry = chunks[at][1][exit_]
                end = at == len(chunks) - 1
                rows.append((conv, chunks[at][0], entry, exit_, tail if end else "", counts.report(cost, audit) if end else None))
                exit_ = entry
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["conv", "chunk", "entry", "exit", "tail", "report"])

        for batch in batches:
            for c, chunk, packed, paths in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if chunks and c != conv:
                    yield done()
                    chunks, counts = [], _Counts()
                if not chunks:
                    tops = {0: (0, "")}
                conv, after, entered = c, {}, {}
                for p in paths:
                    if p["entry"] in tops:
                        cost, audit = tops[p["entry"]]
                        made = (cost + p["cost"], audit + p["audit"])
                        if p["exit"] not in after or made < after[p["exit"]]:
                            after[p["exit"]], entered[p["exit"]] = made, p["entry"]
                tops = after
                chunks.append((chunk, entered))
                counts.join(_Counts.of(packed))
        if chunks:
            yield done()

    return run


def _replay(conv_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for conv, chunk, rows, paths, entry, exit_, tail, report in zip(*(batch.column(i).to_pylist() for i in range(8))):
                audit = next(p["audit"] for p in paths if (p["entry"], p["exit"]) == (entry, exit_))
                turns, _ = replayed(ENTRIES[entry], audit + tail, [(r["role"], r["text"]) for r in rows])
                found.append((conv, chunk, False, report, _named(_TURNS, turns)))
            kinds = (conv_type, pa.int64(), pa.bool_(), _REPORT, _TURNS)
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], k) for i, k in enumerate(kinds)], ["conv", "chunk", "alone", "report", "turns"])

    return run


def repair_conversations(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    *, rows_each: int = 20_000, most_rows: int = 4096,
) -> DataFrame:
    """Pieces of repaired conversations: (conv, chunk, alone, report, turns).

    ``turns`` holds (edit, role, text) of the rows that stay or come in, in order; ``report`` (n_rows, gaps, blank, duplicate,
    truncated, illegal, cost, audit) is set on a conversation's last piece. ``alone`` marks a conversation that is one
    piece; of others the pieces follow each other by ``chunk``.

    A conversation's rows are taken by turn (NULLs first), then role, then text. Each row's first fault counts: blank, duplicate (role and text
    seen earlier in the conversation), truncated (no ``.``, ``!`` or ``?`` at its end). The parser reads the rows with a
    graph-structured stack over the grammar (system)? (user assistant)*, at least one pair or nothing at all: each row is kept (0),
    given the role user or assistant (1) or deleted (2, the only way for blank and duplicate rows), empty rows of both roles may be
    inserted (5), and a truncated row that stays adds 5. Stacks with equal tops are merged by the least (cost, audit).
    NULLs in role and text count as one space; a NULL conversation id is a conversation; a role counts by its first letter, and one that
    is empty cannot be kept. Repeated rows are duplicates. An empty table gives no rows; other columns are not read.

    Rows are sorted across partitions by conversation and turn, identical rows spread, so a conversation of any size covers several
    partitions. What lies whole within one is repaired there; the rest in pieces of up to ``most_rows`` rows: each is parsed
    from every top it may be entered with, and these parses are joined in order. So no task holds more than a piece's texts; only the
    joining of a conversation's pieces runs in one task, over audits.
    """
    spark = rows.sparkSession
    narrow = rows.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"),
    )
    keyed = narrow.withColumns({"start": F.substring("text", 1, 100), "mark": F.xxhash64("text"), "spread": F.monotonically_increasing_id()})
    order = ["conv", "turn", "role", "start", "mark", "spread"]
    n_parts = partitions_for(spark, narrow.count(), rows_each)
    sorted_rows = keyed.repartitionByRange(n_parts, *order).sortWithinPartitions(*order)
    kind = rows.select(F.col(conv_col).alias("conv")).schema[0].dataType
    conv_type, conv_sql = rows.select(conv_col).limit(0).toArrow().schema[0].type, kind.simpleString()
    given = sorted_rows.select(F.spark_partition_id().cast("long").alias("part"), "conv", "turn", "role", "text")
    cut = stage(given.mapInArrow(_cut(most_rows, conv_type), f"conv {conv_sql}, chunk long, report {_REPORT_SQL}, turns {_TURNS_SQL}, rows {_ROWS_SQL}, keys array<binary>"), "conversations")
    whole = cut.where("report is not null").select("conv", "chunk", F.lit(True).alias("alone"), "report", "turns")
    open_ = cut.where("report is null")
    # a row is a duplicate if an earlier piece of its conversation has its digest; each piece names a digest once
    keys = open_.select("conv", "chunk", F.explode("keys").alias("key"))
    earlier = keys.withColumn("first", F.min("chunk").over(Window.partitionBy("conv", "key"))).where("chunk > first")
    earlier = earlier.groupBy("chunk").agg(F.collect_list("key").alias("earlier"))
    marked = open_.select("conv", "chunk", "rows").join(earlier, "chunk", "left").select("conv", "chunk", "rows", "earlier")
    parsed = stage(marked.mapInArrow(_paths(conv_type), f"conv {conv_sql}, chunk long, rows {_ROWS_SQL}, counts {_COUNTS_SQL}, paths {_PATHS_SQL}"), "parses")
    in_order = parsed.select("conv", "chunk", "counts", "paths").repartition("conv").sortWithinPartitions("conv", "chunk")
    chosen = in_order.mapInArrow(_fold(conv_type), f"conv {conv_sql}, chunk long, entry int, exit int, tail string, report {_REPORT_SQL}")
    joined = parsed.select("conv", "chunk", "rows", "paths").join(chosen.drop("conv"), "chunk").select("conv", "chunk", "rows", "paths", "entry", "exit", "tail", "report")
    return whole.unionByName(joined.mapInArrow(_replay(conv_type), f"conv {conv_sql}, chunk long, alone boolean, report {_REPORT_SQL}, turns {_TURNS_SQL}"))


def _line(turn):
    return F.concat(turn["role"], F.lit(":"), turn["text"])


def _hashed(conv_type: pa.DataType):
    """sha256 over the pieces of each conversation, one after another: only the running hash is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, hasher, report, wrote = None, None, None, False
        kinds = (conv_type, _REPORT, pa.string())

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip((conv, report, hasher.hexdigest()), kinds)], ["conv", "report", "sha256"])

        for batch in batches:
            for c, part_report, turns in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if hasher is not None and c != conv:
                    yield row()
                    hasher = None
                if hasher is None:
                    conv, hasher, report, wrote = c, hashlib.sha256(), None, False
                for t in turns:
                    hasher.update(b"\n" * wrote + f"{t['role']}:{t['text']}".encode())
                    wrote = True
                report = part_report or report
        if hasher is not None:
            yield row()

    return run


def repair_report(repaired: DataFrame) -> DataFrame:
    """(conv, report columns, repaired_sha256) of every conversation with rows, from :func:`repair_conversations`.

    The hash is over ``role:text`` of the repaired rows, joined by newlines. sha256 has to be taken in order, so the pieces of a
    conversation that is not in one piece stream through one task, of which only the running hash is held.
    """
    conv_type = repaired.select("conv").limit(0).toArrow().schema[0].type
    alone = repaired.where("alone").select("conv", "report", F.sha2(F.array_join(F.transform("turns", _line), "\n"), 256).alias("sha256"))
    pieces = repaired.where("not alone").select("conv", "chunk", "report", "turns").repartition("conv").sortWithinPartitions("conv", "chunk")
    hashed = pieces.select("conv", "report", "turns").mapInArrow(_hashed(conv_type), f"conv {repaired.schema['conv'].dataType.simpleString()}, report {_REPORT_SQL}, sha256 string")
    return alone.unionByName(hashed).select("conv", "report.*", F.col("sha256").alias("repaired_sha256"))


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text) with planted faults, by the crc32 of ``conv:turn`` modulo 20 (NULLs are one space in it).

    0 drops the row, 1 empties its text, 2 takes ``.``, ``!`` and ``?`` out of it, 3 repeats the row, 4 makes its role user.
    """
    as_text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv_col, turn_col)]
    dealt = free_name(rows.columns, "dealt")
    marked = rows.withColumn(dealt, F.crc32(F.concat(as_text[0], F.lit(":"), as_text[1]).cast("binary")) % 20).where(F.col(dealt) != 0)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(" "))
    text = F.when(F.col(dealt) == 1, "").when(F.col(dealt) == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(F.col(dealt) == 4, "user").otherwise(F.coalesce(F.col(role_col).cast("string"), F.lit(" ")))
    times = F.explode(F.when(F.col(dealt) == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return marked.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"), times.alias("copy")).drop("copy")


def damage_report(conversations: DataFrame, conv_col: str = "conv_id", **columns) -> DataFrame:
    """:func:`repair_report` of the damaged table for every conversation id of the original one; zeros where no row is left."""
    found = repair_report(repair_conversations(damaged(conversations, conv_col, **columns), "conv"))
    ids = conversations.select(F.col(conv_col).alias("id")).distinct()
    joined = ids.join(found, F.col("id").eqNullSafe(F.col("conv")), "left").drop("conv")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    empty = hashlib.sha256(b"").hexdigest()
    return joined.select("id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))
