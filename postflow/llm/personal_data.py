"""Personal data: fixed patterns, and identifiers found by contexts that bootstrapping learns from them."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postflow.llm.common import free_name, stage, text_mark

#: Kinds in the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"\S+")
_EDGES = "\"'`.,;:!?()[]{}<>=#*$%&"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From every @: the domain behind it, and all that may stand before it back to the last match."""
    at, free = text.find("@"), 0
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                yield start, domain.end()
                free = domain.end()
                at = text.find("@", free)
                continue
        at = text.find("@", at + 1)


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four numbers at a time from every run of dotted numbers."""
    for run in _DOTTED.finditer(text):
        parts = run[0].split(".")
        at = run.start()
        for k in range(0, len(parts) - 3, 4):
            own = parts[k : k + 4]
            end = at + sum(map(len, own)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in own):
                yield at, end
            at = end + 1


def luhn(digits: str) -> bool:
    doubled = (2 * int(d) for d in digits[-2::-2])
    return (sum(map(int, digits[::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for run in _DIGITS.finditer(text):
        digits = run[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield run.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for run in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in run[0]) <= 15:
            yield run.span()


_FIND = {"email": _emails, "ip": _addresses, "card": _cards, "phone": _phones}


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of each kind by code points, leftmost and not overlapping within a kind; linear in the text."""
    return {kind: list(find(text)) for kind, find in _FIND.items()}


def listed(spans: list[tuple[str, int, int]]) -> str:
    """kind:start:end by kind as listed, then start."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(set(spans), key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def bare(text: str, a: int, b: int) -> tuple[int, int]:
    """The stretch without the marks around it; a bracket that is closed within it stays."""
    word = text[a:b]
    kept = word.strip(_EDGES)
    start = a + len(word) - len(word.lstrip(_EDGES)) if kept else a
    end = start + len(kept)
    return start - (start > a and text[start - 1] == "(" and ")" in kept and "(" not in kept), end


def shaped(value: str, marks: str) -> bool:
    """May a bare value be an identifier? Five characters or more, among them a digit or one of ``marks``, which are those that
    the seeds of the kind without a digit hold."""
    return len(value) >= 5 and any("0" <= c <= "9" or c in marks for c in value)


def _numeric(word: str) -> bool:
    """May a word be a part of an identifier written with spaces? A digit and no letter."""
    return any("0" <= c <= "9" for c in word) and not any(c.isalpha() for c in word)


class Slots:
    """What stands in the slots of patterns in a text: a base span, or words of identifier shape."""

    def __init__(self, text: str):
        self.text, self.words = text, text.lower().split()
        self.places = [m.span() for m in _WORD.finditer(text)]
        starts = [a for a, _ in self.places]
        self.spans: list[tuple[str, int, int, int, int]] = []  # kind, start, end, first and last word
        self.first, self.last, self.exact, self.taken = {}, {}, {}, set()
        for kind, spans in base_spans(text).items():
            for a, b in spans:
                i, j = bisect_right(starts, a) - 1, bisect_left(starts, b) - 1  # a span may be a part of its words
                self.spans.append((kind, a, b, i, j))
                self.first.setdefault((kind, i), (a, b))
                self.last[kind, j] = (a, b)
                self.exact.setdefault((kind, i, j), (a, b))
                self.taken.update(range(i, j + 1))

    def _own(self, i: int, j: int, marks: str) -> tuple[int, int] | None:
        """Words i to j as a candidate."""
        if i > j or not self.taken.isdisjoint(range(i, j + 1)):
            return None
        a, b = bare(self.text, self.places[i][0], self.places[j][1])
        return (a, b) if shaped(self.text[a:b], marks) else None

    def _run(self, i: int, step: int, most: int) -> int:
        """The last word of the run of numeric words from i on, ``most`` words at most; a comma and the like end it."""
        end = i
        while abs(end + step - i) < most and 0 <= end + step < len(self.words) and end + step not in self.taken:
            if not _numeric(self.words[end]) or not _numeric(self.words[end + step]) or self.words[min(end, end + step)][-1] in ",;:!?":
                break
            end += step
        return end

    def fill(self, side: str, i: int, j: int, kind: str, most: int, marks: str) -> tuple[int, int] | None:
        """The base span of a kind in a slot, else a candidate. The slot is words i to j; of a "before" pattern it is
        known where it starts, of a "behind" pattern where it ends."""
        if side == "before":
            return self.first.get((kind, i)) or self._own(i, self._run(i, 1, most), marks)
        if side == "behind":
            return self.last.get((kind, j)) or self._own(self._run(j, -1, most), j, marks)
        if (kind, i, j) in self.exact:
            return self.exact[kind, i, j]
        return self._own(i, j, marks) if i == j or all(map(_numeric, self.words[i : j + 1])) else None


def contexts(before: list[str], behind: list[str]) -> list[tuple[str, str, str]]:
    """Lexical patterns of up to two words on each side: the two before, the two behind, or one on each side."""
    out = []
    if len(before) == 2:
        out.append(("before", before[0], before[1]))
    if len(behind) == 2:
        out.append(("behind", behind[0], behind[1]))
    if before and behind:
        out.append(("between", before[-1], behind[0]))
    return out


_SEED = pa.struct([("kind", pa.string()), ("value", pa.string()), ("width", pa.int32()), ("side", pa.string()), ("one", pa.string()), ("two", pa.string())])
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_BASE = "row long, id long, mark long, spans array<struct<kind:string,start:long,end:long>>, seeds array<struct<kind:string,value:string,width:int,side:string,one:string,two:string>>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Base spans of every text, and the patterns around them."""
    for batch in batches:
        all_spans, all_seeds = [], []
        for text in batch.column(2):
            slots = Slots(text.as_py() or "")
            spans = [{"kind": k, "start": a, "end": b} for k, a, b, _, _ in slots.spans]
            seeds = []
            for kind, a, b, i, j in slots.spans:
                value = slots.text[a:b]
                # whole words, however long; those the value is glued to are none of them
                for side, one, two in contexts(slots.words[max(i - 2, 0) : i], slots.words[j + 1 : j + 3]):
                    seeds.append({"kind": kind, "value": value.lower(), "width": len(value.split()), "side": side, "one": one, "two": two})
            all_spans.append(spans)
            all_seeds.append(seeds)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), pa.array(all_spans, pa.list_(_SPAN)), pa.array(all_seeds, pa.list_(_SEED))], ["row", "id", "mark", "spans", "seeds"])


class Patterns:
    """A bounded part of the patterns, as sorted pairs of word numbers for each side.

    ``shapes`` has for each kind how many words its identifiers have at most, and the marks of its seeds without a digit.
    """

    def __init__(self, rows: list[tuple[int, str, str, str, str]], shapes: dict[str, tuple[int, str]]):
        self.number: dict[str, int] = {}
        number = lambda w: self.number.setdefault(w, len(self.number))
        pairs: dict[str, list[tuple[int, int, int]]] = {"before": [], "behind": [], "between": []}
        self.shapes, self.kind = shapes, {}
        for which, side, one, two, kind in rows:
            pairs[side].append((number(one), number(two), which))
            self.kind[which] = kind
        self.widest = max((shapes[k][0] for k in set(self.kind.values())), default=1)
        size = self.size = max(len(self.number), 1)
        self.code, self.which = {}, {}
        for side, own in pairs.items():
            made = sorted((a * size + b, w) for a, b, w in own)
            self.code[side] = np.array([c for c, _ in made], np.int64)
            self.which[side] = np.array([w for _, w in made], np.int64)

    def _hits(self, n: np.ndarray, side: str, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index among the pairs of word places, pattern) of every pattern of a side with these two words; the
        patterns of several kinds may have the same words."""
        a, b = n[first], n[second]
        at = np.flatnonzero((a >= 0) & (b >= 0))
        code = a[at] * self.size + b[at]
        low, high = np.searchsorted(self.code[side], code, "left"), np.searchsorted(self.code[side], code, "right")
        many = high - low
        offset = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        return np.repeat(at, many), self.which[side][np.repeat(low, many) + offset]

    def matches(self, slots: Slots) -> Iterator[tuple[int, tuple[int, int] | None]]:
        """(pattern, stretch of the base span or candidate in its slot or None) of every occurrence.

        Between its two words a pattern has any one word, or several that are a base span or a candidate.
        """
        words = slots.words
        n = np.fromiter((self.number.get(w, -1) for w in words), np.int64, len(words))
        # slots of one word by place; slots of several between two words by the base spans, and by the width of candidates
        ones = np.arange(max(len(words) - 2, 0))
        wide = sorted({(i, j) for _, i, j in slots.exact if i < j and i > 0 and j + 1 < len(words)})
        lists = [("before", ones, ones + 1, ones + 2, ones + 2), ("behind", ones + 1, ones + 2, ones, ones), ("between", ones, ones + 2, ones + 1, ones + 1)]
        i, j = np.array(wide, np.int64).reshape(-1, 2).T
        lists.append(("between", i - 1, j + 1, i, j))
        for width in range(2, self.widest + 1):
            at = np.arange(max(len(words) - width - 1, 0))
            lists.append(("between", at, at + width + 1, at + 1, at + width))
        for number, (side, first, second, i, j) in enumerate(lists):
            if not len(first) or not len(self.code[side]):
                continue
            for at, which in zip(*(x.tolist() for x in self._hits(n, side, first, second))):
                kind = self.kind[which]
                most, marks = self.shapes[kind]
                a, b = int(i[at]), int(j[at])
                known = (kind, a, b) in slots.exact
                if number == 3 and not known or number > 3 and (known or b - a >= most):
                    continue
                found = slots.fill(side, a, b, kind, most, marks)
                if found or a == b:
                    yield which, found


def _count(patterns: Patterns):
    """How often each pattern occurs, and how often with a base span or words of identifier shape in its slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, good = Counter(), Counter()
            for text in batch.column(2):
                for which, found in patterns.matches(Slots(text.as_py() or "")):
                    n[which] += 1
                    good[which] += found is not None
            if n:
                yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.int64()), pa.array(list(n.values()), pa.int64()), pa.array([good[w] for w in n], pa.int64())], ["pattern", "n", "n_shaped"])

    return run


def _collect(patterns: Patterns):
    """Every place of a pattern with a base span or words of identifier shape in its slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for key, text in zip(zip(batch.column(1).to_pylist(), batch.column(3).to_pylist()), batch.column(2)):
                text = text.as_py() or ""
                for which, found in patterns.matches(Slots(text)):
                    if found:
                        out.append((*key, which, text[found[0] : found[1]].lower(), *found))
            columns = list(zip(*out)) if out else [[], [], [], [], [], []]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["id", "mark", "pattern", "value", "start", "end"])

    return run


def learn_shapes(seeds: DataFrame, least_seeds: int) -> dict[str, tuple[int, str]]:
    """For each kind, the largest number of words that ``least_seeds`` different seed values have or exceed, 1 at
    least, and the marks inside its seeds without a digit."""
    values = seeds.select("kind", "value", "width").distinct()
    marks = F.array_join(F.array_sort(F.array_distinct(F.split(F.regexp_replace("value", r"[\p{L}\p{N}\s]", ""), ""))), "")
    rows = values.groupBy("kind", "width", F.when(~F.col("value").rlike("[0-9]"), marks).alias("marks")).agg(F.count(F.lit(1)).alias("n")).collect()
    out = {}
    for kind in KINDS:
        own = [r for r in rows if r.kind == kind]
        widths = [w for w in {r.width for r in own} if sum(r.n for r in own if r.width >= w) >= least_seeds]
        out[kind] = max(widths, default=1), "".join(sorted(set("".join(r.marks or "" for r in own))))
    return out


def _parts(patterns: DataFrame, most: int, shapes: dict[str, tuple[int, str]]) -> Iterator[Patterns]:
    """The patterns, at most about ``most`` at a time."""
    n = -(-patterns.count() // most)
    for k in range(n):
        rows = patterns.where(F.pmod(F.xxhash64("pattern"), F.lit(n)) == k).select("pattern", "side", "one", "two", "kind").collect()
        yield Patterns([tuple(r) for r in rows], shapes)


def learn_patterns(narrow: DataFrame, seeds: DataFrame, *, least_seeds: int, threshold: float, rounds: int, most_at_once: int) -> tuple[DataFrame, DataFrame] | None:
    """(patterns with their confidence, places of the patterns that may reach the threshold), or None.

    1. A pattern is a candidate if it stands around ``least_seeds`` different seed values of one kind.
    2. Its occurrences over all texts are counted. No more of them than those around base spans of its kind
       and identifier-shaped words can ever count as right, so a pattern below the threshold by that measure is out.
    3. Patterns and the values in them are a bipartite graph. A seed value has confidence 1; another value that which
       its patterns leave it (one minus the product of their doubts); a pattern the mean of its values over all
       its occurrences. Both are computed in turn, ``rounds`` times.
    """
    pattern = F.xxhash64("kind", "side", "one", "two").alias("pattern")
    by_value = seeds.groupBy(pattern, "kind", "side", "one", "two", "value").agg(F.count(F.lit(1)).alias("n"))
    candidates = stage(by_value.groupBy("pattern", "kind", "side", "one", "two").agg(F.count(F.lit(1)).alias("support")).where(F.col("support") >= least_seeds), "patterns")
    shapes = learn_shapes(seeds, least_seeds)
    counted = None
    for part in _parts(candidates, most_at_once, shapes):
        own = narrow.mapInArrow(_count(part), "pattern long, n long, n_shaped long")
        counted = own if counted is None else counted.unionByName(own)
    if counted is None:
        return None
    totals = counted.groupBy("pattern").agg(F.sum("n").alias("n"), F.sum("n_shaped").alias("n_shaped"))
    open_ = stage(candidates.join(totals, "pattern").where(F.col("n_shaped") >= threshold * F.col("n")), "open-patterns")
    places = None
    for part in _parts(open_, most_at_once, shapes):
        own = narrow.mapInArrow(_collect(part), "id long, mark long, pattern long, value string, start long, end long")
        places = own if places is None else places.unionByName(own)
    if places is None:
        return None
    places = stage(places, "places")
    known = seeds.select("value").distinct().withColumn("seed", F.lit(True))
    edges = places.groupBy("pattern", "value").agg(F.count(F.lit(1)).alias("k")).join(known, "value", "left").withColumn("seed", F.coalesce("seed", F.lit(False)))
    edges = stage(edges, "edges")
    total = open_.select("pattern", "n")
    confidence = edges.groupBy("pattern").agg(F.sum(F.when(F.col("seed"), F.col("k")).otherwise(0)).alias("right")).join(total, "pattern")
    confidence = stage(confidence.select("pattern", (F.col("right") / F.col("n")).alias("confidence")), "confidence")
    for _ in range(rounds):
        doubt = F.sum(F.log(F.lit(1.0) - F.least(F.col("confidence"), F.lit(0.999))))
        values = edges.join(confidence, "pattern").groupBy("value").agg(F.max("seed").alias("seed"), (1 - F.exp(doubt)).alias("belief"))
        values = values.select("value", F.when(F.col("seed"), 1.0).otherwise(F.col("belief")).alias("belief"))
        mean = edges.join(values, "value").groupBy("pattern").agg(F.sum(F.col("k") * F.col("belief")).alias("right")).join(total, "pattern")
        confidence = stage(mean.select("pattern", (F.col("right") / F.col("n")).alias("confidence")), "confidence")
    return open_.join(confidence, "pattern"), places


def personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, least_seeds: int = 5, threshold: float = 0.8, rounds: int = 4,
    most_at_once: int = 200_000, row_col: str | None = None,
) -> DataFrame:
    """(row, id, base, spans) of every row: spans are arrays of (kind, start, end) in code points.

    ``base``: what the fixed patterns find (see ``base_spans``). ``spans``: these and the identifiers found by
    context: words of the shape of a kind's seeds (see ``shaped``, ``learn_shapes``) in the slot of a pattern of ``threshold``
    confidence or more, which do not overlap a base span or lie within another such; they have the kind of the pattern's seeds. Patterns are learned from all texts (see
    ``learn_patterns``); at most ``most_at_once`` of them go out with a pass over the texts, and there are as many
    passes as that takes. NULL and empty texts have no spans. A NULL id stays NULL, repeated rows are
    searched each, other columns are not read.
    """
    row = row_col or free_name(docs.columns, "row_no")
    source = docs if row_col else docs.withColumn(row, F.monotonically_increasing_id())
    narrow = source.select(F.col(row).alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), text_mark(F.col(text_col)).alias("mark"))
    base = stage(narrow.mapInArrow(_scan, _BASE), "base-spans")
    seeds = base.select(F.explode("seeds").alias("s")).select("s.*")
    learned = learn_patterns(narrow, seeds, least_seeds=least_seeds, threshold=threshold, rounds=rounds, most_at_once=most_at_once)
    found = base.select("row", "id", "mark", F.col("spans").alias("base"))
    if learned is None:
        return found.select("row", "id", "base", F.col("base").alias("spans"))
    patterns, places = learned
    sure = patterns.where(F.col("confidence") >= threshold).select("pattern", "kind")
    # the texts were read once more; id and text together say which rows the places belong to
    extra = places.join(sure, "pattern").groupBy(F.col("id").alias("own_id"), F.col("mark").alias("own_mark")).agg(F.collect_set(F.struct("kind", "start", "end")).alias("extra"))
    joined = found.join(extra, F.col("id").eqNullSafe(F.col("own_id")) & (F.col("mark") == F.col("own_mark")), "left").withColumn("extra", F.coalesce("extra", F.array().cast("array<struct<kind:string,start:long,end:long>>")))
    free = F.filter("extra", lambda e: ~F.exists("base", lambda b: (b["start"] < e["end"]) & (e["start"] < b["end"])))
    joined = joined.withColumn("extra", free)
    inside = lambda e, o: (o["kind"] == e["kind"]) & (o["start"] <= e["start"]) & (e["end"] <= o["end"]) & (o != e)
    outer = F.filter("extra", lambda e: ~F.exists("extra", lambda o: inside(e, o)))
    return joined.select("row", "id", "base", F.concat("base", outer).alias("spans"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        base, spans = ([[(s["kind"], s["start"], s["end"]) for s in own or ()] for own in batch.column(i).to_pylist()] for i in (1, 2))
        counts = [pa.array([sum(s[0] == k for s in own) for own in base], pa.int64()) for k in KINDS]
        digest = pa.array([hashlib.sha256(listed(own).encode()).hexdigest() for own in base], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column(0), *counts, digest, pa.array([listed(own) for own in spans], pa.string())], ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])


def span_report(found: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) from ``personal_data``: counts and digest of the base
    spans, and all spans as text."""
    return found.select("id", "base", "spans").mapInArrow(_digests, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
