"""Find dictionary terms inside post texts.

A term matches when it occurs anywhere in the text, ignoring case and word boundaries. NULL and blank terms
match nothing: they are dropped from the dictionary before anything else. The cleaned dictionary is written
once as a snapshot, and its size decides between four ways that give the same rows.

``literal``    a handful of terms: the tests are written into the projection itself. One codegen stage,
               no join and no shuffle.
``automaton``  up to some 50,000 terms: one pass over each text with a multi-pattern automaton, in Arrow
               batches. Spark has no built-in that searches many terms in one pass; testing them one by one
               costs (text length x terms), the automaton only (text length). Posts are not shuffled.
``store``      up to 64 such automata: the dictionary is cut into bounded shards, and the texts are searched
               with one after another (see ``term_store``). Texts are not shuffled, only (text key, entry) is.
``shuffled``   any size: texts and terms meet in an equi-join. Terms of up to 22 bytes meet the stretches of just
               their length of every text, so what meets is a match. A longer term meets the consecutive
               blocks of the texts; such candidates return to their text by key and are verified there.
               A bitmap of the dictionary, bounded in size, holds back the stretches that are no term (see
               ``stretches``), so only few (text key, stretch) pairs are shuffled, and adaptive execution
               splits the partitions of stretches that many texts share.

Lengths, places and blocks are those of the UTF-8 bytes, in which a term occurs where and only where it occurs in
the characters. Why blocks find everything: wherever a term of 23 bytes or more starts, each possible alignment
puts a whole block of twelve inside it. A term is therefore filed once per alignment, each time under the
block the fewest other terms use, so that a common block does not gather a large part of the dictionary.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postflow.operators import stretches, term_store
from postflow.operators.row_keys import KeyFilter, row_digest
from postflow.operators.skew import fits_broadcast, join_isolated
from postflow.session import Staged, outside_scopes, stage

#: Bytes of a block.
BLOCK = 12
#: Terms of fewer bytes need not hold a whole block at every alignment.
LONG = 2 * BLOCK - 1

_LOWER = term_store.LOWER
_KEY = term_store.KEY
_BLOCK = stretches.PIECE
_NEEDLE = term_store.NEEDLE
_PHASE = "_phase"
#: Whether a post has a text; taken before joins, so that texts nobody asks for do not move.
_PRESENT = "_present"


@dataclass(frozen=True)
class MatchLimits:
    """Dictionary sizes up to which each way is taken."""

    literal_terms: int = 64
    automaton_terms: int = 50_000
    automaton_bytes: int = 4 * 1024 * 1024
    #: Size of one shard of the store, and up to how many shards (passes over the texts) it is taken.
    shard_terms: int = 50_000
    shard_bytes: int = 4 * 1024 * 1024
    store_shards: int = 64


DEFAULT_LIMITS = MatchLimits()


class DictionaryCache:
    """Dictionaries as they were prepared for one version, for work that repeats, such as a stream's batches.

    Preparing means cleaning, measuring, and fetching it or writing its store. ``begin`` names the version of the moment; while it
    does not change, nothing is prepared again, and when it does, what was staged for the old one is deleted.
    """

    def __init__(self):
        self.version, self.prepared = None, 0
        self._held: dict[tuple, tuple] = {}

    def begin(self, version) -> None:
        if version != self.version:
            for _, _, held in self._held.values():
                if held is not None:
                    held.delete()
            self._held.clear()
            self.version = version

    def get(self, key: tuple, prepare: Callable[[], tuple]) -> tuple:
        if key not in self._held:
            self.prepared += 1
            with outside_scopes():
                self._held[key] = prepare()
        return self._held[key]


def dictionary_version(orgs: DataFrame) -> tuple:
    """Equal for equal dictionaries, whatever the order of their rows; one small job."""
    digest = F.xxhash64(row_digest(orgs.schema))
    return tuple(orgs.agg(F.count(F.lit(1)), F.sum(digest.cast("decimal(38,0)")), F.bit_xor(F.xxhash64(digest))).first())


def with_lower(posts: DataFrame, content: str) -> DataFrame:
    """Add the lower-cased text, unless the posts already carry it.

    It leaves through ``explode`` of a one-element array on purpose: filters that use the text many times
    then stay above it, and the text is lower-cased once per post instead of once per term.
    """
    if _LOWER in posts.columns:
        return posts
    return posts.select("*", F.explode(F.array(F.lower(content))).alias(_LOWER))


def without_lower(posts: DataFrame) -> DataFrame:
    return posts.drop(_LOWER)


def _any_term(terms: list[str]) -> Column:
    tests = [F.col(_LOWER).contains(F.lit(t)) for t in terms]
    while len(tests) > 1:
        # a balanced tree keeps the expression shallow
        tests = [a | b for a, b in zip(tests[::2], tests[1::2])] + (tests[-1:] if len(tests) % 2 else [])
    return tests[0]


def _dictionary(terms: DataFrame, limits: MatchLimits, cache: DictionaryCache | None = None) -> tuple[str, list, Staged | None]:
    """Which way to take; the dictionary's rows, or for the ways beyond one automaton its snapshot.

    ``terms`` holds the lower-cased term in column ``_needle``. What is measured, fetched and joined is one
    snapshot, so a dictionary that changes meanwhile is neither cut nor mixed: two jobs, the write that measures
    it and, below the limits, the fetch. With a ``cache`` it is the snapshot of the version begun there.
    """
    if cache is not None:
        return cache.get((tuple(terms.columns), limits), lambda: _dictionary(terms, limits))
    clean = terms.filter(F.col(_NEEDLE).isNotNull() & (F.trim(_NEEDLE) != ""))
    held = Staged.of(clean, sized=terms.columns)
    if held.n_bytes > limits.automaton_bytes or held.n_rows > max(limits.literal_terms, limits.automaton_terms):
        return "any", [], held
    rows = held.table.collect()
    held.delete()
    return "literal" if len(rows) <= limits.literal_terms else "automaton", rows, None


def _labels_found(spark: SparkSession, labels: dict[str, list], kind: str = "int"):
    """Arrow UDF: lower-cased text -> sorted distinct labels of all needles that occur in it."""
    shared = spark.sparkContext.broadcast(labels)

    @F.pandas_udf(f"array<{kind}>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = ahocorasick.Automaton()
        for needle, found in shared.value.items():
            automaton.add_word(needle, found)
        automaton.make_automaton()
        for texts in batches:
            yield texts.map(
                lambda t: sorted({x for _, found in automaton.iter(t) for x in found}) if t else []
            )

    return find


def _any_found(spark: SparkSession, needles: list[str]):
    """Arrow UDF: lower-cased text -> does any needle occur? Stops at the first."""
    shared = spark.sparkContext.broadcast(needles)

    @F.pandas_udf("boolean")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = ahocorasick.Automaton()
        for needle in shared.value:
            automaton.add_word(needle, True)
        automaton.make_automaton()
        for texts in batches:
            yield texts.map(lambda t: bool(t) and next(automaton.iter(t), None) is not None)

    return find


def bounded_broadcast(df: DataFrame, max_rows: int = 1_000_000, max_bytes: int = 64 * 1024 * 1024) -> DataFrame:
    """``broadcast(df)`` if its measured size allows it, else ``df`` unchanged."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df


def _stretches(text: Column, lengths: list[int]) -> Column:
    """Distinct stretches of the given lengths in characters, from every place of the text: the plain form of what ``stretches`` looks for.

    Each match moves on by one character and looks ahead for the stretch, so the time is in proportion to the text.
    """

    def of(n: int) -> Column:
        return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))."), F.lit(1)))

    return F.concat(*[of(n) for n in lengths])


def _filed(entries: DataFrame) -> DataFrame:
    """Long dictionary entries with one block per alignment."""
    spelt = F.encode(_NEEDLE, "UTF-8")
    blocks = (
        entries.select(_NEEDLE)
        .distinct()
        .select(_NEEDLE, F.explode(F.sequence(F.lit(0), F.octet_length(_NEEDLE) - BLOCK)).alias("_offset"))
        .select(_NEEDLE, (F.col("_offset") % BLOCK).alias(_PHASE), F.substring(spelt, F.col("_offset") + 1, F.lit(BLOCK)).alias(_BLOCK))
    )
    users = blocks.groupBy(_BLOCK).agg(F.count(F.lit(1)).alias("_users"))
    filed = blocks.join(users, _BLOCK).groupBy(_NEEDLE, _PHASE).agg(F.min_by(_BLOCK, F.struct("_users", _BLOCK)).alias(_BLOCK))
    return entries.join(filed.select(_NEEDLE, _BLOCK), _NEEDLE)


def text_key(content: str) -> Column:
    """Key of a text; equal texts share it."""
    return F.unhex(F.sha2(F.col(content), 256))


def _key_matches(posts: DataFrame, entries: Staged, content: str, limits: MatchLimits, cache: DictionaryCache | None = None) -> DataFrame:
    """Beyond one automaton: (text key, columns of the dictionary entry) of every distinct text; a pair may come more than once.

    ``entries`` is a cleaned snapshot with ``_needle``; its distinct rows count.
    """
    rows = entries.table.distinct()
    columns = [c for c in rows.columns if c != _NEEDLE]
    present = posts.filter(F.col(content).isNotNull())
    if term_store.shards_needed(entries.n_rows, entries.n_bytes, limits.shard_terms, limits.shard_bytes) <= limits.store_shards:
        texts = present.select(text_key(content).alias(_KEY), F.lower(content).alias(_LOWER))

        def write() -> tuple:
            store = term_store.TermStore.of(rows, entries.n_rows, entries.n_bytes, limits.shard_terms, limits.shard_bytes)
            return "store", store, store.entries

        _, store, _ = write() if cache is None else cache.get(("store", tuple(columns), limits), write)
        return store.hits(texts, columns)
    return _joined_matches(present, rows, content, columns)


def _joined_matches(posts: DataFrame, entries: DataFrame, content: str, columns: list[str]) -> DataFrame:
    """Shuffled way. What may be a term or a block of one is written once; of the texts only those with a candidate of a long term move."""
    texts = posts.select(text_key(content).alias(_KEY), F.lower(content).alias(_LOWER))
    spelt, n_bytes = F.encode(_NEEDLE, "UTF-8"), F.octet_length(_NEEDLE)
    lengths = sorted(r["n"] for r in entries.select(F.least(n_bytes, F.lit(LONG)).alias("n")).distinct().collect())  # at most LONG rows
    whole, block = [n for n in lengths if n < LONG], BLOCK if LONG in lengths else 0
    short = entries.where(n_bytes < LONG).withColumn(_BLOCK, spelt)
    begins = short.select(F.substring(_BLOCK, 1, min(whole, default=1)).alias(_BLOCK), F.lit(stretches.BEGINNING).alias(stretches.KIND))
    keys = begins.unionByName(short.select(_BLOCK, n_bytes.alias(stretches.KIND)))
    if block:
        filed = stage(_filed(entries.where(n_bytes >= LONG)))
        keys = keys.unionByName(filed.select(_BLOCK, F.lit(stretches.IN_BLOCK).alias(stretches.KIND)))
    keys = Staged.of(keys.distinct())
    bitmap = stretches.bitmap_of(keys.table, keys.n_rows)
    keys.delete()
    pieces = stage(stretches.passing(texts, _KEY, F.col(_LOWER), bitmap, whole, block))
    found = pieces.join(short, _BLOCK).select(_KEY, *columns)
    if not block:
        return found
    candidates = Staged.of(pieces.join(filed, _BLOCK).select(_KEY, _NEEDLE, *columns).distinct())
    held = KeyFilter.of(candidates.table.select(_KEY), candidates.n_rows)
    some = held.passing(texts.select(_KEY, _LOWER)).dropDuplicates([_KEY])
    return found.unionByName(candidates.table.join(some, _KEY).where(F.contains(_LOWER, _NEEDLE)).select(_KEY, *columns))


def _with_hits(posts: DataFrame, hits: DataFrame, content: str, how: str) -> DataFrame:
    """Posts joined with ``hits`` by the key of their text; posts without text stay out of the shuffle.

    Posts of a text that very many share do not move either: the hits of these few texts are measured and broadcast. The rest
    is joined by key.
    """
    found = join_isolated(posts.filter(F.col(content).isNotNull()).withColumn(_KEY, text_key(content)), hits, [_KEY], how)
    if how == "inner":
        return found
    return found.unionByName(posts.filter(F.col(content).isNull()), allowMissingColumns=True)


def _spread(posts: DataFrame, labels: Column, how: str) -> DataFrame:
    explode = F.explode if how == "inner" else F.explode_outer
    return posts.select("*", explode(labels).alias("_label"))


def match_terms(
    posts: DataFrame,
    terms: DataFrame,
    *,
    term: str = "keyword",
    content: str = "content",
    how: str = "inner",
    limits: MatchLimits = DEFAULT_LIMITS,
    cache: DictionaryCache | None = None,
) -> DataFrame:
    """Posts with the columns of every dictionary entry found in them, one row per (post, entry).

    ``terms`` holds the entry text in column ``term`` next to any payload such as ``org_id``; an entry
    listed twice gives two rows. With ``how="left"`` a post without a match is kept once, with NULL entry
    columns.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how!r}")
    shared = set(posts.columns) & set(terms.columns)
    if shared:
        raise ValueError(f"posts and terms share the columns {sorted(shared)}")
    spark = posts.sparkSession
    entries = terms.withColumn(_NEEDLE, F.lower(term))
    way, rows, snapshot = _dictionary(entries, limits, cache)
    base = with_lower(posts, content)
    if way == "literal":
        kind = f"struct<{','.join(f'`{f.name}`:{f.dataType.simpleString()}' for f in terms.schema)}>"
        found = [
            F.when(
                F.col(_LOWER).contains(F.lit(r[_NEEDLE])),
                F.struct(*[F.lit(r[c]).alias(c) for c in terms.columns]).cast(kind),
            )
            for r in rows
        ]
        hits = F.array(*found) if found else F.array().cast(f"array<{kind}>")
        if how == "left":
            hits = F.filter(hits, lambda h: h.isNotNull())
        out = _spread(base, hits, how)
        if how == "inner":
            out = out.filter(F.col("_label").isNotNull())
        return out.select(*posts.columns, *[F.col("_label")[c].alias(c) for c in terms.columns])
    if way == "automaton":
        labels: dict[str, list[int]] = {}
        for i, r in enumerate(rows):
            labels.setdefault(r[_NEEDLE], []).append(i)
        listed = spark.createDataFrame(
            [(i, *[r[c] for c in terms.columns]) for i, r in enumerate(rows)],
            "_label int, " + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in terms.schema),
        )
        out = _spread(base, _labels_found(spark, labels)(_LOWER), how)
        # the listed rows are the ones just measured and fetched, so their size is bounded
        return out.join(F.broadcast(listed), "_label", how).select(*posts.columns, *terms.columns)
    # repeated entries are counted before the keys are made distinct, and spread out again afterwards
    counted = snapshot.table.groupBy(*snapshot.table.columns).agg(F.count(F.lit(1)).cast("int").alias("_times"))
    hits = _key_matches(posts, snapshot.of_same_size(counted), content, limits, cache).distinct()
    copies = F.array_repeat(F.lit(0), F.coalesce("_times", F.lit(1)))
    keyed = _with_hits(posts, hits, content, how)
    return keyed.select("*", F.explode(copies).alias("_copy")).select(*posts.columns, *terms.columns)


def match_orgs(
    posts: DataFrame,
    keywords: DataFrame,
    *,
    content: str = "content",
    limits: MatchLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """Posts with ``org_id`` of every organisation one of whose keywords occurs: one row per (post, organisation)."""
    entries = (
        keywords.filter(F.col("org_id").isNotNull())
        .select(F.col("org_id").cast("int").alias("org_id"), F.lower("keyword").alias(_NEEDLE))
        .distinct()
    )
    way, rows, snapshot = _dictionary(entries, limits)
    if way == "any":
        hits = _key_matches(posts, snapshot, content, limits).distinct()
        return _with_hits(posts, hits, content, "inner").select(*posts.columns, "org_id")
    base = with_lower(posts, content)
    if way == "automaton":
        labels: dict[str, list[int]] = {}
        for r in rows:
            labels.setdefault(r[_NEEDLE], []).append(r["org_id"])
        orgs = _labels_found(posts.sparkSession, labels)(_LOWER)
    else:
        by_org: dict[int, list[str]] = {}
        for r in sorted(rows):
            by_org.setdefault(r["org_id"], []).append(r[_NEEDLE])
        tests = [F.when(_any_term(needles), F.lit(org)) for org, needles in by_org.items()]
        orgs = F.array(*tests) if tests else F.array().cast("array<int>")
    out = _spread(base, orgs, "inner").filter(F.col("_label").isNotNull())
    return out.select(*posts.columns, F.col("_label").alias("org_id"))


def org_sets(
    posts: DataFrame,
    keywords: DataFrame,
    *,
    content: str = "content",
    limits: MatchLimits = DEFAULT_LIMITS,
    cache: DictionaryCache | None = None,
) -> DataFrame:
    """Add ``org_ids``: the sorted organisations one of whose keywords occurs, an empty array where none does.

    Posts keep their rows: a text is not repeated for each keyword or organisation.
    """
    entries = (
        keywords.filter(F.col("org_id").isNotNull())
        .select(F.col("org_id").cast("int").alias("org_id"), F.lower("keyword").alias(_NEEDLE))
        .distinct()
    )
    way, rows, snapshot = _dictionary(entries, limits, cache)
    none = F.array().cast("array<int>")
    if way == "any":
        hits = _key_matches(posts, snapshot, content, limits, cache).groupBy(_KEY).agg(F.array_sort(F.collect_set("org_id")).alias("org_ids"))
        return _with_hits(posts, hits, content, "left").select(*posts.columns, F.coalesce("org_ids", none).alias("org_ids"))
    by_org: dict[int, list[str]] = {}
    for r in sorted(rows):
        by_org.setdefault(r["org_id"], []).append(r[_NEEDLE])
    if way == "automaton":
        labels: dict[str, list[int]] = {}
        for org, needles in by_org.items():
            for needle in needles:
                labels.setdefault(needle, []).append(org)
        found = _labels_found(posts.sparkSession, labels)(_LOWER)
    else:
        tests = [F.when(_any_term(needles), F.lit(org)) for org, needles in sorted(by_org.items())]
        found = F.array_compact(F.array(*tests)) if tests else none
    return with_lower(posts, content).select(*posts.columns, F.coalesce(found, none).alias("org_ids"))


def matched_keywords(
    posts: DataFrame,
    keywords: DataFrame,
    *,
    content: str = "content",
    limits: MatchLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """Add ``matched_keywords``: the sorted array of distinct dictionary spellings found; NULL for a NULL text."""
    terms = keywords.select("keyword").distinct().withColumn(_NEEDLE, F.lower("keyword"))
    way, rows, snapshot = _dictionary(terms, limits)
    present = F.col(content).isNotNull()
    if way == "any":
        hits = _key_matches(posts, snapshot, content, limits).groupBy(_KEY).agg(F.array_sort(F.collect_set("keyword")).alias("matched_keywords"))
        keyed = _with_hits(posts.withColumn(_PRESENT, present), hits, content, "left")
        found = F.coalesce("matched_keywords", F.array().cast("array<string>"))
        return keyed.select(*posts.columns, F.when(F.col(_PRESENT), found).alias("matched_keywords"))
    rows = sorted(rows)
    base = with_lower(posts, content)
    if way == "automaton":
        labels: dict[str, list[str]] = {}
        for r in rows:
            labels.setdefault(r[_NEEDLE], []).append(r["keyword"])
        found = _labels_found(posts.sparkSession, labels, "string")(_LOWER)
    elif rows:
        tests = [F.when(F.col(_LOWER).contains(F.lit(r[_NEEDLE])), F.lit(r["keyword"])) for r in rows]
        found = F.array_compact(F.array(*tests))
    else:
        found = F.array().cast("array<string>")
    return base.select(*posts.columns, F.when(present, found).alias("matched_keywords"))


def has_text(posts: DataFrame, content: str = "content") -> DataFrame:
    """Posts whose text is neither NULL nor empty."""
    return posts.filter(F.col(content).isNotNull() & (F.col(content) != ""))


def is_spam(
    posts: DataFrame,
    spam: DataFrame,
    *,
    term: str = "term",
    content: str = "content",
    limits: MatchLimits = DEFAULT_LIMITS,
    cache: DictionaryCache | None = None,
) -> DataFrame:
    """Add ``has_spamwords``: NULL for a missing or empty text, else whether a spam term occurs."""
    needles = spam.select(F.lower(term).alias(_NEEDLE)).distinct()
    way, rows, snapshot = _dictionary(needles, limits, cache)
    present = F.col(content).isNotNull() & (F.col(content) != "")
    if way == "any":
        hits = _key_matches(posts, snapshot, content, limits, cache).select(_KEY, F.lit(True).alias("_spam")).distinct()
        keyed = _with_hits(posts.withColumn(_PRESENT, present), hits, content, "left")
        return keyed.select(*posts.columns, F.when(F.col(_PRESENT), F.coalesce("_spam", F.lit(False))).alias("has_spamwords"))
    if way == "automaton":
        hit = _any_found(posts.sparkSession, [r[_NEEDLE] for r in rows])(_LOWER)
    else:
        hit = _any_term(sorted(r[_NEEDLE] for r in rows)) if rows else F.lit(False)
    return with_lower(posts, content).select(*posts.columns, F.when(present, hit).alias("has_spamwords"))


def drop_spam(
    posts: DataFrame,
    spam: DataFrame,
    *,
    term: str = "term",
    content: str = "content",
    limits: MatchLimits = DEFAULT_LIMITS,
    cache: DictionaryCache | None = None,
) -> DataFrame:
    """Posts with a non-empty text in which no spam term occurs; an empty list drops nothing else."""
    flagged = is_spam(has_text(posts, content), spam, term=term, content=content, limits=limits, cache=cache)
    return flagged.filter(~F.col("has_spamwords")).drop("has_spamwords")
