import random

import pytest
from conftest import values
from postflow.functions import phrases
from postflow.operators import matching as m
from pyspark.sql import functions as F

TEXTS = [
    None, "", "   ", "ÉTION partout", "the license number", "LICENSE", "unlicensed text", "nothing here",
    "abcabcabcabd", "x", "ab", "aaaaaaaaaaaa", "smile 😀😀 face 😀b", "İstanbul", "tab\tand\nnewline term\nsplit",
    "ends with needle", "needle starts", "neeedle needlenee dle needle",
]
TERMS = [
    (1, "étion"), (1, "license"), (2, "LICENSE"), (2, "abd"), (3, "abcabd"), (3, "x"), (4, "ab"), (4, "aaaaaaa"),
    (5, "😀b"), (5, "😀😀 f"), (6, "needle"), (6, "needlenee dle"), (7, "term\nsplit"), (7, "license"), (7, "license"),
    (8, "not in any text"), (9, "i̇stanbul"),
]
WAYS = {
    "literal": m.MatchLimits(),
    "automaton": m.MatchLimits(literal_terms=0),
    "store": m.MatchLimits(literal_terms=0, automaton_terms=0, shard_terms=9),
    "shuffled": m.MatchLimits(literal_terms=0, automaton_terms=0, store_shards=0),
}


def posts(spark, texts=TEXTS):
    return spark.createDataFrame(list(enumerate(texts)), "id int, content string")


def dictionary(spark, terms=TERMS):
    return spark.createDataFrame(terms, "org_id int, keyword string")


def expected(texts, terms):
    return [(i, o, k) for i, t in enumerate(texts) if t for o, k in terms if k.lower() in t.lower()]


@pytest.fixture(params=sorted(WAYS))
def limits(request):
    return WAYS[request.param]


def key(r):
    return tuple((x is not None, str(x)) for x in r)


def test_terms_equal_brute_force(spark, limits):
    got = m.match_terms(posts(spark), dictionary(spark), limits=limits).select("id", "org_id", "keyword")
    assert values(got) == sorted(expected(TEXTS, TERMS), key=key)


def test_left_keeps_unmatched_once(spark, limits):
    want = expected(TEXTS, TERMS)
    want += [(i, None, None) for i in range(len(TEXTS)) if i not in {w[0] for w in want}]
    got = m.match_terms(posts(spark), dictionary(spark), how="left", limits=limits).select("id", "org_id", "keyword")
    assert values(got) == sorted(want, key=key)


def test_orgs_once_per_post(spark, limits):
    got = m.match_orgs(posts(spark), dictionary(spark), limits=limits).select("id", "org_id")
    assert values(got) == sorted({w[:2] for w in expected(TEXTS, TERMS)}, key=key)


def test_copies_of_a_post_are_all_kept(spark, limits):
    texts = ["a license"] * 5 + ["other"] * 3
    assert m.match_orgs(posts(spark, texts), dictionary(spark), limits=limits).count() == 5 * 3
    assert m.match_terms(posts(spark, texts), dictionary(spark), limits=limits).count() == 5 * 4


def test_keyword_array(spark, limits):
    got = {r.id: r.matched_keywords for r in m.matched_keywords(posts(spark), dictionary(spark), limits=limits).collect()}
    for i, text in enumerate(TEXTS):
        want = None if text is None else sorted({k for j, _, k in expected(TEXTS, TERMS) if j == i})
        assert got[i] == want


def test_org_sets_leave_the_rows_alone(spark, limits):
    got = {r.id: r.org_ids for r in m.org_sets(posts(spark), dictionary(spark), limits=limits).collect()}
    assert got == {i: sorted({o for j, o, _ in expected(TEXTS, TERMS) if j == i}) for i in range(len(TEXTS))}
    assert m.org_sets(posts(spark, ["a"]), dictionary(spark, []), limits=limits).first()["org_ids"] == []


def test_spam_flag_and_filter(spark, limits):
    spam = spark.createDataFrame([("LICENSE",), ("😀b",), ("x",)], "term string")
    flags = {r.id: r.has_spamwords for r in m.is_spam(posts(spark), spam, limits=limits).collect()}
    for i, text in enumerate(TEXTS):
        want = any(t in text.lower() for t in ("license", "😀b", "x")) if text else None
        assert flags[i] == want
    kept = {r.id for r in m.drop_spam(posts(spark), spam, limits=limits).collect()}
    assert kept == {i for i, f in flags.items() if f is False}


def test_empty_spam_list_drops_only_empty_texts(spark):
    spam = spark.createDataFrame([], "term string")
    assert m.drop_spam(posts(spark), spam).count() == sum(1 for t in TEXTS if t)


def test_empty_dictionary(spark):
    none = dictionary(spark, [])
    assert m.match_orgs(posts(spark), none).count() == 0
    assert m.match_terms(posts(spark), none).count() == 0
    assert m.match_terms(posts(spark), none, how="left").count() == len(TEXTS)
    assert {tuple(r.matched_keywords) for r in m.matched_keywords(posts(spark, ["a"]), none).collect()} == {()}


@pytest.mark.parametrize("way", ["automaton", "store", "shuffled"])
def test_random_texts(spark, way):
    rnd = random.Random(7)
    texts = ["".join(rnd.choice("abcé ") for _ in range(rnd.randint(0, 60))) for _ in range(200)]
    terms = list({(rnd.randint(1, 9), "".join(rnd.choice("abcÉ") for _ in range(rnd.randint(1, 14)))) for _ in range(150)})
    got = m.match_terms(posts(spark, texts), dictionary(spark, terms), limits=WAYS[way]).select("id", "org_id", "keyword")
    assert values(got) == sorted(expected(texts, terms), key=key)


def test_terms_are_cleaned(spark):
    orgs = spark.createDataFrame(
        [
            (1, ["a", None, " ", "", "a"], ['{"match_phrase":{"content":"bad"}}', "not json", None]),
            (2, None, []),
            (3, [], ['{"other":1}', '{"match_phrase":{"content":" "}}']),
        ],
        "org_id int, keywords array<string>, spamwords array<string>",
    )
    assert values(phrases.org_keywords(orgs)) == [(1, "a"), (1, "a")]
    assert values(phrases.spam_terms(orgs)) == [("bad",)]


def test_no_row_python_and_no_pair_join(spark):
    """The small-dictionary plan is one codegen stage; no way compares all posts with all terms."""
    base, terms = posts(spark), dictionary(spark)
    for name, limits in WAYS.items():
        plan = m.match_orgs(base, terms, limits=limits)._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        assert ("ArrowEvalPython" in plan) == (name == "automaton")
        if name in ("literal", "automaton"):
            assert "Exchange" not in plan


def test_shared_columns_are_refused(spark):
    with pytest.raises(ValueError, match="org_id"):
        m.match_terms(posts(spark).withColumn("org_id", F.lit(1)), dictionary(spark))
    with pytest.raises(ValueError, match="inner or left"):
        m.match_terms(posts(spark), dictionary(spark), how="right")


def test_size_check(spark):
    df = spark.range(100).select(F.lit("x" * 10).alias("s"))
    assert m.fits_broadcast(df, 100, 1000)
    assert not m.fits_broadcast(df, 99, 1000)
    assert not m.fits_broadcast(df, 100, 999)
    assert "broadcast" in m.bounded_broadcast(df)._jdf.queryExecution().logical().toString()
    assert "broadcast" not in m.bounded_broadcast(df, max_rows=5)._jdf.queryExecution().logical().toString()


def test_null_and_blank_terms_match_nothing(spark, limits):
    terms = dictionary(spark, [(1, "aa"), (2, None), (3, ""), (4, "  "), (5, "cc")])
    texts = ["xAAx", "nothing at all", None, "", "cc"]
    got = m.match_terms(posts(spark, texts), terms, limits=limits).select("id", "org_id", "keyword")
    assert values(got) == [(0, 1, "aa"), (4, 5, "cc")]
    assert m.match_terms(posts(spark, texts), terms, how="left", limits=limits).count() == 5
    spam = terms.selectExpr("keyword AS term")
    flags = {r.id: r.has_spamwords for r in m.is_spam(posts(spark, texts), spam, limits=limits).collect()}
    assert flags == {0: True, 1: False, 2: None, 3: None, 4: True}
    found = {r.id: r.matched_keywords for r in m.matched_keywords(posts(spark, texts), terms, limits=limits).collect()}
    assert found == {0: ["aa"], 1: [], 2: None, 3: [], 4: ["cc"]}


def test_a_growing_dictionary_is_read_once(spark, tmp_path, limits):
    """What counts is the dictionary of the moment it was measured."""
    folder = str(tmp_path / "terms")
    dictionary(spark, [(k, f"t{k}t") for k in range(5)]).write.parquet(folder)
    live = spark.read.parquet(folder)
    found = m.match_terms(posts(spark, [f"t{k}t" for k in range(20)]), live, limits=limits)
    dictionary(spark, [(k, f"t{k}t") for k in range(5, 20)]).write.mode("append").parquet(folder)
    assert found.count() == 5


def test_short_terms_meet_matches_only(spark):
    """Candidates of three and four letters are the true matches: no pair is joined in vain."""
    rng = random.Random(9)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(200)) for _ in range(60)]
    terms = [(k, "".join(rng.choice("abcdefgh") for _ in range(rng.choice((3, 4))))) for k in range(80)]
    lowered = posts(spark, texts).select("id", F.explode(m._stretches(F.lower("content"), [3, 4])).alias("needle"))
    pairs = lowered.join(spark.createDataFrame(terms, "org_id int, needle string").select("needle").distinct(), "needle").count()
    assert pairs == sum(n in t for t in texts for n in {n for _, n in terms})


def test_shards_are_searched_one_by_one(spark):
    """Any number of shards gives the rows of one, and a needle with very many entries is not sent out."""
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdef ") for _ in range(80)) for _ in range(50)] * 2
    terms = [(k, "".join(rng.choice("abcdef") for _ in range(3))) for k in range(60)] + [(k, "abc") for k in range(20)]
    want = sorted(expected(texts, terms), key=key)
    for shard_terms in (1000, 30):
        limits = m.MatchLimits(literal_terms=0, automaton_terms=0, shard_terms=shard_terms)
        got = m.match_terms(posts(spark, texts), dictionary(spark, terms), limits=limits).select("id", "org_id", "keyword")
        assert values(got) == want


def test_beyond_the_store_texts_and_terms_are_joined(spark):
    few = m.MatchLimits(literal_terms=0, automaton_terms=0, shard_terms=2, store_shards=3)
    got = m.match_terms(posts(spark), dictionary(spark), limits=few)
    assert "_block" in got._jdf.queryExecution().optimizedPlan().toString()
    assert values(got.select("id", "org_id", "keyword")) == sorted(expected(TEXTS, TERMS), key=key)


def test_stretches_of_long_texts_take_linear_time(spark):
    import time

    def seconds(n):
        text = spark.createDataFrame([("ab cd😀efg " * (n // 10),)], "t string")
        start = time.perf_counter()
        text.select(F.size(m._stretches(F.col("t"), [4, 7]))).collect()
        return time.perf_counter() - start

    seconds(20_000)
    assert seconds(400_000) < 20 * max(seconds(20_000), 0.2)


def test_a_text_that_many_posts_share_stays_in_place(spark):
    """A third of the posts have one text: without adaptive plans no partition of the join gets much more than the others."""
    texts = ["license and needle"] * 3000 + [f"needle {k}" for k in range(6000)]
    base = posts(spark, texts).repartition(8)
    way = m.MatchLimits(literal_terms=0, automaton_terms=0)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = m.match_terms(base, dictionary(spark), limits=way).groupBy(F.spark_partition_id().alias("p"), F.length("content").alias("n")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    hot = [r["count"] for r in found if r["n"] == len(texts[0])]
    assert sum(hot) == 3000 * 5 and len(hot) == 8 and max(hot) <= 2 * sorted(hot)[4]


def test_what_the_store_finds_is_not_shuffled(spark):
    entries = spark.createDataFrame([("ab", 1), ("license", 2)], "_needle string, org_id int")
    texts = posts(spark).filter("content is not null").select(m.text_key("content").alias("_text_key"), F.lower("content").alias("_text_lower"))
    hits = m.term_store.TermStore.of(entries, 2, 9, 1, 100).hits(texts, ["org_id"])
    assert "Exchange" not in hits._jdf.queryExecution().executedPlan().toString()
    assert hits.distinct().groupBy("org_id").count().count() == 2 and {len(r[0]) for r in hits.collect()} == {32}


def test_what_a_task_holds_of_the_store_is_bounded():
    import types

    import pyarrow as pa

    needles = [chr(97 + i) + chr(97 + j) for i in range(26) for j in range(26)]
    text = "".join(needles)
    batch = pa.RecordBatch.from_arrays([pa.array([bytes([i // 256, i % 256]) for i in range(1000)]), pa.array([text] * 1000)], ["k", "t"])
    out = list(m.term_store._needles_found(types.SimpleNamespace(value=needles))(iter([batch, batch])))
    assert max(b.num_rows for b in out) <= m.term_store._FOUND + len(needles)
    assert sum(b.num_rows for b in out) == 1000 * len(needles)  # the second time nothing is found again


def test_only_stretches_that_may_be_terms_leave_the_texts(spark):
    """Of all places of the texts about those that hold a term become rows, of any length in bytes, across parts of a batch."""
    rng = random.Random(5)
    texts = ["".join(rng.choice("abcdé😀 ") for _ in range(rng.randint(0, 3000))) for _ in range(40)] + ["", "x" * 600_000 + "needle in a very long haystack" + "y" * 9]
    terms = sorted({"".join(rng.choice("abcdé😀") for _ in range(rng.randint(3, 8))) for _ in range(300)}) + ["needle"]
    long_ = "needle in a very long haystack"
    keys = [(t.encode()[: min(len(x.encode()) for x in terms)], 0) for t in terms] + [(t.encode(), len(t.encode())) for t in terms] + [(long_.encode()[k : k + 12], -1) for k in range(12)]
    bitmap = m.stretches.bitmap_of(spark.createDataFrame([(bytearray(k), n) for k, n in set(keys)], "_block binary, _kind int"), len(keys))
    base = posts(spark, texts).select(m.text_key("content").alias("k"), "content")
    out = m.stretches.passing(base, "k", F.col("content"), bitmap, sorted({len(t.encode()) for t in terms}), 12).collect()
    number = {r["k"]: r["content"] for r in base.collect()}
    found = {(number[r["k"]], bytes(r["_block"])) for r in out}
    want = {(t, n.encode()) for t in texts for n in terms if n in t}
    assert want <= found and all(b in t.encode() for t, b in found)
    assert any(b in long_.encode() and len(b) == 12 for _, b in found)
    assert len(out) <= 1.2 * len(want) + 20 < sum(len(t) for t in texts) / 50


def test_long_terms_and_copies_by_the_join(spark):
    """Terms around the length from which blocks decide, at every alignment, in texts that come more than once."""
    rng = random.Random(6)
    stem = "".join(rng.choice("abcdefgé") for _ in range(60))
    terms = [(k, stem[a : a + n]) for k, (a, n) in enumerate((a, n) for a in range(13) for n in (10, 20, 22, 23, 30))]
    texts = ["z" * pad + stem[cut:] for pad in range(13) for cut in (0, 5, 20)] * 2 + ["nothing", None, ""]
    got = m.match_terms(posts(spark, texts), dictionary(spark, terms), limits=WAYS["shuffled"]).select("id", "org_id", "keyword")
    assert values(got) == sorted(expected(texts, terms), key=key)
