"""One query per operator or job. ``QUERIES`` holds the Spark side, ``ORACLES`` the SQL side."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postflow.functions import calendar, ids, phrases, variations
from postflow.operators import compaction, dedupe, incremental, matching, quality, sales
from postflow.plans import classify, daily, property_sales as sales_plan, publish
from postflow.schemas import POST_PUBLISH, POST_STORED, POST_STREAM, PROPERTY_EVENT, conform, table as schema
from postflow.session import run_folder
from postflow.sources.ranges import equal_depth_ranges
from postflow.sources.readers import read_source
from postflow.sources.specs import SinkSpec, SourceSpec, StreamSinkSpec, files
from postflow.sources.writers import write, write_if_any, write_json, write_stream
from postflow.streaming import jobs, parse
from postflow.streaming.ledger import EpochLedger
from workload.inputs import (
    AS_OF,
    DERIVED_SQL,
    DICT_LETTERS,
    DICT_SQL,
    EPOCH,
    ORG_OF_LANG,
    POSTS_SQL,
    PROPERTIES_SQL,
    as_classified_posts,
    as_messages,
    as_posts,
    as_properties,
    derived_orgs,
    naive_stamps,
    orgs,
    plain_orgs,
    RARE_LENGTH,
    planted_events,
    PLANTED_SQL,
    post_messages,
    rare_spam,
    stream,
    table,
)

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
HOUR = "1 hour"
#: Limits that send any dictionary to the store of automata (here in shards of 500 terms), or to the join by stretches.
ANY_SIZE = matching.MatchLimits(literal_terms=0, automaton_terms=0, shard_terms=500)
JOINED = matching.MatchLimits(literal_terms=0, automaton_terms=0, store_shards=0)


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def _posts(spark, d) -> DataFrame:
    return as_posts(table(spark, d, "documents"))


def _properties(spark, d) -> DataFrame:
    return as_properties(table(spark, d, "events"))


# --- batch jobs ------------------------------------------------------------------------------------

_CLEAN = f"""{DICT_SQL}, {POSTS_SQL},
    clean AS (SELECT * FROM posts p WHERE content IS NOT NULL AND content <> ''
              AND NOT EXISTS (SELECT 1 FROM spam s WHERE contains(lower(p.content), lower(s.term))))"""
_IN_WINDOW = f"pub_time BETWEEN {EPOCH - 86400} AND {EPOCH + 2 * 86400}"


def _stored_sql(source: str, post_id: str = "concat_ws('-', url, org_id)") -> str:
    special = {
        "post_id": post_id,
        "pg_sync": "false",
        "createdAt": "TIMESTAMP '2024-01-15 07:00:00'",
        "updatedAt": "TIMESTAMP '2024-01-15 07:00:00'",
    }
    cast = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR"}
    items = [
        f'{special[f.name]} AS "{f.name}"'
        if f.name in special
        else f'CAST({f.name} AS {cast[f.dataType.simpleString()]}) AS "{f.name}"'
        for f in POST_STORED
    ]
    return (
        f"SELECT {', '.join(items)} FROM {source} WHERE url IS NOT NULL "
        "QUALIFY row_number() OVER (PARTITION BY url, org_id ORDER BY crawl_time DESC, id DESC) = 1"
    )


@query(f"""WITH {_CLEAN},
    matched AS (SELECT DISTINCT c.*, k.org_id FROM clean c JOIN keywords k ON contains(lower(c.content), lower(k.keyword))
                WHERE {_IN_WINDOW})
    {_stored_sql('matched')}""")
def classify_posts(spark: SparkSession, d: str) -> DataFrame:
    return naive_stamps(classify.classify_posts(_posts(spark, d), orgs(spark), AS_OF))


_LARGE_SQL = f"""{DERIVED_SQL}, {POSTS_SQL},
    late AS (SELECT DISTINCT keyword AS term FROM words WHERE length(keyword) > {RARE_LENGTH}),
    matched AS (SELECT DISTINCT p.*, w.org_id FROM posts p JOIN words w ON contains(lower(p.content), lower(w.keyword))
                WHERE {_IN_WINDOW} AND content <> '' AND NOT EXISTS (SELECT 1 FROM late WHERE contains(lower(p.content), lower(term))))"""


@query(f"""WITH {_LARGE_SQL} {_stored_sql('matched')}""")
def classify_large_dictionary(spark, d):
    """Hundreds of organisations, keywords and spam phrases derived from the data."""
    return naive_stamps(classify.classify_posts(_posts(spark, d), rare_spam(derived_orgs(spark, d)), AS_OF))


@query(ORACLES["classify_large_dictionary"])
def classify_shuffled(spark, d):
    """The same by the way for dictionaries of any size."""
    return naive_stamps(classify.classify_posts(_posts(spark, d), rare_spam(derived_orgs(spark, d)), AS_OF, limits=ANY_SIZE))


_WORDS_SQL = f"""WITH {DERIVED_SQL}
    SELECT doc_id, EXISTS (SELECT 1 FROM words WHERE contains(lower(t.text), lower(keyword))) AS has_spamwords FROM documents t"""


@query(_WORDS_SQL)
def spam_flag_large(spark, d):
    """Hundreds of terms, in one pass over each text."""
    terms = phrases.org_keywords(derived_orgs(spark, d)).select(F.col("keyword").alias("term"))
    return matching.is_spam(table(spark, d, "documents"), terms, content="text").select("doc_id", "has_spamwords")


@query(_WORDS_SQL)
def spam_flag_shuffled(spark, d):
    terms = phrases.org_keywords(derived_orgs(spark, d)).select(F.col("keyword").alias("term"))
    return matching.is_spam(table(spark, d, "documents"), terms, content="text", limits=JOINED).select("doc_id", "has_spamwords")


@query(_WORDS_SQL)
def spam_flag_store(spark, d):
    """The same by shards of the dictionary, one pass over the texts for each."""
    terms = phrases.org_keywords(derived_orgs(spark, d)).select(F.col("keyword").alias("term"))
    return matching.is_spam(table(spark, d, "documents"), terms, content="text", limits=ANY_SIZE).select("doc_id", "has_spamwords")


_ARRAY_SQL = f"""WITH {DERIVED_SQL}, once AS (SELECT DISTINCT keyword FROM words)
    SELECT doc_id, coalesce((SELECT string_agg(keyword, '|' ORDER BY keyword) FROM once
                             WHERE contains(lower(t.text), lower(keyword))), '') AS matched_keywords FROM documents t"""


@query(_ARRAY_SQL)
def matched_keywords_large(spark, d):
    found = matching.matched_keywords(table(spark, d, "documents"), phrases.org_keywords(derived_orgs(spark, d)), content="text")
    return found.select("doc_id", F.array_join("matched_keywords", "|").alias("matched_keywords"))


@query(f"""WITH short AS (SELECT DISTINCT lower(substr(keyword, 1, 4)) AS keyword FROM (SELECT unnest(regexp_extract_all(text, '{DICT_LETTERS}')) AS keyword FROM benchmark))
    SELECT doc_id, coalesce((SELECT string_agg(keyword, '|' ORDER BY keyword) FROM short
                             WHERE contains(lower(t.text), keyword)), '') AS matched_keywords FROM documents t""")
def matched_short_terms_shuffled(spark, d):
    """Terms of four letters by the ways for dictionaries beyond one automaton."""
    terms = phrases.org_keywords(derived_orgs(spark, d)).select(F.lower(F.substring("keyword", 1, 4)).alias("keyword"))
    found = matching.matched_keywords(table(spark, d, "documents"), terms, content="text", limits=ANY_SIZE)
    return found.select("doc_id", F.array_join("matched_keywords", "|").alias("matched_keywords"))


@query(f"""WITH {_CLEAN}
    SELECT c.id, c.url, k.org_id FROM clean c LEFT JOIN keywords k ON contains(lower(c.content), lower(k.keyword))""")
def classify_keep_unmatched(spark, d):
    return classify.classify_all(_posts(spark, d), plain_orgs(spark)).select("id", "url", "org_id")


@query(f"""WITH {_CLEAN},
    hits AS (SELECT c.url, c.content, c.crawl_time, c.id, k.org_id FROM clean c
             LEFT JOIN keywords k ON contains(lower(c.content), lower(k.keyword)))
    SELECT url AS post_id, md5(content) AS content_md5,
           coalesce(array_to_string(list_sort(list_distinct(list(org_id) FILTER (org_id IS NOT NULL))), ','), '') AS org_ids,
           max(crawl_time) AS crawl_time, arg_max(id, crawl_time) AS id
    FROM hits GROUP BY url, content""")
def classify_collapse_orgs(spark, d):
    hits = classify.classify_all(_posts(spark, d), plain_orgs(spark))
    one = dedupe.collapse_orgs(hits.select(F.col("url").alias("post_id"), "content", "crawl_time", "id", "org_id"))
    return one.select(
        "post_id", F.md5("content").alias("content_md5"), F.array_join("org_ids", ",").alias("org_ids"), "crawl_time", "id"
    )


@query(ORACLES["classify_collapse_orgs"])
def classify_collapsed_sets(spark, d):
    """The same with organisations found as one array per post."""
    posts = _posts(spark, d).withColumn("post_id", F.col("url"))
    one = classify.classify_collapsed(posts, plain_orgs(spark))
    return one.select(
        "post_id", F.md5("content").alias("content_md5"), F.array_join("org_ids", ",").alias("org_ids"), "crawl_time", "id"
    )


@query(f"""WITH {POSTS_SQL}, classified AS (SELECT *, org_of_lang AS org_id FROM posts WHERE {_IN_WINDOW})
    {_stored_sql('classified')}""")
def normalise_classified(spark, d):
    return naive_stamps(classify.normalise_classified(as_classified_posts(table(spark, d, "documents")), AS_OF))


_PUBLISH_SPECIAL = {
    "id": "concat_ws('-', code, crawl_source_code, source_type, auth_type, doc_type, "
    "substr(md5(concat_ws('-', url, org_id)), 1, 16))",
    "is_sent": "0", "spam": "0", "completed": "0", "bot_id": "'bot_cron'",
}


@query(f"""WITH {DICT_SQL}, {POSTS_SQL},
    stored AS (SELECT *, org_of_lang AS org_id FROM posts
               QUALIFY row_number() OVER (PARTITION BY url, org_of_lang ORDER BY crawl_time DESC, id DESC) = 1)
    SELECT {', '.join(f'{_PUBLISH_SPECIAL.get(c, "s." + c)} AS {c}' for c in POST_PUBLISH.names)}
    FROM stored s JOIN codes USING (org_id)
    WHERE crawl_time >= {EPOCH} AND crawl_time < {EPOCH + 86400}""")
def publish_posts(spark, d):
    """Posts count as stored at their crawl time; those of 2024-01-14 are published."""
    stored = classify.normalise_classified(as_classified_posts(table(spark, d, "documents")), AS_OF)
    stored = stored.withColumn("createdAt", F.timestamp_seconds("crawl_time") + F.expr("interval 7 hours"))
    return publish.publish_posts(stored, orgs(spark), dt.date(2024, 1, 14))


@query(f"""WITH {_CLEAN} SELECT id, url FROM clean""")
def spam_filter(spark, d):
    return matching.drop_spam(_posts(spark, d), phrases.spam_terms(orgs(spark))).select("id", "url")


@query(f"""WITH {DICT_SQL}, {POSTS_SQL}
    SELECT id, CASE WHEN content <> '' THEN EXISTS (SELECT 1 FROM spam s WHERE contains(lower(p.content), lower(s.term))) END
    AS has_spamwords FROM posts p""")
def spam_flag(spark, d):
    return matching.is_spam(_posts(spark, d), phrases.spam_terms(orgs(spark))).select("id", "has_spamwords")


@query(f"""WITH {DICT_SQL}
    SELECT doc_id, coalesce((SELECT string_agg(keyword, '|' ORDER BY keyword) FROM keywords k
                             WHERE contains(lower(t.text), lower(k.keyword))), '') AS matched_keywords
    FROM documents t""")
def matched_keywords(spark, d):
    found = matching.matched_keywords(table(spark, d, "documents"), phrases.org_keywords(orgs(spark)), content="text")
    return found.select("doc_id", F.array_join("matched_keywords", "|").alias("matched_keywords"))


@query(f"""WITH {DICT_SQL}
    SELECT conv_id, turn, org_id, keyword FROM conversations c JOIN keywords k ON contains(lower(c.text), lower(k.keyword))""")
def keyword_entries(spark, d):
    found = matching.match_terms(table(spark, d, "conversations"), phrases.org_keywords(orgs(spark)), content="text")
    return found.select("conv_id", "turn", "org_id", "keyword")


@query(ORACLES["keyword_entries"])
def keyword_entries_shuffled(spark, d):
    """The same rows by the join that is taken for dictionaries of any size."""
    terms = phrases.org_keywords(orgs(spark))
    found = matching.match_terms(table(spark, d, "conversations"), terms, content="text", limits=JOINED)
    return found.select("conv_id", "turn", "org_id", "keyword")


_HOT_TEXT = "CASE WHEN conv_id % 3 = 0 THEN 'the ering of a license and étion' ELSE text END"


@query(f"""WITH {DICT_SQL}, c AS (SELECT conv_id, turn, {_HOT_TEXT} AS text FROM conversations)
    SELECT conv_id, turn, org_id, keyword FROM c JOIN keywords k ON contains(lower(c.text), lower(k.keyword))""")
def keyword_entries_hot_text(spark, d):
    """A third of the posts share one text."""
    posts = table(spark, d, "conversations").select("conv_id", "turn", F.expr(_HOT_TEXT).alias("text"))
    found = matching.match_terms(posts, phrases.org_keywords(orgs(spark)), content="text", limits=ANY_SIZE)
    return found.select("conv_id", "turn", "org_id", "keyword")


# --- filters, projections, ids ---------------------------------------------------------------------

@query(f"""SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS pub_time FROM events
    WHERE floor(epoch(ts)) BETWEEN {EPOCH - 86400} AND {EPOCH + 2 * 86400}""")
def pub_window(spark, d):
    events = table(spark, d, "events").select("event_id", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("pub_time"))
    return events.filter(calendar.in_publish_window(F.col("pub_time"), AS_OF))


@query("""SELECT event_id, ts FROM events
    WHERE ts - INTERVAL 7 HOUR >= TIMESTAMP '2024-01-15' AND ts - INTERVAL 7 HOUR < TIMESTAMP '2024-01-16'""")
def created_today(spark, d):
    return calendar.stored_on(table(spark, d, "events").select("event_id", "ts"), "ts", AS_OF)


@query(f"""SELECT doc_id, concat_ws('-', CASE WHEN lang <> 'de' THEN concat('doc://', source) END, {ORG_OF_LANG}) AS post_id
    FROM documents""")
def post_id_build(spark, d):
    docs = table(spark, d, "documents").withColumns(
        {"url": F.when(F.col("lang") != "de", F.concat(F.lit("doc://"), "source")), "org_id": F.expr(ORG_OF_LANG)}
    )
    return docs.select("doc_id", ids.post_id().alias("post_id"))


@query("""SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS level,
    TRY_CAST(o_orderpriority AS INTEGER) AS doc_type, TRY_CAST(o_orderkey * 1000000 AS INTEGER) AS views,
    CAST(o_custkey AS VARCHAR) AS auth_id FROM orders""")
def cast_projection(spark, d):
    """Text and numbers that do not fit become NULL."""
    raw = table(spark, d, "orders").select(
        "o_orderkey",
        F.substring("o_orderpriority", 1, 1).alias("level"),
        F.col("o_orderpriority").alias("doc_type"),
        (F.col("o_orderkey") * 1000000).alias("views"),
        F.col("o_custkey").alias("auth_id"),
    )
    return conform(raw, schema("o_orderkey BIGINT, level INT, doc_type INT, views INT, auth_id STRING"))


@query("""SELECT o_orderkey AS order_id, o_orderstatus, 0 AS is_sent, 0 AS spam, 0 AS completed, 'bot_cron' AS bot_id FROM orders""")
def constants_projection(spark, d):
    flagged = table(spark, d, "orders").withColumns({c: F.lit(v) for c, v in publish.NEW_FLAGS.items()})
    return (
        flagged.drop("o_totalprice", "o_orderdate", "o_custkey", "o_orderpriority")
        .withColumnRenamed("o_orderkey", "order_id")
    )


@query(f"""WITH {POSTS_SQL} SELECT id, url FROM posts WHERE org_of_lang = 3""")
def single_org(spark, d):
    return as_classified_posts(table(spark, d, "documents")).filter(F.col("org_id") == 3).select("id", "url")


@query("""SELECT count(*) AS n_rows, count(*) AS n_ids, CAST(16 AS BIGINT) AS id_length FROM orders""")
def random_uid(spark, d):
    drawn = table(spark, d, "orders").select(ids.random_uid().alias("uid"))
    return drawn.agg(
        F.count("uid").alias("n_rows"),
        F.countDistinct("uid").alias("n_ids"),
        F.max(F.char_length("uid")).cast("bigint").alias("id_length"),
    )


@query("""SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M') AS minute, date_trunc('minute', ts) AS minute_start FROM events""")
def minute_key(spark, d):
    events = table(spark, d, "events").select("event_id", calendar.minute_key(F.col("ts")).alias("minute"))
    return naive_stamps(events.withColumn("minute_start", F.to_timestamp("minute", "yyyy-MM-dd HH:mm")))


@query("""SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 100""")
def latest_topk(spark, d):
    return dedupe.newest(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", 100, ["o_orderkey"])


# --- dictionary text -------------------------------------------------------------------------------

@query(f"WITH {DERIVED_SQL} SELECT DISTINCT keyword FROM words")
def dict_terms_distinct(spark, d):
    return phrases.org_keywords(derived_orgs(spark, d)).select("keyword").distinct()


@query(f"WITH {DERIVED_SQL} SELECT DISTINCT keyword AS term FROM words")
def spam_phrases_from_json(spark, d):
    return phrases.spam_terms(derived_orgs(spark, d))


_WORDS_SQL = f"regexp_extract_all(text, '{DICT_LETTERS}')"


def _phrase_text(words):
    items = F.transform(words, lambda w: F.concat(F.lit("{match_phrase={content="), w, F.lit("}}")))
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))


def _conversation_words(spark, d):
    words = F.regexp_extract_all("text", F.lit(DICT_LETTERS), F.lit(0))
    return table(spark, d, "conversations").select("conv_id", "turn", words.alias("words"))


@query(f"SELECT conv_id, turn, array_to_string({_WORDS_SQL}, '|') AS phrases FROM conversations")
def spam_phrases_from_text(spark, d):
    text = _conversation_words(spark, d).withColumn("text", _phrase_text(F.col("words")))
    return text.select("conv_id", "turn", F.array_join(phrases.phrases_from_text(F.col("text")), "|").alias("phrases"))


@query(f"""SELECT conv_id, turn, array_to_string({_WORDS_SQL}, '|') AS items,
    array_to_string(list_transform({_WORDS_SQL}, lambda w: 'match_phrase={{content=' || w), '|') AS objects FROM conversations""")
def bracket_list_parse(spark, d):
    rows = _conversation_words(spark, d).withColumns(
        {"list": F.concat(F.lit("["), F.array_join("words", ","), F.lit("]")), "objs": _phrase_text(F.col("words"))}
    )
    objects = F.transform(phrases.bracket_objects(F.col("objs")), lambda o: F.regexp_replace(o, r"^\{|\}+$", ""))
    return rows.select(
        "conv_id",
        "turn",
        F.array_join(phrases.bracket_list(F.col("list")), "|").alias("items"),
        F.array_join(objects, "|").alias("objects"),
    )


# --- dedupe and incremental load -------------------------------------------------------------------

@query("""SELECT user_id, event_type, event_id, ts FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def dedupe_latest(spark, d):
    events = table(spark, d, "events").select("user_id", "event_type", "event_id", "ts")
    return dedupe.keep_latest(events, ["user_id", "event_type"], [F.col("ts").desc(), F.col("event_id").desc()])


@query("SELECT DISTINCT * FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_linenumber = 1)")
def compact_dedup(spark, d):
    """Whole rows; those of first lines come twice."""
    lines = table(spark, d, "lineitem")
    return dedupe.compact_dedup(lines.unionByName(lines.filter("l_linenumber = 1")))


@query("SELECT DISTINCT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem")
def compact_bucketed(spark, d):
    """Three runs into one table: most lines, lines of which most are there already, and the same again, which writes nothing."""
    store = compaction.BucketedTable(spark, run_folder(spark, "compacted"), n_buckets=16)
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    store.add(lines.filter("l_orderkey % 100 <> 0"))
    store.add(lines)
    assert store.add(lines).rewritten == ()
    return store.read()


@query("SELECT o_orderkey, nullif(o_custkey, 7) AS o_custkey FROM orders")
def read_in_ranges(spark, d):
    """A table cut into ranges of about equally many rows; rows without the key have a range of their own."""
    folder = run_folder(spark, "orders-ranges")
    orders = table(spark, d, "orders").selectExpr("o_orderkey", "nullif(o_custkey, 7) AS o_custkey")
    orders.write.parquet(folder)
    ranges = equal_depth_ranges(orders, "o_custkey", 6)
    spec = SourceSpec("parquet", path=folder, schema=orders.schema, predicates=tuple(ranges))
    return read_source(spark, spec)


_LOADED = "DATE '1998-01-01'"


@query(f"""SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderdate < {_LOADED})""")
def insert_missing_single_key(spark, d):
    orders = table(spark, d, "orders")
    held = orders.filter(f"o_orderdate < {_LOADED}")
    return incremental.insert_missing(orders.select("o_orderkey", "o_custkey", "o_totalprice"), held, ["o_orderkey"])


_LINES_SQL = "lines AS (SELECT l_orderkey, nullif(l_linenumber, 7) AS l_linenumber, l_partkey, l_quantity, l_shipdate FROM lineitem)"
_KEYED = "l.l_orderkey = h.l_orderkey AND l.l_linenumber"


@query(f"""WITH {_LINES_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lines l
    WHERE l_linenumber IS NOT NULL AND NOT EXISTS
      (SELECT 1 FROM lines h WHERE h.l_shipdate < {_LOADED} AND {_KEYED} = h.l_linenumber)""")
def insert_missing_composite(spark, d):
    return _composite(spark, d, "skip")


@query(f"""WITH {_LINES_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lines l
    WHERE NOT EXISTS (SELECT 1 FROM lines h WHERE h.l_shipdate < {_LOADED} AND {_KEYED} IS NOT DISTINCT FROM h.l_linenumber)""")
def insert_missing_null_keys(spark, d):
    return _composite(spark, d, "insert")


def _composite(spark, d, null_keys):
    lines = table(spark, d, "lineitem").withColumn("l_linenumber", F.expr("nullif(l_linenumber, 7)"))
    held = lines.filter(f"l_shipdate < {_LOADED}")
    incoming = lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return incremental.insert_missing(incoming, held, ["l_orderkey", "l_linenumber"], null_keys)


_CHANGED = "CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 1 ELSE c_acctbal END"


@query(f"""SELECT * FROM customer EXCEPT
    SELECT c_custkey, c_name, c_nationkey, {_CHANGED}, c_mktsegment FROM customer""")
def insert_missing_full_row(spark, d):
    customer = table(spark, d, "customer")
    return incremental.insert_missing_rows(customer, customer.withColumn("c_acctbal", F.expr(_CHANGED)))


@query("SELECT * FROM supplier EXCEPT SELECT * FROM supplier WHERE s_acctbal >= 0")
def insert_missing_ignore_surrogate(spark, d):
    supplier = table(spark, d, "supplier")
    held = supplier.filter("s_acctbal >= 0").withColumn("detail_id", F.col("s_suppkey") + 1000)
    return incremental.insert_missing_rows(supplier, held, surrogate="detail_id")


@query("""WITH a AS (SELECT event_id, ts + INTERVAL (event_id % 3) MICROSECOND AS stamp, CASE WHEN event_id % 2 = 0 THEN 0.0 WHEN event_id % 7 = 0 THEN 'nan'::DOUBLE ELSE value END AS v,
        CASE WHEN event_id % 5 <> 0 THEN event_type END AS kind FROM events),
      b AS (SELECT event_id, ts + INTERVAL (CASE WHEN event_id % 4 = 0 THEN 0 ELSE event_id % 3 END) MICROSECOND AS stamp,
        CASE WHEN event_id % 2 = 0 THEN 0.0 WHEN event_id % 7 = 0 THEN 'nan'::DOUBLE ELSE value END AS v, CASE WHEN event_id % 25 <> 0 AND event_id % 5 <> 0 THEN event_type END AS kind FROM events)
    SELECT event_id, stamp FROM (SELECT * FROM a EXCEPT SELECT * FROM b)""")
def insert_missing_planted_values(spark, d):
    """Whole rows that differ by a microsecond only, signed zeros, NaN and NULL."""
    events = table(spark, d, "events")
    at = "timestamp_micros(unix_micros(cast(ts as timestamp)) + {})"
    v = "CASE WHEN event_id % 2 = 0 THEN {} WHEN event_id % 7 = 0 THEN double('NaN') ELSE value END AS v"
    new = events.selectExpr("event_id", at.format("event_id % 3") + " AS stamp", v.format("double('-0.0')"), "CASE WHEN event_id % 5 <> 0 THEN event_type END AS kind")
    held = events.selectExpr("event_id", at.format("CASE WHEN event_id % 4 = 0 THEN 0 ELSE event_id % 3 END") + " AS stamp", v.format("double('0.0')"), "CASE WHEN event_id % 25 <> 0 AND event_id % 5 <> 0 THEN event_type END AS kind")
    return naive_stamps(incremental.insert_missing_rows(new, held).select("event_id", "stamp"))


@query(f"""SELECT count(*) FILTER (o_orderdate < {_LOADED}) AS n_target, count(*) AS n_incoming,
    count(*) FILTER (o_orderdate >= {_LOADED}) AS n_missing, count(*) FILTER (o_orderdate < {_LOADED}) = count(*) AS counts_equal
    FROM orders""")
def reconcile_counts(spark, d):
    orders = table(spark, d, "orders")
    held = orders.filter(f"o_orderdate < {_LOADED}")
    return incremental.reconcile(orders, held, incremental.insert_missing(orders, held, ["o_orderkey"]))


@query("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def append_missing_table(spark, d):
    """Load a table in two overlapping runs through the sink, then repeat the second run."""
    sink = SinkSpec("parquet", path=run_folder(spark, "orders"))
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    incremental.append_missing(orders.filter("o_orderstatus = 'F'"), sink, ["o_orderkey"])
    for _ in range(2):
        incremental.append_missing(orders, sink, ["o_orderkey"])
    return spark.read.parquet(sink.path)


@query("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def append_missing_many_keys(spark, d):
    """Keys that count as too many to send out: a Bloom filter of them thins the target first."""
    sink = SinkSpec("parquet", path=run_folder(spark, "orders-many"))
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    for part in (orders.filter("o_orderstatus = 'F'"), orders, orders):
        incremental.append_missing(part, sink, ["o_orderkey"], key_rows=0)
    return spark.read.parquet(sink.path)


@query("SELECT s_suppkey, s_name FROM supplier")
def append_missing_preview(spark, d):
    """A load that is announced with its first rows, into a table whose presence and first key are checked before and after."""
    sink = SinkSpec("parquet", path=run_folder(spark, "suppliers-preview"))
    suppliers = table(spark, d, "supplier").select("s_suppkey", "s_name")
    suppliers.createOrReplaceTempView("known_suppliers")
    quality.require_table(spark, "known_suppliers", F.col("s_suppkey") == suppliers.agg(F.min("s_suppkey")).first()[0])
    for part in (suppliers.filter("s_suppkey % 2 = 0"), suppliers):
        incremental.append_missing(part, sink, ["s_suppkey"], preview=3)
    return spark.read.parquet(sink.path)


@query("SELECT o_totalprice, o_orderkey, o_orderstatus FROM orders")
def append_missing_key_not_first(spark, d):
    """A target whose format goes by position, and a key that is not the first column."""
    sink = SinkSpec("csv", path=run_folder(spark, "orders-csv"), options={"header": "true"})
    orders = table(spark, d, "orders").select("o_totalprice", "o_orderkey", "o_orderstatus")
    write(orders.filter("o_orderstatus = 'F'").limit(0).select("o_totalprice", F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_orderstatus"), sink)
    for part in (orders.filter("o_orderstatus = 'F'"), orders):
        incremental.append_missing(part, sink, ["o_orderkey"], count_target=False)
    return read_source(spark, files("csv", sink.path, schema("o_totalprice DOUBLE, o_orderkey BIGINT, o_orderstatus STRING"), header="true"))


@query("SELECT DISTINCT p_brand, p_type, p_size FROM part")
def append_missing_whole_rows(spark, d):
    """Whole rows through the sink; the target has a key column of its own."""
    sink = SinkSpec("parquet", path=run_folder(spark, "parts"))
    parts = table(spark, d, "part").select("p_brand", "p_type", "p_size")
    write(parts.filter("p_size < 20").distinct().withColumn("row_id", F.xxhash64("p_brand", "p_type", "p_size")), sink)
    report = incremental.append_missing(parts, sink, surrogate="row_id")
    assert report.n_missing == parts.filter("p_size >= 20").distinct().count()
    return spark.read.parquet(sink.path).select("p_brand", "p_type", "p_size")


@query("SELECT count(*) AS n, false AS wrote_nothing FROM supplier WHERE s_acctbal > 0")
def write_guarded(spark, d):
    """An empty result is not written, another one is."""
    sink, empty = (SinkSpec("parquet", path=run_folder(spark, label)) for label in ("suppliers", "none"))
    suppliers = table(spark, d, "supplier")
    wrote = write_if_any(suppliers.filter("s_acctbal > 0"), sink)
    nothing = write_if_any(suppliers.filter("s_acctbal > 1e12"), empty)
    return spark.read.parquet(sink.path).agg(F.count(F.lit(1)).alias("n")).withColumn("wrote_nothing", F.lit(nothing or not wrote))


@query("SELECT c_custkey, c_name FROM customer")
def json_array_import(spark, d):
    """Files that hold one array of objects, or one object."""
    folder = run_folder(spark, "json-arrays")
    rows = table(spark, d, "customer").select(F.to_json(F.struct("c_custkey", "c_name")).alias("o"), F.col("c_custkey").alias("k"))
    # of a thousand keys one object has a file of its own and the others are one array, so files grow with a thousandth of the rows
    arrays = rows.filter("k % 1000 <> 7").groupBy(F.expr("floor(k / 1000)")).agg(F.concat(F.lit("["), F.array_join(F.collect_list("o"), ",\n"), F.lit("]")).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(f"{folder}/a")
    rows.filter("k % 1000 = 7").select(F.col("o").alias("value")).write.option("maxRecordsPerFile", 1).text(f"{folder}/b")
    kinds = schema("c_custkey BIGINT, c_name STRING")
    parts = [read_source(spark, files("json", f"{folder}/{x}", kinds, multiLine="true")) for x in "ab"]
    return parts[0].unionByName(parts[1])


@query(f"""WITH {_CLEAN},
    matched AS (SELECT DISTINCT c.*, k.org_id FROM clean c JOIN keywords k ON contains(lower(c.content), lower(k.keyword)) WHERE {_IN_WINDOW}),
    raw AS ({_stored_sql('matched')}),
    labelled AS (SELECT *, org_of_lang AS org_id FROM posts WHERE {_IN_WINDOW}),
    given AS ({_stored_sql('labelled')}),
    store AS (SELECT * FROM raw UNION ALL SELECT * FROM given WHERE post_id NOT IN (SELECT post_id FROM raw))
    SELECT url, org_id, code, crawl_time FROM store JOIN codes USING (org_id)""")
def daily_run(spark, d):
    """Classify, normalise and publish over file stores; what is published."""
    folder = run_folder(spark, "daily")
    docs = table(spark, d, "documents")
    kinds = {"raw": as_posts(docs), "labelled": as_classified_posts(docs), "orgs": orgs(spark)}
    for name, df in kinds.items():
        df.write.parquet(f"{folder}/{name}")
    spec = {name: files("parquet", f"{folder}/{name}", df.schema) for name, df in kinds.items()}
    config = daily.DailyConfig(
        spec["raw"], spec["labelled"], spec["orgs"], files("parquet", f"{folder}/store"),
        SinkSpec("parquet", path=f"{folder}/store"), SinkSpec("parquet", path=f"{folder}/publish"),
    )
    daily.daily_run(spark, config, AS_OF)
    rows = spark.read.parquet(f"{folder}/publish")
    return rows.select("url", "org_id", F.split("id", "-")[0].alias("code"), "crawl_time")


@query("SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def json_roundtrip(spark, d):
    folder = run_folder(spark, "customers")
    names = schema("c_custkey BIGINT, c_name STRING, c_acctbal DOUBLE, c_mktsegment STRING")
    write_json(table(spark, d, "customer").select(*names.names), folder)
    return read_source(spark, files("json", folder, names))


# --- messages and variation strings ----------------------------------------------------------------

@query("""SELECT CASE WHEN event_type <> 'error' THEN event_id END AS event_id,
    CASE WHEN event_type <> 'error' THEN CAST(json_extract(props, '$.k') AS INTEGER) END AS k FROM events""")
def parse_json_events(spark, d):
    """Messages of one event type are broken on purpose; they become rows of NULLs."""
    broken = F.concat(F.lit("broken "), "props")
    good = F.concat(F.lit('{"event_id": '), "event_id", F.lit(", "), F.expr("substring(props, 2)"))
    value = F.when(F.col("event_type") == "error", broken).otherwise(good)
    return parse.parse_json(table(spark, d, "events").select(value.alias("value")), schema("event_id BIGINT, k INT"))


@query("""SELECT concat('broken ', props) AS bad FROM events WHERE event_type = 'error'""")
def bad_json_events(spark, d):
    value = F.when(F.col("event_type") == "error", F.concat(F.lit("broken "), "props")).otherwise(F.col("props"))
    parsed = parse.parse_json(table(spark, d, "events").select(value.alias("value")), schema("k INT"), keep_bad=True)
    return parse.bad_messages(parsed).select(F.col(parse.CORRUPT).alias("bad"))


@query("""SELECT p_partkey, 'name1,name2,name3' AS name, concat(p_brand, ', ', p_type, ', ', p_name) AS value FROM part""")
def split_variations(spark, d):
    parts = table(spark, d, "part").select(
        "p_partkey", F.concat("p_brand", F.lit(", "), "p_type", F.lit(",\t"), "p_name").alias("v")
    )
    parts = parts.withColumn("v", variations.split_variations(F.col("v")))
    return parts.select(
        "p_partkey", variations.variation_names("v").alias("name"), variations.variation_values("v").alias("value")
    )


@query("""SELECT p_partkey, CASE WHEN p_size > 25 THEN p_brand ELSE concat(p_brand, ', ', p_type, ',', p_name) END AS model1,
    CASE WHEN p_size > 25 THEN ' ' || p_type END AS model2 FROM part""")
def split_variations_pair(spark, d):
    two = F.concat("p_brand", F.lit(", "), "p_type")
    text = F.when(F.col("p_size") > 25, two).otherwise(F.concat(two, F.lit(","), "p_name"))
    models = table(spark, d, "part").select("p_partkey", variations.split_variation_pair(text).alias("m"))
    return models.select("p_partkey", "m.model1", "m.model2")


# --- sales windows ---------------------------------------------------------------------------------

_LAST_SQL = f"""{PROPERTIES_SQL},
    win AS (SELECT product_id, property_id, CAST(floor(epoch(crawl_time) / 3600) AS BIGINT) * 3600 AS window_start,
                   arg_max(property_sold, crawl_time) AS total_sales, arg_max(property_price, crawl_time) AS price
            FROM properties GROUP BY 1, 2, 3)"""
_GMV_OF = """gmv AS (SELECT w.*, p.total_sales AS prev_total_sales,
                   CASE WHEN p.total_sales IS NULL THEN 0 ELSE w.total_sales - p.total_sales END AS quantity,
                   CASE WHEN p.total_sales IS NULL THEN 0 ELSE w.total_sales - p.total_sales END * w.price AS gmv
            FROM win w LEFT JOIN win p ON w.product_id = p.product_id AND w.property_id = p.property_id
                 AND w.window_start = p.window_start + 3600)"""
_GMV_SQL = f"""{_LAST_SQL}, {_GMV_OF}"""
_PLANTED_GMV_SQL = f"""{_LAST_SQL.replace("FROM properties", "FROM planted").replace(PROPERTIES_SQL, PROPERTIES_SQL + ", " + PLANTED_SQL)}
    , {_GMV_OF}"""
_CLOSED = "window_start + 3600 <= (SELECT epoch(max(ts)) FROM events) - 600"


def _window_epoch(df):
    return df.withColumn("window_start", F.unix_timestamp("time_window.start")).drop("time_window")


@query(f"WITH {_LAST_SQL} SELECT * FROM win")
def window_last(spark, d):
    return _window_epoch(sales.window_last(_properties(spark, d), width=HOUR))


@query(f"WITH {_GMV_SQL} SELECT * FROM gmv")
def window_prev_delta(spark, d):
    gmv = sales.property_gmv(_properties(spark, d), width=HOUR)
    return gmv.withColumn("window_start", F.unix_timestamp("window_start"))


@query(f"""WITH {_PLANTED_GMV_SQL} SELECT e.property_promotion_id AS event_id, e.product_id, e.property_id, coalesce(g.quantity, 0) AS quantity, coalesce(g.gmv, 0) AS gmv,
    split_part(e.property_name, ',', 1) AS property_name_1
    FROM planted e LEFT JOIN gmv g ON e.product_id = g.product_id AND e.property_id = g.property_id
      AND g.window_start = CAST(floor(epoch(e.crawl_time) / 3600) AS BIGINT) * 3600""")
def gmv_attach(spark, d):
    """Some events have no time, some no key: they stay, with 0."""
    events = planted_events(_properties(spark, d))
    rows = sales.attach_gmv(events, sales.property_gmv(events, width=HOUR), width=HOUR)
    models = rows.withColumn("m", variations.split_variation_pair(F.col("property_name")))
    return models.select(
        F.col("property_promotion_id").alias("event_id"), "product_id", "property_id", "quantity", "gmv",
        F.col("m.model1").alias("property_name_1"),
    )


def _sales_sql(gmv: str, events: str, join: str) -> str:
    return f"""WITH {gmv} SELECT e.property_id, e.product_id, split_part(e.property_name, ',', 1) AS property_name_1,
    ' ' || split_part(e.property_name, ', ', 2) AS property_name_2, e.property_price, e.property_price_before_discount,
    e.property_stock, e.property_sold, e.property_promotion_id, coalesce(g.quantity, 0) AS quantity, coalesce(g.gmv, 0) AS gmv,
    e.rating_star, e.crawl_time
    FROM {events} e {join} gmv g ON e.product_id = g.product_id AND e.property_id = g.property_id
      AND g.window_start = CAST(floor(epoch(e.crawl_time) / 3600) AS BIGINT) * 3600"""


_SALES_SQL = _sales_sql(_GMV_SQL, "properties", "JOIN")


@query(_sales_sql(_PLANTED_GMV_SQL, "planted", "LEFT JOIN"))
def property_sales(spark, d):
    return naive_stamps(sales_plan.property_sales(planted_events(_properties(spark, d)), width=HOUR))


# --- quality ---------------------------------------------------------------------------------------

_DQ = {
    "post_id": "md5(text)",
    "url": "CASE WHEN lang <> 'de' THEN concat('doc://', source) END",
    "org_id": f"CAST({ORG_OF_LANG} AS INT)",
    "doc_type": "CAST(n_chars AS INT)",
    "title": "text",
    "crawl_source_code": "source",
    "sentiment": "CASE WHEN lang = 'fr' THEN CAST(1 AS INT) END",
}
_DQ_SQL = "p AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in _DQ.items()) + " FROM documents)"


def _dq(spark, d):
    return table(spark, d, "documents").selectExpr(*[f"{e} AS {c}" for c, e in _DQ.items()])


@query(f"""WITH {_DQ_SQL}
    SELECT 'not_null' AS rule, 'post_id' AS "column", count(*) FILTER (post_id IS NULL) AS n_bad FROM p UNION ALL
    SELECT 'not_null', 'url', count(*) FILTER (url IS NULL) FROM p UNION ALL
    SELECT 'not_null', 'org_id', count(*) FILTER (org_id IS NULL) FROM p UNION ALL
    SELECT 'max_length', 'post_id', count(*) FILTER (length(post_id) > 255) FROM p UNION ALL
    SELECT 'max_length', 'url', count(*) FILTER (length(url) > 500) FROM p UNION ALL
    SELECT 'max_length', 'title', count(*) FILTER (length(title) > 500) FROM p UNION ALL
    SELECT 'max_length', 'crawl_source_code', count(*) FILTER (length(crawl_source_code) > 4) FROM p UNION ALL
    SELECT 'smallint', 'doc_type', count(*) FILTER (doc_type NOT BETWEEN -32768 AND 32767) FROM p UNION ALL
    SELECT 'primary_key', 'post_id', count(*) FROM (SELECT post_id FROM p GROUP BY 1 HAVING count(*) > 1)""")
def dq_contract(spark, d):
    return quality.check(_dq(spark, d), quality.PUBLISH_CONTRACT)


@query(f"""WITH {_DQ_SQL}
    SELECT post_id, concat_ws('|', CASE WHEN url IS NULL THEN 'not_null:url' END,
        CASE WHEN length(title) > 500 THEN 'max_length:title' END,
        CASE WHEN length(crawl_source_code) > 4 THEN 'max_length:crawl_source_code' END,
        CASE WHEN doc_type > 32767 THEN 'smallint:doc_type' END) AS violations
    FROM p WHERE url IS NULL OR length(title) > 500 OR length(crawl_source_code) > 4 OR doc_type > 32767""")
def dq_invalid_rows(spark, d):
    invalid = quality.split(_dq(spark, d), quality.PUBLISH_CONTRACT)[1]
    return invalid.select("post_id", F.array_join("violations", "|").alias("violations"))


@query(f"""WITH {_CLEAN},
    matched AS (SELECT DISTINCT c.*, k.org_id FROM clean c JOIN keywords k ON contains(lower(c.content), lower(k.keyword)) WHERE {_IN_WINDOW}),
    stored AS ({_stored_sql('matched')})
    SELECT 'not_null' AS rule, 'post_id' AS "column", count(*) FILTER (lang_known IS NULL) AS n_bad
        FROM (SELECT CASE WHEN crawl_source_code <> 'FR' THEN 1 END AS lang_known FROM stored) UNION ALL
    SELECT 'not_null', 'org_id', count(*) FILTER (org_id IS NULL) FROM stored UNION ALL
    SELECT 'type', 'sentiment', count(*) FROM stored""")
def dq_store_contract(spark, d):
    """Contract of the document store on classified posts, with planted faults: ids taken away, a column of another type."""
    stored = classify.classify_posts(_posts(spark, d), orgs(spark), AS_OF)
    faulty = stored.withColumns({"post_id": F.when(F.col("crawl_source_code") != "FR", F.col("post_id")), "sentiment": F.col("sentiment").cast("bigint")})
    return quality.check(faulty, quality.STORE_CONTRACT)


@query(f"""WITH p AS ({ORACLES["publish_posts"]})
    SELECT 'not_null' AS rule, c AS "column", 0 AS n_bad FROM (VALUES ('id'), ('url'), ('org_id')) v(c) UNION ALL
    SELECT 'max_length', c, 0 FROM (VALUES {", ".join(f"('{c}')" for c in quality.PUBLISHED_CONTRACT.max_length if c in POST_PUBLISH.names)}) v(c) UNION ALL
    SELECT 'smallint', c, 0 FROM (VALUES ('source_type'), ('auth_type'), ('is_sent'), ('spam'), ('completed'), ('doc_type')) v(c) UNION ALL
    SELECT 'smallint', 'crawl_source', count(*) FILTER (crawl_source > 32767) FROM p UNION ALL
    SELECT 'primary_key', 'id', count(*) FROM (SELECT id FROM p GROUP BY 1 HAVING count(*) > 1)""")
def dq_published(spark, d):
    """Contract of the publish table on what the publish job gives."""
    return quality.check(publish_posts(spark, d), quality.PUBLISHED_CONTRACT)


@query(f"""WITH {_DQ_SQL} SELECT post_id, coalesce(sentiment, 0) AS sentiment, 0 AS is_sent, 0 AS spam FROM p""")
def dq_defaults(spark, d):
    filled = quality.apply_defaults(_dq(spark, d), quality.PUBLISH_CONTRACT)
    return filled.select("post_id", "sentiment", "is_sent", "spam")


# --- streams (run to the end of the available data, then read the sink's table) --------------------

def _drain(spark, df: DataFrame, label: str) -> DataFrame:
    folder = run_folder(spark, label)
    spec = StreamSinkSpec("parquet", f"{folder}/state", path=f"{folder}/rows", available_now=True)
    write_stream(df, spec).awaitTermination()
    return read_source(spark, files("parquet", spec.path, df.schema))


def _drain_batches(spark, df: DataFrame, label: str, each_batch) -> None:
    spec = StreamSinkSpec("parquet", f"{run_folder(spark, label)}/state", available_now=True)
    write_stream(df, spec, each_batch).awaitTermination()


@query(f"""WITH {PROPERTIES_SQL} SELECT property_id, product_id, 'name1,name2' AS name, property_name AS value,
    property_price, property_price_before_discount, property_stock, property_sold, property_promotion_id, rating_star, crawl_time
    FROM properties""")
def stream_parse_properties(spark, d):
    events = as_properties(stream(spark, d, "events"))
    text = events.withColumn("crawl_time", F.date_format("crawl_time", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    parsed = parse.parse_json(as_messages(text), PROPERTY_EVENT)
    return naive_stamps(_drain(spark, jobs.properties(parsed), "properties"))


@query(f"""WITH {_CLEAN}
    SELECT c.id AS post_id, c.url, k.org_id FROM clean c JOIN keywords k ON contains(lower(c.content), lower(k.keyword))""")
def stream_classify(spark, d):
    parsed = parse.parse_json(post_messages(stream(spark, d, "documents")), POST_STREAM)
    rows = jobs.classify_stream(parsed, plain_orgs(spark)).select("post_id", "url", "org_id")
    return _drain(spark, rows, "classified")


@query(f"""WITH {DERIVED_SQL}, late AS (SELECT DISTINCT keyword AS term FROM words WHERE length(keyword) > {RARE_LENGTH})
    SELECT concat(conv_id, '-', turn) AS post_id, org_id FROM conversations c JOIN words w ON contains(lower(c.text), lower(w.keyword))
    WHERE c.text <> '' AND NOT EXISTS (SELECT 1 FROM late WHERE contains(lower(c.text), lower(term)))""")
def stream_classify_each_batch(spark, d):
    """Every micro-batch meets keywords and spam list as they are at that moment; the stream is delivered again, and its epochs are known."""
    posts = stream(spark, d, "conversations").select(
        F.concat("conv_id", F.lit("-"), "turn").alias("post_id"), F.col("text").alias("content")
    )
    sink = SinkSpec("parquet", path=run_folder(spark, "each-batch-rows"))
    ledger = EpochLedger(run_folder(spark, "each-batch-ledger"), "conversations")
    each = jobs.classify_each_batch(lambda: rare_spam(derived_orgs(spark, d)), sink, encoded_spam=True, ledger=ledger)
    for _ in range(2):
        _drain_batches(spark, posts, "each-batch", each)
    return spark.read.parquet(sink.path).select("post_id", "org_id")


@query(f"WITH {_LAST_SQL} SELECT * FROM win WHERE {_CLOSED}")
def stream_window_last(spark, d):
    rows = jobs.windowed_last(as_properties(stream(spark, d, "events")), width=HOUR)
    return _drain(spark, _window_epoch(rows), "window-last")


@query(f"WITH {_GMV_SQL} SELECT * FROM gmv WHERE {_CLOSED}")
def stream_prev_delta(spark, d):
    rows = jobs.windowed_delta(as_properties(stream(spark, d, "events")), width=HOUR)
    return _drain(spark, _window_epoch(rows), "prev-delta")


_LATE = "event_id % 50 = 0 AND ts < (SELECT max(ts) FROM events) - INTERVAL 2 HOUR"
_ON_TIME_SQL = _GMV_SQL.replace("value AS rating_star, ts AS crawl_time FROM events)", f"value AS rating_star, ts AS crawl_time FROM events WHERE NOT ({_LATE}))")


@query(f"WITH {_ON_TIME_SQL} SELECT * FROM gmv WHERE {_CLOSED}")
def stream_prev_delta_late(spark, d):
    """Some events come hours late, after the others: their windows are out, so they change neither these nor the ones after."""
    folder = run_folder(spark, "late-events")
    events = table(spark, d, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    last = events.agg(F.max(at)).first()[0]
    marked = events.withColumn("late", (F.col("event_id") % 50 == 0) & (at < last - 7_200_000_000))
    spec = StreamSinkSpec("parquet", f"{folder}/state", path=f"{folder}/rows", available_now=True)
    # rows are late against the watermark of the batch before, so the newest ones come in between; every delivery is as many files
    # as there are tasks, and one run of the stream, which goes on from its checkpoint
    for part in (~F.col("late") & (at < last), at == last, F.col("late")):
        as_properties(marked.filter(part)).write.mode("append").parquet(f"{folder}/events")
        source = spark.readStream.schema(PROPERTY_EVENT).parquet(f"{folder}/events")
        rows = _window_epoch(jobs.windowed_delta(source, width=HOUR))
        write_stream(rows, spec).awaitTermination()
    return read_source(spark, files("parquet", spec.path, rows.schema))


@query(f"{_SALES_SQL} AND {_CLOSED}")
def stream_property_sales(spark, d):
    rows = jobs.property_sales_stream(as_properties(stream(spark, d, "events")), width=HOUR)
    return naive_stamps(_drain(spark, rows, "property-sales"))


@query("SELECT event_id, user_id, event_type, value FROM events")
def stream_replayed(spark, d):
    """A writer that does not look at its target, delivered twice: the ledger knows the epochs."""
    events = stream(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    sink = SinkSpec("parquet", path=run_folder(spark, "stream-replayed"))
    each = jobs.append_each_batch(sink, ledger=EpochLedger(run_folder(spark, "ledger"), "events"))
    for _ in range(2):
        _drain_batches(spark, events, "stream-replayed", each)
    return spark.read.parquet(sink.path)


@query("SELECT event_id, user_id, event_type, value FROM events")
def stream_insert_missing(spark, d):
    """The stream is delivered twice; the second delivery adds nothing."""
    events = stream(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    sink = SinkSpec("parquet", path=run_folder(spark, "stream-table"))
    for _ in range(2):
        _drain_batches(spark, events, "stream-missing", jobs.append_missing_each_batch(sink, ["event_id"]))
    return spark.read.parquet(sink.path)
