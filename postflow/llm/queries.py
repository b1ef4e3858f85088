"""One query per corpus operator over the given tables, with SQL counterparts where SQL can express them."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postflow.llm import byte_language
from postflow.llm.bit_planes import cluster_vectors, with_inertia
from postflow.llm.common import table
from postflow.llm.cuckoo import exact_duplicates
from postflow.llm.language_model import score_texts
from postflow.llm.personal_data import personal_data, span_report
from postflow.llm.role_repair import damage_report
from postflow.llm.sentence_pieces import encode_pieces
from postflow.llm.simhash import simhash_classes
from postflow.llm.token_counts import section_tokens
from postflow.llm.token_files import token_file_round_trip
from postflow.llm.tiling import contaminated
from postflow.llm.toxicity import fit, toxicity
from postflow.llm.warc import archive_round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(function):
    QUERIES[function.__name__] = function
    return function


@_query
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    found = simhash_classes(table(spark, sf_dir, "documents"), words_each=4, max_bits=4)
    return found.select(found.id.alias("doc_id"), "fingerprint", "component_id")


@_query
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document that stays for every document."""
    found = exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select(found.id.alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


ORACLES["op2_exact_dedup"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS n FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY n) AS group_size,
       row_number() OVER w = 1 AS kept,
       sha256(n) AS text_sha256
FROM d WINDOW w AS (PARTITION BY n ORDER BY length(t) DESC, doc_id NULLS LAST)
"""


@_query
def op3_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every document, and whether decoding them gives the text back."""
    found = encode_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select(found.id.alias("doc_id"), "n_ids", "ids", found.same.alias("round_trip"))


@_query
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the token files written from all documents hold when they are read back."""
    found = token_file_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return found.select(found.id.alias("doc_id"), "start", "n_tokens", "ids_crc32")


@_query
def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model and base log10 probability of every document."""
    found = score_texts(table(spark, sf_dir, "documents"), order=2)
    return found.select(found.id.alias("doc_id"), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@_query
def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return span_report(personal_data(table(spark, sf_dir, "documents")))


@_query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document."""
    found = section_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return found.select(found.id.alias("doc_id"), "section", "char_start", "char_end", "n_tokens", "n_crossing")


@_query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, from a network trained on labelled documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    found = toxicity(docs, fit(docs, table(spark, sf_dir, "labels")), threshold=0.3)
    return found.select(found.id.alias("doc_id"), "held_out", "score", "predicted")


@_query
def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that cover a benchmark item, with the item and the tiles that cover it."""
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(found.id.alias("doc_id"), "item_id", "item_words", "covered", "coverage", "tiles")


@_query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the archives written from ``pages`` hold when they are read back."""
    found = archive_round_trip(table(spark, sf_dir, "pages"), min_bytes=0)
    return found.select("page_id", "payload_bytes", "payload_digest", found.warc_type.alias("record_type"), "refers_to")


ORACLES["op10_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
k AS (SELECT *, sha1(payload) AS hexed, min(page_id) OVER (PARTITION BY payload) AS least FROM p)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((('0x' || substr(hexed, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31), 1)), '') AS payload_digest,
       CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> least THEN least END AS refers_to
FROM k
"""


@_query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, least repair and hash of the repaired rows of every conversation, after the agreed damage."""
    found = damage_report(table(spark, sf_dir, "conversations"))
    return found.select(found.id.alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


_CRC_SQL = """xor(list_reduce(list_transform(range(1, length(key) + 1), lambda i: ascii(substr(key, i, 1))::BIGINT),
    lambda c, b: list_reduce([xor(c, b)::BIGINT] || list_transform(range(8), lambda k: 0::BIGINT),
                             lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END), 4294967295::BIGINT), 4294967295)"""

# The grammar as a table of states: 0 nothing, 1 system, 2 user, 3 pairs. ``ins``: states reached by inserted rows; ``act``: by a role.
ORACLES["op11_conversation_repair"] = rf"""
WITH RECURSIVE src AS (
    SELECT dense_rank() OVER (ORDER BY conv_id) AS gid, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')) AS key FROM conversations),
dealt AS (SELECT *, {_CRC_SQL} % 20 AS d FROM src),
damaged AS (
    SELECT gid, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
           CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(range(CASE WHEN d = 3 THEN 2 ELSE 1 END)) AS copy FROM dealt WHERE d <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY gid ORDER BY turn NULLS FIRST, role, text, copy) AS rn, substr(role, 1, 1) AS ini FROM damaged),
rows_ AS MATERIALIZED (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'b'
                   WHEN row_number() OVER (PARTITION BY gid, role, text ORDER BY rn) > 1 THEN 'd'
                   WHEN NOT regexp_matches(text, '[.!?][ 	-
]*\z') THEN 't' ELSE '' END AS fault,
           coalesce(rn > 1 AND lag(ini) OVER (PARTITION BY gid ORDER BY rn) || ini NOT IN ('su', 'ua', 'au'), false) AS illegal FROM placed),
found AS (
    SELECT gid, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
           count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (illegal) AS illegal FROM rows_ GROUP BY gid),
ins(e, f, marks) AS (VALUES (0, 0, ''), (0, 2, 'I'), (0, 3, 'II'), (1, 1, ''), (1, 2, 'I'), (1, 3, 'II'), (2, 2, ''), (2, 3, 'I'), (3, 3, ''), (3, 2, 'I')),
act(f, sym, t) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
step AS (
    SELECT r.gid, r.rn, f, f AS t, 2 AS cost, 'D' AS edit FROM rows_ r, range(4) s(f) UNION ALL
    SELECT r.gid, r.rn, f, t, CASE fault WHEN 't' THEN 5 ELSE 0 END, 'K' FROM rows_ r JOIN act ON ini = sym WHERE fault IN ('', 't') UNION ALL
    SELECT r.gid, r.rn, f, t, 1 + CASE fault WHEN 't' THEN 5 ELSE 0 END, 'R' FROM rows_ r, act WHERE sym IN ('u', 'a') AND fault IN ('', 't')),
tops(gid, rn, e, best) AS (
    SELECT gid, 0::BIGINT, 0, {{'cost': 0::BIGINT, 'audit': ''}} FROM found UNION ALL
    SELECT p.gid, p.rn + 1, x.t, min({{'cost': (p.best.cost + 5 * length(marks) + x.cost)::BIGINT, 'audit': p.best.audit || marks || edit}})
    FROM tops p JOIN ins ON ins.e = p.e JOIN step x ON x.gid = p.gid AND x.rn = p.rn + 1 AND x.f = ins.f GROUP BY p.gid, p.rn, x.t),
ends AS (
    SELECT p.gid, min({{'cost': (p.best.cost + 5 * length(marks))::BIGINT, 'audit': p.best.audit || marks}}) AS best
    FROM tops p JOIN found USING (gid) JOIN ins ON ins.e = p.e WHERE p.rn = found.n AND ins.f IN (0, 3) GROUP BY p.gid),
edits AS (SELECT gid, j, substr(best.audit, j, 1) AS edit, length(replace(substr(best.audit, 1, j), 'I', '')) AS rn FROM ends, range(1, 10000) t(j) WHERE j <= length(best.audit)),
kept AS (
    SELECT e.gid, e.j, e.edit, r.role, CASE WHEN e.edit = 'I' THEN '' ELSE r.text END AS text, row_number() OVER w AS o,
           first_value(e.edit = 'K' AND r.ini = 's') OVER w AS led
    FROM edits e LEFT JOIN rows_ r ON r.gid = e.gid AND r.rn = e.rn WHERE e.edit <> 'D' WINDOW w AS (PARTITION BY e.gid ORDER BY e.j)),
text_ AS (
    SELECT gid, string_agg(CASE WHEN edit = 'K' THEN role WHEN (o - led::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY j) AS repaired FROM kept GROUP BY gid)
SELECT s.conv_id, coalesce(f.gaps, 0) AS gaps, coalesce(f.blank, 0) AS blank, coalesce(f.duplicate, 0) AS duplicate, coalesce(f.truncated, 0) AS truncated,
       coalesce(f.illegal, 0) AS illegal, coalesce(e.best.cost, 0) AS cost, coalesce(e.best.audit, '') AS audit, sha256(coalesce(t.repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT gid, conv_id FROM src) s LEFT JOIN found f USING (gid) LEFT JOIN ends e USING (gid) LEFT JOIN text_ t USING (gid)
"""


@_query
def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, by a network trained on documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    found = byte_language.predict_languages(docs, byte_language.fit(docs))
    return found.select(found.id.alias("doc_id"), "held_out", "lang_pred", "score")


@_query
def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every usable vector after ten rounds."""
    assigned, centres = cluster_vectors(table(spark, sf_dir, "embeddings"), k=8, rounds=10, scale=1024, seed=3)
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres.tolist()]
    digest = F.element_at(F.array(*map(F.lit, hashes)) if hashes else F.array().cast("array<string>"), F.col("cluster") + 1)
    found = with_inertia(assigned).withColumn("centroid_sha256", digest)
    return found.select(found.id.alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _rounds_sql(rounds: int) -> str:
    """Centres c0, c1, ... of the rounds, each from the assignment to the one before."""
    steps = []
    for n in range(rounds + 1):
        steps.append(f"""a{n} AS MATERIALIZED (SELECT rid, arg_min(k, far * 100 + k) AS k, min(far) AS far FROM (
            SELECT v.rid, c.k, list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::HUGEINT AS far
            FROM v CROSS JOIN c{n} c) GROUP BY rid)""")
        if n < rounds:
            steps.append(f"""m{n} AS (SELECT a.k, i, CAST(sum(v.x[i]) AS HUGEINT) AS total, count(*) AS n
                FROM a{n} a JOIN v USING (rid), range(1, 65) r(i) GROUP BY ALL),
            c{n + 1} AS MATERIALIZED (SELECT k, CASE WHEN new IS NULL THEN x ELSE new END AS x FROM c{n} LEFT JOIN (
                SELECT k, list(CAST((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY i) AS new FROM m{n} GROUP BY k) USING (k))""")
    return ", ".join(steps)


ORACLES["op13_centroid_clustering"] = f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS x
           FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64),
     c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS k, x FROM (SELECT sha256('3:' || vec_id) AS h, x FROM v ORDER BY h LIMIT 8)),
     {_rounds_sql(10)},
     done AS (SELECT v.vec_id, CAST(a.k AS INTEGER) AS cluster, CAST(a.far AS BIGINT) AS distance FROM a10 a JOIN v USING (rid))
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM done JOIN c10 c ON c.k = done.cluster
"""
