import pytest
from oracle import connect, spark_rows, sql_rows

from postflow.llm.queries import ORACLES, QUERIES

FIRST = {
    "op1_simhash_near_dedup": ["doc_id", "fingerprint", "component_id"],
    "op2_exact_dedup": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op4_token_files": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op5_lm_scoring": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op6_personal_data": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op8_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op11_conversation_repair": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
    "op12_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op13_centroid_clustering": ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
    "op10_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
}


@pytest.mark.parametrize("name", sorted(FIRST))
def test_whole_table_in_the_agreed_columns(spark, sf_dir, name):
    found = QUERIES[name](spark, sf_dir)
    assert found.columns[: len(FIRST[name])] == FIRST[name]
    read, key = {"op10_warc": ("pages", "page_id"), "op11_conversation_repair": ("conversations", "conv_id"), "op13_centroid_clustering": ("embeddings", "vec_id")}.get(name, ("documents", "doc_id"))
    rows = spark.read.parquet(f"{sf_dir}/{read}.parquet")
    assert found.count() == (rows.select(key).distinct().count() if key == "conv_id" else rows.count())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_rows_equal_sql(spark, sf_dir, name):
    assert spark_rows(QUERIES[name](spark, sf_dir)) == sql_rows(connect(sf_dir), ORACLES[name])
