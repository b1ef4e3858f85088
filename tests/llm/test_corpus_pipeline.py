import corpus_pipeline
from helpers import DOCS
from postflow.llm import toxicity
from postflow.llm.common import stage
from postflow.llm.queries import QUERIES
from postflow.llm.tiling import words_of
from test_dedup import strip
from test_similar_texts import plain_classes
from test_tiling import plain_hits


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact dedup", "SimHash near-dedup", "benchmark decontamination", "SentencePiece encoding and decoding",
    ]
    assert corpus_pipeline.ORACLE_SQL is None


def test_each_stage_against_a_plain_version(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    steps = dict(corpus_pipeline.STAGES)
    rows = lambda df: {r.doc_id: r.text for r in df.collect()}

    left = stage(steps["toxicity"](spark, docs, sf_dir), "test")
    net = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = dict(zip(rows(docs), toxicity.Scorer(net).scores([t or "" for t in rows(docs).values()])))
    assert left.columns == columns and set(rows(left)) == {i for i, s in score.items() if s < 0.3}

    before = rows(left)
    left = stage(steps["exact dedup"](spark, left, sf_dir), "test")
    best = {}
    for i, t in before.items():
        key = (-len(t or ""), i)
        best[strip(t)] = min(best.get(strip(t), key), key)
    assert left.columns == columns and set(rows(left)) == {i for _, i in best.values()}

    before = sorted(rows(left).items())
    left = stage(steps["SimHash near-dedup"](spark, left, sf_dir), "test")
    root = plain_classes([t for _, t in before])  # all pairs by five-word shingles, similarity 0.8
    assert left.columns == columns and set(rows(left)) == {before[k][0] for k in set(root)}

    before = rows(left)
    left = stage(steps["benchmark decontamination"](spark, left, sf_dir), "test")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    seeds = {tuple(words_of(t)[k : k + 5]) for _, t in items for k in range(len(words_of(t)) - 4)}
    near = [(i, t) for i, t in before.items() if any(tuple(words_of(t)[k : k + 5]) in seeds for k in range(len(words_of(t)) - 4))]
    assert left.columns == columns and set(rows(left)) == set(before) - {h[0] for h in plain_hits(near, items)}

    before = rows(left)
    coded = steps["SentencePiece encoding and decoding"](spark, left, sf_dir).collect()
    assert {r.doc_id for r in coded} == set(before) and all(r.round_trip for r in coded)


def test_stages_take_empty_and_awkward_tables(spark, tmp_path):
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(None, 1), (1, None), (1, 0), (2, 1)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "x", None, "s", 1), (3, "a b", "en", "s", 3), (3, "a b", "en", "s", 3)]
    for part in (rows, []):
        docs = spark.createDataFrame(part, DOCS)
        for name, step in corpus_pipeline.STAGES:
            out = stage(step(spark, docs, str(tmp_path)), "test")
            assert out.count() <= docs.count() and (name == corpus_pipeline.STAGES[-1][0] or out.columns == docs.columns)
            docs = out if out.columns == docs.columns else docs


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_stages_send_texts_in_small_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was, seen = spark.conf.get(key), []
    step = corpus_pipeline.in_small_batches(lambda s, docs, d: seen.append(s.conf.get(key)))
    try:
        for rows in ("10000", "0", "200"):
            spark.conf.set(key, rows)
            step(spark, None, "")
    finally:
        spark.conf.set(key, was)
    assert seen == ["1000", "1000", "200"]
