"""From raw documents to token ids: a chain of corpus operators, one table after the other."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from postflow.llm.common import stage, table
from postflow.llm.cuckoo import drop_exact_duplicates
from postflow.llm.sentence_pieces import encode_pieces
from postflow.llm.similar_texts import drop_similar
from postflow.llm.tiling import drop_contaminated
from postflow.llm.toxicity import drop_toxic

#: Rows of an Arrow batch in the session of the pipeline.
BATCH_ROWS = 1000


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose most toxic window scores 0.3 or more go.

    NULL and empty texts have the network's base score; repeated rows go or stay together.
    """
    return drop_toxic(docs, table(spark, sf_dir, "labels"), threshold=0.3)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays.

    NULL, empty and blank texts are one group; of repeated rows one stays.
    """
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays: fingerprints meet in a forest of vantage-point trees and are
    verified on whole sets of five-word shingles, similarity 0.8 or more.

    NULL and blank texts are one class; of repeated rows one stays.
    """
    return drop_similar(docs, words_each=5, similarity=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover 0.8 or more of a benchmark item in runs of five or more words go.

    NULL and empty texts stay, repeated rows too; items without words match nothing.
    """
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"), min_match=5, threshold=0.8)


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of what is left, and whether decoding them gives the text back.

    NULL and empty texts have no ids; every row is kept.
    """
    found = encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return found.select(found.id.alias("doc_id"), "n_ids", "ids", found.same.alias("round_trip"))


Step = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(step: Step) -> Step:
    """The stage, with rows that go to Python at most as many at a time as ``build_session`` sets: they hold whole texts, and an
    Arrow batch is held by the executor and its worker at once."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        rows = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
        if not 0 < rows <= BATCH_ROWS:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        return step(spark, docs, sf_dir)

    return run


STAGES: list[tuple[str, Step]] = [
    (name, in_small_batches(step))
    for name, step in [
        ("toxicity", toxicity),
        ("exact dedup", exact_dedup),
        ("SimHash near-dedup", near_dedup),
        ("benchmark decontamination", decontamination),
        ("SentencePiece encoding and decoding", sentence_pieces),
    ]
]

#: SQL cannot express the classifier, the fingerprints or the tokenizer; tests hold stages against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
