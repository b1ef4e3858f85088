"""Data contracts of the stores as checks on DataFrames."""

from __future__ import annotations

import functools
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postflow.schemas import POST_STORED

SMALLINT = (-32768, 32767)


@dataclass(frozen=True)
class Contract:
    required: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    types: Mapping[str, T.DataType] = field(default_factory=dict)
    max_length: Mapping[str, int] = field(default_factory=dict)
    smallint: tuple[str, ...] = ()
    primary_key: tuple[str, ...] = ()
    defaults: Mapping[str, object] = field(default_factory=dict)


# Contract of the document store.
STORE_CONTRACT = Contract(
    required=("post_id", "org_id"),
    not_null=("post_id", "org_id"),
    types={f.name: f.dataType for f in POST_STORED},
)

# Contract of the relational publish table.
PUBLISH_CONTRACT = Contract(
    required=("post_id", "url", "org_id"),
    not_null=("post_id", "url", "org_id"),
    max_length={
        "post_id": 255, "subject_id": 255, "reply_to": 255, "tag1": 255, "tag2": 255, "tag3": 255,
        "title": 500, "url": 500, "auth_id": 500, "auth_name": 500, "source_id": 500, "source_name": 500,
        "source_url": 500, "auth_url": 500, "web_tags": 1000, "web_keywords": 1000, "bot_id": 31,
        "crawl_source_code": 4,
    },
    smallint=("doc_type", "source_type", "crawl_source", "auth_type", "is_sent", "spam", "completed"),
    primary_key=("post_id",),
    defaults={"sentiment": 0, "is_sent": 0, "spam": 0},
)

#: The same contract for rows as ``publish_posts`` gives them: their key column is ``id``.
PUBLISHED_CONTRACT = replace(
    PUBLISH_CONTRACT,
    required=("id", "url", "org_id"),
    not_null=("id", "url", "org_id"),
    max_length={"id": 255, **{c: n for c, n in PUBLISH_CONTRACT.max_length.items() if c != "post_id"}},
    primary_key=("id",),
)


def broken_rules(df: DataFrame, contract: Contract) -> dict[tuple[str, str], Column]:
    """(rule, column) -> predicate that is true on rows breaking it; columns the table lacks are skipped."""
    has = set(df.columns)
    rules: dict[tuple[str, str], Column] = {}
    for c in contract.not_null:
        if c in has:
            rules["not_null", c] = F.col(c).isNull()
    for c, n in contract.max_length.items():
        if c in has:
            rules["max_length", c] = F.coalesce(F.char_length(c) > n, F.lit(False))
    for c in contract.smallint:
        if c in has:
            rules["smallint", c] = F.coalesce(~F.col(c).between(*SMALLINT), F.lit(False))
    return rules


def schema_faults(df: DataFrame, contract: Contract) -> list[tuple[str, str]]:
    """(rule, column) for missing required columns and for columns of the wrong type."""
    kinds = {f.name: f.dataType for f in df.schema}
    missing = [("required", c) for c in contract.required if c not in kinds]
    wrong = [("type", c) for c, t in contract.types.items() if c in kinds and kinds[c] != t]
    return missing + wrong


def check(df: DataFrame, contract: Contract) -> DataFrame:
    """(rule, column, n_bad) for every rule of the contract, from one pass over the rows.

    A fault of the schema counts every row. Key uniqueness adds a second aggregation that shuffles keys only.
    """
    rules = broken_rules(df, contract)
    faults = [F.struct(F.lit(r).alias("rule"), F.lit(c).alias("column"), F.col("_n").alias("n_bad"))
              for r, c in schema_faults(df, contract)]
    counts = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(p).alias(f"{r}:{c}") for (r, c), p in rules.items()])
    rows = [F.struct(F.lit(r).alias("rule"), F.lit(c).alias("column"), F.col(f"{r}:{c}").alias("n_bad")) for r, c in rules]
    report = counts.select(F.inline(F.array(*rows, *faults)))
    if contract.primary_key and set(contract.primary_key) <= set(df.columns):
        repeats = df.groupBy(*contract.primary_key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        report = report.union(
            repeats.agg(F.count(F.lit(1)).alias("n_bad")).select(
                F.lit("primary_key").alias("rule"), F.lit(",".join(contract.primary_key)).alias("column"), "n_bad"
            )
        )
    return report


def split(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """(valid rows, invalid rows with ``violations``), judged row by row."""
    rules = broken_rules(df, contract)
    names = F.array_compact(F.array(*[F.when(p, F.lit(f"{r}:{c}")) for (r, c), p in rules.items()]))
    bad = functools.reduce(lambda a, b: a | b, rules.values(), F.lit(False))
    return df.filter(~bad), df.filter(bad).withColumn("violations", names)


def apply_defaults(df: DataFrame, contract: Contract) -> DataFrame:
    """Column defaults for NULLs; a missing column is added with its default."""
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v)) if c in df.columns else F.lit(v) for c, v in contract.defaults.items()}
    )


def require_table(spark: SparkSession, name: str, key: Column | None = None) -> None:
    """Raise unless the table exists and, when a key predicate is given, holds a row for it."""
    if not spark.catalog.tableExists(name):
        raise ValueError(f"missing table {name}")
    if key is not None and spark.table(name).filter(key).limit(1).isEmpty():
        raise ValueError(f"expected row not found in {name}")
