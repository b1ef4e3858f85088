"""One row per key, and whole-table duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postflow.operators.row_keys import row_digest


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """One row per key: the first under ``order``; a hash of the whole row settles what is still equal.

    The ``= 1`` filter on ``row_number`` lets Spark keep one row per key in every input partition before
    the shuffle, so a key that holds a large share of the table arrives as a handful of rows.
    NULL keys form one group.
    """
    columns = [F.col(c) for c in df.columns]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, F.xxhash64(*columns)))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def latest_crawl(df: DataFrame, keys: Sequence[str], tiebreak: str = "id") -> DataFrame:
    """Keep the most recently crawled row per key."""
    order = [F.col("crawl_time").desc_nulls_last()]
    if tiebreak in df.columns:
        order.append(F.col(tiebreak).desc_nulls_last())
    return keep_latest(df, keys, order)


def collapse_orgs(df: DataFrame, keys: Sequence[str] = ("post_id", "content")) -> DataFrame:
    """One row per post with the sorted set of its organisations; other columns come from its latest crawl.

    The key columns are grouped by a digest of their values, so long texts are not compared or sorted.
    """
    rest = [c for c in df.columns if c != "org_id"]
    order = F.struct("crawl_time", F.xxhash64(*[F.col(c) for c in rest if c not in keys]))
    digest = row_digest(df.select(*keys).schema)
    return (
        df.groupBy(digest.alias("_key"))
        .agg(F.sort_array(F.collect_set("org_id")).alias("org_ids"), F.max_by(F.struct(*rest), order).alias("_rest"))
        .select(*[F.col("_rest")[k].alias(k) for k in keys], "org_ids", *[F.col("_rest")[c].alias(c) for c in rest if c not in keys])
    )


def compact_dedup(df: DataFrame) -> DataFrame:
    """Whole-row duplicates removed. Write the result to a new place, never over the table being read."""
    return df.dropDuplicates()


def newest(df: DataFrame, column: str, n: int, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Top-n report: newest first, ties settled by the given columns. Plans as a per-partition top-n."""
    return df.orderBy(F.col(column).desc(), *tiebreak).limit(n)
