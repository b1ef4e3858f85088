"""Joins whose left side has a few keys with very many rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MARK = "_join_mark"


def table_size(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes of the values as text), from one distributed pass."""
    size = F.lit(0).cast("bigint")
    for name in df.columns:
        size = size + F.coalesce(F.octet_length(F.col(name).cast("string")).cast("bigint"), F.lit(0))
    n, total = df.agg(F.count(F.lit(1)), F.sum(size)).first()
    return n, total or 0


def fits_broadcast(df: DataFrame, max_rows: int, max_bytes: int) -> bool:
    """Measure a table with one bounded job before it is broadcast."""
    rows, size = table_size(df.limit(max_rows + 1))
    return rows <= max_rows and size <= max_bytes


def hot_keys(keyed: DataFrame, key: str, most: int = 64) -> list:
    """Keys with more rows than half a shuffle partition's share, found by a sketch; at most ``most``."""
    n_parts = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n, top = keyed.agg(F.count(F.lit(1)), F.expr(f"approx_top_k({key}, {most}, 10000)")).first()
    return [r["item"] for r in top or [] if r["count"] > 1 and r["count"] * 2 * n_parts >= n]


def join_isolated(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", *, max_rows: int = 1_000_000, max_bytes: int = 64 * 1024 * 1024) -> DataFrame:
    """``left.join(right, keys, how)`` (inner or left) in which rows of a hot key stay where they are.

    Keys that fill more than half a shuffle partition are found by a sketch over ``left``; the rows of ``right`` with these few keys
    are measured and broadcast, and the rest is joined as usual. Where they are too many nothing is split. Key columns must have
    the same types on both sides.
    """
    keys, mark = list(keys), F.xxhash64(*keys)
    hot = hot_keys(left.select(mark.alias(_MARK)), _MARK)
    few = right.filter(mark.isin(hot)) if hot else None
    if few is None or not fits_broadcast(few, max_rows, max_bytes):
        return left.join(right, keys, how)
    is_hot = mark.isin(hot)
    moved = left.filter(~is_hot).join(right.filter(~is_hot), keys, how)
    return moved.unionByName(left.filter(is_hot).join(F.broadcast(few), keys, how))
