"""Sales deltas of product properties between consecutive time windows."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postflow.operators.skew import join_isolated

KEYS = ("product_id", "property_id")


def window_last(
    events: DataFrame,
    *,
    keys: Sequence[str] = KEYS,
    time: str = "crawl_time",
    total: str = "property_sold",
    price: str = "property_price",
    width: str = "1 minute",
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Last ``total`` and ``price`` of every key in every tumbling window.

    "Last" is by event time, then by ``tiebreak``; give one where event times can be equal. The aggregate
    is partial before its shuffle, so a key with very many events sends one row per window and input
    partition.
    """
    order = event_order(time, tiebreak)
    grouped = events.groupBy(F.window(time, width).alias("time_window"), *keys)
    return grouped.agg(F.max_by(total, order).alias("total_sales"), F.max_by(price, order).alias("price"))


def event_order(time: str, tiebreak: Sequence[str] = ()) -> Column:
    """Ordering of events; a bare timestamp keeps the aggregation hash-based."""
    return F.struct(time, *tiebreak) if tiebreak else F.col(time)


def all_set(keys: Sequence[str]) -> Column:
    """Every key column has a value; rows without one have no previous window."""
    return functools.reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def delta(total: Column, previous: Column) -> Column:
    """Difference to the previous window; 0 where that window has no row."""
    return F.when(previous.isNotNull(), total - previous).otherwise(F.lit(0))


def with_previous(windows: DataFrame, *, keys: Sequence[str] = KEYS, width: str = "1 minute") -> DataFrame:
    """keys, window_start, total_sales, price and ``prev_total_sales`` of exactly the preceding window.

    A gap gives NULL. Every window row counts once as itself and once, one window later, as the previous
    value; a second small aggregation brings the two together. The events are read and aggregated once, no
    join is needed, and the load spreads over (key, window), so one hot key is never sorted in one task.
    """
    own = F.col("_ahead") == 0
    start = F.col("time_window.start")
    twice = windows.withColumn("_ahead", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn(
        "window_start", F.when(own, start).otherwise(start + F.expr(f"interval {width}"))
    )
    paired = twice.groupBy(*keys, "window_start").agg(
        F.max(F.when(own, F.col("total_sales"))).alias("total_sales"),
        F.max(F.when(own, F.col("price"))).alias("price"),
        F.max(F.when(~own & all_set(keys), F.col("total_sales"))).alias("prev_total_sales"),
        F.count_if(own).alias("_own"),
    )
    return paired.filter(F.col("_own") > 0).drop("_own")


def property_gmv(
    events: DataFrame,
    *,
    keys: Sequence[str] = KEYS,
    width: str = "1 minute",
    **columns,
) -> DataFrame:
    """Per key and window: window_start, total_sales, price, prev_total_sales, quantity, gmv."""
    windows = with_previous(window_last(events, keys=keys, width=width, **columns), keys=keys, width=width)
    return windows.select(
        *keys,
        "window_start",
        "total_sales",
        "price",
        "prev_total_sales",
        delta(F.col("total_sales"), F.col("prev_total_sales")).alias("quantity"),
    ).withColumn("gmv", F.col("quantity") * F.col("price"))


def attach_gmv(
    events: DataFrame,
    gmv: DataFrame,
    *,
    keys: Sequence[str] = KEYS,
    time: str = "crawl_time",
    width: str = "1 minute",
) -> DataFrame:
    """Events with quantity and gmv of their window; 0 where there is none.

    Events without a time or key have no window; they are kept, with 0. A key that holds much of a window's events stays in place
    (see :func:`join_isolated`).
    """
    at = F.col(time)
    # window functions drop rows without a time, so these go round the join
    keyed = events.filter(at.isNotNull()).withColumn("window_start", F.window(time, width)["start"])
    values = gmv.select(*keys, "window_start", "quantity", "gmv")
    joined = join_isolated(keyed, values, [*keys, "window_start"], "left")
    timeless = events.filter(at.isNull())
    return joined.unionByName(timeless, allowMissingColumns=True).fillna({"quantity": 0, "gmv": 0})
