"""Stream transformations and ``foreachBatch`` writers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postflow.functions.variations import split_variations, variation_names, variation_values
from postflow.operators.incremental import append_missing
from postflow.operators.matching import DEFAULT_LIMITS, DictionaryCache, MatchLimits, dictionary_version
from postflow.operators.sales import KEYS, all_set, delta, window_last
from postflow.plans.classify import classify_all
from postflow.plans.property_sales import sales_columns
from postflow.schemas import PROPERTY_OUT
from postflow.session import staging_scope
from postflow.sources.specs import SinkSpec
from postflow.sources.writers import write
from postflow.streaming.ledger import EpochLedger


def properties(events: DataFrame) -> DataFrame:
    """Product property events with the variation string split into names and values."""
    pairs = events.withColumn("property_name", split_variations(F.col("property_name")))
    named = pairs.withColumns({"name": variation_names("property_name"), "value": variation_values("property_name")})
    return named.select(*PROPERTY_OUT.names)


def classify_stream(posts: DataFrame, orgs: DataFrame, *, encoded_spam: bool = False,
                    limits: MatchLimits = DEFAULT_LIMITS) -> DataFrame:
    """Stateless classification: one row per (post, matching entry), unmatched posts are dropped.

    The dictionary is read when the stream starts. Use :func:`classify_each_batch` for a dictionary that
    changes or that is too large to be embedded in the plan.
    """
    return classify_all(posts, orgs, how="inner", encoded_spam=encoded_spam, limits=limits)


def classify_each_batch(
    read_orgs: Callable[[], DataFrame],
    sink: SinkSpec,
    *,
    keys: Sequence[str] | None = None,
    encoded_spam: bool = False,
    limits: MatchLimits = DEFAULT_LIMITS,
    ledger: EpochLedger | None = None,
    cache: DictionaryCache | None = None,
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer that classifies every micro-batch against the dictionary of the moment.

    With ``keys`` only rows absent from the sink are appended, so a replayed batch adds nothing; with a ``ledger`` a
    batch that was committed is not even classified again. What a batch stages is deleted with it. The dictionary is prepared when
    its content has changed since the batch before; otherwise a batch costs one digest of it.
    """
    cache = DictionaryCache() if cache is None else cache

    def run(batch: DataFrame, epoch_id: int) -> int | None:
        with staging_scope():
            orgs = read_orgs()
            cache.begin(dictionary_version(orgs))
            rows = classify_all(batch, orgs, how="inner", encoded_spam=encoded_spam, limits=limits, cache=cache)
            if keys:
                return append_missing(rows, sink, keys, count_target=False).n_missing
            write(rows, sink)

    return ledger.guarded(run) if ledger else run


def append_each_batch(sink: SinkSpec, *, ledger: EpochLedger | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer that appends the batch as it is; without a ``ledger`` a replayed batch is written again."""

    def run(batch: DataFrame, epoch_id: int) -> None:
        write(batch, sink)

    return ledger.guarded(run) if ledger else run


def append_missing_each_batch(
    sink: SinkSpec, keys: Sequence[str], *, ledger: EpochLedger | None = None, **options
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer that appends only absent keys, so a replayed batch adds nothing.

    The target is scanned once per batch, and not at all for a batch that the ``ledger`` holds. It is not counted; ``options`` go
    to :func:`append_missing`, such as a ``target_filter``.
    """

    def run(batch: DataFrame, epoch_id: int) -> int:
        with staging_scope():
            return append_missing(batch, sink, keys, **{"count_target": False, **options}).n_missing

    return ledger.guarded(run) if ledger else run


def windowed_last(events: DataFrame, *, time: str = "crawl_time", late: str = "10 minutes", **options) -> DataFrame:
    """:func:`window_last` with a watermark; a window is emitted once the watermark has passed its end."""
    return window_last(events.withWatermark(time, late), time=time, **options)


def windowed_delta(
    events: DataFrame,
    *,
    keys: Sequence[str] = KEYS,
    time: str = "crawl_time",
    width: str = "1 minute",
    late: str = "10 minutes",
    **options,
) -> DataFrame:
    """Sales delta to the preceding window on a stream: two stateful aggregations, one after the other.

    The first gives every window's last values once the watermark has passed its end. The second brings each emitted
    window together with the one before it, in windows of twice the width that slide by one. A row that comes after its own
    window was emitted counts nowhere, so "previous" is always the value that was emitted.
    """
    emitted = windowed_last(events, keys=keys, time=time, width=width, late=late, **options)
    paired = emitted.withColumn("_pair", F.window(F.window_time("time_window"), f"{width} {width}", width))
    own = F.col("time_window.end") == F.col("_pair.end")
    windows = paired.groupBy("_pair", *keys).agg(
        F.max(F.when(own, F.col("time_window"))).alias("time_window"),
        F.max(F.when(own, F.col("total_sales"))).alias("total_sales"),
        F.max(F.when(own, F.col("price"))).alias("price"),
        F.max(F.when(~own & all_set(keys), F.col("total_sales"))).alias("prev_total_sales"),
    )
    quantity = delta(F.col("total_sales"), F.col("prev_total_sales"))
    return (
        windows.filter(F.col("time_window").isNotNull())
        .select("time_window", *keys, "total_sales", "price", "prev_total_sales", quantity.alias("quantity"))
        .withColumn("gmv", F.col("quantity") * F.col("price"))
    )


def property_sales_stream(events: DataFrame, *, width: str = "1 minute", late: str = "10 minutes", salts: int = 4) -> DataFrame:
    """Every event with quantity and gmv of its window, emitted once that window is closed.

    Events wait in the state of a join on (window, key) until :func:`windowed_delta` emits the window; the
    watermark clears both sides. Events of one key are dealt over ``salts`` parts by their content, and the one row a window
    and key have on the other side is repeated for each, so a key with most of the events is spread over as many state partitions. Raise
    ``salts`` where windows are few and events many: the repeated rows are state too.
    """
    deltas = windowed_delta(events, width=width, late=late).select("time_window", *KEYS, "quantity", "gmv")
    deltas = deltas.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    keyed = events.withWatermark("crawl_time", late).withColumn("time_window", F.window("crawl_time", width))
    # a stream may carry one event-time column: the window keeps the watermark, the raw time gives its mark up
    keyed = keyed.withColumn("crawl_time", F.col("crawl_time").alias("crawl_time", metadata={}))
    keyed = keyed.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in events.columns]), F.lit(salts)).cast("int"))
    joined = keyed.join(deltas, ["time_window", *KEYS, "_salt"], "left").drop("_salt")
    # events without a time belong to no window; they pass at once, with 0
    timeless = events.filter(F.col("crawl_time").isNull())
    return sales_columns(joined.unionByName(timeless, allowMissingColumns=True).fillna({"quantity": 0, "gmv": 0}))
