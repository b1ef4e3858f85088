"""Write only what the target does not hold yet.

Single writer per target is assumed: the check and the append are two steps. A key that appears twice in
the incoming rows is written twice; ``unique_keys`` refuses such rows instead.
"""

from __future__ import annotations

import functools
import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postflow.operators.row_keys import KeyFilter, common_schema, row_digest
from postflow.session import Staged
from postflow.sources.specs import SinkSpec
from postflow.sources.writers import read_target, write

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class LoadReport:
    n_target: int | None
    n_incoming: int
    n_missing: int

    @property
    def counts_equal(self) -> bool | None:
        """None where the target was not counted."""
        return None if self.n_target is None else self.n_target == self.n_incoming


def insert_missing(incoming: DataFrame, target: DataFrame, keys: Sequence[str], null_keys: str = "skip") -> DataFrame:
    """Incoming rows whose key is absent from the target, all columns and all copies kept.

    ``null_keys="skip"`` leaves out rows with a NULL in their key; ``"insert"`` compares NULLs as values.
    """
    keys = list(keys)
    held = target.select(*keys)
    if null_keys == "skip":
        return incoming.dropna(subset=keys).join(held, keys, "left_anti").select(*incoming.columns)
    if null_keys != "insert":
        raise ValueError(f"null_keys must be skip or insert, not {null_keys!r}")
    held = held.toDF(*[f"_held_{k}" for k in keys])
    same = functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_held_{k}")) for k in keys])
    return incoming.join(held, same, "left_anti")


def insert_missing_rows(incoming: DataFrame, target: DataFrame, surrogate: str | None = None) -> DataFrame:
    """Distinct incoming rows that the target does not hold as a whole row (NULLs compare equal).

    Columns are matched by name. ``surrogate`` names a key column only the target has. The rows are those of ``EXCEPT`` (see
    :func:`row_digest`, by which they are compared in the types common to both sides), so of the target only digests
    are shuffled.
    """
    names = [c for c in target.columns if c != surrogate]
    rows, held = incoming.select(*names), target.select(*names)
    common = common_schema(rows, held)
    digest = row_digest(common).alias("_digest")
    return rows.select("*", digest).join(held.select(digest), "_digest", "left_anti").dropDuplicates(["_digest"]).select(*names)


def reconcile(incoming: DataFrame, target: DataFrame, missing: DataFrame) -> DataFrame:
    """One row: n_target, n_incoming, n_missing, counts_equal."""

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("side"), "n")

    counts = counted(target, "target").union(counted(incoming, "incoming")).union(counted(missing, "missing"))
    return counts.agg(
        *[F.max(F.when(F.col("side") == s, F.col("n"))).alias(f"n_{s}") for s in ("target", "incoming", "missing")]
    ).withColumn("counts_equal", F.col("n_target") == F.col("n_incoming"))


def append_missing(
    incoming: DataFrame,
    sink: SinkSpec,
    keys: Sequence[str] | None = None,
    *,
    surrogate: str | None = None,
    null_keys: str = "skip",
    preview: int = 0,
    count_target: bool = True,
    target_filter: Column | None = None,
    unique_keys: bool = False,
    key_rows: int = 2_000_000,
    key_bytes: int = 128 * 1024 * 1024,
) -> LoadReport:
    """Append the rows the sink's table does not hold; without ``keys`` whole rows are compared.

    The incoming rows are staged once, so preview, check and write see the same rows, and are counted by that
    write. If their keys are small (up to ``key_rows`` and ``key_bytes``, as measured), the target scan is first reduced
    to the keys they share with a broadcast semi join: one pass over the target, no shuffle of its keys. Beyond that size a
    Bloom filter of the incoming keys is sent out instead, so that of the target little more than the keys both sides share
    is shuffled. These shared keys are staged, because the append changes the table they come from, and are sent out if they are
    small, so that incoming rows neither move nor are written a second time; of whole rows the difference is staged. All staged
    tables are deleted in the end.

    ``target_filter`` limits the scan of the target to rows that can hold the incoming keys (a day, a partition).
    ``count_target=False`` saves counting the target, whose cost grows with it. ``unique_keys`` raises if a key comes twice.
    Columns are written in the order of the target.
    """
    spark = incoming.sparkSession
    staged = [Staged.of(incoming, sized=keys or ())]
    try:
        incoming, n_incoming = staged[0].table, staged[0].n_rows
        if unique_keys and keys and not incoming.groupBy(*keys).count().filter("count > 1").isEmpty():
            raise ValueError(f"incoming rows repeat a key of {list(keys)}")
        target = read_target(spark, sink)
        if target is None:
            missing, n_target, n_missing = incoming, 0, n_incoming
        else:
            n_target = target.count() if count_target else None
            held = target if target_filter is None else target.filter(target_filter)
            if keys:
                held = held.select(*keys)
                if null_keys == "skip" and n_incoming <= key_rows and staged[0].n_bytes <= key_bytes:
                    held = held.join(F.broadcast(incoming.select(*keys)), list(keys), "left_semi")
                else:
                    mine = incoming.select(*keys)
                    keyed = KeyFilter.of(mine, n_incoming, common_schema(mine, held))
                    staged.append(keyed.blocks)
                    held = keyed.passing(held)
                # the keys both sides share are all that is kept of the target: the difference does not change with the append
                shared = Staged.of(held, sized=keys)
                staged.append(shared)
                few = shared.n_rows <= key_rows and shared.n_bytes <= key_bytes
                missing = insert_missing(incoming, F.broadcast(shared.table) if few else shared.table, keys, null_keys)
                n_missing = missing.count()
            else:
                staged.append(Staged.of(insert_missing_rows(incoming, held, surrogate)))
                missing, n_missing = staged[-1].table, staged[-1].n_rows
            order = [c for c in target.columns if c in missing.columns]
            missing = missing.select(*order, *[c for c in missing.columns if c not in order])
        if preview:
            missing.show(preview, truncate=False)
        report = LoadReport(n_target, n_incoming, n_missing)
        log.info("%s: %s, counts equal: %s", sink.label, report, report.counts_equal)
        if report.n_missing:
            write(missing, sink)
        return report
    finally:
        for one in staged:
            one.delete()
