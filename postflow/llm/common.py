"""Helpers that the corpus operators share."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postflow.session import scratch_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, by a path that only Spark has to understand."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once below ``spark.checkpoint.dir`` and go on from the written table.

    Cuts lineage, survives lost executors, and freezes values (such as row numbers) that must not change
    between the jobs that read them.
    """
    spark = df.sparkSession
    folder = scratch_folder(spark, label)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def free_name(taken: Iterable[str], wanted: str) -> str:
    """``wanted``, with underscores added until no column has that name (Spark ignores case)."""
    lower = {c.lower() for c in taken}
    while wanted.lower() in lower:
        wanted += "_"
    return wanted


def text_mark(text: Column) -> Column:
    """Hash of a text (NULL is empty); with the row's id it tells rows apart that are not copies of each other."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def keep_marked(docs: DataFrame, kept: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` whose id and text are in ``kept`` (id, mark), all columns; of repeated rows one.

    ``docs`` is read anew instead of being copied, so nothing depends on row numbers that another job would
    count differently. Join and choice among repeated rows share one shuffle, on a key that no two texts share.
    """
    none, number, mark, rank = (free_name(docs.columns, n) for n in ("no_id", "an_id", "text_mark", "copy_no"))

    def key(an_id: Column, a_mark: Column) -> list[Column]:
        return [an_id.isNull().alias(none), F.coalesce(an_id.cast("long"), F.lit(0)).alias(number), a_mark.alias(mark)]

    marked = docs.select("*", *key(F.col(id_col), text_mark(F.col(text_col))))
    found = marked.join(kept.select(*key(F.col("id"), F.col("mark"))), [none, number, mark], "left_semi")
    first = F.row_number().over(Window.partitionBy(none, number, mark).orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])))
    return found.withColumn(rank, first).where(F.col(rank) == 1).select(*docs.columns)


def partitions_for(spark: SparkSession, n_rows: int, rows_each: int) -> int:
    """Partitions that hold about ``rows_each`` rows, but never fewer than the session's shuffle setting."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // max(rows_each, 1)), 1)
