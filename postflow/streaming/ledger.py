"""Which micro-batches of a stream have been written."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postflow.session import delete_folder, folder_exists, move_folder


@dataclass(frozen=True)
class EpochLedger:
    """Committed epochs of one stream, one small folder each, beside its checkpoint or its target.

    ``name`` stands for the stream; it must change when the stream starts from a new checkpoint, because epochs then count
    from 0 again. An entry appears in one step, after the batch has been written. If a driver dies between the two, the batch is
    replayed, so writers that check for keys stay right; a committed epoch is skipped without looking at the target.
    """

    folder: str
    name: str

    def entry(self, epoch: int) -> str:
        return f"{self.folder.rstrip('/')}/{self.name}/epoch-{epoch}"

    def committed(self, spark: SparkSession, epoch: int) -> bool:
        return folder_exists(spark, self.entry(epoch))

    def commit(self, spark: SparkSession, epoch: int, n_rows: int | None) -> None:
        unfinished = f"{self.folder.rstrip('/')}/{self.name}/_{uuid.uuid4().hex}"
        row = spark.range(1).select(F.lit(self.name).alias("stream"), F.lit(epoch).cast("long").alias("epoch"), F.lit(n_rows).cast("long").alias("n_rows"))
        row.coalesce(1).write.json(unfinished)
        if not move_folder(spark, unfinished, self.entry(epoch)):
            delete_folder(spark, unfinished)
            if not self.committed(spark, epoch):
                raise OSError(f"cannot write {self.entry(epoch)}")

    def entries(self, spark: SparkSession) -> DataFrame:
        """stream, epoch and n_rows of all committed epochs."""
        return spark.read.schema("stream string, epoch long, n_rows long").json(f"{self.folder.rstrip('/')}/{self.name}/epoch-*")

    def guarded(self, each: Callable[[DataFrame, int], int | None]) -> Callable[[DataFrame, int], None]:
        """``each`` for epochs that are not committed; what it returns is the row count of the entry."""

        def run(batch: DataFrame, epoch_id: int) -> None:
            spark = batch.sparkSession
            if not self.committed(spark, epoch_id):
                self.commit(spark, epoch_id, each(batch, epoch_id))

        return run
