"""Session construction and the shared folder for checkpoints, stream state and staged tables."""

from __future__ import annotations

import os
import threading
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def build_session(
    app_name: str = "postflow",
    master: str | None = None,
    *,
    executor_memory: str | None = None,
    executor_cores: int | None = None,
    num_executors: int | None = None,
    driver_memory: str | None = None,
    jars: Sequence[str] = (),
    packages: Sequence[str] = (),
    conf: Mapping[str, str] | None = None,
    time_zone: str = "UTC",
    log_level: str = "WARN",
) -> SparkSession:
    """Build (or reuse) a session.

    Resources left at None stay with the cluster's own defaults. The session time zone is always set:
    every calendar rule in this library (publish window, created-on filter) is evaluated in it.
    """
    settings = {
        "spark.sql.session.timeZone": time_zone,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # stream state outside the JVM heap, with small incremental commits
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        # posts can be long texts; this bounds the memory of one Arrow batch
        "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
        "spark.executor.memory": executor_memory,
        "spark.executor.cores": executor_cores,
        "spark.executor.instances": num_executors,
        "spark.driver.memory": driver_memory,
        "spark.jars": ",".join(os.path.abspath(j) for j in jars) or None,
        "spark.jars.packages": ",".join(packages) or None,
        **(conf or {}),
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        if value is not None:
            builder = builder.config(key, str(value))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(log_level)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir`` (or a checkpoint folder set before)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(folder)
        return folder.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def run_folder(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def delete_folder(spark: SparkSession, folder: str) -> None:
    files, path = _path(spark, folder)
    files.delete(path, True)


def move_folder(spark: SparkSession, folder: str, to: str) -> bool:
    """Rename within one file system, in one step; False if it could not be done, such as when ``to`` is there already."""
    files, path = _path(spark, folder)
    return files.rename(path, _path(spark, to)[1])


def folder_exists(spark: SparkSession, folder: str) -> bool:
    files, path = _path(spark, folder)
    return files.exists(path)


_scopes = threading.local()  # a stream's batches run in threads of their own


@contextmanager
def staging_scope() -> Iterator[None]:
    """Everything staged inside is deleted on leaving, so results must have been written by then.

    For work that repeats in one session, such as a stream's batches. What is staged outside any scope is deleted
    when the session's process ends.
    """
    outer, _scopes.folders = getattr(_scopes, "folders", None), []
    try:
        yield
    finally:
        inner, _scopes.folders = _scopes.folders, outer
        for spark, folder in inner:
            delete_folder(spark, folder)


@contextmanager
def outside_scopes() -> Iterator[None]:
    """What is staged inside outlives the scope this stands in; whoever makes it deletes it, or the process does."""
    outer, _scopes.folders = getattr(_scopes, "folders", None), None
    try:
        yield
    finally:
        _scopes.folders = outer


_roots: dict[str, str] = {}


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder that is deleted with the scope it is made in, or else when the driver process ends."""
    shared = shared_folder(spark)
    if shared not in _roots:
        _roots[shared] = f"{shared}/scratch-{uuid.uuid4().hex}"
        files, path = _path(spark, _roots[shared])
        files.mkdirs(path)
        files.deleteOnExit(path)
    folder = f"{_roots[shared]}/{label}-{uuid.uuid4().hex}"
    if getattr(_scopes, "folders", None) is not None:
        _scopes.folders.append((spark, folder))
    return folder


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and continue from there (see :class:`Staged`)."""
    return Staged.of(df).table


@dataclass(frozen=True)
class Staged:
    """A table written once below the shared folder, with its size as counted while it was written.

    Used wherever one result feeds several actions (count, then write) or where the inputs are about to
    change. Lost executors cost no recomputation, and later steps read only the columns they need.
    ``delete`` it once nothing reads it any more.
    """

    table: DataFrame
    folder: str
    n_rows: int
    n_bytes: int

    @classmethod
    def of(cls, df: DataFrame, sized: Sequence[str] = ()) -> Staged:
        """``n_bytes`` counts the values of the columns in ``sized``, as text."""
        spark, folder, seen = df.sparkSession, scratch_folder(df.sparkSession, "staged"), Observation()
        length = F.lit(0).cast("bigint")
        for name in sized:
            length = length + F.coalesce(F.octet_length(F.col(f"`{name}`").cast("string")).cast("bigint"), F.lit(0))
        df.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(length).alias("bytes")).write.option("compression", "zstd").parquet(folder)
        return cls(spark.read.schema(df.schema).parquet(folder), folder, seen.get["n"], seen.get["bytes"] or 0)

    def of_same_size(self, table: DataFrame) -> Staged:
        """Another view of the same rows; the size stays as measured."""
        return replace(self, table=table)

    def delete(self) -> None:
        delete_folder(self.table.sparkSession, self.folder)


def cache_static(df: DataFrame) -> DataFrame:
    """Keep a small static table that several plans read; release it with ``unpersist()``."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
