"""A table without whole-row duplicates that is compacted bucket by bucket.

Rows lie in buckets by the digest of their values, so equal rows share one. A manifest names the folder that holds each bucket. A run
adds rows: it reads the buckets they fall in, and writes only those that get a row they do not hold; then a new manifest
appears in one step. Readers see the old table or the new one, never a mixture, and a failed run leaves nothing they see.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postflow.operators.row_keys import KeyFilter, row_digest
from postflow.session import Staged, delete_folder, folder_exists, move_folder, staging_scope

_DIGEST, _BUCKET = "_digest", "_bucket"
#: Bytes of a row's SHA-256 that are compared: of 2 ** 40 different rows two have the same ones with a chance of 2 ** -49.
_BYTES = 16


@dataclass(frozen=True)
class Compaction:
    """What a run did."""

    version: int
    n_incoming: int
    n_added: int
    rewritten: tuple[int, ...]


class BucketedTable:
    """``folder`` holds ``data/<run>/_bucket=<b>`` and ``manifest/<version>``; one writer at a time, a second one fails."""

    def __init__(self, spark: SparkSession, folder: str, n_buckets: int = 64):
        self.spark, self.folder, self.n_buckets = spark, folder.rstrip("/"), n_buckets

    def _entry(self, version: int) -> str:
        return f"{self.folder}/manifest/{version:012d}"

    def manifest(self) -> tuple[int, dict[int, str], str | None]:
        """(version, folder of each bucket that has rows, schema); version 0 is the empty table."""
        if not folder_exists(self.spark, f"{self.folder}/manifest"):
            return 0, {}, None
        rows = self.spark.read.schema("version long, buckets string, columns string, n_buckets int").json(f"{self.folder}/manifest/0*")
        last = rows.orderBy(F.desc("version")).first()
        if last["n_buckets"] != self.n_buckets:
            raise ValueError(f"{self.folder} has {last['n_buckets']} buckets, not {self.n_buckets}")
        return last["version"], {int(k): v for k, v in json.loads(last["buckets"]).items()}, last["columns"]

    def _stored(self, buckets: dict[int, str], columns: str | None) -> DataFrame | None:
        paths = [f"{self.folder}/data/{run}/{_BUCKET}={b}" for b, run in buckets.items()]
        if not paths:
            return None
        return self.spark.read.schema(columns).parquet(*paths)

    def read(self) -> DataFrame:
        """The rows of the newest manifest."""
        _, buckets, columns = self.manifest()
        if columns is None:
            raise FileNotFoundError(self.folder)
        found = self._stored(buckets, columns)
        return self.spark.createDataFrame([], columns) if found is None else found

    def add(self, rows: DataFrame) -> Compaction:
        """Add rows, each once (see :func:`row_digest` for what counts as equal); columns and types must be those of the table."""
        version, buckets, columns = self.manifest()
        given = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        if columns is not None and columns != given:
            raise ValueError(f"rows have the columns {given}, the table has {columns}")
        whole = row_digest(rows.schema)
        digest = F.substring(F.unhex(whole), 1, _BYTES).alias(_DIGEST)
        bucket = F.pmod(F.xxhash64(whole), F.lit(self.n_buckets)).cast("int").alias(_BUCKET)
        with staging_scope():
            incoming = Staged.of(rows)
            marked = incoming.table.select("*", digest, bucket)
            touched = [r[0] for r in marked.select(_BUCKET).distinct().collect()]  # at most ``n_buckets``
            held = self._stored({b: buckets[b] for b in touched if b in buckets}, given)
            if held is not None:
                # digests alone are compared; rows move only if they are missing
                new = Staged.of(marked.select(_DIGEST).distinct().join(held.select(digest), _DIGEST, "left_anti"))
                if not new.n_rows:
                    return Compaction(version, incoming.n_rows, 0, ())
                marked = KeyFilter.of(new.table, new.n_rows).passing(marked).join(new.table, _DIGEST, "left_semi")
            missing = Staged.of(marked.dropDuplicates([_DIGEST]).drop(_DIGEST))
            changed = sorted(r[0] for r in missing.table.select(_BUCKET).distinct().collect())
            if not changed and columns is not None:
                return Compaction(version, incoming.n_rows, 0, ())
            run = uuid.uuid4().hex
            if changed:
                # rows a bucket has already are copied by one task each, without a shuffle
                out = missing.table.repartition(len(changed), _BUCKET)
                for b in (b for b in changed if b in buckets):
                    out = out.unionByName(self._stored({b: buckets[b]}, given).coalesce(1).withColumn(_BUCKET, F.lit(b)))
                out.write.partitionBy(_BUCKET).parquet(f"{self.folder}/data/{run}")
            self._commit(version + 1, {**buckets, **dict.fromkeys(changed, run)}, given)
            return Compaction(version + 1, incoming.n_rows, missing.n_rows, tuple(changed))

    def _commit(self, version: int, buckets: dict[int, str], columns: str) -> None:
        unfinished = f"{self.folder}/unfinished/{uuid.uuid4().hex}"
        row = self.spark.createDataFrame([(version, json.dumps(buckets), columns, self.n_buckets)], "version long, buckets string, columns string, n_buckets int")
        row.coalesce(1).write.json(unfinished)
        if version == 1:
            self.spark.createDataFrame([], "none int").write.mode("ignore").json(f"{self.folder}/manifest")
        if folder_exists(self.spark, self._entry(version)) or not move_folder(self.spark, unfinished, self._entry(version)):
            delete_folder(self.spark, unfinished)
            raise RuntimeError(f"another writer has committed version {version} of {self.folder}")

    def vacuum(self) -> list[str]:
        """Delete the runs that the newest manifest no longer names; readers of older ones must be done."""
        version, buckets, _ = self.manifest()
        named = set(buckets.values())
        older = self.spark.read.schema("version long, buckets string").json(f"{self.folder}/manifest/0*").where(F.col("version") < version)
        runs = {run for r in older.collect() for run in json.loads(r["buckets"]).values()} - named
        for run in runs:
            delete_folder(self.spark, f"{self.folder}/data/{run}")
        return sorted(runs)
