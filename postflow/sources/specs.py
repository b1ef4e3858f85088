"""Where data comes from and where it goes.

A spec holds a Spark data source name and its options. The builders below fill in the option names of the
usual stores; their connector packages must be on the session's classpath. Secrets are passed in by the
caller and never printed.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields

from pyspark.sql import types as T

SECRET = ("password", "pass", "uri", "url")


def masked(options: Mapping[str, str]) -> dict[str, str]:
    return {k: "***" if any(s in k.lower() for s in SECRET) else v for k, v in options.items()}


class Validated:
    def validate(self):
        """Raise ValueError naming the first setting that has no value; return self otherwise."""
        for f in fields(self):
            if f.name in self.optional:
                continue
            value = getattr(self, f.name)
            if value is None:
                raise ValueError(f"missing value for {f.name}")
            if isinstance(value, Mapping):
                for key, item in value.items():
                    if item is None:
                        raise ValueError(f"missing value for {f.name}[{key}]")
        return self

    def __repr__(self):
        return f"{type(self).__name__}({self.format}, {masked(self.options)})"


@dataclass(frozen=True, repr=False)
class SourceSpec(Validated):
    format: str
    options: Mapping[str, str] = field(default_factory=dict)
    path: str | None = None
    schema: T.StructType | None = None
    columns: tuple[str, ...] | None = None
    #: Conditions that exclude each other and cover the table; each is read by a task of its own.
    predicates: tuple[str, ...] | None = None

    optional = ("path", "schema", "columns", "predicates")


@dataclass(frozen=True, repr=False)
class SinkSpec(Validated):
    format: str
    options: Mapping[str, str] = field(default_factory=dict)
    path: str | None = None
    read_options: Mapping[str, str] = field(default_factory=dict)
    schema: T.StructType | None = None
    mode: str = "append"

    optional = ("path", "schema")

    @property
    def label(self) -> str:
        return self.path or self.options.get("dbtable") or self.options.get("collection") or self.format


@dataclass(frozen=True, repr=False)
class StreamSinkSpec(Validated):
    format: str
    checkpoint: str | None
    options: Mapping[str, str] = field(default_factory=dict)
    path: str | None = None
    output_mode: str = "append"
    available_now: bool = False
    processing_time: str | None = None

    optional = ("path", "processing_time")


def files(format: str, path: str, schema: T.StructType | None = None, **options: str) -> SourceSpec:
    return SourceSpec(format, options, path, schema)


def json_documents(path: str, schema: T.StructType) -> SourceSpec:
    """JSON files holding either an array of objects or one object each."""
    return SourceSpec("json", {"multiLine": "true"}, path, schema)


def search_index(host, port, index, user, password, schema: T.StructType) -> SourceSpec:
    options = {
        "es.nodes": host,
        "es.port": port,
        "es.resource": index,
        "es.net.http.auth.user": user,
        "es.net.http.auth.pass": password,
        "es.net.ssl": "false",
        "es.nodes.wan.only": "true",
    }
    return SourceSpec("org.elasticsearch.spark.sql", options, schema=schema).validate()


def document_store(
    uri, database, collection, schema=None, columns=None, partitioner=None, partitions=None, format="mongo"
) -> SourceSpec:
    options = {"uri": uri, "database": database, "collection": collection}
    if partitioner:
        options["partitioner"] = partitioner
    if partitions:
        options["partitionerOptions.numPartitions"] = str(partitions)
    return SourceSpec(format, options, schema=schema, columns=columns).validate()


def document_sink(uri, database, collection, format="mongo") -> SinkSpec:
    return SinkSpec(format, {"uri": uri, "database": database, "collection": collection}).validate()


def _jdbc(url, table, user, password, driver) -> dict[str, str]:
    return {"url": url, "dbtable": table, "user": user, "password": password, "driver": driver}


def jdbc_table(
    url, table, user, password, driver, *, columns=None, partition_column=None, lower=None, upper=None, partitions=None, predicates=None
) -> SourceSpec:
    """A table, read in parallel ranges of ``partition_column`` when one is given.

    Equal steps from ``lower`` to ``upper`` must be guessed and overfill a range where the column is skewed; ``predicates`` from
    :func:`postflow.sources.ranges.equal_depth_ranges` hold about equally many rows each.
    """
    if predicates and partition_column:
        raise ValueError("give either predicates or a partition column")
    options = _jdbc(url, table, user, password, driver)
    if partition_column:
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": None if lower is None else str(lower),
            "upperBound": None if upper is None else str(upper),
            "numPartitions": None if partitions is None else str(partitions),
        }
    return SourceSpec("jdbc", options, columns=columns, predicates=None if predicates is None else tuple(predicates)).validate()


def jdbc_sink(url, schema, table, user, password, driver, *, read_options=None) -> SinkSpec:
    """Target table under its qualified name; ``read_options`` may hold the partitioned-read settings."""
    return SinkSpec(
        "jdbc", _jdbc(url, f"{schema}.{table}", user, password, driver), read_options=read_options or {}
    ).validate()


def broker_topic(servers, topic, starting_offsets=None) -> SourceSpec:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if starting_offsets:
        options["startingOffsets"] = starting_offsets
    return SourceSpec("kafka", options).validate()
