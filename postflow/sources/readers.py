"""Batch and stream scans."""

from __future__ import annotations

import functools
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from postflow.sources.specs import SourceSpec


def _load(reader, spec: SourceSpec) -> DataFrame:
    spec.validate()
    reader = reader.format(spec.format).options(**spec.options)
    if spec.schema is not None:
        reader = reader.schema(spec.schema)
    df = reader.load(spec.path) if spec.path else reader.load()
    return df.select(*spec.columns) if spec.columns else df


def read_source(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """Scan with the declared schema; ``columns`` narrows it at the source, ``predicates`` cut it into parts."""
    if not spec.predicates:
        return _load(spark.read, spec)
    if spec.format == "jdbc":
        spec.validate()
        rest = {k: v for k, v in spec.options.items() if k not in ("url", "dbtable")}
        df = spark.read.jdbc(spec.options["url"], spec.options["dbtable"], predicates=list(spec.predicates), properties=rest)
        return df.select(*spec.columns) if spec.columns else df
    whole = _load(spark.read, replace(spec, columns=None))
    parts = functools.reduce(DataFrame.unionByName, [whole.where(p) for p in spec.predicates])
    return parts.select(*spec.columns) if spec.columns else parts


def read_stream(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    return _load(spark.readStream, spec)
