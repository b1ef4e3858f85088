"""Batch and stream writes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from postflow.sources.specs import SinkSpec, StreamSinkSpec


def read_target(spark: SparkSession, sink: SinkSpec) -> DataFrame | None:
    """The sink's current table, or None where a file target does not exist yet."""
    reader = spark.read.format(sink.format).options(**sink.options, **sink.read_options)
    if sink.schema is not None:
        reader = reader.schema(sink.schema)
    if not sink.path:
        return reader.load()
    try:
        return reader.load(sink.path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def check_target(spark: SparkSession, sink: SinkSpec) -> None:
    """Fail before any work is done when the target cannot be reached."""
    try:
        target = read_target(spark, sink)
        if target is not None:
            target.limit(0).collect()
    except Exception as error:
        raise ConnectionError(f"cannot reach {sink.format} target {sink.label}") from error


def write(df: DataFrame, sink: SinkSpec, mode: str | None = None) -> None:
    sink.validate()
    writer = df.write.format(sink.format).options(**sink.options).mode(mode or sink.mode)
    if sink.path:
        writer.save(sink.path)
    else:
        writer.save()


def write_if_any(df: DataFrame, sink: SinkSpec) -> bool:
    """Write unless there is nothing to write; tells whether it wrote."""
    if df.isEmpty():
        return False
    write(df, sink)
    return True


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_stream(
    df: DataFrame, sink: StreamSinkSpec, each_batch: Callable[[DataFrame, int], None] | None = None
) -> StreamingQuery:
    """Start the stream with its checkpoint; ``each_batch`` takes the place of the format."""
    sink.validate()
    writer = df.writeStream.outputMode(sink.output_mode).option("checkpointLocation", sink.checkpoint)
    writer = writer.options(**sink.options)
    if sink.available_now:
        writer = writer.trigger(availableNow=True)
    elif sink.processing_time:
        writer = writer.trigger(processingTime=sink.processing_time)
    if each_batch is not None:
        return writer.foreachBatch(each_batch).start()
    writer = writer.format(sink.format)
    return writer.start(sink.path) if sink.path else writer.start()
