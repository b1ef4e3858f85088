"""postflow: classify, clean and incrementally load crawled posts and product events with PySpark.

Layout

``sources``    connection specs, readers and writers (batch and stream)
``functions``  column expressions: ids, dictionary text, calendar windows, variation strings
``operators``  DataFrame -> DataFrame building blocks: matching, dedupe, incremental load, quality
``plans``      the user-level batch jobs composed from the operators
``streaming``  the same work on Structured Streaming
"""

from postflow.session import build_session

__all__ = ["build_session"]
