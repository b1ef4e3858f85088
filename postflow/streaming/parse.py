"""Messages to typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def parse_json(messages: DataFrame, schema: T.StructType, value: str = "value", keep_bad: bool = False) -> DataFrame:
    """Message bytes or text to the schema's columns.

    A message that is not valid JSON becomes a row of NULLs. With ``keep_bad`` its text is kept in
    ``_corrupt_record``, so that bad messages can be sent elsewhere.
    """
    if keep_bad:
        schema = T.StructType([*schema, T.StructField(CORRUPT, T.StringType(), True)])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json(F.col(value).cast("string"), schema, options)
    return messages.select(parsed.alias("data")).select("data.*")


def bad_messages(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def good_messages(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
