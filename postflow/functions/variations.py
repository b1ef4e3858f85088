"""Product variation strings such as ``"Red, XL"``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the white space removed around a variation value (Unicode spaces and the separator controls).
_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z"

_PAIRS = "array<struct<name:string,value:string>>"
_MODELS = "struct<model1:string,model2:string>"


def _is_empty(text: Column) -> Column:
    return text.isNull() | (text == "")


def split_variations(text: Column) -> Column:
    """``"a, b"`` -> ``[{name1, a}, {name2, b}]``; NULL and ``""`` give an empty array."""
    pairs = F.transform(
        F.split(text, ","),
        lambda part, i: F.struct(
            F.concat(F.lit("name"), (i + 1).cast("string")).alias("name"),
            F.regexp_replace(part, _EDGE_SPACE, "").alias("value"),
        ),
    )
    return F.when(_is_empty(text), F.array().cast(_PAIRS)).otherwise(pairs)


def split_variation_pair(text: Column) -> Column:
    """Exactly two parts become (model1, model2), untrimmed; any other text is kept whole in model1."""
    parts = F.split(text, ",")
    two = (F.size(parts) == 2) & ~_is_empty(text)
    model1 = F.when(two, parts[0]).when(~_is_empty(text), text)
    model2 = F.when(two, F.get(parts, F.lit(1)))
    return F.struct(model1.alias("model1"), model2.alias("model2")).cast(_MODELS)


def variation_names(pairs: str) -> Column:
    """Comma list of the generated names of an array column made by :func:`split_variations`."""
    return F.concat_ws(",", F.col(f"{pairs}.name"))


def variation_values(pairs: str) -> Column:
    return F.concat_ws(", ", F.col(f"{pairs}.value"))
