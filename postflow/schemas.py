"""Table schemas. Column names and types are fixed values of the data contract; columns are read by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spark's own DDL reader needs a running session; schemas are also needed before there is one.
_TYPES = {
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "STRING": T.StringType(),
    "BOOLEAN": T.BooleanType(),
    "DOUBLE": T.DoubleType(),
    "TIMESTAMP": T.TimestampType(),
    "ARRAY<STRING>": T.ArrayType(T.StringType()),
}


def table(ddl: str) -> T.StructType:
    """``"a BIGINT, b STRING"`` -> StructType; every column is nullable."""
    fields = (item.split() for item in ddl.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in fields])


# Crawled posts before classification.
POST_RAW = table(
    "doc_type BIGINT, source_type BIGINT, crawl_source BIGINT, crawl_source_code STRING, pub_time BIGINT, "
    "crawl_time BIGINT, sentiment BIGINT, title STRING, description STRING, content STRING, url STRING, "
    "media_urls STRING, subject_id STRING, web_tags STRING, web_keywords STRING, reactions BIGINT, comments "
    "BIGINT, shares BIGINT, favors BIGINT, views BIGINT, auth_id STRING, auth_url STRING, auth_name STRING, "
    "auth_type BIGINT, source_id STRING, source_url STRING, source_name STRING, reply_to STRING, level BIGINT, id "
    "STRING, mg_sync BOOLEAN"
)

# Crawled posts that already carry an organisation; level arrives as text here.
POST_RAW_CLASSIFIED = T.StructType(
    [T.StructField(f.name, T.StringType() if f.name == "level" else f.dataType, True) for f in POST_RAW]
    + list(table("org_id BIGINT, mg_sync_at TIMESTAMP"))
)

# One row per organisation.
ORG_DICT = table("code STRING, keywords ARRAY<STRING>, org_id INT, spamwords ARRAY<STRING>")
ORG_CODES = table("code STRING, org_id INT")

# Stored posts, one row per (url, organisation).
POST_STORED = table(
    "post_id STRING, doc_type INT, source_type INT, crawl_source INT, crawl_source_code STRING, pub_time BIGINT, "
    "crawl_time BIGINT, subject_id STRING, title STRING, description STRING, content STRING, url STRING, "
    "media_urls STRING, comments INT, shares INT, reactions INT, favors INT, views INT, web_tags STRING, "
    "web_keywords STRING, auth_id STRING, auth_name STRING, auth_type INT, auth_url STRING, source_id STRING, "
    "source_name STRING, source_url STRING, reply_to STRING, level INT, org_id INT, sentiment INT, pg_sync "
    "BOOLEAN, createdAt TIMESTAMP, updatedAt TIMESTAMP"
)

# Rows of the relational publish table.
POST_PUBLISH = table(
    "id STRING, org_id INT, doc_type INT, source_type INT, crawl_source INT, crawl_source_code STRING, pub_time "
    "BIGINT, crawl_time BIGINT, subject_id STRING, title STRING, description STRING, content STRING, url STRING, "
    "media_urls STRING, comments INT, shares INT, reactions INT, favors INT, views INT, web_tags STRING, "
    "web_keywords STRING, auth_id STRING, auth_name STRING, auth_type INT, source_id STRING, source_name STRING, "
    "reply_to STRING, level INT, sentiment INT, is_sent INT, spam INT, completed INT, source_url STRING, auth_url "
    "STRING, bot_id STRING"
)

# Posts arriving as JSON messages.
POST_STREAM = table(
    "auth_id STRING, auth_name STRING, auth_type INT, auth_url STRING, comments INT, content STRING, crawl_source "
    "INT, crawl_source_code STRING, crawl_time BIGINT, description STRING, doc_type INT, favors INT, level "
    "STRING, media_urls STRING, pg_sync BOOLEAN, post_id STRING, pub_time BIGINT, reactions INT, reply_to STRING, "
    "sentiment INT, shares INT, source_id STRING, source_name STRING, source_type INT, source_url STRING, "
    "subject_id STRING, title STRING, url STRING, views INT, web_keywords STRING, web_tags STRING"
)

# Product property messages and the rows made from them.
PROPERTY_EVENT = table(
    "product_id BIGINT, property_name STRING, property_stock INT, property_sold INT, property_promotion_id "
    "BIGINT, property_price INT, property_price_before_discount INT, property_id BIGINT, shop_id BIGINT, "
    "crawl_time TIMESTAMP, rating_star DOUBLE"
)
PROPERTY_OUT = table(
    "property_id BIGINT, product_id BIGINT, name STRING, value STRING, property_price INT, "
    "property_price_before_discount INT, property_stock INT, property_sold INT, property_promotion_id BIGINT, "
    "rating_star DOUBLE, crawl_time TIMESTAMP"
)


def lenient_cast(df: DataFrame, field: T.StructField) -> Column:
    """Column cast to the field's type; text or numbers that do not fit become NULL, no error is raised."""
    column = F.col(field.name)
    if df.schema[field.name].dataType != field.dataType:
        column = column.try_cast(field.dataType)
    return column.alias(field.name)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to exactly the schema's columns, in its order and with its types."""
    return df.select([lenient_cast(df, f) for f in schema])
