"""The library's inputs, derived from the test tables; Spark and SQL versions side by side."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postflow.schemas import POST_RAW, POST_STREAM, PROPERTY_EVENT
from postflow.sources.readers import read_stream
from postflow.sources.specs import SourceSpec

AS_OF = dt.date(2024, 1, 15)
EPOCH = 1705190400  # 2024-01-14 00:00 UTC
DICT_LETTERS = r"\p{L}{7,}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # the expected results are written for UTC
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a stream.

    A file stream takes folders or patterns, not a single file; the one-letter pattern fits the table
    whether it is one file or a folder of files.
    """
    schema = table(spark, sf_dir, name).schema
    return read_stream(spark, SourceSpec("parquet", path=f"{sf_dir}/{name}.parque[t]", schema=schema))


# --- organisations ---------------------------------------------------------------------------------

def orgs(spark: SparkSession) -> DataFrame:
    """Small dictionary: two spellings of one term, non-ASCII terms, a spam entry that is not JSON."""
    return spark.sql(r"""
        SELECT code, keywords, CAST(org_id AS INT) AS org_id, spamwords FROM VALUES
          ('A001', array('Ering', 'thble'),   1, array('{"match_phrase":{"content":"anedble"}}')),
          ('B002', array('ERING', 'license'), 2, array('{"match_phrase":{"content":"Queque"}}')),
          ('C003', array('éelle', 'Étion'),   3, array('not json')),
          ('D004', array('intion'),           4, CAST(array() AS array<string>))
        AS t(code, keywords, org_id, spamwords)""")


def plain_orgs(spark: SparkSession) -> DataFrame:
    """The same dictionary with spam entries as plain phrases."""
    return orgs(spark).withColumn(
        "spamwords",
        F.transform(
            F.filter("spamwords", lambda e: e != "not json"),
            lambda e: F.get_json_object(e, "$.match_phrase.content"),
        ),
    )


DICT_SQL = """
    codes(org_id, code) AS (VALUES (1, 'A001'), (2, 'B002'), (3, 'C003'), (4, 'D004')),
    keywords(org_id, keyword) AS (VALUES (1, 'Ering'), (1, 'thble'), (2, 'ERING'), (2, 'license'),
                                         (3, 'éelle'), (3, 'Étion'), (4, 'intion')),
    spam(term) AS (VALUES ('anedble'), ('Queque'))"""


def derived_orgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary that grows with the data: one organisation per benchmark passage, its long words as keywords,
    and the same words as JSON spam entries next to one entry that is not JSON."""
    words = F.array_distinct(F.regexp_extract_all("text", F.lit(DICT_LETTERS), F.lit(0)))
    entries = F.transform(words, lambda w: F.to_json(F.struct(F.struct(w.alias("content")).alias("match_phrase"))))
    return table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("B"), "item_id").alias("code"),
        words.alias("keywords"),
        F.col("item_id").cast("int").alias("org_id"),
        F.concat(entries, F.array(F.lit("not json"))).alias("spamwords"),
    )


#: Keywords longer than this stand for a spam list.
RARE_LENGTH = 14


def rare_spam(dictionary: DataFrame) -> DataFrame:
    """The derived dictionary with its longest words alone as spam entries, encoded as JSON."""
    words = F.filter("keywords", lambda w: F.char_length(w) > RARE_LENGTH)
    return dictionary.withColumn("spamwords", F.transform(words, lambda w: F.to_json(F.struct(F.struct(w.alias("content")).alias("match_phrase")))))


DERIVED_SQL = rf"""
    words AS (SELECT DISTINCT CAST(item_id AS INTEGER) AS org_id, unnest(regexp_extract_all(text, '{DICT_LETTERS}')) AS keyword
              FROM benchmark)"""


# --- posts -----------------------------------------------------------------------------------------

# Contract columns, with an expression valid in both dialects
POST_COLUMNS = {
    "doc_type": "length(lang)",
    "source_type": "length(source)",
    "crawl_source": "n_chars",
    "crawl_source_code": "upper(lang)",
    "pub_time": f"{EPOCH} + n_chars",
    "crawl_time": f"{EPOCH} + n_chars + doc_id",
    "sentiment": "length(source)",
    "title": "source",
    "content": "text",
    "url": "concat('doc://', lang, '/', md5(text))",
    "web_tags": "lang",
    "reactions": "n_chars",
    "comments": "doc_id",
    "views": "n_chars",
    "auth_id": "source",
    "auth_name": "source",
    "auth_type": "length(lang)",
    "source_id": "source",
    "source_name": "source",
    "level": "length(source)",
    "id": "doc_id",
    "mg_sync": "false",
}

ORG_OF_LANG = "CASE lang WHEN 'en' THEN 1 WHEN 'fr' THEN 2 WHEN 'de' THEN 3 WHEN 'es' THEN 4 END"

_SQL_TYPE = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN", "int": "INTEGER"}


def _post_items(schema, dialect: str) -> list[str]:
    items = []
    for f in schema:
        kind = f.dataType.simpleString()
        kind = kind if dialect == "spark" else _SQL_TYPE[kind]
        items.append(f"CAST({POST_COLUMNS.get(f.name, 'NULL')} AS {kind}) AS {f.name}")
    return items


def as_posts(documents: DataFrame) -> DataFrame:
    return documents.selectExpr(*_post_items(POST_RAW, "spark"))


def as_classified_posts(documents: DataFrame) -> DataFrame:
    """Posts that already carry an organisation; level is text, as such posts arrive."""
    items = [i for i in _post_items(POST_RAW, "spark") if not i.endswith("AS level")]
    return documents.selectExpr(*items, "CAST(length(source) AS string) AS level", f"CAST({ORG_OF_LANG} AS bigint) AS org_id")


POSTS_SQL = f"posts AS (SELECT {', '.join(_post_items(POST_RAW, 'sql'))}, CAST({ORG_OF_LANG} AS INTEGER) AS org_of_lang FROM documents)"


def as_messages(df: DataFrame) -> DataFrame:
    """One JSON object per row, as bytes, the way a broker delivers it."""
    return df.select(F.to_json(F.struct(*df.columns)).cast("binary").alias("value"))


def post_messages(documents: DataFrame) -> DataFrame:
    posts = as_posts(documents)
    names = [c for c in POST_STREAM.names if c in posts.columns]
    return as_messages(posts.select(*names, F.col("id").alias("post_id")))


# --- product property events -------------------------------------------------------------------------

# Contract columns.
PROPERTY_COLUMNS = {
    "product_id": "user_id",
    "property_name": "concat(event_type, ', ', props)",
    "property_stock": "length(props)",
    "property_sold": "event_id",
    "property_promotion_id": "event_id",
    "property_price_before_discount": "length(event_type)",
    "property_id": "ascii(event_type)",
    "shop_id": "user_id",
    "rating_star": "value",
}


def as_properties(events: DataFrame) -> DataFrame:
    price = F.get_json_object("props", "$.k").cast("int")
    return events.select(
        *[F.expr(e).cast(PROPERTY_EVENT[c].dataType).alias(c) for c, e in PROPERTY_COLUMNS.items()],
        price.alias("property_price"),
        F.col("ts").cast("timestamp").alias("crawl_time"),
    ).select(*PROPERTY_EVENT.names)


PROPERTIES_SQL = """
    properties AS (SELECT user_id AS product_id, ascii(event_type) AS property_id,
        concat(event_type, ', ', props) AS property_name, CAST(length(props) AS INTEGER) AS property_stock,
        CAST(event_id AS INTEGER) AS property_sold, event_id AS property_promotion_id,
        CAST(json_extract(props, '$.k') AS INTEGER) AS property_price,
        CAST(length(event_type) AS INTEGER) AS property_price_before_discount,
        value AS rating_star, ts AS crawl_time FROM events)"""


def planted_events(properties: DataFrame) -> DataFrame:
    """Some events lose their time, some their property: malformed messages arrive so."""
    sold = F.col("property_sold")
    return properties.withColumns({"crawl_time": F.when(sold % 11 != 0, F.col("crawl_time")), "property_id": F.when(sold % 13 != 0, F.col("property_id"))})


PLANTED_SQL = """
    planted AS (SELECT * REPLACE (CASE WHEN property_sold % 11 <> 0 THEN crawl_time END AS crawl_time,
                                  CASE WHEN property_sold % 13 <> 0 THEN property_id END AS property_id) FROM properties)"""


def naive_stamps(df: DataFrame) -> DataFrame:
    """Zoned timestamps as plain ones, which is how the SQL side reads them."""
    return df.withColumns(
        {f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema if f.dataType.simpleString() == "timestamp"}
    )
