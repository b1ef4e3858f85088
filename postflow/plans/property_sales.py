"""Product property events with the sales made since the preceding time window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postflow.functions.variations import split_variation_pair
from postflow.operators.sales import attach_gmv, property_gmv

# Columns of the result.
COLUMNS = (
    "property_id", "product_id", "property_name_1", "property_name_2", "property_price",
    "property_price_before_discount", "property_stock", "property_sold", "property_promotion_id",
    "quantity", "gmv", "rating_star", "crawl_time",
)


def sales_columns(events: DataFrame) -> DataFrame:
    """Events that carry quantity and gmv, projected to the result's columns."""
    models = events.withColumn("_models", split_variation_pair(F.col("property_name")))
    return models.withColumns(
        {"property_name_1": F.col("_models.model1"), "property_name_2": F.col("_models.model2")}
    ).select(*COLUMNS)


def property_sales(events: DataFrame, *, width: str = "1 minute") -> DataFrame:
    return sales_columns(attach_gmv(events, property_gmv(events, width=width), width=width))
