"""Bronze -> silver -> gold tables for the e-commerce data.

Bronze keeps raw text; silver types, filters and stamps rows; gold holds
the business KPIs.  Each gold KPI aggregates the line items per join key
before joining, so a hot order or product is combined map-side and the
join sees one row per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelpulse.functions.columns import parse_time
from reelpulse.operators.warehouse import dedupe_by_key

UNKNOWN_CATEGORY = "unknown"


def to_bronze(raw: DataFrame) -> DataFrame:
    """Raw landing: every column as text, nothing dropped."""
    return raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])


def silver_orders(bronze: DataFrame, stamp: bool = True) -> DataFrame:
    out = dedupe_by_key(bronze, "order_id").withColumn(
        "order_purchase_timestamp", parse_time("order_purchase_timestamp")
    )
    return out.withColumn("silver_processed_at", F.current_timestamp()) if stamp else out


def silver_items(bronze: DataFrame, stamp: bool = True) -> DataFrame:
    """Prices as doubles; negative or unparsable prices/freight dropped."""
    out = (
        bronze.withColumn("price", F.col("price").try_cast("double"))
        .withColumn("freight_value", F.col("freight_value").try_cast("double"))
        .filter((F.col("price") >= 0) & (F.col("freight_value") >= 0))
    )
    return out.withColumn("silver_processed_at", F.current_timestamp()) if stamp else out


def silver_products(bronze: DataFrame, stamp: bool = True) -> DataFrame:
    """A missing (null) category becomes ``unknown``; blank text stays."""
    out = bronze.withColumn(
        "product_category_name", F.coalesce(F.col("product_category_name"), F.lit(UNKNOWN_CATEGORY))
    )
    return out.withColumn("silver_processed_at", F.current_timestamp()) if stamp else out


def silver_reviews(bronze: DataFrame, stamp: bool = True) -> DataFrame:
    out = bronze.withColumn("review_score", F.col("review_score").try_cast("int")).filter(
        F.col("review_score").isNotNull()
    )
    return out.withColumn("silver_processed_at", F.current_timestamp()) if stamp else out


def sales_daily(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Per purchase date: item revenue, freight, items sold (inner join)."""
    per_order = items.groupBy("order_id").agg(
        F.sum("price").alias("_price"),
        F.sum("freight_value").alias("_freight"),
        F.count(F.lit(1)).alias("_items"),
    )
    o = orders.select("order_id", F.col("order_purchase_timestamp").cast("date").alias("sales_date"))
    return (
        o.join(per_order, "order_id")
        .groupBy("sales_date")
        .agg(
            F.sum("_price").alias("total_item_revenue"),
            F.sum("_freight").alias("total_freight_cost"),
            F.sum("_items").cast("long").alias("total_order_items_sold"),
        )
        .orderBy(F.asc("sales_date"))
    )


def category_performance(items: DataFrame, products: DataFrame) -> DataFrame:
    per_product = items.groupBy("product_id").agg(
        F.sum("price").alias("_price"),
        F.count("product_id").alias("_units"),
    )
    p = products.select("product_id", "product_category_name")
    return (
        per_product.join(p, "product_id")
        .groupBy("product_category_name")
        .agg(
            F.sum("_price").alias("total_category_revenue"),
            F.sum("_units").cast("long").alias("total_units_sold"),
        )
        .orderBy(F.desc("total_category_revenue"), F.asc("product_category_name"))
    )


def product_satisfaction(reviews: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Mean review score per category.  An order-level review is counted
    once per item of the order, as a plain join does (trap T8).  Items and
    reviews meet on the order, then shrink to one row per product."""
    i = items.select("order_id", "product_id")
    r = reviews.select("order_id", "review_id", "review_score")
    p = products.select("product_id", "product_category_name")
    weighted = (
        i.join(r, "order_id")
        .groupBy("product_id")
        .agg(
            F.sum(F.col("review_score").cast("long")).alias("_score"),
            F.count("review_score").alias("_scored"),
            F.count("review_id").alias("_reviews"),
        )
    )
    return (
        weighted.join(p, "product_id")
        .groupBy("product_category_name")
        .agg(
            F.try_divide(F.sum("_score").cast("double"), F.sum("_scored").cast("double")).alias("avg_customer_rating"),
            F.coalesce(F.sum("_reviews"), F.lit(0)).cast("long").alias("total_reviews_received"),
        )
        .orderBy(F.desc("avg_customer_rating"), F.asc("product_category_name"))
    )

