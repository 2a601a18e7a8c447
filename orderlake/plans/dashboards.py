"""The four chart queries. Each sums up to the join key before joining."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.functions.money import exact_sum, named_parts, sum_of_parts
from orderlake.operators import scd
from orderlake.plans.business import paid_per_order


def active_customers_by_day(orders: DataFrame, customers: DataFrame, approx: bool = False) -> DataFrame:
    """Distinct buyers per day (not only first-time buyers), in day order; exact,
    or a sketch-based estimate with ``approx=True``."""
    distinct = F.approx_count_distinct if approx else F.count_distinct
    visits = orders.select(F.to_date("order_purchase_ts").alias("signup_date"), "customer_id").distinct()
    people = scd.active(customers).select("customer_id", "customer_unique_id")
    return (
        visits.join(people, "customer_id")
        .groupBy("signup_date")
        .agg(distinct("customer_unique_id").alias("new_customers"))
        .orderBy("signup_date")
    )


def monthly_revenue(orders: DataFrame, payments: DataFrame) -> DataFrame:
    months = orders.select("order_id", F.date_trunc("month", "order_purchase_ts").alias("month"))
    return (
        months.join(paid_per_order(payments, "_paid"), "order_id")
        .groupBy("month")
        .agg(F.round(exact_sum(F.col("_paid")), 2).alias("revenue"))
        .orderBy("month")
    )


def _item_revenue(items: DataFrame, key: str) -> DataFrame:
    return items.groupBy(key).agg(*named_parts(F.col("price"), "revenue"))


def top_categories(items: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    """The k categories with the most item revenue; no category is one too."""
    names = scd.active(products).select("product_id", "product_category_name")
    return (
        _item_revenue(items, "product_id")
        .join(names, "product_id")
        .groupBy("product_category_name")
        .agg(F.round(sum_of_parts("revenue"), 2).alias("revenue"))
        .orderBy(F.desc("revenue"), F.asc("product_category_name"))
        .limit(k)
    )


def top_sellers(items: DataFrame, sellers: DataFrame, k: int = 10) -> DataFrame:
    """The k known sellers with the most item revenue."""
    return (
        _item_revenue(items, "seller_id")
        .join(scd.active(sellers).select("seller_id"), "seller_id")
        .groupBy("seller_id")
        .agg(F.round(sum_of_parts("revenue"), 2).alias("revenue"))
        .orderBy(F.desc("revenue"), F.asc("seller_id"))
        .limit(k)
    )
