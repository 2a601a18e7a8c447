"""Star schema: five dimensions and four facts, each a function of its inputs.

Surrogate keys are hashes of the natural key, so a dimension can be rebuilt
without touching the facts. Facts keep every input row: lookups are left joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.functions.keys import date_key, surrogate_key
from orderlake.operators import scd
from orderlake.operators.joins import GEO_KEY, attach_geolocation, resolve_keys, resolve_keys_in_place

PLACE = [
    "geolocation_zip_code_prefix",
    "geolocation_city",
    "geolocation_state",
    "geolocation_lat",
    "geolocation_lng",
]
# Order timestamps and the date keys derived from them.
ORDER_DATES = {
    "order_purchase_ts": "purchase_date_key",
    "order_approved_ts": "approved_date_key",
    "order_delivered_carrier_ts": "delivered_carrier_date_key",
    "order_delivered_customer_ts": "delivered_customer_date_key",
    "order_estimated_delivery_ts": "estimated_delivery_date_key",
}


def dim_geolocation(geolocation: DataFrame) -> DataFrame:
    places = geolocation.where(F.col(PLACE[0]).isNotNull()).select(PLACE).distinct()
    return places.select(surrogate_key(*PLACE).alias(GEO_KEY), *PLACE)


def dim_customer(customers: DataFrame, geolocation: DataFrame, one_per_place: bool = False) -> DataFrame:
    current = scd.active(customers).select(
        surrogate_key("customer_id").alias("customer_key"),
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    )
    return attach_geolocation(
        current, geolocation, "customer_zip_code_prefix", "customer_city", "customer_state", one_per_place
    )


def dim_seller(sellers: DataFrame, geolocation: DataFrame, one_per_place: bool = False) -> DataFrame:
    current = scd.active(sellers).select(
        surrogate_key("seller_id").alias("seller_key"),
        "seller_id",
        "seller_zip_code_prefix",
        "seller_city",
        "seller_state",
    )
    return attach_geolocation(
        current, geolocation, "seller_zip_code_prefix", "seller_city", "seller_state", one_per_place
    )


def dim_product(products: DataFrame, translation: DataFrame) -> DataFrame:
    english = "product_category_name_english"
    names = translation.select("product_category_name", F.col(english).alias("_english"))
    return (
        scd.active(products)
        .join(names, "product_category_name", "left")
        .select(
            surrogate_key("product_id").alias("product_key"),
            "product_id",
            "product_category_name",
            F.coalesce("_english", "product_category_name").alias(english),
            "product_name_length",
            "product_description_length",
            "product_photos_qty",
            "product_weight_g",
            "product_length_cm",
            "product_height_cm",
            "product_width_cm",
        )
    )


def dim_date(orders: DataFrame) -> DataFrame:
    """One row per calendar day from the first to the last purchase."""
    span = orders.agg(
        F.to_date(F.min("order_purchase_ts")).alias("first_day"),
        F.to_date(F.max("order_purchase_ts")).alias("last_day"),
    )
    days = span.select(
        F.explode(F.sequence("first_day", "last_day", F.expr("interval 1 day"))).alias("date_value")
    )
    d = F.col("date_value")
    return days.select(
        date_key(d).alias("date_key"),
        "date_value",
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
    )


def _keyed(fact: DataFrame, dimensions: dict[str, DataFrame], buckets: int | None) -> DataFrame:
    """Add the surrogate key of each dimension, named ``customer`` and so on. With ``buckets`` the
    rows stay by order in so many of them, see ``resolve_keys_in_place``."""
    lookups = [(df.select(f"{name}_id", f"{name}_key"), f"{name}_id") for name, df in dimensions.items()]
    if not buckets:
        return resolve_keys(fact, lookups)
    usual = [(lookup, key, surrogate_key(key)) for lookup, key in lookups]
    return resolve_keys_in_place(fact, usual, "order_id", buckets)


def fact_orders(orders: DataFrame, customers: DataFrame, buckets: int | None = None) -> DataFrame:
    """``customers`` is ``dim_customer``; if it lists a customer per coordinate,
    the customer's orders repeat likewise."""
    keyed = _keyed(orders, {"customer": customers}, buckets)
    return keyed.select(
        "order_id",
        "customer_key",
        *[date_key(ts).alias(name) for ts, name in ORDER_DATES.items()],
        "order_status",
        *ORDER_DATES,
    )


def _order_keys(orders_fact: DataFrame) -> DataFrame:
    """The part of the order fact that its child facts look up."""
    return orders_fact.select(
        "order_id", "customer_key", date_key("order_purchase_ts").alias("purchase_date_key")
    )


def fact_order_items(
    items: DataFrame, orders_fact: DataFrame, products: DataFrame, sellers: DataFrame, buckets: int | None = None
) -> DataFrame:
    by_order = [(_order_keys(orders_fact), "order_id")]
    dimensions = {"product": products, "seller": sellers}
    if buckets:
        keyed = resolve_keys(_keyed(items, dimensions, buckets), by_order)
    else:
        keyed = _keyed(resolve_keys(items, by_order), dimensions, buckets)
    return keyed.select(
        "order_id",
        "order_item_id",
        "customer_key",
        "purchase_date_key",
        "product_key",
        "seller_key",
        date_key("shipping_limit_date").alias("shipping_limit_date_key"),
        "shipping_limit_date",
        "price",
        "freight_value",
    )


def fact_payments(payments: DataFrame, orders_fact: DataFrame) -> DataFrame:
    return resolve_keys(payments, [(_order_keys(orders_fact), "order_id")]).select(
        "order_id",
        "payment_sequential",
        "customer_key",
        "purchase_date_key",
        "payment_type",
        "payment_installments",
        "payment_value",
    )


def fact_reviews(reviews: DataFrame, orders_fact: DataFrame) -> DataFrame:
    return resolve_keys(reviews, [(_order_keys(orders_fact), "order_id")]).select(
        "review_id",
        "order_id",
        "customer_key",
        "purchase_date_key",
        date_key("review_creation_ts").alias("review_creation_date_key"),
        date_key("review_answer_ts").alias("review_answer_date_key"),
        "review_score",
        "review_comment_title",
        "review_comment_message",
        "review_creation_ts",
        "review_answer_ts",
    )
