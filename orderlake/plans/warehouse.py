"""Builds the derived layers from stored silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderlake import session
from orderlake.plans import gold, views
from orderlake.streaming.sinks import ensure_schema, write_table


def build_gold(
    spark: SparkSession,
    silver: str = "silver",
    schema: str = "gold",
    one_per_place: bool = False,
    buckets: int | None = None,
) -> list[str]:
    """Write the five dimensions, then the four facts, and name them.

    Later tables read earlier ones from storage. ``buckets`` stores all with one bucket
    count, facts by order and dimensions by their natural key: a fact whose silver table is
    stored so too is joined to ``fact_orders`` without a shuffle. Readers see the previous
    build of a table until the new one is written.
    """
    ensure_schema(spark, schema)
    built: list[str] = []

    def write(name: str, df: DataFrame, bucket_by: str | None = None) -> DataFrame:
        with session.using(spark, session.IN_PLACE if bucket_by else {}):
            write_table(df, f"{schema}.{name}", buckets if bucket_by else None, bucket_by)
        built.append(f"{schema}.{name}")
        return spark.table(f"{schema}.{name}")

    def read(name: str) -> DataFrame:
        return spark.table(f"{silver}.{name}")

    places = write("dim_geolocation", gold.dim_geolocation(read("geolocation")))
    customers = write("dim_customer", gold.dim_customer(read("customers"), places, one_per_place), "customer_id")
    sellers = write("dim_seller", gold.dim_seller(read("sellers"), places, one_per_place), "seller_id")
    translation = read("product_category_translation")
    products = write("dim_product", gold.dim_product(read("products"), translation), "product_id")
    write("dim_date", gold.dim_date(read("orders")))
    orders = write("fact_orders", gold.fact_orders(read("orders"), customers, buckets), "order_id")
    items = gold.fact_order_items(read("order_items"), orders, products, sellers, buckets)
    write("fact_order_items", items, "order_id")
    write("fact_payments", gold.fact_payments(read("order_payments"), orders), "order_id")
    write("fact_reviews", gold.fact_reviews(read("order_reviews"), orders), "order_id")
    return built


def register_views(spark: SparkSession, silver: str = "silver", schema: str = "business") -> list[str]:
    """Create or replace the three business views over silver in the catalog, and name them."""
    ensure_schema(spark, schema)
    for name, query in views.VIEWS.items():
        spark.sql(f"CREATE OR REPLACE VIEW {schema}.{name} AS {views.text(query, silver)}")
    return [f"{schema}.{name}" for name in views.VIEWS]
