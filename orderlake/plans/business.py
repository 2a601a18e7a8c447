"""Business views: daily revenue, product performance, sales by customer.

Every input is brought to the grain of the join key before it is joined, so the
joins see one row per key where they can and a hot order, product or customer is
summed up inside the map tasks first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.functions.money import exact_avg, exact_sum, named_parts, sum_of_parts
from orderlake.operators import scd

# Fixed value: order states that count as revenue.
REVENUE_STATUSES = ("delivered", "shipped", "invoiced", "approved")


def count_if(condition: Column) -> Column:
    """Rows where the condition holds; unknown counts as not, empty as zero."""
    return F.sum(F.when(condition, 1).otherwise(0))


def paid_per_order(payments: DataFrame, name: str) -> DataFrame:
    return payments.groupBy("order_id").agg(exact_sum(F.col("payment_value")).alias(name))


def daily_revenue(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders, revenue and mean order value per purchase day. Orders without any
    payment drop out."""
    sold = orders.where(F.col("order_status").isin(*REVENUE_STATUSES)).select(
        "order_id", F.to_date("order_purchase_ts").alias("revenue_date")
    )
    paid = F.col("paid_amount")
    return (
        sold.join(paid_per_order(payments, "paid_amount"), "order_id")
        .groupBy("revenue_date")
        .agg(
            F.count_distinct("order_id").alias("orders_count"),
            exact_sum(paid).alias("gross_revenue"),
            exact_avg(paid).alias("avg_order_value"),
        )
    )


def sales_by_customer(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Item revenue per purchase day, customer *and* order state (the state is
    not shown, so a day and customer can appear more than once). Items whose
    order is unknown gather under NULL."""
    per_order = items.groupBy("order_id").agg(*named_parts(F.col("price"), "order_total"))
    heads = orders.select(
        "order_id", F.to_date("order_purchase_ts").alias("purchase_date"), "customer_id", "order_status"
    )
    return (
        per_order.join(heads, "order_id", "left")
        .groupBy("purchase_date", "customer_id", "order_status")
        .agg(sum_of_parts("order_total").alias("total_price"))
        .drop("order_status")
    )


def flag_first(df: DataFrame, key: str, ts: str, flag: str) -> DataFrame:
    """Mark the rows at the key's earliest time; an unknown time or key is no first."""
    first = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(ts).alias("_first"))
    return df.join(first, key, "left").withColumn(
        flag, F.coalesce(F.col(ts) == F.col("_first"), F.lit(False))
    ).drop("_first")


def allocate(paid: Column, price: Column, total: Column) -> Column:
    """The part of an order's payments that falls to one item by price; NULL when
    the order has no total to divide by."""
    return F.when(total != 0, paid * (price / total))


def product_performance(
    orders: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    products: DataFrame,
    translation: DataFrame,
) -> DataFrame:
    """Seventeen measures per product and category.

    What depends on the order alone is gathered into one row per order, which the
    item table is joined to once. All measures then come from one shuffle of the lines
    by product (see ``_per_product``) and only the result, one row per product, is
    joined to the product names.
    """
    heads = flag_first(
        orders.select(
            "order_id",
            "customer_id",
            "order_status",
            "order_purchase_ts",
            F.col("order_delivered_customer_ts").alias("_delivered"),
        ),
        "customer_id",
        "order_purchase_ts",
        "_is_first",
    )
    review_means = reviews.groupBy("order_id").agg(
        F.avg(F.col("review_score").cast("double")).alias("_score")
    )
    item_totals = items.groupBy("order_id").agg(exact_sum(F.col("price")).alias("_total"))
    order_rows = (
        heads.join(paid_per_order(payments, "_paid"), "order_id", "left")
        .join(review_means, "order_id", "left")
        .join(item_totals, "order_id", "left")
    )
    sold = items.select(
        "order_id", "product_id", "seller_id", "price", "freight_value", "shipping_limit_date"
    ).join(order_rows, "order_id")
    measures = _per_product(sold)
    english = translation.select(
        "product_category_name", F.col("product_category_name_english").alias("_english")
    )
    named = (
        scd.active(products)
        .select("product_id", "product_category_name")
        .join(english, "product_category_name", "left")
        .select(
            "product_id", F.coalesce("_english", "product_category_name").alias("product_category")
        )
    )
    return (
        measures.join(named, "product_id", "left")
        .select(
            "product_id",
            "product_category",
            "units_sold",
            "orders_count",
            "sellers_count",
            "gmv_item_price",
            "total_freight_value",
            "avg_item_price",
            "median_item_price",
            "allocated_revenue_paid_value",
            "avg_review_score",
            "delivered_units",
            "on_time_delivered_units",
            "units_from_new_customers",
            "units_from_returning_customers",
            "first_seen_purchase_ts",
            "last_seen_purchase_ts",
        )
    )


def _per_product(sold: DataFrame) -> DataFrame:
    """All measures of a product, from one shuffle of lines that hold what is summed up.

    Sums have five columns for each amount and a product's lines lie in many orders, so sums
    made before the shuffle would be wider than the lines and hardly fewer. A product's lines
    are added up one after the other, so that one with many needs no more memory. Two exact
    distinct counts in one aggregate would copy every row once per count; instead one line is
    marked for each order of a product, before the shuffle, where lines lie by order, and one
    for each seller of a product behind it.
    """
    price = F.col("price")
    share = F.coalesce(allocate(F.col("_paid"), price, F.col("_total")), F.lit(0.0))
    lines = sold.select(
        "product_id",
        "seller_id",
        "price",
        F.col("freight_value").alias("freight"),
        share.alias("share"),
        F.col("_score").alias("score"),
        "order_purchase_ts",
        (F.col("order_status") == "delivered").alias("delivered"),
        (F.col("_delivered") <= F.col("shipping_limit_date")).alias("on_time"),
        F.col("_is_first").alias("fresh"),
        _is_one_of("order_id", "product_id").alias("new_order"),
    ).repartition("product_id")
    marked = lines.withColumn("new_seller", F.col("seller_id").isNotNull() & _is_one_of("product_id", "seller_id"))
    fresh, units = count_if(F.col("fresh")), F.count(F.lit(1))
    return marked.groupBy("product_id").agg(
        units.alias("units_sold"),
        count_if(F.col("new_order")).alias("orders_count"),
        F.count(F.when(F.col("new_seller"), 1)).alias("sellers_count"),
        exact_sum(price).alias("gmv_item_price"),
        exact_sum(F.col("freight")).alias("total_freight_value"),
        exact_avg(price).alias("avg_item_price"),
        F.percentile_approx("price", 0.5).alias("median_item_price"),
        exact_sum(F.col("share")).alias("allocated_revenue_paid_value"),
        exact_avg(F.col("score")).alias("avg_review_score"),
        count_if(F.col("delivered")).alias("delivered_units"),
        count_if(F.col("on_time")).alias("on_time_delivered_units"),
        fresh.alias("units_from_new_customers"),
        (units - fresh).alias("units_from_returning_customers"),
        F.min("order_purchase_ts").alias("first_seen_purchase_ts"),
        F.max("order_purchase_ts").alias("last_seen_purchase_ts"),
    )


def _is_one_of(*keys: str) -> Column:
    """True for one row of each combination of ``keys``."""
    return F.row_number().over(Window.partitionBy(*keys).orderBy(*keys)) == 1
