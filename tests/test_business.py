from pyspark.sql import functions as F

from orderlake.plans import business, dashboards
from tests.helpers import rows, ts

D1, D2 = ts("2024-01-01 08:00:00"), ts("2024-02-02 09:00:00")


def orders(spark):
    data = [
        ("1", "c", "delivered", D1, D1),
        ("2", "c", "canceled", D2, None),
        ("3", "d", "shipped", D2, None),
        ("4", "e", "approved", None, None),
    ]
    return spark.createDataFrame(data, "order_id string, customer_id string, order_status string, order_purchase_ts timestamp, order_delivered_customer_ts timestamp")


def items(spark):
    data = [
        ("1", "p", "s", 10.0, 1.0, D1),
        ("1", "p", "t", 30.0, 1.0, None),
        ("2", "p", "s", 0.0, 1.0, D1),
        ("3", "q", "s", 7.0, 1.0, D1),
        ("9", "q", "s", 5.0, 1.0, D1),
        (None, "q", "s", 2.0, 1.0, D1),
        ("1", None, None, 60.0, 1.0, D2),
    ]
    return spark.createDataFrame(data, "order_id string, product_id string, seller_id string, price double, freight_value double, shipping_limit_date timestamp")


def payments(spark):
    return spark.createDataFrame([("1", 50.0), ("1", 50.0), ("2", 9.0), ("4", 1.0)], "order_id string, payment_value double")


def test_daily_revenue(spark):
    got = business.daily_revenue(orders(spark), payments(spark))
    assert rows(got) == [(None, 1, 1.0, 1.0), (D1.date(), 1, 100.0, 100.0)]


def test_sales_by_customer_keeps_items_without_order(spark):
    got = business.sales_by_customer(items(spark), orders(spark))
    assert rows(got) == [(None, None, 7.0), (D1.date(), "c", 100.0), (D2.date(), "c", 0.0), (D2.date(), "d", 7.0)]


def test_first_purchase_flag(spark):
    flagged = business.flag_first(orders(spark), "customer_id", "order_purchase_ts", "f")
    assert rows(flagged, "order_id", "f") == [("1", True), ("2", False), ("3", True), ("4", False)]


def test_allocation(spark):
    df = spark.createDataFrame([(100.0, 10.0, 40.0), (9.0, 0.0, 0.0), (9.0, 1.0, None), (None, 1.0, 2.0)], "paid double, price double, total double")
    share = business.allocate(F.col("paid"), F.col("price"), F.col("total"))
    assert [r[0] for r in df.select(share).collect()] == [25.0, None, None, None]


def test_count_if_counts_unknown_as_no(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "v int")
    assert df.agg(business.count_if(F.col("v") > 2)).first()[0] == 1


def test_product_performance(spark):
    reviews = spark.createDataFrame([("1", 4), ("1", 5), ("2", 1)], "order_id string, review_score int")
    products = spark.createDataFrame([("p", "a", True), ("p", "old", False)], "product_id string, product_category_name string, IsActive boolean")
    translation = spark.createDataFrame([("a", "A")], "product_category_name string, product_category_name_english string")
    got = {r.product_id: r for r in business.product_performance(orders(spark), items(spark), payments(spark), reviews, products, translation).collect()}
    assert set(got) == {"p", "q", None}
    p = got["p"]
    assert (p.product_category, p.units_sold, p.orders_count, p.sellers_count) == ("A", 3, 2, 2)
    assert (p.gmv_item_price, p.total_freight_value, p.median_item_price) == (40.0, 3.0, 10.0)
    assert abs(p.avg_item_price - 40 / 3) < 1e-12
    assert p.allocated_revenue_paid_value == 40.0
    assert abs(p.avg_review_score - (4.5 + 4.5 + 1) / 3) < 1e-6
    assert (p.delivered_units, p.on_time_delivered_units) == (2, 1)
    assert (p.units_from_new_customers, p.units_from_returning_customers) == (2, 1)
    assert (p.first_seen_purchase_ts, p.last_seen_purchase_ts) == (D1, D2)
    q = got["q"]
    assert (q.units_sold, q.product_category, q.avg_review_score, q.allocated_revenue_paid_value) == (1, None, None, 0.0)
    unknown = got[None]
    assert (unknown.units_sold, unknown.orders_count, unknown.sellers_count, unknown.median_item_price) == (1, 1, 0, 60.0)


def test_orders_count_with_two_sellers_in_one_order(spark):
    data = [("1", "p", s, 1.0, 1.0, D1) for s in ("s", "t", "s", None)] + [("2", "p", None, 1.0, 1.0, D1)]
    several = spark.createDataFrame(data, items(spark).schema)
    reviews = spark.createDataFrame([], "order_id string, review_score int")
    none = spark.createDataFrame([], "product_id string, product_category_name string, IsActive boolean")
    names = spark.createDataFrame([], "product_category_name string, product_category_name_english string")
    row = business.product_performance(orders(spark), several, payments(spark), reviews, none, names).first()
    assert (row.units_sold, row.orders_count, row.sellers_count) == (5, 2, 2)


def test_lines_are_shuffled_once_by_product(spark):
    reviews = spark.createDataFrame([], "order_id string, review_score int")
    products = spark.createDataFrame([], "product_id string, product_category_name string, IsActive boolean")
    names = spark.createDataFrame([], "product_category_name string, product_category_name_english string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = business.product_performance(orders(spark), items(spark), payments(spark), reviews, products, names)
        plan = made._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    by_product = [line for line in plan.splitlines() if "Exchange hashpartitioning(product_id" in line]
    assert len(by_product) == 2  # lines, names
    assert "Exchange hashpartitioning(_product" not in plan and "seller_id" not in "".join(x.split("ENSURE")[0] for x in by_product)


def test_dashboards(spark):
    people = spark.createDataFrame([("c", "u1", True), ("d", "u2", True), ("c", "u0", False)], "customer_id string, customer_unique_id string, IsActive boolean")
    assert [tuple(r) for r in dashboards.active_customers_by_day(orders(spark), people).collect()] == [(D1.date(), 1), (D2.date(), 2)]
    months = dashboards.monthly_revenue(orders(spark), payments(spark)).collect()
    assert [(r.month and r.month.month, r.revenue) for r in months] == [(None, 1.0), (1, 100.0), (2, 9.0)]
    sellers = spark.createDataFrame([("s", True), ("t", True), ("s", False)], "seller_id string, IsActive boolean")
    assert [tuple(r) for r in dashboards.top_sellers(items(spark), sellers).collect()] == [("t", 30.0), ("s", 24.0)]
    assert dashboards.top_sellers(items(spark), sellers, k=1).count() == 1
    products = spark.createDataFrame([("p", "a", True), ("q", None, True), ("q", "b", False)], "product_id string, product_category_name string, IsActive boolean")
    assert [tuple(r) for r in dashboards.top_categories(items(spark), products).collect()] == [("a", 40.0), (None, 14.0)]


def test_top_k_does_not_sort_everything(spark):
    sellers = spark.createDataFrame([("s", True)], "seller_id string, IsActive boolean")
    plan = dashboards.top_sellers(items(spark), sellers)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
