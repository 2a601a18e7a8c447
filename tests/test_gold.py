import pytest
from pyspark.sql import functions as F

from orderlake import session
from orderlake.functions import surrogate_key
from orderlake.operators import joins
from orderlake.plans import gold
from tests.helpers import rows, ts

T1 = ts("2024-02-27 10:00:00")
GEO = "geolocation_zip_code_prefix string, geolocation_city string, geolocation_state string, geolocation_lat double, geolocation_lng double"
PEOPLE = "customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_city string, customer_state string, IsActive boolean"
ORDERS = (
    "order_id string, customer_id string, order_status string, order_purchase_ts timestamp, "
    "order_approved_ts timestamp, order_delivered_carrier_ts timestamp, "
    "order_delivered_customer_ts timestamp, order_estimated_delivery_ts timestamp"
)


def places(spark):
    data = [("1", "rio", "RJ", 1.0, 1.0), ("1", "rio", "RJ", 1.0, 1.0), ("1", "rio", "RJ", 2.0, 1.0), ("2", "ita", "SP", 3.0, 1.0), (None, "x", "SP", 3.0, 1.0)]
    return gold.dim_geolocation(spark.createDataFrame(data, GEO))


def customers(spark):
    data = [("c1", "u", "1", "RIO", "RJ", True), ("c1", "u", "9", "old", "RJ", False), ("c2", "u", "2", "Ita", "XX", True), ("c3", "u", None, None, None, True)]
    return spark.createDataFrame(data, PEOPLE)


def orders(spark):
    data = [("o1", "c1", "shipped", T1, T1, None, None, None), ("o2", "nobody", "shipped", ts("2024-03-02 00:00:00"), None, None, None, None)]
    return spark.createDataFrame(data, ORDERS)


def test_places_are_distinct_and_have_a_zip(spark):
    got = places(spark)
    assert got.count() == 3 == got.select("geolocation_key").distinct().count()


def test_customers_multiply_by_coordinates_unless_told_otherwise(spark):
    geo = places(spark)
    many = gold.dim_customer(customers(spark), geo)
    assert rows(many.groupBy("customer_id").agg(F.count("geolocation_key"))) == [("c1", 2), ("c2", 0), ("c3", 0)]
    assert many.count() == 4
    one = gold.dim_customer(customers(spark), geo, one_per_place=True)
    smallest = min(r.geolocation_key for r in many.where("customer_id = 'c1'").collect())
    assert rows(one, "customer_id", "geolocation_key") == [("c1", smallest), ("c2", None), ("c3", None)]


def test_product_falls_back_to_its_own_category(spark):
    measures = ", ".join(f"{c} int" for c in ("product_name_length", "product_description_length", "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"))
    data = [("p1", "a", True), ("p2", "b", True), ("p3", None, True), ("p1", "z", False)]
    products = spark.createDataFrame([(*d, *[1] * 7) for d in data], f"product_id string, product_category_name string, IsActive boolean, {measures}")
    translation = spark.createDataFrame([("a", "A")], "product_category_name string, product_category_name_english string")
    got = gold.dim_product(products, translation)
    assert rows(got, "product_id", "product_category_name_english") == [("p1", "A"), ("p2", "b"), ("p3", None)]


def test_calendar(spark):
    days = gold.dim_date(orders(spark)).orderBy("date_key").collect()
    assert [d.date_key for d in days] == [20240227, 20240228, 20240229, 20240301, 20240302]
    last = days[-1]
    assert (last.month_name, last.day_name, last.day_of_week, last.week_of_year, last.is_weekend) == ("March", "Saturday", 7, 9, True)
    assert (days[0].quarter, days[0].day_of_month, days[0].is_weekend) == (1, 27, False)


def test_calendar_of_no_orders_is_empty(spark):
    assert gold.dim_date(orders(spark).limit(0)).count() == 0


def test_facts_keep_unknown_references(spark):
    dim = gold.dim_customer(customers(spark), places(spark))
    fact = gold.fact_orders(orders(spark), dim)
    key = spark.range(1).select(surrogate_key(F.lit("c1"))).first()[0]
    assert rows(fact, "order_id", "customer_key", "purchase_date_key", "delivered_carrier_date_key") == [
        ("o1", key, 20240227, None),
        ("o1", key, 20240227, None),
        ("o2", None, 20240302, None),
    ]
    one = gold.fact_orders(orders(spark), gold.dim_customer(customers(spark), places(spark), one_per_place=True))
    assert one.count() == 2
    items = spark.createDataFrame(
        [("o1", 1, "p", "s", T1, 5.0, 1.0), ("o9", 1, "p", "s", None, 5.0, 1.0)],
        "order_id string, order_item_id int, product_id string, seller_id string, shipping_limit_date timestamp, price double, freight_value double",
    )
    products = spark.createDataFrame([("p", 7)], "product_id string, product_key long")
    sellers = spark.createDataFrame([("s", 8), ("s", 8)], "seller_id string, seller_key long")
    got = gold.fact_order_items(items, one, products, sellers)
    assert rows(got, "order_id", "purchase_date_key", "product_key", "seller_key", "shipping_limit_date_key") == [
        ("o1", 20240227, 7, 8, 20240227),
        ("o1", 20240227, 7, 8, 20240227),
        ("o9", None, 7, 8, None),
        ("o9", None, 7, 8, None),
    ]


def test_payment_and_review_facts(spark):
    fact = gold.fact_orders(orders(spark), gold.dim_customer(customers(spark), places(spark), True))
    payments = spark.createDataFrame([("o1", 1, "voucher", 1, 5.0), ("o9", 1, "voucher", 1, 5.0)], "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double")
    assert rows(gold.fact_payments(payments, fact), "order_id", "purchase_date_key") == [("o1", 20240227), ("o9", None)]
    reviews = spark.createDataFrame([("r", "o1", 5, "t", "m", T1, None)], "review_id string, order_id string, review_score int, review_comment_title string, review_comment_message string, review_creation_ts timestamp, review_answer_ts timestamp")
    got = gold.fact_reviews(reviews, fact)
    assert rows(got, "purchase_date_key", "review_creation_date_key", "review_answer_date_key") == [(20240227, 20240227, None)]


def test_shown_keys_are_looked_up_without_passes_over_the_lines(spark, sf_dir):
    """Three lookups lie over the item table, by order, product and seller; the natural keys
    behind the surrogates are found on the dimensions."""
    from orderlake import registry

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("fact_order_items", "fact_order_items_one_per_place"):
            plan = registry.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString().splitlines()
            depth = [next((i for i, c in enumerate(line) if c.isalpha()), 0) for line in plan]
            at = next(n for n, line in enumerate(plan) if "Scan parquet" in line and "l_extendedprice" in line)
            above, joins = depth[at], 0
            for n in range(at, -1, -1):
                if depth[n] < above:
                    above, joins = depth[n], joins + ("Join" in plan[n])
            assert joins == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")


@pytest.mark.parametrize("most", [0, 500_000])
def test_keys_resolved_in_place_equal_those_of_a_plain_join(spark, monkeypatch, most):
    """Keys that are missing, unknown, repeated, known by another value or by none, rows that
    repeat, and rows without a place."""
    monkeypatch.setattr(joins, "LOOKUP_ROWS", most)
    data = [(o, k, n) for n, (o, k) in enumerate([("o1", "a"), ("o1", "a"), ("o1", "b"), ("o2", "a"), ("o2", "two"), ("o2", "gone"), ("o3", "odd"), ("o3", "void"), ("o3", None), (None, "a"), (None, "two"), (None, None), (None, "gone")])]
    lines = spark.createDataFrame(data, "order_id string, product_id string, n int")
    hashed = spark.createDataFrame([("a",), ("b",), ("two",), ("two",), ("unused",)], "product_id string")
    odd = spark.createDataFrame([("odd", 7), ("void", None), ("two", 9), (None, 8)], "product_id string, product_key long")
    known = hashed.select("product_id", surrogate_key("product_id").alias("product_key")).unionByName(odd)
    columns = ["order_id", "product_id", "n", "product_key"]
    expected = rows(joins.resolve_keys(lines, [(known, "product_id")]), *columns)
    assert len(expected) == 13 + 2 * 2
    with session.using(spark, session.IN_PLACE):
        for usual in (surrogate_key("product_id"), None):
            got = joins.resolve_keys_in_place(lines, [(known, "product_id", usual)], "order_id", 3)
            assert rows(got, *columns) == expected
        two = joins.resolve_keys_in_place(lines, [(known, "product_id", None), (spark.createDataFrame([(3, "x"), (3, "y")], "n int, name string"), "n", None)], "order_id", 3)
        assert two.where("n = 3").count() == 2 and two.count() == len(expected) + 1
