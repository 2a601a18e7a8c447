import pytest
from pyspark.sql import functions as F

from orderlake.plans.silver import (
    category_translation,
    geolocation,
    order_items,
    order_payments,
    order_reviews,
    orders,
    people,
    products,
)
from tests.helpers import names, rows, ts

T1, T2 = ts("2024-01-01"), ts("2024-02-01")


def batch(spark, schema, data, ts_column="_InsertTimeStamp"):
    """Rows get the ingest time 2024-01-01 and file f unless they bring their own."""
    width = len(schema.split(","))
    full = [r if len(r) > width else (*r, T1, "f") for r in data]
    return spark.createDataFrame(full, f"{schema}, {ts_column} timestamp, _source_file string")


ORDERS = (
    "order_id string, customer_id string, order_status string, order_purchase_timestamp string, "
    "order_approved_at string, order_delivered_carrier_date string, "
    "order_delivered_customer_date string, order_estimated_delivery_date string"
)


def order(key, status="shipped", bought="2024-01-01 10:00:00", approved=None, carrier=None, *lineage):
    return (key, "c", status, bought, approved, carrier, None, None, *lineage)


def test_orders(spark):
    data = [
        order("1"),
        order("1", "delivered", "2024-01-01 10:00:00", None, None, T2, "g"),
        order(None),
        order("2", bought=None),
        order("3", "lost"),
        order("4", approved="2024-01-05 00:00:00", carrier="2024-01-04 00:00:00"),
        order("5", approved="2024-01-05 00:00:00"),
        order("6", approved="yesterday"),
    ]
    result = orders.transform(batch(spark, ORDERS, data))
    valid = {r.order_id: r for r in result.valid.collect()}
    assert sorted(valid) == ["1", "3", "4", "5"]
    assert valid["1"].order_status == "delivered"
    assert valid["1"].order_purchase_ts == ts("2024-01-01 10:00:00")
    assert names(valid["4"], "_warnings") == ["carrier_after_approval"]
    assert valid["5"]._warnings is None
    refused = [names(r) for r in result.source_invalid.collect()]
    assert sorted(refused) == [["order_approved_at_castable"], ["order_id_not_null"], ["purchase_ts_not_null"]]
    assert result.target_invalid.count() == 0


def test_orders_warn_about_unknown_states(spark):
    from orderlake.operators import quality

    checked = quality.apply(batch(spark, ORDERS, [order("1", "lost"), order("2", None), order("3")]), orders.SOURCE_RULES)
    assert [names(r, "_warnings") for r in checked.orderBy("order_id").collect()] == [
        ["order_status_valid"],
        ["order_status_valid"],
        [],
    ]


def test_tolerant_casts_give_null(spark):
    result = orders.transform(batch(spark, ORDERS, [order("6", approved="yesterday")]), strict_casts=False)
    assert result.valid.first().order_approved_ts is None
    assert result.source_invalid.count() == 0


ITEMS = (
    "order_id string, order_item_id string, product_id string, seller_id string, "
    "shipping_limit_date string, price string, freight_value string"
)


def test_order_items(spark):
    day = "2024-01-01 00:00:00"
    data = [
        ("1", "1", "p", "s", day, "10.5", "1"),
        (None, "1", "p", "s", day, "10.5", "1"),
        ("2", None, "p", "s", day, "10.5", "1"),
        ("3", "1", None, "s", day, "10.5", "1"),
        ("4", "1", "p", "s", day, "0", "1"),
        ("5", "1", "p", "s", day, "10.5", "-1"),
        ("6", "1", "p", "s", day, "10.5", "1"),
        ("6", "1", "q", "s", day, "10.5", "1"),
        ("7", "1", "p", "s", day, "dear", "1"),
        ("8", "1", "p", "s", day, None, "1"),
    ]
    result = order_items.transform(batch(spark, ITEMS, data, "_ingest_time"))
    assert rows(result.valid, "order_id", "order_item_id", "price") == [("1", 1, 10.5), ("5", 1, 10.5), ("8", 1, None)]
    refused = sorted(names(r) for r in result.source_invalid.collect())
    assert refused == [
        ["CustomerKey_is_unique"],
        ["CustomerKey_is_unique"],
        ["order_id_not_null"],
        ["order_item_id_not_null"],
        ["price_castable"],
        ["price_must_be_positive"],
        ["product_id_not_null"],
    ]


def test_order_items_written_in_two_ways_are_one(spark):
    day = "2024-01-01 00:00:00"
    data = [("1", "1", "p", "s", day, "1", "1"), ("1", "01", "q", "s", day, "2", "1", T2, "g"), ("1", " 1", "r", "s", day, "3", "1")]
    result = order_items.transform(batch(spark, ITEMS, data, "_ingest_time"))
    assert rows(result.valid, "order_id", "order_item_id", "product_id") == [("1", 1, "q")]
    assert result.source_invalid.count() == 0 and result.target_invalid.count() == 0


def test_order_item_warning(spark):
    from orderlake.operators import quality

    data = [("5", "1", "p", "s", None, "10.5", "-1")]
    checked = quality.apply(batch(spark, ITEMS, data, "_ingest_time"), order_items.SOURCE_RULES)
    assert names(checked.first(), "_warnings") == ["freight_value_non_negative"]


def test_order_item_target_rules(spark):
    from orderlake.operators import quality

    df = spark.createDataFrame([("1", 1, "p", -1.0), ("2", 1, "p", 0.0)], "order_id string, order_item_id int, product_id string, price double")
    checked = quality.apply(df, order_items.TARGET_RULES).orderBy("order_id").collect()
    assert [names(r) for r in checked] == [["price_non_negative"], []]


PAYMENTS = (
    "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double"
)


def test_order_payments(spark):
    data = [
        ("1", 1, "voucher", 1, 5.0),
        ("1", 1, "boleto", 1, 6.0, T2, "g"),
        (None, 1, "voucher", 1, 5.0),
        ("2", 1, "voucher", 1, -5.0),
        ("3", 1, "cheque", 1, 5.0),
        ("4", 1, None, 1, 5.0),
        ("5", None, "voucher", 1, 5.0),
    ]
    result = order_payments.transform(batch(spark, PAYMENTS, data))
    assert rows(result.valid, "order_id", "payment_type") == [("1", "boleto"), ("5", "voucher")]
    assert sorted(names(r) for r in result.source_invalid.collect()) == [
        ["order_id_not_null"],
        ["payment_value_positive"],
    ]
    assert [names(r) for r in result.target_invalid.collect()] == [["payment_type_valid"]] * 2


def test_order_reviews(spark):
    schema = (
        "review_id string, order_id string, review_score string, review_comment_title string, "
        "review_comment_message string, review_creation_date string, review_answer_timestamp string"
    )
    good, answered = "2024-01-01 10:00:00", "2024-01-02 10:00:00"
    data = [
        ("r1", "1", "5", "t", "m", good, answered),
        ("r2", "2", "5", "t", "m", good, None),
        ("r3", "3", "5", "t", "m", good, "soon"),
        ("r4", "4", "6", "t", "m", good, answered),
        ("r5", "5", "5", "t", "m", "01/01/2024", answered),
        ("r6", "6", None, "t", "m", good, answered),
        (None, "7", "6", "t", "m", good, answered),
        ("r8", None, "5", "t", "m", good, answered),
        ("r9", "9", "5", "t", "m", good, answered),
        ("r9", "9", "0", "t", "m", good, answered),
    ]
    result = order_reviews.transform(batch(spark, schema, data))
    valid = {r.review_id: r for r in result.valid.collect()}
    assert sorted(valid) == ["r1", "r2", "r3"]
    assert valid["r1"].review_score == 5 and valid["r3"].review_answer_ts is None
    assert rows(result.source_invalid, "dq_error_reason", "order_id", "review_score") == sorted(
        [
            ("INVALID_FORMAT", "4", None),
            ("INVALID_FORMAT", "5", "5"),
            ("INVALID_FORMAT", "6", None),
            ("NULL_KEY", "7", "6"),
            ("NULL_KEY", None, "5"),
            ("DUPLICATE_KEY", "9", "5"),
            ("DUPLICATE_KEY", "9", "0"),
        ],
        key=lambda r: [(v is not None, str(v)) for v in r],
    )


def test_review_scores_may_arrive_as_numbers(spark):
    schema = (
        "review_id string, order_id string, review_score int, review_comment_title string, "
        "review_comment_message string, review_creation_date string, review_answer_timestamp string"
    )
    data = [("r1", "1", 5, "t", "m", "2024-01-01 10:00:00", None), ("r2", "2", 15, "t", "m", "2024-01-01 10:00:00", None)]
    result = order_reviews.transform(batch(spark, schema, data))
    assert rows(result.valid, "review_id", "review_score") == [("r1", 5)]


def test_geolocation(spark):
    schema = (
        "geolocation_zip_code_prefix string, geolocation_lat string, geolocation_lng string, "
        "geolocation_city string, geolocation_state string"
    )
    data = [
        ("1", "1.5", "2", "a", "S"),
        ("1", "1.5", "2", "a", "S"),
        ("1", "1.6", "2", "a", "S"),
        (None, "1.5", "2", "a", "S"),
        ("2", None, "2", "a", "S"),
        ("3", "1.5", None, "a", "S"),
        ("4", "north", "2", "a", "S"),
    ]
    result = geolocation.transform(batch(spark, schema, data))
    assert rows(result.valid, "geolocation_zip_code_prefix", "geolocation_lat") == [("1", 1.5), ("1", 1.6)]
    assert sorted(names(r) for r in result.source_invalid.collect()) == [
        ["geolocation_lat_castable"],
        ["lat_not_null"],
        ["lng_not_null"],
        ["zip_not_null"],
    ]


def test_category_translation(spark):
    schema = "product_category_name string, product_category_name_english string"
    data = [("a", "x"), ("a", "y", T2, "g"), (None, "x"), ("b", None)]
    result = category_translation.transform(batch(spark, schema, data))
    assert rows(result.valid, "product_category_name", "product_category_name_english") == [("a", "y")]
    assert sorted(names(r) for r in result.source_invalid.collect()) == [
        ["product_name_english_not_null"],
        ["product_name_not_null"],
    ]
    assert result.target_invalid.count() == 0


CUSTOMERS = (
    "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
    "customer_city string, customer_state string"
)


def test_customers(spark):
    data = [
        ("1", "u", "z", "old", "S"),
        ("1", "u", "z", "new", "S", T2, "g"),
        ("2", "u", "z", "a", "S"),
        ("2", "u", "z", "a", "S"),
        (None, "u", "z", "a", "S"),
        ("3", None, "z", "a", "S"),
        ("4", "u", "z", "a", "S", None, "f"),
        ("5", "u", "z", None, None),
    ]
    result = people.transform(batch(spark, CUSTOMERS, data), people.CUSTOMERS)
    assert rows(result.valid, "customer_id", "customer_city", "EffectiveFrom", "EffectiveTo", "IsActive") == [
        ("1", "new", T2, None, True),
        ("1", "old", T1, T2, False),
        ("2", "a", T1, None, True),
        ("5", None, T1, None, True),
    ]
    assert sorted(names(r) for r in result.source_invalid.collect()) == [
        ["customer_id_not_null"],
        ["customer_unique_id_not_null"],
    ]
    assert [names(r) for r in result.target_invalid.collect()] == [["effective_from_not_null"]]


def test_customers_as_zero_length_versions(spark):
    data = [("1", "u", "z", "a", "S"), ("1", "u", "z", "b", "S"), ("1", "u", "z", "b", "S")]
    result = people.transform(batch(spark, CUSTOMERS, data), people.CUSTOMERS)
    assert rows(result.valid, "customer_city", "EffectiveTo") == [("a", T1), ("b", None)]
    last = people.transform(batch(spark, CUSTOMERS, data), people.CUSTOMERS, keep_ties=False)
    assert rows(last.valid, "customer_city", "EffectiveTo") == [("b", None)]


def test_flag_and_end_must_agree(spark):
    from orderlake.operators import quality

    schema = "customer_id string, customer_city string, customer_state string, EffectiveFrom timestamp, EffectiveTo timestamp, IsActive boolean"
    data = [("1", "c", "s", T1, None, True), ("2", "c", "s", T1, T2, True), ("3", "c", "s", T1, None, False), ("4", None, None, T1, T2, False)]
    checked = quality.apply(spark.createDataFrame(data, schema), people.CUSTOMERS.target_rules)
    got = checked.orderBy("customer_id").collect()
    assert [names(r) for r in got] == [[], [people.FLAG_RULE], [people.FLAG_RULE], []]
    assert names(got[3], "_warnings") == ["customer_city_not_null", "customer_state_valid"]


def test_sellers(spark):
    schema = "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string"
    data = [("1", "z", "a", "S"), (None, "z", "a", "S"), ("1", "z", "b", "S", T2, "g")]
    result = people.transform(batch(spark, schema, data), people.SELLERS)
    assert rows(result.valid, "seller_city", "IsActive") == [("a", False), ("b", True)]
    assert [names(r) for r in result.source_invalid.collect()] == [["seller_id_not_null"]]


PRODUCTS = (
    "product_id string, product_category_name string, product_name_lenght string, "
    "product_description_lenght string, product_photos_qty string, product_weight_g string, "
    "product_length_cm string, product_height_cm string, product_width_cm string"
)


@pytest.mark.parametrize("open_ended,active", [(False, 2), (True, 3)])
def test_products(spark, open_ended, active):
    data = [
        ("1", "c", "1", "2", "3", "4", "5", "6", "7"),
        ("1", "c", "1", "2", "3", "9", "5", "6", "7", T2, "g"),
        (None, "c", "1", "2", "3", "4", "5", "6", "7"),
        ("2", None, "1", "2", "3", "4", "5", "6", "7"),
        ("3", "c", "1", "2", "many", "4", "5", "6", "7"),
        ("4", "c", "1", "2", "3", "4", "5", "6", "7", None, "f"),
    ]
    result = products.transform(batch(spark, PRODUCTS, data), open_ended=open_ended)
    assert result.valid.where(F.col("IsActive")).count() == active
    assert dict(result.valid.dtypes)["product_name_length"] == "int"
    assert sorted(names(r) for r in result.source_invalid.collect()) == [
        ["insert_ts_not_null"],
        ["product_id_not_null"],
        ["product_photos_qty_castable"],
    ]


def test_valid_order_lines_are_unique_and_latest_changes_nothing(spark, sf_dir):
    from orderlake import feeds
    from orderlake.operators import dedup

    valid = order_items.transform(feeds.order_items_raw(feeds.Tables(spark, sf_dir))).valid
    assert valid.count() == valid.select("order_id", "order_item_id").distinct().count()
    again = dedup.latest(valid, ["order_id", "order_item_id"], "_ingest_time", ["_source_file"])
    assert rows(again, "order_id", "order_item_id", "price") == rows(valid, "order_id", "order_item_id", "price")


def test_repeated_customers_are_only_a_warning_in_the_quarantine(spark):
    data = [("1", None, "z", "a", "S"), ("1", "u", "z", "a", "S"), ("2", None, "z", "a", "S")]
    result = people.transform(batch(spark, CUSTOMERS, data), people.CUSTOMERS)
    got = {r.customer_id: r for r in result.source_invalid.collect()}
    assert names(got["1"], "_warnings") == ["customer_id_unique"]
    assert names(got["2"], "_warnings") == []
    assert rows(result.valid, "customer_id") == [("1",)]
