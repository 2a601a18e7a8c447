"""The nine feeds as they arrive, and how each is ingested.

Fixed values: column names, order and types as in the feeds' CSV headers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType

INGESTED = "_InsertTimeStamp"
SOURCE_FILE = "_source_file"
# Holds the raw line of a row in a typed feed that did not fit its types.
UNPARSED = "_corrupt_record"


@dataclass(frozen=True)
class Feed:
    """``typed`` feeds may infer column types; the others stay text throughout."""

    name: str
    ddl: str
    typed: bool = False
    ingest_column: str = INGESTED

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def read_schema(self) -> StructType:
        """With room for lines that do not fit, so that no value gets lost."""
        return self.schema.add(UNPARSED, "string") if self.typed else self.schema


def _text(*columns: str) -> str:
    return ", ".join(f"{c} STRING" for c in columns)


FEEDS = {
    feed.name: feed
    for feed in (
        Feed(
            "customers",
            _text(
                "customer_id",
                "customer_unique_id",
                "customer_zip_code_prefix",
                "customer_city",
                "customer_state",
            ),
        ),
        Feed(
            "geolocation",
            _text(
                "geolocation_zip_code_prefix",
                "geolocation_lat",
                "geolocation_lng",
                "geolocation_city",
                "geolocation_state",
            ),
        ),
        Feed(
            "order_items",
            "order_id STRING, order_item_id INT, product_id STRING, seller_id STRING, "
            "shipping_limit_date TIMESTAMP, price DOUBLE, freight_value DOUBLE",
            typed=True,
            ingest_column="_ingest_time",
        ),
        Feed(
            "order_payments",
            "order_id STRING, payment_sequential INT, payment_type STRING, "
            "payment_installments INT, payment_value DOUBLE",
            typed=True,
        ),
        Feed(
            "order_reviews",
            "review_id STRING, order_id STRING, review_score INT, review_comment_title STRING, "
            "review_comment_message STRING, review_creation_date STRING, review_answer_timestamp STRING",
            typed=True,
        ),
        Feed(
            "orders",
            "order_id STRING, customer_id STRING, order_status STRING, "
            "order_purchase_timestamp TIMESTAMP, order_approved_at TIMESTAMP, "
            "order_delivered_carrier_date TIMESTAMP, order_delivered_customer_date TIMESTAMP, "
            "order_estimated_delivery_date TIMESTAMP",
            typed=True,
        ),
        Feed(
            "product_category_name",
            _text("product_category_name", "product_category_name_english"),
        ),
        Feed(
            "products",
            _text(
                "product_id",
                "product_category_name",
                "product_name_lenght",
                "product_description_lenght",
                "product_photos_qty",
                "product_weight_g",
                "product_length_cm",
                "product_height_cm",
                "product_width_cm",
            ),
        ),
        Feed(
            "sellers",
            _text("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
        ),
    )
}
