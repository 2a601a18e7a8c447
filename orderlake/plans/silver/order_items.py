"""Order lines: checked, cast, newest row per line, checked again, appended.

The source gate refuses every row of a repeated line as it is written. Text feeds may
write one line number in several ways (``1``, ``01``), which only casting makes equal:
of such rows the newest stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from orderlake.operators import dedup, quality
from orderlake.operators.quality import Rule
from orderlake.plans.silver.result import SOURCE_FILE, Pin, Result, cast_rules, casts, unparsed_rules, unpinned

# This feed names its ingest time differently from the others.
INGESTED = "_ingest_time"
TYPES = {
    "order_item_id": "int",
    "price": "double",
    "freight_value": "double",
    "shipping_limit_date": "timestamp",
}

# Rule names and conditions. The source gate wants a positive
# price, the target gate accepts zero; both are kept under their own names.
# try_cast lets the conditions read text and typed feeds alike.
SOURCE_RULES = [
    Rule.not_null("order_id"),
    Rule.not_null("order_item_id"),
    Rule.not_null("product_id"),
    Rule.unique(["order_id", "order_item_id"], name="CustomerKey_is_unique"),
    Rule.expr("price_must_be_positive", "try_cast(price AS double) > 0", "price must be greater than 0"),
    Rule.expr(
        "freight_value_non_negative",
        "try_cast(freight_value AS double) >= 0",
        "freight_value must be >= 0",
        "warn",
    ),
]
TARGET_RULES = [
    Rule.expr("price_non_negative", "price >= 0", "price must be >= 0"),
    Rule.unique(["order_id", "product_id", "order_item_id"], name="order_item_unique", deduplicated=True),
]


def transform(batch: DataFrame, strict_casts: bool = True, pin: Pin = unpinned) -> Result:
    rules = [*SOURCE_RULES, *cast_rules(TYPES, strict_casts), *unparsed_rules(batch)]
    checked = pin(quality.apply(batch, rules))
    good, refused = quality.split(checked)
    cast = good.select("order_id", "product_id", "seller_id", *casts(TYPES), INGESTED, SOURCE_FILE)
    newest = dedup.latest(cast, ["order_id", "order_item_id"], INGESTED, [SOURCE_FILE])
    valid, late_refused = quality.split(quality.apply(newest, TARGET_RULES))
    return Result(valid, refused, late_refused)
