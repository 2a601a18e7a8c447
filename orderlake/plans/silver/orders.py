"""Orders: checked, timestamps parsed, newest row per order, appended."""

from __future__ import annotations

from pyspark.sql import DataFrame

from orderlake.operators import dedup, quality
from orderlake.operators.quality import Rule
from orderlake.plans.silver.result import (
    INGESTED,
    SOURCE_FILE,
    Pin,
    Result,
    cast_rules,
    casts,
    unparsed_rules,
    unpinned,
)

# Order states, rule names and conditions, column names.
STATUSES = (
    "created",
    "approved",
    "invoiced",
    "shipped",
    "delivered",
    "canceled",
    "unavailable",
    "processing",
)
TIMESTAMPS = {
    "order_purchase_timestamp": "order_purchase_ts",
    "order_approved_at": "order_approved_ts",
    "order_delivered_carrier_date": "order_delivered_carrier_ts",
    "order_delivered_customer_date": "order_delivered_customer_ts",
    "order_estimated_delivery_date": "order_estimated_delivery_ts",
}
SOURCE_RULES = [
    Rule.not_null("order_id"),
    Rule.in_list("order_status", STATUSES, "warn"),
    Rule.not_null("order_purchase_timestamp", name="purchase_ts_not_null"),
]
TARGET_RULES = [
    Rule.unique(["order_id"], deduplicated=True),
    Rule.expr(
        "carrier_after_approval",
        "order_delivered_carrier_ts >= order_approved_ts",
        "Carrier date must be after approval date",
        "warn",
    ),
]


def transform(batch: DataFrame, strict_casts: bool = True, pin: Pin = unpinned) -> Result:
    types = dict.fromkeys(TIMESTAMPS, "timestamp")
    rules = [*SOURCE_RULES, *cast_rules(types, strict_casts), *unparsed_rules(batch)]
    checked = pin(quality.apply(batch, rules))
    good, refused = quality.split(checked)
    parsed = good.select(
        "order_id", "customer_id", "order_status", *casts(types, TIMESTAMPS), INGESTED, SOURCE_FILE
    )
    newest = dedup.latest(parsed, ["order_id"], INGESTED, [SOURCE_FILE])
    valid, late_refused = quality.split(pin(quality.apply(newest, TARGET_RULES)))
    return Result(valid, refused, late_refused)
