"""Payments: checked, cast, newest row per payment, checked again, appended."""

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

# Payment types, rule names and conditions.
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")
TYPES = {"payment_sequential": "int", "payment_installments": "int", "payment_value": "double"}
SOURCE_RULES = [
    Rule.not_null("order_id"),
    Rule.expr(
        "payment_value_positive", "try_cast(payment_value AS double) >= 0", "payment_value must be >= 0"
    ),
]
TARGET_RULES = [
    Rule.in_list("payment_type", PAYMENT_TYPES),
    Rule.unique(["order_id", "payment_sequential"], name="unique_payment", deduplicated=True),
]


def transform(batch: DataFrame, strict_casts: bool = True, pin: Pin = unpinned) -> Result:
    rules = [*SOURCE_RULES, *cast_rules(TYPES, strict_casts), *unparsed_rules(batch)]
    checked = pin(quality.apply(batch, rules))
    good, refused = quality.split(checked)
    cast = good.select("order_id", "payment_type", *casts(TYPES), INGESTED, SOURCE_FILE)
    newest = dedup.latest(cast, ["order_id", "payment_sequential"], INGESTED, [SOURCE_FILE])
    valid, late_refused = quality.split(pin(quality.apply(newest, TARGET_RULES)))
    return Result(valid, refused, late_refused)
