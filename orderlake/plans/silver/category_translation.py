"""Category names and their English form: checked, one row per name, upserted."""

from __future__ import annotations

from pyspark.sql import DataFrame

from orderlake.operators import dedup, quality
from orderlake.operators.quality import Rule
from orderlake.plans.silver.result import INGESTED, Pin, Result, unpinned

KEY = "product_category_name"
# Rule names.
SOURCE_RULES = [
    Rule.not_null("product_category_name", name="product_name_not_null"),
    Rule.not_null("product_category_name_english", name="product_name_english_not_null"),
]
TARGET_RULES = [Rule.unique([KEY], name="category_name_unique", deduplicated=True)]


def transform(batch: DataFrame, pin: Pin = unpinned) -> Result:
    good, refused = quality.split(pin(quality.apply(batch, SOURCE_RULES)))
    named = good.select(KEY, "product_category_name_english", INGESTED)
    single = dedup.latest(named, [KEY], INGESTED)
    valid, late_refused = quality.split(pin(quality.apply(single, TARGET_RULES)))
    return Result(valid.drop(quality.ERRORS, quality.WARNINGS), refused, late_refused)
