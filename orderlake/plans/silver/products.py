"""Products: checked, measures cast, versioned."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.operators import dedup, quality, scd
from orderlake.operators.quality import Rule
from orderlake.plans.silver.result import INGESTED, SOURCE_FILE, Pin, Result, cast_rules, casts, unpinned

KEY = "product_id"
# Rule names, and the feed's spelling of two columns.
SOURCE_RULES = [
    Rule.not_null("product_id"),
    Rule.not_null("product_category_name", "warn", name="category_not_null"),
    Rule.not_null(INGESTED, name="insert_ts_not_null"),
]
RENAMED = {
    "product_name_lenght": "product_name_length",
    "product_description_lenght": "product_description_length",
}
MEASURES = [
    "product_name_lenght",
    "product_description_lenght",
    "product_photos_qty",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
]
TYPES = dict.fromkeys(MEASURES, "int")
ATTRIBUTES = ["product_category_name", *[RENAMED.get(c, c) for c in MEASURES]]


def transform(
    batch: DataFrame,
    open_ended: bool = False,
    keep_ties: bool = True,
    null_skipping: bool = False,
    strict_casts: bool = True,
    pin: Pin = unpinned,
) -> Result:
    """Versions of one batch.

    Equal records are removed by fingerprint; different ones of one ingest time all become
    versions, all but the last of them empty. ``keep_ties=False`` keeps just that last one;
    ``open_ended=True`` leaves every distinct record of the batch active instead of ending
    it at the product's next one."""
    checked = pin(quality.apply(batch, [*SOURCE_RULES, *cast_rules(TYPES, strict_casts)]))
    good, refused = quality.split(checked)
    records = good.drop(quality.ERRORS, quality.WARNINGS)
    if open_ended or keep_ties:
        raw = ["product_category_name", *MEASURES]
        records = dedup.by_hash(records, KEY, raw, INGESTED, null_skipping)
    cast = records.select(KEY, "product_category_name", *casts(TYPES, RENAMED), INGESTED, SOURCE_FILE)
    dated = scd.versions(
        cast,
        KEY,
        INGESTED,
        ATTRIBUTES,
        tie_breakers=[SOURCE_FILE, *ATTRIBUTES],
        open_ended=open_ended,
        keep_ties=keep_ties,
    )
    return Result(dated.withColumn(INGESTED, F.col(scd.FROM)), refused)
