"""Places: checked, equal rows reduced to one, coordinates cast, appended."""

from __future__ import annotations

from pyspark.sql import DataFrame

from orderlake.operators import dedup, quality
from orderlake.operators.quality import Rule
from orderlake.plans.silver.result import INGESTED, Pin, Result, cast_rules, casts, unpinned

COLUMNS = [
    "geolocation_zip_code_prefix",
    "geolocation_lat",
    "geolocation_lng",
    "geolocation_city",
    "geolocation_state",
]
TYPES = {"geolocation_lat": "double", "geolocation_lng": "double"}
# Rule names.
SOURCE_RULES = [
    Rule.not_null("geolocation_zip_code_prefix", name="zip_not_null"),
    Rule.not_null("geolocation_lat", name="lat_not_null"),
    Rule.not_null("geolocation_lng", name="lng_not_null"),
]


def transform(batch: DataFrame, strict_casts: bool = True, pin: Pin = unpinned) -> Result:
    checked = pin(quality.apply(batch, [*SOURCE_RULES, *cast_rules(TYPES, strict_casts)]))
    good, refused = quality.split(checked)
    distinct = dedup.exact(good.drop(quality.ERRORS, quality.WARNINGS), COLUMNS, INGESTED)
    lat, lng = casts(TYPES)
    valid = distinct.select(
        "geolocation_zip_code_prefix", lat, lng, "geolocation_city", "geolocation_state", INGESTED
    )
    return Result(valid, refused)
