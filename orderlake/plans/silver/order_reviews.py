"""Reviews: no rule set; each refused row carries one reason code."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.operators import quality
from orderlake.operators.quality import REASON
from orderlake.plans.silver.result import INGESTED, SOURCE_FILE, Pin, Result, unpinned
from orderlake.schemas import UNPARSED

KEYS = ["order_id", "review_id"]
# The score pattern and the timestamp format.
SCORE_PATTERN = "^[1-5]$"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

VALID_COLUMNS = [
    "order_id",
    "review_id",
    "review_score",
    "review_comment_title",
    "review_comment_message",
    "review_creation_ts",
    "review_answer_ts",
    SOURCE_FILE,
    INGESTED,
]
REFUSED_COLUMNS = [
    "order_id",
    "review_id",
    "review_score",
    "review_creation_date",
    "review_answer_timestamp",
    SOURCE_FILE,
    INGESTED,
    REASON,
]


def transform(batch: DataFrame, pin: Pin = unpinned) -> Result:
    """A missing answer time is fine; a missing or unreadable creation time is not.

    A refused score outside 1-5 appears as NULL under INVALID_FORMAT and as it
    came under the other reasons.
    """
    score = F.when(
        F.col("review_score").cast("string").rlike(SCORE_PATTERN), F.col("review_score").try_cast("int")
    )
    parsed = batch.withColumns(
        {
            "_score": score,
            "review_creation_ts": F.try_to_timestamp("review_creation_date", F.lit(TIME_FORMAT)),
            "review_answer_ts": F.try_to_timestamp("review_answer_timestamp", F.lit(TIME_FORMAT)),
        }
    )
    unreadable = F.col("_score").isNull() | F.col("review_creation_ts").isNull()
    if UNPARSED in batch.columns:
        unreadable = unreadable | F.col(UNPARSED).isNotNull()
    judged = pin(quality.reason_split(parsed, KEYS, unreadable))

    valid = judged.where(F.col(REASON).isNull()).withColumn("review_score", F.col("_score"))
    shown = F.when(F.col(REASON) == "INVALID_FORMAT", F.col("_score").cast("string")).otherwise(
        F.col("review_score").cast("string")
    )
    refused = judged.where(F.col(REASON).isNotNull()).withColumn("review_score", shown)
    return Result(valid.select(VALID_COLUMNS), refused.select(REFUSED_COLUMNS))
