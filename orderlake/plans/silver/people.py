"""Customers and sellers: checked, reduced to distinct records, versioned.

The two feeds differ only in their columns and rules, so one function serves
both. ``transform`` yields the batch's versions; merging them into the table is
``operators.scd``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from orderlake.operators import dedup, quality, scd
from orderlake.operators.quality import Rule
from orderlake.plans.silver.result import INGESTED, SOURCE_FILE, Pin, Result, unpinned

# The rule tying the active flag to the end date, name as published.
FLAG_RULE = "active_flag_effectivet_to_consistency"
FLAG_MATCHES_END = (
    "(IsActive = true AND EffectiveTo IS NULL) OR (IsActive = false AND EffectiveTo IS NOT NULL)"
)


@dataclass(frozen=True)
class Entity:
    key: str
    attributes: Sequence[str]
    source_rules: Sequence[Rule]
    target_rules: Sequence[Rule]

    @property
    def deciding_rules(self) -> list[Rule]:
        """The rules that can refuse a row. Warnings only show in the quarantine,
        so repeated keys are looked up for its few rows and not for all."""
        return [rule for rule in self.source_rules if rule.level == "error"]


def _flag_rule() -> Rule:
    return Rule.expr(FLAG_RULE, FLAG_MATCHES_END, "Each row must have IsActive and EffectiveTo consistent")


# Rule names, levels and columns of the two feeds.
CUSTOMERS = Entity(
    key="customer_id",
    attributes=("customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"),
    source_rules=(
        Rule.not_null("customer_id"),
        Rule.unique(["customer_id"], "warn"),
        Rule.not_null("customer_unique_id"),
    ),
    target_rules=(
        Rule.not_null("customer_id"),
        Rule.not_null("EffectiveFrom", name="effective_from_not_null"),
        _flag_rule(),
        Rule.not_null("customer_city", "warn"),
        Rule.not_null("customer_state", "warn", name="customer_state_valid"),
    ),
)
SELLERS = Entity(
    key="seller_id",
    attributes=("seller_zip_code_prefix", "seller_city", "seller_state"),
    source_rules=(Rule.not_null("seller_id"), Rule.unique(["seller_id"], "warn")),
    target_rules=(
        Rule.not_null("EffectiveFrom", name="effective_from_not_null"),
        _flag_rule(),
    ),
)


def transform(
    batch: DataFrame,
    entity: Entity,
    keep_ties: bool = True,
    null_skipping: bool = False,
    pin: Pin = unpinned,
) -> Result:
    """Versions of one batch and what the two gates refused.

    Only equal records are removed, by fingerprint; different ones of one ingest time
    all become versions, all but the last of them empty. ``keep_ties=False`` keeps just
    that last one.
    """
    good, bad = quality.split(pin(quality.apply(batch, entity.deciding_rules)))
    records = good.drop(quality.ERRORS, quality.WARNINGS)
    refused = quality.apply(bad, entity.source_rules, among=batch)
    if keep_ties:
        records = dedup.by_hash(records, entity.key, entity.attributes, INGESTED, null_skipping)
    dated = scd.versions(
        records,
        entity.key,
        INGESTED,
        entity.attributes,
        tie_breakers=[SOURCE_FILE, *entity.attributes],
        keep_ties=keep_ties,
    )
    valid, late_refused = quality.split(pin(quality.apply(dated, entity.target_rules)))
    return Result(valid.drop(quality.ERRORS, quality.WARNINGS), refused, late_refused)
