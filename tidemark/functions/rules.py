"""Catalogue of data-quality rules, each a SQL predicate with a tag for its domain."""

from __future__ import annotations

from dataclasses import dataclass

POLICIES = "policies"
CLAIMS = "claims"
LABELS = "labels"


@dataclass(frozen=True)
class Rule:
    name: str
    constraint: str
    tag: str


# Rule names and predicates, in domain order.
CATALOGUE = (
    Rule("valid_policy_id", "policy_id IS NOT NULL", POLICIES),
    Rule("valid_updated_at", "policy_updated_at IS NOT NULL", POLICIES),
    Rule("valid_age", "policyholder_age >= 18", POLICIES),
    Rule("valid_gender", "gender IS NOT NULL", POLICIES),
    Rule("valid_region", "TRIM(region_type) IN ('urban', 'suburban', 'rural')", POLICIES),
    Rule("valid_premium", "annual_premium_eur > 0", POLICIES),
    Rule("valid_vehicle_year", "vehicle_year > 1900 AND vehicle_year <= 2026", POLICIES),
    Rule("valid_telematics_flag", "has_telematics IN (0, 1)", POLICIES),
    Rule("valid_claim_id", "claim_id IS NOT NULL", CLAIMS),
    Rule("valid_policy_id", "policy_id IS NOT NULL", CLAIMS),
    Rule("valid_incident_date", "timestamp IS NOT NULL", CLAIMS),
    Rule("valid_amount", "claimed_amount_eur >= 0", CLAIMS),
    Rule(
        "valid_incident_type",
        "accident_type IN ('hit_and_run', 'animal_collision', 'single_vehicle', 'theft', "
        "'parking', 'side_collision', 'rollover', 'hail_damage', 'vandalism', 'rear_end')",
        CLAIMS,
    ),
    Rule("valid_parties", "n_parties_involved >= 1", CLAIMS),
    Rule("valid_telematics_anomaly", "telematics_anomaly IN (0, 1)", CLAIMS),
    Rule("valid_police_report", "police_report_filed IN (0, 1)", CLAIMS),
    Rule("valid_business_hours", "outside_business_hours IN (0, 1)", CLAIMS),
    Rule("valid_lbl_claim_id", "claim_id IS NOT NULL", LABELS),
    Rule("valid_fraud_flag", "is_fraud IS NOT NULL AND is_fraud IN (0, 1)", LABELS),
    Rule("valid_lbl_date", "label_available_date IS NOT NULL", LABELS),
)


def rules_for(tag: str) -> tuple[Rule, ...]:
    """The rules of one domain."""
    return tuple(rule for rule in CATALOGUE if rule.tag == tag)
