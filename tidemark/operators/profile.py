"""Profile features of policy versions and row features of claims."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.scd2 import END, START

# Columns of the profile table and the features taken from it.
BASE_COLUMNS = (
    "policy_id",
    "policyholder_age",
    "gender",
    "region_type",
    "vehicle_year",
    "annual_premium_eur",
    "has_telematics",
    "coverage_type",
    "vehicle_type",
    "policy_start_date",
)
PROFILE_FEATURES = (
    "age_group",
    "vehicle_segment",
    "risk_level_by_premium",
    "driver_experience_years",
    "is_new_policy_risk",
    "gender",
    "region_type",
    "coverage_type",
    "vehicle_type",
)
# Upper bounds (exclusive) and lower bounds (inclusive) of the bands.
AGE_BANDS = ((25, "novel"), (65, "standard"))
VEHICLE_BANDS = ((2022, "new"), (2015, "mid_age"))
PREMIUM_BANDS = ((500, "low_risk"), (1200, "medium_risk"))
NEW_POLICY_DAYS = 90


def _below(name: str, bands, otherwise: str) -> Column:
    out = F
    for bound, band in bands:
        out = out.when(F.col(name) < bound, band)
    return out.otherwise(otherwise)


def _at_least(name: str, bands, otherwise: str) -> Column:
    out = F
    for bound, band in bands:
        out = out.when(F.col(name) >= bound, band)
    return out.otherwise(otherwise)


def profile_features(history: DataFrame, as_of: dt.date | Column | None = None) -> DataFrame:
    """Bands, experience and new-policy flag of every version.

    A null falls into the last band of each column. The new-policy flag compares the policy
    start with ``as_of``; by default with the day the version begins, which makes it a value
    of that point in time.
    """
    if as_of is None:
        today = F.col(START).cast("date")
    else:
        today = as_of if isinstance(as_of, Column) else F.lit(as_of)
    recent = F.datediff(today, "policy_start_date") < NEW_POLICY_DAYS
    return history.select(
        *BASE_COLUMNS,
        START,
        END,
        _below("policyholder_age", AGE_BANDS, "senior").alias("age_group"),
        _at_least("vehicle_year", VEHICLE_BANDS, "old").alias("vehicle_segment"),
        _below("annual_premium_eur", PREMIUM_BANDS, "high_risk").alias("risk_level_by_premium"),
        F.col("bonus_malus_years").alias("driver_experience_years"),
        F.when(recent, 1).otherwise(0).alias("is_new_policy_risk"),
    )


# Limits of the row features. Their names are those of the feature tables, although log_premium is the
# logarithm of the claimed amount.
FREQUENT_CLAIMS = 1
SPIKE_RATIO = 1.2


def _flag(*conditions: str) -> str:
    """1 if all conditions hold, 0 if one does not or is undecided."""
    return f"CAST(coalesce({' AND '.join(conditions)}, false) AS int)"


ROW_FEATURES = {
    "is_frequent_claimant": _flag(f"count_claims_30d > {FREQUENT_CLAIMS}"),
    "is_immediate_fraud_risk": _flag("is_new_policy_risk = 1", "count_claims_30d > 0"),
    "log_premium": "coalesce(ln(1 + claimed_amount_eur), 0D)",
    "is_activity_spike": _flag(f"claims_7d_vs_avg_30d_ratio > {SPIKE_RATIO}D"),
}


def row_feature_sql() -> list[str]:
    return [f"{sql} AS {name}" for name, sql in ROW_FEATURES.items()]


def row_features(df: DataFrame) -> DataFrame:
    """Features computable from one enriched row; an undecided comparison counts as 0."""
    return df.selectExpr("*", *row_feature_sql())


def flag_sql(flags: list[str]) -> list[str]:
    return [f"coalesce(cast(`{c}` AS double), CAST(0 AS double)) AS `{c}_dbl`" for c in flags]


def flags_to_double(df: DataFrame, flags: list[str]) -> DataFrame:
    """``<flag>_dbl`` for each flag; a missing flag is 0.0."""
    return df.selectExpr("*", *flag_sql(flags))
