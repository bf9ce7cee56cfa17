"""Spines: which claims, at what instant, with or without a label. Tables and streams."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.time import parse_event_time, truncate_to_ms

# Columns known when a claim is reported.
CLAIM_COLUMNS = (
    "accident_type",
    "claimed_amount_eur",
    "n_parties_involved",
    "telematics_anomaly",
    "police_report_filed",
    "outside_business_hours",
)


def training_spine(enriched: DataFrame) -> DataFrame:
    """Keys, label, label time cut to milliseconds, and claim columns."""
    label_time = truncate_to_ms(enriched, "label_available_timestamp")
    return enriched.select(
        "claim_id",
        "policy_id",
        "timestamp",
        "is_fraud",
        label_time.alias("label_available_timestamp"),
        *CLAIM_COLUMNS,
    )


def inference_spine(claims: DataFrame) -> DataFrame:
    """Unlabelled claims straight from ingestion; a text ``timestamp`` is parsed."""
    time = F.col("timestamp")
    if isinstance(claims.schema["timestamp"].dataType, T.StringType):
        time = parse_event_time("timestamp")
    return claims.select("claim_id", "policy_id", time.alias("timestamp"), *CLAIM_COLUMNS)


def labelled_only(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    return df.filter(F.col(label).isNotNull())


def since(df: DataFrame, last_seen: dt.date, ts: str = "timestamp") -> DataFrame:
    """Rows from the day after ``last_seen`` on."""
    return df.filter(F.col(ts) >= F.lit(last_seen + dt.timedelta(days=1)))
