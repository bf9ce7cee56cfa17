"""Joining claims with labels that arrive later."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# How long a label may take, and the event-time delays of the two streams.
MAX_LABEL_DELAY = "31 days"
CLAIM_WATERMARK = "31 days"
LABEL_WATERMARK = "1 day"


def join_late_labels(
    claims: DataFrame,
    labels: DataFrame,
    claim_ts: str = "incident_timestamp",
    label_ts: str = "label_available_timestamp",
    max_delay: str = MAX_LABEL_DELAY,
) -> DataFrame:
    """Every claim with the label that became available within ``max_delay`` after it.

    Left outer join on ``claim_id`` and the time interval, for tables and, given watermarks,
    for streams. Two labels for one claim give two rows. A label outside the interval never
    matches; the claim then keeps a null label.
    """
    left = claims.alias("c")
    right = labels.select("claim_id", "is_fraud", label_ts).alias("l")
    on = (
        (F.col("c.claim_id") == F.col("l.claim_id"))
        & (F.col(f"l.{label_ts}") >= F.col(f"c.{claim_ts}"))
        & (F.col(f"l.{label_ts}") <= F.col(f"c.{claim_ts}") + F.expr(f"INTERVAL {max_delay}"))
    )
    return left.join(right, on, "leftOuter").select("c.*", "l.is_fraud", f"l.{label_ts}")


def labels_or_zero(claims: DataFrame, labels: DataFrame) -> DataFrame:
    """Every claim with its label, 0 where there is none yet. Two labels give two rows."""
    known = labels.select("claim_id", "is_fraud")
    return claims.join(known, "claim_id", "left").withColumn(
        "is_fraud", F.coalesce("is_fraud", F.lit(0))
    )


def latest_label(labels: DataFrame, label_ts: str = "label_available_timestamp") -> DataFrame:
    """One label per claim: the last to become available, fraud winning a tie."""
    last = F.max(F.struct(label_ts, "is_fraud")).alias("last")
    return labels.groupBy("claim_id").agg(last).select("claim_id", "last.is_fraud", f"last.{label_ts}")
