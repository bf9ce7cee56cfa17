"""Fraud confirmed before the row: a prior claim counts only once its label was known.

A fraud claim made at c whose label became known at l counts for a row at t (milliseconds)
exactly when max(c, l) + 1 <= t <= c + horizon. It therefore enters as two signed steps, +1 at
max(c, l) + 1 and -1 at c + horizon + 1, and the feature is the running sum of the steps: no
self join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.time import MS_PER_DAY, MS_PER_HOUR, epoch_ms
from tidemark.operators.skew import RUNNING_ROWS_PER_KEY, attach, hot_keys, split_hot

_AT, _STEP, _ROW, _HOUR = "__at", "__step", "__row", "__hour"


def confirmed_fraud_strict(
    df: DataFrame,
    key: str = "policy_id",
    ts: str = "timestamp",
    label: str = "is_fraud",
    label_ts: str = "label_available_timestamp",
    days: int = 30,
    max_rows_per_key: int = RUNNING_ROWS_PER_KEY,
    count_on: DataFrame | None = None,
) -> DataFrame:
    """All columns of ``df`` plus ``num_fraud_confirmed_strict_{days}d``."""
    out = f"num_fraud_confirmed_strict_{days}d"
    hot = hot_keys(df if count_on is None else count_on, [key], max_rows_per_key)
    stepped = _with_steps(df, ts, label, label_ts, days)
    if hot is None:
        return _running(stepped, key, out)
    ordinary, heavy = split_hot(stepped, hot)
    return _running(ordinary, key, out).unionByName(_running_by_hours(heavy, key, out))


def _with_steps(df: DataFrame, ts: str, label: str, label_ts: str, days: int) -> DataFrame:
    made, known = epoch_ms(df, ts), epoch_ms(df, label_ts)
    end = made + F.lit(days * MS_PER_DAY)
    start = F.greatest(made, known)

    def step(at, sign, is_row):
        return F.struct(at.alias(_AT), F.lit(sign).alias(_STEP), F.lit(is_row).alias(_ROW))

    itself = step(made, 0, True)
    counts = (F.col(label) == 1) & known.isNotNull() & (start < end)
    steps = F.when(
        counts, F.array(itself, step(start + F.lit(1), 1, False), step(end + F.lit(1), -1, False))
    ).otherwise(F.array(itself))
    return df.select("*", F.inline(steps))


def _running(stepped: DataFrame, key: str, out: str) -> DataFrame:
    so_far = Window.partitionBy(key).orderBy(_AT).rangeBetween(Window.unboundedPreceding, 0)
    return (
        stepped.withColumn(out, F.sum(_STEP).over(so_far)).filter(_ROW).drop(_AT, _STEP, _ROW)
    )


def _running_by_hours(stepped: DataFrame, key: str, out: str) -> DataFrame:
    instants = (
        stepped.groupBy(key, _AT)
        .agg(F.sum(_STEP).alias(_STEP))
        .withColumn(_HOUR, F.floor(F.col(_AT) / MS_PER_HOUR))
    )
    in_hour = (
        Window.partitionBy(key, _HOUR).orderBy(_AT).rangeBetween(Window.unboundedPreceding, 0)
    )
    before = Window.partitionBy(key).orderBy(_HOUR).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        instants.groupBy(key, _HOUR)
        .agg(F.sum(_STEP).alias("hour_steps"))
        .select(key, _HOUR, F.coalesce(F.sum("hour_steps").over(before), F.lit(0)).alias("carry"))
    )
    local = instants.select(key, _AT, _HOUR, F.sum(_STEP).over(in_hour).alias("local"))
    counted = attach(local, carried, [key, _HOUR]).select(
        key, _AT, (F.col("local") + F.col("carry")).alias(out)
    )
    return attach(stepped.filter(_ROW), counted, [key, _AT]).drop(_AT, _STEP, _ROW)
