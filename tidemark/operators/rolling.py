"""Leak-free rolling behaviour features: 24-hour, 7-day and 30-day windows per key.

Every window ends one millisecond before the row, so neither the row nor rows of the same
millisecond are counted.

One linear plan: one exchange on (key, slice), then frames that only ever grow. What a window holds is what came up to
its end less what came before its beginning, both growing frames; its maximum is that of the current 30 days up
to the row, and of the 30 days before from the beginning of the window on, which a growing frame from the other end
has. No frame is added up anew for every row, so a key with many rows costs no more a row than others.

Differences of sums of doubles would lose digits after a burst of large amounts. Amounts are therefore added as whole
1024ths, exactly, and what is left of them, which is small. Amounts of 2^40 and more, and those that are not finite,
are added apart, and only where the window has some. Decimals and whole numbers are added as they are.

Slices: keys with very many rows are cut into slices of 30 days, and each row of theirs goes to its slice and, as a halo
row that counts but does not come out, to the next one. All other keys are one slice. Which keys those are is part of
the plan, a broadcast of at most 10,000 keys; building the query runs nothing.

A row without a time counts all rows of its key without one, as range windows do. Sums leave as doubles, means
and maxima as the type of avg and max.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.time import MS_PER_DAY, epoch_ms
from tidemark.operators.skew import RUNNING_ROWS_PER_KEY, mark_hot

# Window lengths in days by feature suffix.
HORIZON_DAYS = {"24h": 1, "7d": 7, "30d": 30}
# Fixed value: keeps the ratio finite when the mean is zero.
RATIO_EPSILON = 1e-6

FEATURES = (
    "count_claims_24h",
    "sum_amount_24h",
    "count_claims_7d",
    "sum_amount_7d",
    "avg_amount_7d",
    "count_claims_30d",
    "sum_amount_30d",
    "avg_amount_30d",
    "max_amount_30d",
    "num_fraud_confirmed_30d",
    "claims_7d_vs_avg_30d_ratio",
)

_MS = "__ms"
_SLICE = "__slice"
_HALO = "__halo"
# Longest window, and so the length of a slice.
MONTH_MS = max(HORIZON_DAYS.values()) * MS_PER_DAY


def rolling_features(
    df: DataFrame,
    key: str = "policy_id",
    ts: str = "timestamp",
    amount: str = "claimed_amount_eur",
    label: str = "is_fraud",
    event_id: str = "claim_id",
    max_rows_per_key: int = RUNNING_ROWS_PER_KEY,
    count_on: DataFrame | None = None,
) -> DataFrame:
    """All columns of ``df`` plus the eleven features of ``FEATURES``; one row per input row.

    Keys with more than ``max_rows_per_key`` rows, and more than a 10,000th of all, are cut into slices. ``count_on`` is a
    cheaper table to count the rows per key on, such as the claims before their join with labels.
    """
    hot = mark_hot(df, df if count_on is None else count_on, key, max_rows_per_key, _HALO)
    timed = hot.withColumn(_MS, epoch_ms(df, ts))
    return in_slices(timed, key, amount, label, event_id).drop(_MS)


def in_slices(marked: DataFrame, key: str, amount: str, label: str, event_id: str) -> DataFrame:
    """Features of rows with epoch milliseconds, whose ``__halo`` says that their key is cut into slices."""
    own = F.when(F.col(_HALO), F.floor(F.col(_MS) / MONTH_MS))
    here, after = F.struct(own.alias(_SLICE), F.lit(False).alias(_HALO)), F.struct((own + 1).alias(_SLICE), F.lit(True).alias(_HALO))
    slices = F.when(own.isNotNull(), F.array(here, after)).otherwise(F.array(here))
    dealt = marked.withColumn("__slices", slices).drop(_HALO).select("*", F.inline("__slices")).drop("__slices")
    done = in_place(dealt, [key, _SLICE], amount, label, event_id)
    return done.filter(~F.col(_HALO)).drop(_SLICE, _HALO)


def _is_fraud(label: str) -> Column:
    return F.when(F.col(label) == 1, 1).otherwise(0)


def ratio() -> Column:
    """Amount of 7 days over the mean amount of 30 days; 1.0 without history."""
    return F.coalesce(
        F.try_divide("sum_amount_7d", F.col("avg_amount_30d") + F.lit(RATIO_EPSILON)), F.lit(1.0)
    )


def _measures(kind: T.DataType, amount: str, label: str, event_id: str) -> dict[str, Column]:
    """What is added up, by name; see the head of this module."""
    x = F.col(amount)
    out = {"n": F.col(event_id).isNotNull().cast("long"), "v": x.isNotNull().cast("long"), "f": _is_fraud(label)}
    if not isinstance(kind, (T.DoubleType, T.FloatType)):
        return {**out, "s": x}
    plain = F.abs(x) < float(1 << 40)
    whole = F.when(plain, F.floor(x.cast("double") * 1024.0))
    return {**out, "hi": whole, "lo": F.when(plain, x.cast("double") - whole / 1024.0), "big": F.when(~plain, x), "nb": F.when(~plain, 1)}


def in_place(timed: DataFrame, by: list[str], amount: str, label: str, event_id: str) -> DataFrame:
    """Features by growing frames over ``by``; ``timed`` carries epoch milliseconds. One exchange, two sorts."""
    kind = timed.schema[amount].dataType
    by_time, by_end = Window.partitionBy(*by).orderBy(_MS), Window.partitionBy(*by).orderBy(F.col(_MS).desc())
    until = by_time.rangeBetween(Window.unboundedPreceding, -1)
    before = {s: by_time.rangeBetween(Window.unboundedPreceding, -d * MS_PER_DAY - 1) for s, d in HORIZON_DAYS.items()}
    measures = _measures(kind, amount, label, event_id)
    month = F.floor(F.col(_MS) / MONTH_MS)
    # The largest amount of a row's month from the row on: the later the order, the earlier the month.
    from_here = F.max(F.struct((-month).alias("m"), F.col(amount).alias("x"))).over(by_end.rangeBetween(Window.unboundedPreceding, 0))
    rows = timed.select("*", from_here.alias("__rest")).select("*", F.lead("__rest").over(by_time).alias("__next"))
    summed = rows.select(
        "*",
        *[F.sum(c).over(until).alias(f"__until_{m}") for m, c in measures.items()],
        *[F.sum(c).over(w).alias(f"__before_{s}_{m}") for s, w in before.items() for m, c in measures.items() if m != "f" or s == "30d"],
        F.max(F.struct(month.alias("m"), F.col(amount).alias("x"))).over(until).alias("__head"),
        # The first row of the month-long window, as the one after the last row before it.
        F.coalesce(F.last("__next").over(before["30d"]), F.first("__rest").over(by_time.rangeBetween(Window.unboundedPreceding, 0))).alias("__tail"),
    )
    untimed = F.col(_MS).isNull()

    def total(suffix: str, measure: str) -> Column:
        up, low = F.coalesce(F.col(f"__until_{measure}"), F.lit(0)), F.coalesce(F.col(f"__before_{suffix}_{measure}"), F.lit(0))
        return F.when(untimed, up).otherwise(up - low)

    def amounts(suffix: str) -> Column:
        if "s" in measures:
            return total(suffix, "s")
        large = F.when(total(suffix, "nb") > 0, total(suffix, "big")).otherwise(0.0)
        return total(suffix, "hi") / 1024.0 + total(suffix, "lo") + large

    def mean(suffix: str) -> Column:
        valued = total(suffix, "v")
        if not isinstance(kind, T.DecimalType):
            return F.when(valued > 0, amounts(suffix) / valued)
        average = T.DecimalType(min(38, kind.precision + 4), min(38, kind.scale + 4))
        return F.when(valued > 0, (amounts(suffix) / valued.cast("decimal(20,0)")).cast(average))

    head = F.when(untimed | (F.col("__head.m") == month), F.col("__head.x"))
    tail = F.when(F.col("__tail.m") == 1 - month, F.col("__tail.x"))
    return summed.select(
        *timed.columns,
        *[total(s, "n").alias(f"count_claims_{s}") for s in HORIZON_DAYS],
        *[amounts(s).cast("double").alias(f"sum_amount_{s}") for s in HORIZON_DAYS],
        mean("7d").alias("avg_amount_7d"),
        mean("30d").alias("avg_amount_30d"),
        F.greatest(head, tail).alias("max_amount_30d"),
        total("30d", "f").alias("num_fraud_confirmed_30d"),
    ).withColumn("claims_7d_vs_avg_30d_ratio", ratio())


def training_features(enriched: DataFrame, **options) -> DataFrame:
    """Training twin: validated claims with their labels."""
    return rolling_features(enriched, **options).select("policy_id", "timestamp", *FEATURES)


def inference_features(claims: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Inference twin: raw claims; a claim without a label counts as not fraud."""
    from tidemark.operators.labels import labels_or_zero

    options.setdefault("count_on", claims)
    return training_features(labels_or_zero(claims, labels), **options)
