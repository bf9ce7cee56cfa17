"""Checks on a built training set: nulls, row counts, class balance, keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, n_rows, n_null) for every column, counted in one pass."""
    columns = list(columns or df.columns)
    counts = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(F.lit(1)).alias("n_rows"),
                F.count_if(F.col(c).isNull()).alias("n_null"),
            ).alias(f"c{i}")
            for i, c in enumerate(columns)
        ]
    )
    return counts.select(F.inline(F.array(*[f"c{i}" for i in range(len(columns))])))


def row_consistency(spine: DataFrame, enriched: DataFrame) -> DataFrame:
    """One row: rows of both tables and whether they agree."""
    counts = spine.agg(
        F.count(F.lit(1)).alias("spine_rows"),
    ).withColumn("enriched_rows", enriched.agg(F.count(F.lit(1))).scalar())
    return counts.withColumn("consistent", F.col("spine_rows") == F.col("enriched_rows"))


def class_balance(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Rows and percentage (2 decimals) per label value, null being a value of its own."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", F.round(F.col("n") / total * 100, 2)).orderBy(label)


def count_by(df: DataFrame, column: str, values: Sequence[int] = (0, 1)) -> DataFrame:
    """One row: all rows, rows and percentage for each of ``values``, in one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n_total"),
        *[F.count_if(F.col(column) == v).alias(f"n_{v}") for v in values],
    )
    shares = [F.try_divide(F.col(f"n_{v}") * 100, F.col("n_total")).alias(f"pct_{v}") for v in values]
    return counts.select("*", *shares)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys found more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if ``keys`` do not identify the rows; shows one offender."""
    found = duplicate_keys(df, keys).head(1)
    if found:
        raise ValueError(f"not unique on {list(keys)}: {found[0].asDict()}")


def class_weights(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """One row: class counts and inverse-frequency weights n / (2 n_c), 1.0 for an empty class.

    Rows without label count as the negative class.
    """
    counts = df.agg(
        F.count(F.lit(1)).alias("n_total"), F.count_if(F.col(label) == 1).alias("n_fraud")
    ).withColumn("n_legit", F.col("n_total") - F.col("n_fraud"))

    def weight(n: str):
        return F.when(F.col(n) > 0, F.col("n_total") / (2.0 * F.col(n))).otherwise(F.lit(1.0))

    return counts.select(
        "*", weight("n_fraud").alias("weight_fraud"), weight("n_legit").alias("weight_legit")
    )


def with_class_weights(df: DataFrame, label: str = "is_fraud", out: str = "class_weight") -> DataFrame:
    """Each row with the weight of its class. The two weights are one scalar subquery."""
    weights = class_weights(df, label).select(F.struct("weight_fraud", "weight_legit")).scalar()
    return (
        df.withColumn("__w", weights)
        .withColumn(out, F.when(F.col(label) == 1, F.col("__w.weight_fraud")).otherwise(F.col("__w.weight_legit")))
        .drop("__w")
    )
