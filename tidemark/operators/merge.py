"""Idempotent upserts and change feeds between table versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.skew import attach


def pending(spine: DataFrame, done: DataFrame, key: str = "claim_id") -> DataFrame:
    """Spine rows whose key is not in ``done``, which is reduced to distinct keys first."""
    return spine.join(done.select(key).distinct(), key, "left_anti")


def pending_labels(
    labels: DataFrame, scored: DataFrame, key: str = "claim_id", label: str = "is_fraud"
) -> DataFrame:
    """(key, label) of labels whose claim is not yet labelled in ``scored``."""
    labelled = scored.filter(F.col(label).isNotNull())
    return pending(labels, labelled, key).select(key, label)


def merge_insert(target: DataFrame, source: DataFrame, key: str = "claim_id") -> DataFrame:
    """Target plus the source rows whose key it lacks. Doing it twice adds nothing."""
    return target.unionByName(pending(source, target, key))


def merge_update(
    target: DataFrame, source: DataFrame, key: str = "claim_id", columns: Sequence[str] = ("is_fraud",)
) -> DataFrame:
    """Target with ``columns`` taken from the matching source row.

    Unmatched source rows are ignored. Two source rows for one target row are an error, raised
    when the plan runs: the source is combined per key before the join, so the check needs no
    pass of its own.
    """
    names = [f"__new_{c}" for c in columns]
    one = source.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("__n"),
        F.max(F.struct(*[F.col(c).alias(n) for c, n in zip(columns, names)])).alias("__row"),
    )
    joined = target.join(one, key, "left")
    ambiguous = F.col("__n") > 1
    updated = {
        c: F.when(F.col("__n").isNull(), F.col(c))
        .when(
            ambiguous,
            F.raise_error(F.concat(F.lit("several source rows for key "), F.col(key).cast("string"))),
        )
        .otherwise(F.col(f"__row.{n}"))
        for c, n in zip(columns, names)
    }
    return joined.select(*[updated[c].alias(c) if c in updated else c for c in target.columns])


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Change feed from ``old`` to ``new``: rows with ``op`` insert, update or delete.

    Both are unique on ``keys``. Inserts and updates carry the new row, deletes the old one;
    rows equal in all columns are left out.
    """
    keys = list(keys)
    columns = [c for c in new.columns if c not in keys]

    def packed(df: DataFrame, name: str) -> DataFrame:
        return df.select(*[F.col(k).alias(f"{name}_{k}") for k in keys], F.struct(*columns).alias(name))

    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"old_{k}").eqNullSafe(F.col(f"new_{k}"))
    both = packed(old, "old").join(packed(new, "new"), on, "full_outer")
    op = (
        F.when(F.col("old").isNull(), "insert")
        .when(F.col("new").isNull(), "delete")
        .when(~F.col("old").eqNullSafe(F.col("new")), "update")
    )
    key_columns = [
        F.when(F.col("new").isNull(), F.col(f"old_{k}")).otherwise(F.col(f"new_{k}")).alias(k) for k in keys
    ]
    row = F.coalesce("new", "old").alias("__row")
    changes = both.select(*key_columns, row, op.alias("op")).filter("op IS NOT NULL")
    return changes.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in columns], "op")


def publish_changes(feed: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Apply a change feed to a table holding the latest row per key."""
    keys = list(keys)
    touched = feed.select(*keys, F.lit(True).alias("__touched"))
    kept = attach(target, touched, keys).filter(F.col("__touched").isNull()).drop("__touched")
    return kept.unionByName(feed.filter(F.col("op") != "delete").drop("op"))
