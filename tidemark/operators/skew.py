"""Keys that hold too many rows for one task.

A window over a key runs in one task. The operators in this package therefore ask which keys
hold more than a given number of rows, run those keys by time slices with a carry between
slices, and run all other keys with one plain window.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir

# Growing frames and sorts are linear in the rows of a key and spill to disk.
RUNNING_ROWS_PER_KEY = 1_000_000

# Up to this many hot keys are held as literal rows and broadcast; more stay a table and are
# joined by shuffle.
_BROADCAST_KEYS = 10_000


@dataclass(frozen=True)
class HotKeys:
    """Keys above the limit. There are at most (rows of the input / limit) of them."""

    keys: tuple[str, ...]
    frame: DataFrame
    small: bool


def hot_keys(df: DataFrame, keys: Sequence[str], max_rows: int) -> HotKeys | None:
    """Keys of ``df`` with more than ``max_rows`` rows, or None. Runs one count per key,
    combined before its shuffle and reading the key columns only."""
    keys = tuple(keys)
    found = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__n"))
        .filter(F.col("__n") > max_rows)
        .select(*keys)
    )
    head = found.limit(_BROADCAST_KEYS + 1).collect()
    if not head:
        return None
    if len(head) <= _BROADCAST_KEYS:
        return HotKeys(keys, df.sparkSession.createDataFrame(head, found.schema), True)
    ensure_checkpoint_dir(df.sparkSession)
    return HotKeys(keys, found.checkpoint(), False)


def split_hot(df: DataFrame, hot: HotKeys) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary keys, rows of hot keys); a null key is a key like any other."""
    right = hot.frame.select(*[F.col(k).alias(f"__hot_{k}") for k in hot.keys])
    if hot.small:
        right = F.broadcast(right)
    on = _same([(k, f"__hot_{k}") for k in hot.keys])
    return df.join(right, on, "left_anti"), df.join(right, on, "left_semi")


def mark_hot(df: DataFrame, count_on: DataFrame, key: str, max_rows: int, mark: str) -> DataFrame:
    """``df`` with a column that says whether its key has more than ``max_rows`` rows in ``count_on``, and more than a
    10,000th of all of them, so that there are at most 10,000 such keys to broadcast. Part of the plan; runs nothing."""
    sizes = count_on.groupBy(F.col(key).alias("__hot")).agg(F.count(F.lit(1)).alias("__n"))
    least = F.coalesce(sizes.agg(F.sum("__n")).scalar() / _BROADCAST_KEYS, F.lit(0.0))
    hot = sizes.filter((F.col("__n") > max_rows) & (F.col("__n") > least)).select("__hot", F.lit(True).alias(mark))
    joined = df.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("__hot")), "left")
    return joined.drop("__hot").withColumn(mark, F.coalesce(mark, F.lit(False)))


def _same(pairs):
    on = F.lit(True)
    for left, right in pairs:
        on = on & F.col(left).eqNullSafe(F.col(right))
    return on


def attach(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on null-safe equal ``keys``; ``right`` must be unique on them."""
    renamed = right.select(
        *[F.col(k).alias(f"__on_{k}") for k in keys],
        *[c for c in right.columns if c not in keys],
    )
    joined = left.join(renamed, _same([(k, f"__on_{k}") for k in keys]), "left")
    return joined.drop(*[f"__on_{k}" for k in keys])
