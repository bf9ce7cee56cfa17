"""Point-in-time (as-of) joins: for each spine row the last feature row not later than it.

Features and spine are united and one running window per key carries the last feature row
forward, so any number of lookups on the same key costs one exchange. Hot keys run by hour
slices: the window runs inside a (key, hour), and each hour takes the last feature row of the
hours before it as its carry.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.time import US_PER_HOUR, epoch_us
from tidemark.operators.skew import (
    RUNNING_ROWS_PER_KEY,
    attach,
    hot_keys,
    split_hot,
)

_US, _HOUR, _SPINE = "__us", "__hour_us", "__spine"
_UNTIL = "__valid_to_us"


@dataclass(frozen=True)
class FeatureTable:
    """A table with one row per entity key and instant."""

    frame: DataFrame
    keys: tuple[str, ...]
    ts: str


@dataclass(frozen=True)
class FeatureLookup:
    """Which features to take from a feature table, as of the spine's time.

    ``valid_to`` names an exclusive end of validity; a row past it does not match.
    ``unique`` states that keys and time identify a feature row; otherwise the largest of the
    feature values at one instant is taken, so that the result does not depend on row order.
    """

    table: FeatureTable
    features: tuple[str, ...]
    valid_to: str | None = None
    unique: bool = False

    def rows(self, name: str) -> DataFrame:
        """Keys, instant and the features as one struct, which is null only without a match."""
        df = self.table.frame
        kept = df.dropna(subset=[*self.table.keys, self.table.ts])
        until = epoch_us(df, self.valid_to) if self.valid_to else F.lit(None).cast("long")
        payload = F.struct(*self.features, until.alias(_UNTIL))
        rows = kept.select(*self.table.keys, epoch_us(df, self.table.ts).alias(_US), payload.alias(name))
        if self.unique:
            return rows
        return rows.groupBy(*self.table.keys, _US).agg(F.max(name).alias(name))


def asof_join(
    spine: DataFrame,
    lookups: Sequence[FeatureLookup],
    ts: str,
    max_rows_per_key: int = RUNNING_ROWS_PER_KEY,
    count_on: DataFrame | None = None,
) -> DataFrame:
    """Every spine row with the features of each lookup as of its time, null without a match.

    Rows of equal time match. A null key never matches. Lookups that share their keys share
    one exchange. ``count_on`` is a cheaper table with the rows per key of spine and features.
    """
    result = spine
    for keys in dict.fromkeys(lookup.table.keys for lookup in lookups):
        group = [lookup for lookup in lookups if lookup.table.keys == keys]
        result = _asof_one_key(result, group, keys, ts, max_rows_per_key, count_on)
    return result


def _asof_one_key(spine, lookups, keys, ts, max_rows_per_key, count_on):
    names = [f"__f{i}" for i in range(len(lookups))]
    tables = [lookup.rows(name) for lookup, name in zip(lookups, names)]
    timed = spine.withColumn(_US, epoch_us(spine, ts))
    if count_on is None:
        count_on = spine.select(*keys)
        for lookup in lookups:
            count_on = count_on.unionByName(lookup.table.frame.select(*keys))
    hot = hot_keys(count_on, keys, max_rows_per_key)
    if hot is None:
        matched = _running(timed, tables, names, keys)
    else:
        parts = [split_hot(table, hot) for table in tables]
        ordinary, heavy = split_hot(timed, hot)
        matched = _running(ordinary, [p[0] for p in parts], names, keys).unionByName(
            running_by_hours(heavy, [p[1] for p in parts], names, keys)
        )
    return unpack(matched, names, lookups).drop(_US)


def united(timed: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """Spine rows, marked, and feature rows in one table."""
    rows = timed.withColumn(_SPINE, F.lit(True))
    for table in tables:
        rows = rows.unionByName(table, allowMissingColumns=True)
    return rows


def last_known(names: list[str], keys: Sequence[str]) -> list[Column]:
    """The last non-null struct of each lookup up to and including the row's instant."""
    so_far = Window.partitionBy(*keys).orderBy(_US).rangeBetween(Window.unboundedPreceding, 0)
    return [F.last(name, ignorenulls=True).over(so_far).alias(name) for name in names]


def _running(timed, tables, names, keys):
    rows = united(timed, tables)
    others = [c for c in rows.columns if c not in names]
    return rows.select(*others, *last_known(names, keys)).filter(_SPINE).drop(_SPINE)


def running_by_hours(timed, tables, names, keys):
    instants = timed.select(*keys, _US).distinct()
    rows = united(instants, tables).withColumn(_HOUR, F.floor(F.col(_US) / US_PER_HOUR))
    carried = rows.groupBy(*keys, _HOUR).agg(
        *[F.max_by(n, F.when(F.col(n).isNotNull(), F.col(_US))).alias(n) for n in names]
    )
    before = Window.partitionBy(*keys).orderBy(_HOUR).rowsBetween(Window.unboundedPreceding, -1)
    carried = carried.select(
        *keys, _HOUR, *[F.last(n, ignorenulls=True).over(before).alias(f"{n}_carry") for n in names]
    )
    local = rows.select(*keys, _US, _HOUR, _SPINE, *last_known(names, [*keys, _HOUR]))
    found = attach(local.filter(_SPINE).drop(_SPINE), carried, [*keys, _HOUR]).select(
        *keys, _US, *[F.coalesce(n, f"{n}_carry").alias(n) for n in names]
    )
    return attach(timed, found, [*keys, _US])


def unpack(matched: DataFrame, names: list[str], lookups: Sequence[FeatureLookup]) -> DataFrame:
    """Structs to feature columns; a match past its end of validity is no match."""
    columns = []
    for name, lookup in zip(names, lookups):
        for feature in lookup.features:
            value = F.col(f"{name}.{feature}")
            if lookup.valid_to:
                until = F.col(f"{name}.{_UNTIL}")
                value = F.when(until.isNull() | (F.col(_US) < until), value)
            columns.append(value.alias(feature))
    return matched.select(*[c for c in matched.columns if c not in names], *columns)


def build_training_set(
    spine: DataFrame,
    lookups: Sequence[FeatureLookup],
    ts: str,
    label: str | None = None,
    exclude: Sequence[str] = (),
    max_rows_per_key: int = RUNNING_ROWS_PER_KEY,
    count_on: DataFrame | None = None,
) -> DataFrame:
    """Spine plus all looked-up features without the ``exclude`` columns, as a lazy plan.

    ``label`` must be a spine column; None builds an inference set.
    """
    if label is not None and label not in spine.columns:
        raise ValueError(f"label {label!r} is not a column of the spine")
    return asof_join(spine, lookups, ts, max_rows_per_key, count_on).drop(*exclude)
