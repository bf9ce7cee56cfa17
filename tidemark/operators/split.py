"""Temporal train / validation / test split."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Window lengths in months and the ends of the first, fixed split.
TRAINING_MONTHS = 36
VALIDATION_MONTHS = 12
FIRST_TRAIN_END = dt.date(2022, 12, 31)
FIRST_VALIDATION_END = dt.date(2023, 12, 31)

TRAIN, VALIDATION, TEST = "train", "validation", "test"


def months_before(day: dt.date, months: int) -> dt.date:
    """The same day ``months`` earlier, or the last day of that month."""
    index = day.year * 12 + day.month - 1 - months
    year, month = divmod(index, 12)
    first_of_next = dt.date(year + (month == 11), (month + 1) % 12 + 1, 1)
    last = (first_of_next - dt.timedelta(days=1)).day
    return dt.date(year, month + 1, min(day.day, last))


@dataclass(frozen=True)
class SplitSpec:
    """Inclusive calendar days; ``test_end`` None leaves the test split open."""

    train_start: dt.date
    train_end: dt.date
    validation_end: dt.date
    test_end: dt.date | None = None
    inclusive_midnight: bool = False

    @classmethod
    def fixed(cls, **options) -> SplitSpec:
        """Split of the first data version."""
        return cls._ending(FIRST_TRAIN_END, FIRST_VALIDATION_END, TRAINING_MONTHS, **options)

    @classmethod
    def rolling(
        cls,
        previous_max_date: dt.date,
        validation_months: int = VALIDATION_MONTHS,
        training_months: int = TRAINING_MONTHS,
        **options,
    ) -> SplitSpec:
        """Split anchored at the newest day of the previous cycle: all newer rows are test."""
        train_end = months_before(previous_max_date, validation_months)
        return cls._ending(train_end, previous_max_date, training_months, **options)

    @classmethod
    def _ending(cls, train_end, validation_end, training_months, **options) -> SplitSpec:
        return cls(months_before(train_end, training_months), train_end, validation_end, **options)

    def condition(self, ts: str, split: str) -> Column:
        """Rows of one split.

        Splits are whole days [first, last + 1 day). With ``inclusive_midnight`` a split ends
        at the first instant of its last day, so rows later on that day are in no split.
        """
        day = dt.timedelta(days=1)
        first, last = {
            TRAIN: (self.train_start, self.train_end),
            VALIDATION: (self.train_end + day, self.validation_end),
            TEST: (self.validation_end + day, self.test_end),
        }[split]
        inside = F.col(ts) >= F.lit(first)
        if last is None:
            return inside
        if self.inclusive_midnight:
            return inside & (F.col(ts) <= F.lit(last))
        return inside & (F.col(ts) < F.lit(last + day))


def max_event_date(df: DataFrame, ts: str = "timestamp") -> dt.date | None:
    """Calendar day of the newest row."""
    return df.agg(F.max(ts).cast("date")).first()[0]


def temporal_split(df: DataFrame, ts: str, spec: SplitSpec) -> dict[str, DataFrame]:
    """The three splits by name."""
    return {s: df.filter(spec.condition(ts, s)) for s in (TRAIN, VALIDATION, TEST)}


def with_split(df: DataFrame, ts: str, spec: SplitSpec) -> DataFrame:
    """All rows with ``split``, null outside the three."""
    name = F
    for s in (TRAIN, VALIDATION, TEST):
        name = name.when(spec.condition(ts, s), s)
    return df.withColumn("split", name)


# Training modes and the splits each one joins.
MODES = {TRAIN: (TRAIN,), "train_val": (TRAIN, VALIDATION), "all": (TRAIN, VALIDATION, TEST)}


def training_rows(splits: dict[str, DataFrame], mode: str = TRAIN) -> DataFrame:
    """Rows of the splits of ``mode``, with class weights of exactly these rows."""
    from tidemark.operators.checks import with_class_weights

    first, *rest = [splits[s] for s in MODES[mode]]
    rows = first
    for split in rest:
        rows = rows.unionByName(split)
    return with_class_weights(rows)
