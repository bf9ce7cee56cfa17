"""Type-2 history of slowly changing records: versions with half-open validity.

Ordinary keys take one exchange and one sort: a row is kept if it is the last of its key and
sequence value, then if it differs from the version before it, then it ends where the next
version starts. Hot keys run the same three steps by slices of the sequence (ranges of equal size, so of
any type that can be ordered), each slice taking the neighbour it lacks from the nearest non-empty slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.skew import RUNNING_ROWS_PER_KEY, attach, hot_keys, split_hot
from tidemark.session import ensure_checkpoint_dir

START, END = "__START_AT", "__END_AT"
_SLICE = "__slice"


def scd2(
    feed: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    exclude: Sequence[str] = (),
    tie_breaker: Sequence[str] = (),
    collapse_unchanged: bool = True,
    max_rows_per_key: int = RUNNING_ROWS_PER_KEY,
    count_on: DataFrame | None = None,
) -> DataFrame:
    """Versions of each key with ``__START_AT`` and ``__END_AT`` (null for the open one).

    Of several rows with one key and sequence value, the largest by ``tie_breaker``, then by
    the other columns, is kept. ``exclude`` and ``tie_breaker`` columns are not part of a
    version; ``sequence_by`` stays. With ``collapse_unchanged`` a row equal to the version
    before it starts no new version.
    """
    keys = list(keys)
    rows = feed.drop(*[c for c in exclude if c not in tie_breaker])
    tracked = [c for c in rows.columns if c not in {*keys, sequence_by, *tie_breaker, *exclude}]
    order = [*tie_breaker, *tracked]
    args = (keys, sequence_by, order, tracked, collapse_unchanged)
    hot = hot_keys(rows if count_on is None else count_on, keys, max_rows_per_key)
    if hot is None:
        return _versions(rows, *args)
    ordinary, heavy = split_hot(rows, hot)
    return _versions(ordinary, *args).unionByName(_versions_by_slices(heavy, *args))


def _shape(df: DataFrame, keys, sequence_by, tracked, end: Column) -> DataFrame:
    return df.select(
        *keys, sequence_by, *tracked, F.col(sequence_by).alias(START), end.alias(END)
    )


def _versions(rows, keys, sequence_by, order, tracked, collapse):
    by_seq = Window.partitionBy(*keys).orderBy(sequence_by, *order)
    following = F.lead(F.struct(sequence_by)).over(by_seq)
    last_of_value = following.isNull() | ~following[sequence_by].eqNullSafe(F.col(sequence_by))
    kept = rows.withColumn("__last", last_of_value).filter("__last").drop("__last")
    if collapse:
        state = F.struct(*tracked)
        changed = ~F.lag(state).over(by_seq).eqNullSafe(state)
        kept = kept.withColumn("__new", changed).filter("__new").drop("__new")
    return _shape(kept, keys, sequence_by, tracked, F.lead(sequence_by).over(by_seq))


def _versions_by_slices(rows, keys, sequence_by, order, tracked, collapse):
    kept = rows.groupBy(*keys, sequence_by).agg(F.max(F.struct(*order)).alias("__row"))
    kept = kept.select(*keys, sequence_by, *[F.col(f"__row.{c}").alias(c) for c in tracked])
    kept = _sliced(kept, [*keys, sequence_by])
    in_slice = Window.partitionBy(*keys, _SLICE).orderBy(sequence_by)
    by_slice = Window.partitionBy(*keys).orderBy(_SLICE)
    if collapse:
        state = F.struct(*tracked)
        ends = kept.groupBy(*keys, _SLICE).agg(F.max(F.struct(sequence_by, state.alias("__state"))).alias("__ends"))
        before = ends.select(*keys, _SLICE, F.lag("__ends.__state").over(by_slice).alias("__before"))
        local = kept.withColumn("__prev", F.lag(state).over(in_slice))
        chained = attach(local, before, [*keys, _SLICE])
        previous = F.coalesce("__prev", "__before")
        kept = chained.filter(~previous.eqNullSafe(state)).drop("__prev", "__before")
    # In structs, so that a neighbour whose value is null is not taken for a missing one.
    here = F.struct(sequence_by)
    starts = kept.groupBy(*keys, _SLICE).agg(F.min(here).alias("__starts"))
    after = starts.select(*keys, _SLICE, F.lead("__starts").over(by_slice).alias("__after"))
    local = kept.withColumn("__next", F.lead(here).over(in_slice))
    end = F.coalesce("__next", "__after")[sequence_by]
    return _shape(attach(local, after, [*keys, _SLICE]), keys, sequence_by, tracked, end)


def _sliced(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with the number of its range of ``columns``, whatever their types; nulls come first. Checkpointed, so that
    every use sees the same ranges."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    ranges = df.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *columns)
    return ranges.withColumn(_SLICE, F.spark_partition_id()).checkpoint()


def current_versions(history: DataFrame) -> DataFrame:
    """The open version of each key."""
    return history.filter(F.col(END).isNull())
