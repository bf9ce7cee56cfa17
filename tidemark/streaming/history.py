"""Streaming maintenance of a type-2 history, with work bounded by the changes.

The store keeps, per key, the chain of its change rows: one row per sequence value, with the value at which the
next row takes over and whether the row starts a version (it differs from the row before it). A
hash bucket of keys has a *base* of closed rows and a *tail* of open ones, one per key.

A batch reads the tails of the buckets it touches. Changes later than their key's tail need nothing else; for
others the closed rows that end at or after the earliest such change are read as well, which their
statistics let the scan find. It writes, in one job under its batch id, the rows it closed or changed and the new
tails of its buckets. Earlier files are never rewritten: of several closed rows for one key and sequence value
the last batch's holds, and of several tails of a bucket the last one. So stored rows grow with the changes, and a
batch that is run again replaces its own folder. Tails that two later ones have replaced are removed.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.scd2 import _SLICE, END, START, _sliced
from tidemark.operators.skew import RUNNING_ROWS_PER_KEY, attach, hot_keys, split_hot

BUCKETS = 256
_BUCKET, _BATCH, _STATE = "key_bucket", "batch_id", "state"
_TIE, _STARTS, _UNTIL = "__tie", "__starts", "__until"
_PREV, _NEXT = "__prev", "__next"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def folders(spark: SparkSession, pattern: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return [f.getPath().toString() for f in found or []]


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _tails(spark: SparkSession, path: str) -> dict[int, dict[int, str]]:
    """Folder of each tail, by bucket and batch; at most three a bucket."""
    out: dict[int, dict[int, str]] = {}
    for folder in folders(spark, f"{path}/{_BATCH}=*/{_STATE}=open/{_BUCKET}=*"):
        batch, bucket = re.search(rf"{_BATCH}=(\d+)/{_STATE}=open/{_BUCKET}=(\d+)$", folder).groups()
        out.setdefault(int(bucket), {})[int(batch)] = folder
    return out


def _linked(rows: DataFrame, keys: list[str], state: Column, max_rows_per_key: int, count_on: DataFrame) -> DataFrame:
    """Adds the state of the row before (``__prev``, a struct) and the next sequence value (``__next``, a struct).

    Rows are unique on key and sequence value. Hot keys are linked by ranges of it, as in ``scd2``.
    """
    here, before = F.struct(START), F.struct(state.alias("s"))

    def plain(df: DataFrame, by: list[str]) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(START)
        return df.withColumns({_PREV: F.lag(before).over(order), _NEXT: F.lead(here).over(order)})

    hot = hot_keys(count_on, keys, max_rows_per_key)
    if hot is None:
        return plain(rows, keys)
    ordinary, heavy = split_hot(rows, hot)
    sliced = _sliced(heavy, [*keys, START])
    ends = sliced.groupBy(*keys, _SLICE).agg(F.max_by(before, here).alias("__last"), F.min(here).alias("__first"))
    by_slice = Window.partitionBy(*keys).orderBy(_SLICE)
    around = ends.select(*keys, _SLICE, F.lag("__last").over(by_slice).alias("__before"), F.lead("__first").over(by_slice).alias("__after"))
    joined = attach(plain(sliced, [*keys, _SLICE]), around, [*keys, _SLICE])
    filled = joined.withColumns({_PREV: F.coalesce(_PREV, "__before"), _NEXT: F.coalesce(_NEXT, "__after")})
    return plain(ordinary, keys).unionByName(filled.drop("__before", "__after", _SLICE))


def scd2_stream(
    feed: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    sequence_by: str,
    exclude: Sequence[str] = (),
    tie_breaker: Sequence[str] = (),
    collapse_unchanged: bool = True,
    buckets: int = BUCKETS,
    once: bool = True,
    max_rows_per_key: int = RUNNING_ROWS_PER_KEY,
) -> StreamingQuery:
    """Keep the history under ``path`` up to date with a stream of changes, in any order. Versions are those of ``scd2``."""
    keys = list(keys)
    tracked = [c for c in feed.columns if c not in {*keys, sequence_by, *tie_breaker, *exclude}]
    payload = [*([_TIE] if tie_breaker else []), *tracked]

    def row_of(changes: DataFrame) -> DataFrame:
        tie = [F.struct(*tie_breaker).alias(_TIE)] if tie_breaker else []
        return changes.select(*keys, sequence_by, F.col(sequence_by).alias(START), *tie, *tracked)

    typed = row_of(feed).schema
    chain = T.StructType([*typed.fields, T.StructField(_STARTS, T.BooleanType()), T.StructField(_UNTIL, typed[START].dataType)])

    def closed_rows(spark: SparkSession, batch_id: int, touched: list[int], late: DataFrame) -> DataFrame | None:
        """Closed rows of late keys that end at or after their earliest change, as the last batch left them."""
        earliest = late.agg(F.min("__earliest").alias("e"))
        found = earliest.select(F.col("e").isNotNull().alias("any"), F.col(f"e.{START}").isNotNull().alias("bound")).first()
        closed = f"{path}/{_BATCH}=*/{_STATE}=closed"
        if not found["any"] or not folders(spark, closed):
            return None
        places = [T.StructField(_BATCH, T.LongType()), T.StructField(_STATE, T.StringType()), T.StructField(_BUCKET, T.IntegerType())]
        kept = spark.read.schema(T.StructType([*chain.fields, *places])).option("basePath", path).parquet(closed)
        kept = kept.filter((F.col(_BATCH) < batch_id) & F.col(_BUCKET).isin(touched))
        if found["bound"]:  # rows without a sequence value come first
            kept = kept.filter(F.col(_UNTIL) >= earliest.select(f"e.{START}").scalar())
        wanted = attach(kept, late, keys).filter(F.struct(F.col(_UNTIL).alias(START)) >= F.col("__earliest")).drop("__earliest")
        row = F.struct(*[c for c in chain.names if c not in keys])
        last = wanted.groupBy(*keys, START).agg(F.max_by(row, F.col(_BATCH)).alias("__row"))
        return last.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in chain.names])

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        incoming = f"{path}/incoming-{batch_id}"
        row_of(batch).write.mode("overwrite").parquet(incoming)
        changes = spark.read.schema(typed).parquet(incoming)
        touched = [r[0] for r in changes.select(bucket_of(keys, buckets)).distinct().collect()]  # at most ``buckets``
        if not touched:
            remove(spark, incoming)
            return
        tails = _tails(spark, path)
        newest = {b: max((n for n in tails.get(b, {}) if n < batch_id), default=None) for b in touched}
        known = [tails[b][n] for b, n in newest.items() if n is not None]
        stored = spark.read.schema(chain).parquet(*known) if known else spark.createDataFrame([], chain)
        here = F.struct(START)
        first = changes.groupBy(*keys).agg(F.min(here).alias("__earliest"))
        late = attach(stored.select(*keys, here.alias("__tail")), first, keys).filter(F.col("__earliest") <= F.col("__tail")).select(*keys, "__earliest")
        if known and (base := closed_rows(spark, batch_id, touched, late)) is not None:
            stored = stored.unionByName(base)
        old = F.struct(F.struct(*payload).alias("p"), _STARTS, _UNTIL)
        rows = stored.select(*keys, START, F.struct(*payload).alias("__p"), old.alias("__old")).unionByName(
            changes.select(*keys, START, F.struct(*payload).alias("__p")), allowMissingColumns=True
        )
        # The largest row of a key and sequence value holds; at most one of them is a stored one.
        rows = rows.groupBy(*keys, START).agg(F.max("__p").alias("__p"), F.first("__old", ignorenulls=True).alias("__old"))
        state = F.struct(*[F.col(f"__p.{c}").alias(c) for c in tracked])
        linked = _linked(rows, keys, state, max_rows_per_key, changes)
        if collapse_unchanged:
            # The first row read has no change before it: its flag stands, unless it is new or replaced and so the key's first.
            as_before = F.when(F.col("__old.p").eqNullSafe(F.col("__p")), F.col(f"__old.{_STARTS}")).otherwise(True)
            starts = F.when(F.col(_PREV).isNull(), as_before).otherwise(~F.col(f"{_PREV}.s").eqNullSafe(state))
        else:
            starts = F.lit(True)
        until = F.col(f"{_NEXT}.{START}")
        now = F.struct(F.col("__p").alias("p"), starts.alias(_STARTS), until.alias(_UNTIL))
        changed = linked.filter(F.col(_NEXT).isNull() | ~F.col("__old").eqNullSafe(now))
        out = changed.select(
            *keys, F.col(START).alias(sequence_by), START, *[F.col(f"__p.{c}").alias(c) for c in payload], starts.alias(_STARTS), until.alias(_UNTIL),
            F.when(F.col(_NEXT).isNull(), "open").otherwise("closed").alias(_STATE), bucket_of(keys, buckets).alias(_BUCKET),
        )
        out.hint("rebalance", _STATE, _BUCKET).write.mode("overwrite").partitionBy(_STATE, _BUCKET).parquet(f"{path}/{_BATCH}={batch_id}")
        for bucket, last in newest.items():
            for n, folder in tails.get(bucket, {}).items():
                if last is not None and n < last:
                    remove(spark, folder)
        remove(spark, incoming)

    writer = feed.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def stored_rows(spark: SparkSession, path: str) -> DataFrame:
    """``state, n_rows`` of the whole store, replaced rows included."""
    return spark.read.option("basePath", path).parquet(f"{path}/{_BATCH}=*").groupBy(_STATE).agg(F.count(F.lit(1)).alias("n_rows"))


def read_history(spark: SparkSession, path: str, keys: Sequence[str], max_rows_per_key: int = RUNNING_ROWS_PER_KEY) -> DataFrame:
    """The maintained history: versions with their validity, as ``scd2`` has them."""
    keys = list(keys)
    newest = {b: max(found.items()) for b, found in _tails(spark, path).items()}
    tails = spark.read.parquet(*[folder for _, folder in newest.values()])
    rows = tails.drop(_BATCH, _STATE, _BUCKET)
    if closed := folders(spark, f"{path}/{_BATCH}=*/{_STATE}=closed"):
        base = spark.read.option("basePath", path).parquet(*closed)
        # A batch counts in a bucket once its tail is there.
        done = spark.createDataFrame([(b, n) for b, (n, _) in newest.items()], "b int, n long")
        base = base.join(F.broadcast(done), (F.col(_BUCKET) == F.col("b")) & (F.col(_BATCH) <= F.col("n"))).drop("b", "n")
        row = F.struct(*[c for c in rows.columns if c not in (*keys, START)])
        last = base.groupBy(*keys, START).agg(F.max_by(row, F.col(_BATCH)).alias("__row"))
        rows = rows.unionByName(last.select(*keys, START, "__row.*"))
    versions = rows.filter(_STARTS)
    linked = _linked(versions, keys, F.lit(0), max_rows_per_key, versions)
    names = [c for c in rows.columns if c not in (START, _TIE, _STARTS, _UNTIL)]
    return linked.select(*names, START, F.col(f"{_NEXT}.{START}").alias(END))
