"""Continuous publication of changes: the latest row per key, kept up to date by a change feed.

A change is a whole row with an operation and the version of the state it leads to. The store keeps, per hash bucket of the
keys, the last change of every key, deletions too, so a change that comes late, twice, or after a newer one is
known as such and does nothing. A call reads only the buckets that its changes fall into and writes, as a new
generation, only those where something is newer. Readers take the newest generation of each bucket; the one before
stays for readers that have begun, older ones are removed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.skew import attach
from tidemark.streaming.history import bucket_of, folders, remove

BUCKETS = 256
OP, VERSION = "op", "version"
_BUCKET, _GENERATION = "key_bucket", "generation"


def _newest(spark: SparkSession, path: str) -> dict[int, list[tuple[int, str]]]:
    """Generations of each bucket, newest first."""
    out: dict[int, list[tuple[int, str]]] = {}
    for folder in folders(spark, f"{path}/{_GENERATION}=*/{_BUCKET}=*"):
        generation, bucket = (int(part.split("=")[1]) for part in folder.split("/")[-2:])
        out.setdefault(bucket, []).append((generation, folder))
    return {b: sorted(found, reverse=True) for b, found in out.items()}


def publish(changes: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> list[int]:
    """Apply ``changes`` (rows with ``op``, insert, update or delete, and ``version``); the buckets that were rewritten.

    Of several changes of a key the one of the highest version holds; of equal ones any, as they lead to the same state.
    """
    spark, keys = changes.sparkSession, list(keys)
    rest = [c for c in changes.columns if c not in (*keys, VERSION)]
    last = changes.groupBy(*keys).agg(F.max(VERSION).alias(VERSION), F.max_by(F.struct(*rest), VERSION).alias("__row"))
    last = last.select(*keys, VERSION, "__row.*").withColumn(_BUCKET, bucket_of(keys, buckets))
    store = _newest(spark, path)
    touched = [r[0] for r in last.select(_BUCKET).distinct().collect()]  # at most ``buckets``
    known = [store[b][0][1] for b in touched if b in store]
    if known:
        held = spark.read.option("basePath", path).parquet(*known).drop(_GENERATION)
        newer = attach(last, held.select(*keys, F.col(VERSION).alias("__held")), keys)
        newer = newer.filter(F.col("__held").isNull() | (F.col(VERSION) > F.col("__held"))).drop("__held")
        stale = [r[0] for r in newer.select(_BUCKET).distinct().collect()]
        both = held.filter(F.col(_BUCKET).isin(stale)).unionByName(newer)
        row = F.struct(*rest, _BUCKET)
        last = both.groupBy(*keys).agg(F.max(VERSION).alias(VERSION), F.max_by(row, VERSION).alias("__row")).select(*keys, VERSION, "__row.*")
    else:
        stale = touched
    if not stale:
        return []
    generation = 1 + max((g for found in store.values() for g, _ in found), default=-1)
    last.hint("rebalance", _BUCKET).write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{path}/{_GENERATION}={generation}")
    for bucket in stale:
        for _, folder in store.get(bucket, [])[1:]:
            remove(spark, folder)
    return sorted(stale)


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The published rows: the last one of every key that was not deleted."""
    newest = [found[0][1] for found in _newest(spark, path).values()]
    rows = spark.read.option("basePath", path).parquet(*newest)
    return rows.filter(F.col(OP) != "delete").drop(OP, VERSION, _BUCKET, _GENERATION)
