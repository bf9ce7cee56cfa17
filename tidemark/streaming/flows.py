"""Streams: append sink, quarantine routes, late-label join, tumbling features."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.rules import Rule
from tidemark.operators.labels import (
    CLAIM_WATERMARK,
    LABEL_WATERMARK,
    MAX_LABEL_DELAY,
    join_late_labels,
)
from tidemark.operators.quality import FLAG, OUTCOMES, flag_quarantine, observed, observed_counts

# State of a month of claims is kept on disk, not on the heap.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _settings(spark: SparkSession, **settings: str | None) -> Iterator[None]:
    """A stream takes over settings when it starts and keeps them for its checkpoint's life."""
    names = {name.replace("_", "."): value for name, value in settings.items() if value}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def append_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    once: bool = True,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Append flow into a parquet table; with ``once`` it ends when the input is consumed.

    State is kept on disk, in RocksDB, whatever the session's default. ``state_partitions`` is the number of state
    partitions of a stateful stream, for which one to three per core is a good start; the session's
    shuffle partitions by default.
    """
    writer = (
        df.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    partitions = str(state_partitions) if state_partitions else None
    with _settings(df.sparkSession, spark_sql_shuffle_partitions=partitions, spark_sql_streaming_stateStore_providerClass=ROCKSDB):
        return (writer.trigger(availableNow=True) if once else writer).start()


def route_stream(
    df: DataFrame,
    rules: Sequence[Rule],
    path: str,
    checkpoint: str,
    null_policy: str = "quarantine",
    once: bool = True,
    counts: str | None = None,
) -> StreamingQuery:
    """One evaluated stream, two routes.

    Each batch is evaluated and written in one pass to a folder of its own, split by the
    quarantine flag, so a batch that is run again replaces its rows. Read a route back with
    ``read_route``. With ``counts``, a path, the same pass counts how often each rule passed, failed and was
    undecided; ``read_rule_counts`` adds the batches up.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = None
        if counts:
            batch, seen = observed(batch, rules)
        flagged = flag_quarantine(batch, rules, null_policy).filter(F.col(FLAG).isNotNull())
        flagged.write.mode("overwrite").partitionBy(FLAG).parquet(f"{path}/batch_id={batch_id}")
        if counts:
            found = observed_counts(batch.sparkSession, rules, seen)  # one row a rule
            found.coalesce(1).write.mode("overwrite").parquet(f"{counts}/batch_id={batch_id}")

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_route(spark: SparkSession, path: str, dead_letter: bool = False) -> DataFrame:
    """Rows of one route over all batches; only that route's files are read."""
    return spark.read.parquet(path).filter(F.col(FLAG) == F.lit(dead_letter)).drop("batch_id", FLAG)


def read_rule_counts(spark: SparkSession, path: str) -> DataFrame:
    """``rule, passed, failed, undecided`` over all batches of a routed stream."""
    batches = spark.read.parquet(path)
    return batches.groupBy("rule").agg(*[F.sum(name).alias(name) for name in OUTCOMES])


def stream_late_labels(
    claims: DataFrame,
    labels: DataFrame,
    claim_ts: str = "incident_timestamp",
    label_ts: str = "label_available_timestamp",
    claim_delay: str = CLAIM_WATERMARK,
    label_delay: str = LABEL_WATERMARK,
    max_delay: str = MAX_LABEL_DELAY,
) -> DataFrame:
    """Stream-stream left outer join of claims with labels that arrive up to ``max_delay`` later.

    A claim without a label comes out, with nulls, once both watermarks show that none can come.
    """
    return join_late_labels(
        claims.withWatermark(claim_ts, claim_delay),
        labels.withWatermark(label_ts, label_delay),
        claim_ts,
        label_ts,
        max_delay,
    )


def waiting_rows(spark: SparkSession, checkpoint: str, side: str = "left") -> DataFrame:
    """Rows that wait in the state of a stream-stream join, such as claims (left) whose label may still come.

    Rows that have been matched stay until the watermark passes them too; they are left out.
    """
    state = spark.read.format("statestore").option("joinSide", side).load(checkpoint)
    matched = "matched" in state.schema["value"].dataType.names
    return (state.filter(~F.col("value.matched")) if matched else state).select("value.*").drop("matched")


def label_outcomes(joined: DataFrame, waiting: DataFrame, labels: DataFrame, key: str = "claim_id", claim_ts: str = "incident_timestamp", label: str = "is_fraud") -> DataFrame:
    """``day, matched, waiting, too_late`` by the day of the claim, for a late-label join that has consumed its input.

    ``joined``: what came out; ``waiting``: what is left in the state; ``labels``: all that came in. A label is too late if its
    claim came out without one: it arrived after the watermarks had passed the claim.
    """
    day = F.to_date(claim_ts).alias("day")
    out = joined.select(key, day, F.col(label).isNotNull().alias("known"))
    missed = out.filter("not known").join(labels.select(key).distinct(), key, "left_semi")
    rows = out.filter("known").select("day", F.lit("matched").alias("outcome")).unionByName(
        waiting.select(day, F.lit("waiting").alias("outcome"))
    ).unionByName(missed.select("day", F.lit("too_late").alias("outcome")))
    counts = [F.count_if(F.col("outcome") == name).alias(name) for name in ("matched", "waiting", "too_late")]
    return rows.groupBy("day").agg(*counts)


def tumbling_features(
    df: DataFrame,
    key: str = "policy_id",
    ts: str = "timestamp",
    amount: str = "claimed_amount_eur",
    width: str = "1 day",
    delay: str | None = None,
) -> DataFrame:
    """Count, sum, mean and maximum per key and fixed window; ``delay`` is the watermark of a
    stream. Incremental: only the open windows are kept as state."""
    source = df.withWatermark(ts, delay) if delay else df
    return (
        source.groupBy(key, F.window(ts, width).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("count_claims"),
            F.coalesce(F.sum(amount), F.lit(0.0)).alias("sum_amount"),
            F.avg(amount).alias("avg_amount"),
            F.max(amount).alias("max_amount"),
        )
        .select(
            key,
            F.col("w.start").alias("window_start"),
            "count_claims",
            "sum_amount",
            "avg_amount",
            "max_amount",
        )
    )
