"""Late-label join of two streams whose waiting rows are tables.

The rows and rules of ``flows.stream_late_labels``, for streams of many millions of rows a run. A stream-stream join
looks up every row in a store of its own; here a batch takes what waits and what is new through one join on the
claim, so its work is that of a join of tables, and memory does not grow with what waits.

Per batch, under its id: the rows that come out; the claims and labels that wait, with the marks (largest event times)
up to it. A batch reads what the one before left and replaces its own folders when it is run again. As in a
stream-stream join, the watermark is the earlier of both marks less their delays; rows not later than the watermark of
the batches before are dropped, and claims without a label come out, with nulls, once no label can come.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.labels import CLAIM_WATERMARK, LABEL_WATERMARK, MAX_LABEL_DELAY
from tidemark.streaming.history import folders, remove

_BATCH = "batch_id"
_CLAIM, _LABEL, _MATCHED, _FITS = "__claim", "__label", "__matched", "__fits"


def _batches(spark: SparkSession, state: str) -> dict[int, str]:
    """Folders of the batches that ended; the marks are written last."""
    found = folders(spark, f"{state}/{_BATCH}=*/marks/_SUCCESS")
    numbers = [int(re.search(rf"{_BATCH}=(\d+)/", f).group(1)) for f in found]
    return {n: f"{state}/{_BATCH}={n}" for n in numbers}


def late_label_stream(
    claims: DataFrame,
    labels: DataFrame,
    path: str,
    checkpoint: str,
    state: str,
    claim_ts: str = "incident_timestamp",
    label_ts: str = "label_available_timestamp",
    claim_delay: str = CLAIM_WATERMARK,
    label_delay: str = LABEL_WATERMARK,
    max_delay: str = MAX_LABEL_DELAY,
    once: bool = True,
) -> StreamingQuery:
    """Every claim with the label that became available within ``max_delay`` after it, under ``path``.

    What waits is kept under ``state``. Read the rows with ``read_joined``.
    """
    labels = labels.select("claim_id", "is_fraud", label_ts)
    claim_type, label_type = claims.schema, labels.schema
    both = claims.select(F.struct("*").alias(_CLAIM)).unionByName(labels.select(F.struct("*").alias(_LABEL)), allowMissingColumns=True)

    def late(ts: str, mark: Column) -> Column:
        return F.coalesce(F.col(ts) <= mark, F.lit(False))

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = _batches(spark, state)
        before = max((n for n in done if n < batch_id), default=None)
        here = f"{state}/{_BATCH}={batch_id}"
        # The batch's rows are used several times below.
        batch.write.mode("overwrite").parquet(f"{here}/incoming")
        incoming = spark.read.schema(both.schema).parquet(f"{here}/incoming")
        kinds = {f.name: f.dataType for f in (*claim_type.fields, *label_type.fields)}
        if before is None:
            old_claims = spark.createDataFrame([], T.StructType([*claim_type.fields, T.StructField(_MATCHED, T.BooleanType())]))
            old_labels = spark.createDataFrame([], label_type)
            marks = spark.createDataFrame([(0, 0, 0)], "claim long, label long, watermark long")  # a stream without a row holds the watermark
        else:
            old_claims, old_labels, marks = (spark.read.parquet(f"{done[before]}/{name}") for name in ("claims", "labels", "marks"))
        last = marks.first()
        # Marks are microseconds; watermarks are whole milliseconds and never fall.
        def at(ts: str, micros: int) -> Column:
            return F.timestamp_micros(F.lit(micros)).cast(kinds[ts])

        largest = {name: F.max(F.unix_micros(F.col(column).cast("timestamp"))) for name, column in (("claim", f"{_CLAIM}.{claim_ts}"), ("label", f"{_LABEL}.{label_ts}"))}
        seen = incoming.agg(*[F.greatest(F.expr("1000L") * F.floor(x / 1000), F.lit(last[name])).alias(name) for name, x in largest.items()])
        marked = [F.unix_micros(F.timestamp_micros(name) - F.expr(f"INTERVAL {delay}")) for name, delay in (("claim", claim_delay), ("label", label_delay))]
        reached = seen.withColumn("watermark", F.greatest(F.least(*marked), F.lit(last["watermark"]))).first()
        passed = {ts: at(ts, last["watermark"]) for ts in (claim_ts, label_ts)}
        mark = {ts: at(ts, reached["watermark"]) for ts in (claim_ts, label_ts)}

        new_claims = incoming.filter(F.col(_CLAIM).isNotNull()).select(f"{_CLAIM}.*").filter(~late(claim_ts, passed[claim_ts]))
        new_labels = incoming.filter(F.col(_LABEL).isNotNull()).select(f"{_LABEL}.*").filter(~late(label_ts, passed[label_ts]))
        all_claims = old_claims.withColumn("__new", F.lit(False)).unionByName(new_claims.withColumns({_MATCHED: F.lit(False), "__new": F.lit(True)}))
        all_labels = old_labels.withColumn("__new", F.lit(False)).unionByName(new_labels.withColumn("__new", F.lit(True)))
        # A claim meets its labels as one list, so that it stays one row whatever it finds.
        lists = all_labels.filter("claim_id IS NOT NULL").groupBy("claim_id").agg(F.collect_list(F.struct("is_fraud", label_ts, "__new")).alias("__all"))
        met = all_claims.join(lists, "claim_id", "left")
        until = F.col(claim_ts) + F.expr(f"INTERVAL {max_delay}")
        fits = F.filter("__all", lambda x: (x[label_ts] >= F.col(claim_ts)) & (x[label_ts] <= until))
        rows = met.withColumn("__in_time", F.coalesce(fits, F.array())).select(
            *claim_type.names,
            (F.col(_MATCHED) | (F.size("__in_time") > 0)).alias(_MATCHED),
            F.filter("__in_time", lambda x: F.col("__new") | x["__new"]).alias(_FITS),
            late(claim_ts, mark[claim_ts] - F.expr(f"INTERVAL {max_delay}")).alias("__over"),
        )
        rows.write.mode("overwrite").parquet(f"{here}/met")
        rows = spark.read.parquet(f"{here}/met")
        found = rows.select(*claim_type.names, F.explode(_FITS).alias("l")).select(*claim_type.names, "l.is_fraud", f"l.{label_ts}")
        missed = rows.filter(F.col("__over") & ~F.col(_MATCHED)).select(*claim_type.names)
        found.unionByName(missed, allowMissingColumns=True).write.mode("overwrite").parquet(f"{path}/{_BATCH}={batch_id}")
        rows.filter(~F.col("__over")).select(*claim_type.names, _MATCHED).write.mode("overwrite").parquet(f"{here}/claims")
        old_labels.unionByName(new_labels).filter(~late(label_ts, mark[label_ts])).write.mode("overwrite").parquet(f"{here}/labels")
        spark.createDataFrame([reached], marks.schema).coalesce(1).write.mode("overwrite").parquet(f"{here}/marks")
        for scratch in ("incoming", "met"):
            remove(spark, f"{here}/{scratch}")
        for n, folder in done.items():
            if before is not None and n < before:
                remove(spark, folder)

    writer = both.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_joined(spark: SparkSession, path: str) -> DataFrame:
    """Rows that came out, over all batches."""
    return spark.read.parquet(path).drop(_BATCH)
