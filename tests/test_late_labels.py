"""Late labels on tables: the rows of the stream-stream join, batch by batch."""

from __future__ import annotations

import pytest
from helpers import at, rows
from pyspark.sql import functions as F

from tidemark.session import scratch_path
from tidemark.sources import files
from tidemark.streaming import flows, late_labels

CLAIM = "claim_id string, incident_timestamp timestamp, amount double"
LABEL = "claim_id string, is_fraud int, label_available_timestamp timestamp"

# Claims and labels of each run: twice labelled, twice reported, labelled before, after and long after, without an id, late.
RUNS = [
    (
        [("a", at(1), 1.0), ("a", at(1), 1.0), ("b", at(2), 2.0), ("c", at(3), None), (None, at(3), 4.0), ("d", at(20), 5.0), ("i", None, 6.0)],
        [("a", 1, at(5)), ("b", 0, at(1)), ("b", 1, at(2)), (None, 1, at(6)), ("e", 1, at(28)), ("x", None, at(7))],
    ),
    ([("e", at(27, us=7), 6.0), ("x", at(6), 7.0)], [("a", 0, at(9)), ("c", 1, at(10, month=2)), ("d", None, at(21))]),
    ([("f", at(1, month=4), 8.0)], [("g", 0, at(3, month=4)), ("c", 1, at(2))]),
    ([("b", at(2), 9.0), ("g", at(1, month=4), 1.0), ("h", at(1, month=9), 2.0)], [("d", 1, at(22)), ("f", 1, at(1, month=5)), ("h", 0, at(5, month=9))]),
    ([("z", at(1, month=12), 0.0)], [("z", 0, at(2, month=12)), ("z", 1, at(2, month=12)), ("h", 1, at(6, month=9))]),
]


def _streams(spark, base):
    return [files.stream_table(spark, f"{base}/{n}", spark.createDataFrame([], kind).schema) for n, kind in (("claims", CLAIM), ("labels", LABEL))]


def test_rows_of_the_stream_stream_join_after_every_run(spark):
    base = scratch_path(spark, "late_labels")
    counts = []
    for claims, labels in RUNS:
        spark.createDataFrame(claims, CLAIM).coalesce(1).write.mode("append").parquet(f"{base}/claims")
        spark.createDataFrame(labels, LABEL).coalesce(1).write.mode("append").parquet(f"{base}/labels")
        late_labels.late_label_stream(*_streams(spark, base), f"{base}/out", f"{base}/ck", f"{base}/state").awaitTermination()
        flows.append_stream(flows.stream_late_labels(*_streams(spark, base)), f"{base}/want", f"{base}/want_ck", state_partitions=2).awaitTermination()
        got, want = late_labels.read_joined(spark, f"{base}/out"), spark.read.parquet(f"{base}/want")
        assert got.columns == want.columns
        assert rows(got) == rows(want)
        counts.append(got.count())
    assert counts[0] < counts[-1] and counts == sorted(counts)
    kept = spark.read.parquet(f"{base}/state").filter(F.col("amount").isNotNull())
    assert kept.select("batch_id").distinct().count() <= 2


def test_a_batch_that_is_run_again_replaces_its_rows(spark, monkeypatch):
    base = scratch_path(spark, "late_again")
    claims, labels = RUNS[0]
    spark.createDataFrame(claims, CLAIM).write.parquet(f"{base}/claims")
    spark.createDataFrame(labels, LABEL).write.parquet(f"{base}/labels")

    def broken(*_):
        raise OSError("lost")

    def run():
        late_labels.late_label_stream(*_streams(spark, base), f"{base}/out", f"{base}/ck", f"{base}/state").awaitTermination()

    with monkeypatch.context() as patch:
        patch.setattr(late_labels, "remove", broken)
        with pytest.raises(Exception, match="lost"):
            run()
    first = rows(late_labels.read_joined(spark, f"{base}/out"))
    run()
    assert rows(late_labels.read_joined(spark, f"{base}/out")) == first
    assert len(first) == 3


def test_the_pipeline_keeps_what_waits_in_tables(spark, monkeypatch, tmp_path):
    from tidemark.plans import pipeline

    def store(*_, **__):
        raise AssertionError("claims are held in a state store")

    monkeypatch.setattr(flows, "stream_late_labels", store)
    paths = pipeline.Paths(str(tmp_path), scratch_path(spark, "warehouse"))
    claim = [("1", "p", "2024-01-01T00:00:00", "theft", 5.0, 1, 0, 0, 0)]
    spark.createDataFrame(claim, files.CLAIM_SCHEMA).write.json(paths.source("events/claims"))
    spark.createDataFrame([("1", 1, "2024-01-03T00:00:00")], files.LABEL_SCHEMA).write.json(paths.source("events/labels"))
    policy = spark.createDataFrame([("p", at(1), 30)], "policy_id string, policy_updated_at timestamp, policyholder_age int")
    for field in files.POLICY_SCHEMA.fields[3:]:
        policy = policy.withColumn(field.name, F.lit(None).cast(field.dataType))
    policy.write.option("header", True).csv(paths.source("context"))
    pipeline.ingest(spark, paths)
    pipeline.refine(spark, paths)
    joined = late_labels.read_joined(spark, paths.table("silver_enriched"))
    assert rows(joined, "claim_id", "is_fraud") == [("1", 1)]
