"""Upserts, change feeds, snapshots and file sources."""

from __future__ import annotations

import datetime as dt

import pytest
from helpers import at, rows, same
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.operators import merge
from tidemark.session import scratch_path
from tidemark.sources import files, snapshots
from tidemark.streaming import publication

SCHEMA = "claim_id string, is_fraud long, x int"


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_insert_twice_is_insert_once(spark):
    target = frame(spark, ("a", 1, 1))
    source = frame(spark, ("a", 0, 9), ("b", None, 2))
    once = merge.merge_insert(target, source)
    assert rows(once) == [("a", 1, 1), ("b", None, 2)]
    same(merge.merge_insert(once, source), once)


def test_update_touches_matches_only(spark):
    target = frame(spark, ("a", None, 1), ("b", 0, 2), ("c", 1, 3))
    source = spark.createDataFrame([("a", 1), ("b", None), ("z", 1), (None, 1), (None, 0)], "claim_id string, is_fraud long")
    updated = merge.merge_update(target, source)
    assert rows(updated) == [("a", 1, 1), ("b", None, 2), ("c", 1, 3)]
    same(merge.merge_update(updated, source), updated)


def test_update_with_two_source_rows_is_an_error(spark):
    source = spark.createDataFrame([("a", 1), ("a", 1)], "claim_id string, is_fraud long")
    with pytest.raises(PySparkException, match="several source rows"):
        merge.merge_update(frame(spark, ("a", None, 1)), source).collect()
    assert rows(merge.merge_update(frame(spark, ("b", None, 1)), source)) == [("b", None, 1)]


def test_pending_labels(spark):
    scored = frame(spark, ("a", 1, 1), ("b", None, 2))
    labels = spark.createDataFrame([("a", 0), ("b", 1), ("c", 0)], "claim_id string, is_fraud long")
    assert rows(merge.pending_labels(labels, scored)) == [("b", 1), ("c", 0)]
    assert rows(merge.pending(labels, scored)) == [("c", 0)]


def test_change_feed_and_publication(spark):
    old = frame(spark, ("a", 1, 1), ("b", None, 2), ("c", 1, 3), (None, 1, 1))
    new = frame(spark, ("a", 1, 1), ("b", 0, 2), ("d", 1, 4), (None, None, 1))
    feed = merge.snapshot_diff(old, new, ["claim_id"])
    assert rows(feed) == sorted(
        [("b", 0, 2, "update"), ("c", 1, 3, "delete"), ("d", 1, 4, "insert"), (None, None, 1, "update")], key=repr
    )
    same(merge.publish_changes(feed, old, ["claim_id"]), new)
    assert merge.snapshot_diff(new, new, ["claim_id"]).isEmpty()


def test_snapshots_keep_every_version(spark):
    path = scratch_path(spark, "t_snapshots")
    assert snapshots.latest_version(spark, path) is None
    assert snapshots.ensure_like(path, frame(spark, ("a", 1, 1)))
    assert not snapshots.ensure_like(path, frame(spark, ("a", 1, 1)))
    stamped = frame(spark, ("a", 1, 1)).withColumn("t", F.lit(at(5)))
    assert snapshots.write_snapshot(stamped, path, {"label": "is_fraud"}, "t") == 1
    later = stamped.withColumn("t", F.lit(at(9))).withColumn("more", F.lit(1))
    assert snapshots.write_snapshot(later, path, event_ts="t") == 2
    assert snapshots.read_snapshot(spark, path, 0).isEmpty()
    same(snapshots.read_snapshot(spark, path, 1), stamped)
    same(snapshots.read_snapshot(spark, path), later)
    meta = snapshots.snapshot_meta(spark, path, 2)
    assert meta == {"max_event_date": "2024-01-09", "previous_max_date": "2024-01-05"}
    assert rows(snapshots.snapshot_history(spark, path), "snapshot_id", "num_rows", "num_columns") == [
        (0, 0, 3), (1, 1, 4), (2, 1, 5)
    ]
    with pytest.raises(ValueError):
        snapshots.read_snapshot(spark, path, 7)


def test_unlisted_folder_is_ignored_and_replaced(spark):
    path = scratch_path(spark, "t_failed")
    snapshots.write_snapshot(frame(spark, ("a", 1, 1)), path)
    frame(spark, ("broken", 0, 0)).write.parquet(f"{path}/snapshot_id=1")
    assert rows(snapshots.read_snapshot(spark, path), "claim_id") == [("a",)]
    assert snapshots.write_snapshot(frame(spark, ("b", 1, 1)), path) == 1
    assert rows(snapshots.read_snapshot(spark, path), "claim_id") == [("b",)]


def test_csv_with_declared_and_inferred_types(spark):
    path = scratch_path(spark, "t_csv")
    row = ("p", dt.datetime(2024, 1, 1), 40, "F", "urban", 2020, 500.5, 1, "full", "car", dt.date(2023, 5, 1), 3)
    spark.createDataFrame([row], files.POLICY_SCHEMA).write.option("header", True).csv(path)
    declared = files.read_policies(spark, path, files.POLICY_SCHEMA)
    assert tuple(declared.first())[:12] == row
    assert declared.columns[12:] == list(files.AUDIT_COLUMNS)
    inferred = files.read_policies(spark, path, audit=False)
    assert inferred.schema["annual_premium_eur"].dataType.simpleString() == "double"


def test_json_by_month_reads_back_its_folders(spark):
    path = scratch_path(spark, "t_months")
    df = spark.createDataFrame([("a", at(1)), ("b", at(1, month=2)), ("c", at(2, month=2))], "claim_id string, timestamp timestamp_ntz")
    files.write_json_by_month(df, path)
    files.write_json_by_month(df.filter("claim_id = 'a'"), path)
    back = files.read_partitioned_json(spark, path)
    assert rows(back, "claim_id", "year", "month") == [("a", 2024, 1), ("a", 2024, 1), ("b", 2024, 2), ("c", 2024, 2)]


def test_plain_year_month_folders(spark):
    path = scratch_path(spark, "t_plain_months")
    spark.createDataFrame([("a",)], "claim_id string").coalesce(1).write.json(f"{path}/2023/11")
    assert rows(files.read_partitioned_json(spark, path)) == [("a", 2023, 11)]


def test_slices_of_a_backlog(spark):
    backlog = spark.createDataFrame([(i, at(1 + i // 24, i % 24)) for i in range(72)], "claim_id int, timestamp timestamp_ntz")
    first = files.next_slice(backlog, None, 10)
    assert rows(first, "claim_id") == sorted([(i,) for i in range(11)], key=repr)
    second = files.next_slice(backlog, files.high_water_mark(first), 10)
    assert rows(second, "claim_id") == sorted([(i,) for i in range(11, 21)], key=repr)
    empty = backlog.limit(0)
    same(files.next_slice(backlog, files.high_water_mark(empty), 10), first)
    same(files.next_slice(backlog, at(1, 10), 10), second)
    labels = backlog.withColumnRenamed("timestamp", "label_available_timestamp").withColumn("is_fraud", F.lit(0))
    done = labels.filter("claim_id = 12")
    due = files.labels_for_slice(labels, second, done)
    assert {r[0] for r in rows(due, "claim_id")} == set(range(11, 21)) - {12}


def test_json_stream_reads_each_file_once(spark):
    from tidemark.streaming import flows

    source, out, state = (scratch_path(spark, f"t_json_{n}") for n in ("in", "out", "ckpt"))
    for name in ("a", "b"):
        spark.createDataFrame([(name, 1)], "claim_id string, is_fraud int").write.mode("append").json(f"{source}/2024/01")
        flows.append_stream(files.stream_json(spark, source), out, state).awaitTermination()
    read = files.read_table(spark, out)
    assert rows(read, "claim_id") == [("a",), ("b",)]
    assert read.filter("ingestion_timestamp IS NULL OR source_file NOT LIKE '%.json'").isEmpty()


def test_published_changes_in_any_order(spark):
    states = [{}, {1: "a", 2: "b", 3: "c", None: "n"}, {1: "a", 2: "x", 4: "d", None: "n"}, {1: "a", 2: "b", 3: "c2", 4: "d"}]
    frames = [spark.createDataFrame(list(s.items()), "k int, v string") for s in states]
    feed = [merge.snapshot_diff(a, b, ["k"]).withColumn("version", F.lit(n)) for n, (a, b) in enumerate(zip(frames, frames[1:]))]
    for order in ((0, 1, 2), (2, 1, 0), (1, 2, 0, 1)):
        path = scratch_path(spark, "t_published")
        for n in order:
            publication.publish(feed[n], path, ["k"], buckets=4)
        assert rows(publication.read_published(spark, path)) == rows(frames[3])
        assert publication.publish(feed[1], path, ["k"], buckets=4) == []
    # Only the bucket of the changed key is written again.
    change = spark.createDataFrame([(4, "new", "update", 9)], "k int, v string, op string, version int")
    assert len(publication.publish(change, path, ["k"], buckets=4)) == 1
    assert ("4", "new") in {(str(k), v) for k, v in rows(publication.read_published(spark, path))}
