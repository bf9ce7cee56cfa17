"""Files to features, features to model, scoring and label filling, run twice."""

from __future__ import annotations

import datetime as dt

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidemark.operators import merge, model
from tidemark.operators.scd2 import current_versions, scd2
from tidemark.operators.split import SplitSpec
from tidemark.plans import pipeline
from tidemark.plans.pipeline import Paths
from tidemark.session import scratch_path
from tidemark.sources import files, snapshots

CUT = "2024-01-16"


def _land(inputs, paths, claims_where, labels_where, closing=False):
    text = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    claims = inputs.claims().filter(claims_where).withColumn("timestamp", F.date_format("timestamp", text))
    claims = claims.withColumns({c: F.col(c).cast("string") for c in ("claim_id", "policy_id")})
    claims.write.mode("append").json(paths.source("events/claims/2024/01"))
    labels = inputs.clean_labels().filter(labels_where).select(
        F.col("claim_id").cast("string"), "is_fraud", F.date_format("label_available_timestamp", text).alias("label_available_date")
    )
    labels.write.mode("append").json(paths.source("events/labels/2024/01"))


@pytest.fixture(scope="module")
def world(spark, inputs):
    paths = Paths(scratch_path(spark, "landing"), scratch_path(spark, "warehouse"))
    feed = inputs.feed().withColumn("policy_id", F.col("policy_id").cast("string"))
    columns = [f.name for f in files.POLICY_SCHEMA.fields]
    feed = feed.dropDuplicates(["policy_id", "policy_updated_at"]).select(*columns)
    feed.write.option("header", True).csv(paths.source("context"))
    _land(inputs, paths, f"timestamp < '{CUT}'", "true")
    pipeline.run_features(spark, paths)
    # Later claims arrive; much later ones move the watermarks past every claim.
    _land(inputs, paths, f"timestamp >= '{CUT}'", "false")
    late = [("late", "p", "2025-06-01T00:00:00", "theft", 1.0, 1, 0, 0, 0)]
    spark.createDataFrame(late, files.CLAIM_SCHEMA).write.mode("append").json(paths.source("events/claims/2025/06"))
    later = [("other", 0, "2025-06-02T00:00:00")]
    spark.createDataFrame(later, files.LABEL_SCHEMA).write.mode("append").json(paths.source("events/labels/2025/06"))
    pipeline.run_features(spark, paths)
    return paths


def test_every_claim_is_on_one_route_and_in_the_spine(spark, inputs, world):
    raw = files.read_table(spark, world.table("bronze_claims"))
    assert raw.count() == inputs.claims().count() + 1
    spine = files.read_table(spark, world.table("gold_spine"))
    want = inputs.enriched().select(F.col("claim_id").cast("string"), "is_fraud")
    assert rows(spine.filter("claim_id <> 'late'"), "claim_id", "is_fraud") == rows(want)


def test_unchanged_policy_file_adds_nothing_to_the_feed(spark, world):
    assert spark.read.parquet(world.table("policy_feed/snapshot=1")).isEmpty()
    assert [r[0] for r in snapshots.snapshot_history(spark, world.table("bronze_policies")).select("snapshot_id").collect()] == [1, 0]


def _policies(spark, paths, premium, n=3):
    names = {f.name: f.dataType for f in files.POLICY_SCHEMA.fields}
    known = {"policy_id": F.concat(F.lit("p"), F.col("id").cast("string")), "policy_updated_at": F.lit("2024-01-01 00:00:00"), "annual_premium_eur": F.lit(premium)}
    frame = spark.range(n).select(*[known.get(c, F.lit(None)).cast(t).alias(c) for c, t in names.items()])
    frame.write.mode("overwrite").option("header", True).csv(paths.source("context"))


def test_a_failed_ingest_is_made_good_and_corrections_win(spark, inputs, monkeypatch):
    paths = Paths(scratch_path(spark, "landing"), scratch_path(spark, "warehouse"))
    _land(inputs, paths, "claim_id < 5", "claim_id < 5")
    _policies(spark, paths, 100.0)

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(merge, "snapshot_diff", broken)
        with pytest.raises(OSError, match="lost"):
            pipeline.ingest(spark, paths)
    pipeline.ingest(spark, paths)
    assert spark.read.parquet(paths.table("policy_feed")).count() == 3
    _policies(spark, paths, 50.0)  # a correction without a new time
    with monkeypatch.context() as patch:
        patch.setattr(merge, "snapshot_diff", broken)
        with pytest.raises(OSError, match="lost"):
            pipeline.ingest(spark, paths)
    pipeline.ingest(spark, paths)
    feed = spark.read.parquet(paths.table("policy_feed"))
    assert feed.count() == 6
    history = current_versions(scd2(feed, ["policy_id"], "policy_updated_at", tie_breaker=["snapshot"]))
    assert {r["annual_premium_eur"] for r in history.collect()} == {50.0} and history.count() == 3


def test_runs_may_have_gaps(spark):
    path, none = scratch_path(spark, "runs"), spark.createDataFrame([], "claim_id string")
    assert pipeline._runs(spark, path, 0, none).isEmpty() and pipeline._runs(spark, path, 3, none).isEmpty()
    for run in (0, 3):
        spark.createDataFrame([(f"c{run}",)], "claim_id string").write.parquet(f"{path}/run={run}")
    assert rows(pipeline._runs(spark, path, 2, none), "claim_id") == [("c0",)]
    assert rows(pipeline._runs(spark, path, 4, none), "claim_id") == [("c0",), ("c3",)]


def test_train_score_and_fill_labels(spark, world):
    version = pipeline.build_training_snapshot(spark, world)
    training = snapshots.read_snapshot(spark, world.table("training_set"), version)
    assert training.filter("is_fraud IS NULL").isEmpty()
    assert snapshots.snapshot_meta(spark, world.table("training_set"), version)["label_col"] == "is_fraud"
    spec = SplitSpec(dt.date(2024, 1, 1), dt.date(2024, 1, 10), dt.date(2024, 1, 16), dt.date(2024, 1, 24))
    trained = pipeline.train(spark, world, version, spec, grid=model.DEFAULT_GRID[:1])
    assert trained.decision.challenger_wins and trained.version == 1
    again = pipeline.train(spark, world, version, spec, trained.model, model.DEFAULT_GRID[5:], version=2, champion_version=1)
    assert again.decision.challenger_wins or again.version == 1
    baseline = files.read_table(spark, world.table("test_baseline"))
    assert baseline.count() == training.filter("timestamp >= '2024-01-17' AND timestamp < '2024-01-25'").count()

    last_seen = dt.date(2024, 1, 24)
    first = pipeline.score_pending(spark, world, trained.model, 1, last_seen, run=0)
    spine = files.read_table(spark, world.table("gold_inference_spine")).filter("timestamp >= '2024-01-25'")
    assert rows(first, "claim_id") == rows(spine, "claim_id")
    assert pipeline.score_pending(spark, world, trained.model, 1, last_seen, run=1).isEmpty()
    filled = pipeline.fill_labels(spark, world, last_seen, run=0)
    assert not filled.isEmpty()
    assert pipeline.fill_labels(spark, world, last_seen, run=1).isEmpty()
    table = pipeline.scored_table(spark, world)
    assert table.count() == first.count()
    assert rows(table.filter("is_fraud IS NOT NULL"), "claim_id", "is_fraud") == rows(filled, "claim_id", "is_fraud")
