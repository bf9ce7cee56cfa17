"""The three end-to-end flows: files to features, features to model, scoring and labels.

Tables live under one warehouse folder. Every step is a function from tables to a table and
may be run again: streams continue from their checkpoints, batch tables are recomputed, and
scoring adds only what is missing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.rules import CLAIMS, LABELS, POLICIES, rules_for
from tidemark.functions.time import parse_event_time
from tidemark.operators import merge, model
from tidemark.operators.labels import latest_label
from tidemark.operators.profile import profile_features
from tidemark.operators.quality import clean, flag_quarantine, quarantined
from tidemark.operators.rolling import inference_features, training_features
from tidemark.operators.scd2 import scd2
from tidemark.operators.spine import inference_spine, labelled_only, since, training_spine
from tidemark.operators.split import SplitSpec, temporal_split, training_rows
from tidemark.plans.training import enrich_by_lookup
from tidemark.sources import files, snapshots
from tidemark.streaming import flows, late_labels


@dataclass(frozen=True)
class Paths:
    """Folders of the landing zone and of every table."""

    landing: str
    warehouse: str

    def source(self, name: str) -> str:
        return f"{self.landing.rstrip('/')}/{name}"

    def table(self, name: str) -> str:
        return f"{self.warehouse.rstrip('/')}/{name}"

    def checkpoint(self, name: str) -> str:
        return self.table(f"_checkpoints/{name}")


# --- files to features ------------------------------------------------------------------------


def ingest(spark: SparkSession, paths: Paths) -> None:
    """New claim and label files into append-only tables; the policy file as a new snapshot.

    The policy feed gets the changes of every snapshot that has none there yet, so a run that ended between
    the two is made good by the next one.
    """
    for name, schema in (("claims", files.CLAIM_SCHEMA), ("labels", files.LABEL_SCHEMA)):
        stream = files.stream_json(spark, paths.source(f"events/{name}"), schema)
        flows.append_stream(
            stream, paths.table(f"bronze_{name}"), paths.checkpoint(f"bronze_{name}")
        ).awaitTermination()

    store = paths.table("bronze_policies")
    policies = files.read_policies(spark, paths.source("context"), files.POLICY_SCHEMA)
    snapshots.write_snapshot(policies, store)
    columns = [f.name for f in files.POLICY_SCHEMA.fields]
    feeds = paths.table("policy_feed")
    versions = sorted(r["snapshot_id"] for r in snapshots.snapshot_history(spark, store).select("snapshot_id").collect())
    for before, version in zip([None, *versions], versions):
        if files.written(spark, f"{feeds}/snapshot={version}"):
            continue
        new = snapshots.read_snapshot(spark, store, version).select(*columns)
        old = new.limit(0) if before is None else snapshots.read_snapshot(spark, store, before).select(*columns)
        changed = merge.snapshot_diff(old, new, ["policy_id", "policy_updated_at"])
        changed.filter("op <> 'delete'").drop("op").write.mode("overwrite").parquet(f"{feeds}/snapshot={version}")


def refine(spark: SparkSession, paths: Paths) -> None:
    """Quality routes, policy history, and claims joined with late labels."""
    feed = flag_quarantine(spark.read.parquet(paths.table("policy_feed")), rules_for(POLICIES))
    files.write_table(quarantined(feed).drop("snapshot"), paths.table("silver_quarantine_policies"))
    # Of two rows of one policy and time, the later snapshot is a correction.
    history = scd2(clean(feed), ["policy_id"], "policy_updated_at", tie_breaker=["snapshot"])
    files.write_table(history, paths.table("silver_policies_history"))

    times = {"claims": ("timestamp", "incident_timestamp"), "labels": ("label_available_date", "label_available_timestamp")}
    for name, tag in (("claims", CLAIMS), ("labels", LABELS)):
        source = paths.table(f"bronze_{name}")
        text, stamp = times[name]
        stream = files.stream_table(spark, source, spark.read.parquet(source).schema)
        stream = stream.withColumn(stamp, parse_event_time(text))
        flows.route_stream(
            stream, rules_for(tag), paths.table(f"silver_{name}"), paths.checkpoint(f"silver_{name}")
        ).awaitTermination()

    late_labels.late_label_stream(
        _clean_stream(spark, paths, "claims"),
        _clean_stream(spark, paths, "labels"),
        paths.table("silver_enriched"),
        paths.checkpoint("silver_enriched"),
        paths.table("_waiting_enriched"),
    ).awaitTermination()


def _clean_stream(spark: SparkSession, paths: Paths, name: str) -> DataFrame:
    route = paths.table(f"silver_{name}")
    schema = flows.read_route(spark, route).schema
    return files.stream_table(spark, f"{route}/*/is_quarantined=false", schema)


def build_features(spark: SparkSession, paths: Paths) -> None:
    """Training spine (streamed), profile, and both behaviour tables."""
    enriched = paths.table("silver_enriched")
    stream = files.stream_table(spark, f"{enriched}/*", late_labels.read_joined(spark, enriched).schema)
    spine = training_spine(stream.withColumn("timestamp", F.col("incident_timestamp")))
    flows.append_stream(spine, paths.table("gold_spine"), paths.checkpoint("gold_spine")).awaitTermination()

    history = files.read_table(spark, paths.table("silver_policies_history"))
    files.write_table(profile_features(history), paths.table("gold_profile"))

    known = late_labels.read_joined(spark, enriched).withColumn("timestamp", F.col("incident_timestamp"))
    files.write_table(training_features(known), paths.table("gold_behaviour"))

    labels = files.read_table(spark, paths.table("bronze_labels"))
    raw = files.read_table(spark, paths.table("bronze_claims"))
    raw = raw.withColumn("timestamp", parse_event_time("timestamp"))
    files.write_table(inference_features(raw, labels), paths.table("gold_behaviour_inference"))
    files.write_table(inference_spine(raw), paths.table("gold_inference_spine"))


def run_features(spark: SparkSession, paths: Paths) -> None:
    """One daily run of the whole first flow."""
    ingest(spark, paths)
    refine(spark, paths)
    build_features(spark, paths)


# --- features to model ------------------------------------------------------------------------


def build_training_snapshot(spark: SparkSession, paths: Paths) -> int:
    """Training set of all labelled claims as the next snapshot."""
    spine, profile, behaviour = (
        files.read_table(spark, paths.table(f"gold_{n}")) for n in ("spine", "profile", "behaviour")
    )
    rows = labelled_only(enrich_by_lookup(spine, profile, behaviour))
    meta = {"label_col": "is_fraud", "spine_table": "gold_spine", "feature_tables": "gold_profile,gold_behaviour"}
    return snapshots.write_snapshot(rows, paths.table("training_set"), meta, event_ts="timestamp")


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    search: model.Search
    decision: model.Decision
    version: int


def train(
    spark: SparkSession,
    paths: Paths,
    snapshot: int,
    spec: SplitSpec,
    champion: PipelineModel | None = None,
    grid: Sequence[model.ModelParams] = model.DEFAULT_GRID,
    version: int = 1,
    champion_version: int | None = None,
) -> Trained:
    """Search on train and validation, refit the best on both, compare on test; a winner is
    refitted on everything, saved, and scores the test rows as the monitoring baseline.

    ``version`` is the challenger's; a champion that stays keeps ``champion_version``, by default
    the version before.
    """
    splits = temporal_split(snapshots.read_snapshot(spark, paths.table("training_set"), snapshot), "timestamp", spec)
    search = model.grid_search(splits, grid)
    params = next(p for p in grid if p.tag == search.best)
    challenger = model.fit_model(training_rows(splits, "train_val"), params)
    decision = model.compare_models(splits["test"], champion, challenger)
    if not decision.challenger_wins:
        return Trained(champion, search, decision, version - 1 if champion_version is None else champion_version)
    final = model.fit_model(training_rows(splits, "all"), params)
    model.save_model(final, paths.table(f"models/version={version}"))
    files.write_table(model.baseline(final, splits["test"], version), paths.table("test_baseline"))
    return Trained(final, search, decision, version)


# --- scoring and labels -----------------------------------------------------------------------


def _runs(spark: SparkSession, path: str, run: int, template: DataFrame) -> DataFrame:
    """Rows of all runs before ``run``, whichever there are; the folder name prunes the files."""
    if not files.exists(spark, path):
        return template.limit(0)
    return spark.read.parquet(path).filter(F.col("run") < run)


def score_pending(
    spark: SparkSession, paths: Paths, fitted: PipelineModel, version: int, last_seen: dt.date, run: int
) -> DataFrame:
    """Score the claims after ``last_seen`` that no earlier run has scored.

    Runs are numbered from 0 and only add files; a run that is repeated replaces its own.
    """
    spine, profile, behaviour = (
        files.read_table(spark, paths.table(f"gold_{n}")) for n in ("inference_spine", "profile", "behaviour_inference")
    )
    table = paths.table("scored")
    todo = merge.pending(since(spine, last_seen), _runs(spark, table, run, spine.select("claim_id")))
    scored = model.score(fitted, enrich_by_lookup(todo, profile, behaviour, label=None), version)
    scored.write.mode("overwrite").parquet(f"{table}/run={run}")
    return spark.read.parquet(f"{table}/run={run}")


def fill_labels(spark: SparkSession, paths: Paths, last_seen: dt.date, run: int) -> DataFrame:
    """Add the labels that have become known for scored claims without one."""
    bronze = files.read_table(spark, paths.table("bronze_labels"))
    bronze = bronze.withColumn("label_available_timestamp", parse_event_time("label_available_date"))
    labels = since(bronze, last_seen, "label_available_timestamp")
    known = latest_label(labels).select("claim_id", F.col("is_fraud").cast("long").alias("is_fraud"))
    table = paths.table("scored_labels")
    fresh = merge.pending(known, _runs(spark, table, run, known))
    scored = _runs(spark, paths.table("scored"), run + 1, known).select("claim_id")
    fresh.join(scored, "claim_id", "left_semi").write.mode("overwrite").parquet(f"{table}/run={run}")
    return spark.read.parquet(f"{table}/run={run}")


def scored_table(spark: SparkSession, paths: Paths) -> DataFrame:
    """All scored claims with the labels known so far: the two additions merged when read."""
    scored = spark.read.parquet(paths.table("scored")).drop("run")
    return merge.merge_update(scored, spark.read.parquet(paths.table("scored_labels")).drop("run"))
