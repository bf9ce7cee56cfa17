"""Registered queries: each reads a data folder and returns a table.

Floating sums depend on the order of addition, so derived floats are rounded far below the
digits of the data.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.rules import CLAIMS, LABELS, POLICIES, rules_for
from tidemark.functions.time import parse_event_time
from tidemark.operators import asof, checks, labels, leaderboard, merge, metrics, model, monitor, preparation, quality, split
from tidemark.operators.confirmed import confirmed_fraud_strict
from tidemark.operators.profile import flags_to_double, profile_features, row_features
from tidemark.operators.rolling import FEATURES, inference_features, rolling_features
from tidemark.operators.scd2 import END, START, current_versions, scd2
from tidemark.operators.spine import inference_spine, labelled_only, since, training_spine
from tidemark.plans import pipeline, training
from tidemark.plans.fixtures import Inputs
from tidemark.session import scratch_path
from tidemark.sources import files, snapshots
from tidemark.streaming import flows, history, publication

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

POLICY_RULES, CLAIM_RULES, LABEL_RULES = (rules_for(t) for t in (POLICIES, CLAIMS, LABELS))


def query(function: Callable[[Inputs], DataFrame]):
    """Register a function of the inputs under its own name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(Inputs(spark, sf_dir))

    run.__name__ = function.__name__
    run.__doc__ = function.__doc__
    QUERIES[function.__name__] = run
    return function


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _round_features(df: DataFrame) -> DataFrame:
    sums = [f for f in FEATURES if f.startswith("sum_")]
    means = ["avg_amount_7d", "avg_amount_30d", "claims_7d_vs_avg_30d_ratio"]
    return rounded(rounded(df, 6, *sums), 8, *means)


def _ntz(*names: str) -> list[Column]:
    return [F.col(n).cast("timestamp_ntz").alias(n) for n in names]


# --- sources and sinks ------------------------------------------------------------------------


@query
def csv_policies(i: Inputs) -> DataFrame:
    """Policy feed written as CSV and read back with a declared schema and audit columns."""
    path = scratch_path(i.spark, "csv_policies")
    feed = i.feed()
    writer = feed.write.option("header", True)
    writer.options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    read = files.read_policies(i.spark, path, feed.schema)
    audited = F.col("ingestion_timestamp").isNotNull() & F.col("source_file").endswith(".csv")
    return read.select(*feed.columns, audited.alias("audited"))


@query
def json_claims_stream(i: Inputs) -> DataFrame:
    """Claims as JSON files, schema inferred from them, streamed once into a parquet table."""
    source, sink, state = (scratch_path(i.spark, f"json_claims_{n}") for n in ("in", "out", "ckpt"))
    claims = i.claims()
    claims.write.options(**files.MICROSECONDS).json(source)
    stream = files.stream_json(i.spark, source, audit=False)
    flows.append_stream(stream, sink, state).awaitTermination()
    read = files.read_table(i.spark, sink)
    times = {"timestamp": parse_event_time("timestamp").cast("timestamp_ntz")}
    return read.select(*[times.get(f.name, F.col(f.name).cast(f.dataType)).alias(f.name) for f in claims.schema])


@query
def json_by_month(i: Inputs) -> DataFrame:
    """Orders appended as JSON by year and month, read back with both from the file path."""
    path = scratch_path(i.spark, "json_by_month")
    files.write_json_by_month(i.table("orders"), path, "o_orderdate")
    read = files.read_partitioned_json(i.spark, path)
    totals = read.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("total_price")
    )
    return rounded(totals, 4, "total_price")


@query
def event_time_parse(i: Inputs) -> DataFrame:
    """Text times; text that is not a time becomes null."""
    text = F.when(F.col("o_orderstatus") == "P", F.lit("not a time")).otherwise(
        F.col("o_orderdate").cast("string")
    )
    parsed = i.table("orders").select("o_orderkey", text.alias("raw"))
    return parsed.select("o_orderkey", parse_event_time("raw").cast("timestamp_ntz").alias("event_time"))


@query
def high_water_mark(i: Inputs) -> DataFrame:
    return files.high_water_mark(i.claims())


_SLICE_AFTER = dt.datetime(2024, 1, 10)


def _already_there(i: Inputs) -> DataFrame:
    return i.claims().filter(F.col("timestamp") < F.lit(_SLICE_AFTER).cast("timestamp_ntz"))


def _slice(i: Inputs) -> DataFrame:
    return files.next_slice(i.claims(), files.high_water_mark(_already_there(i)), 48)


@query
def next_slice(i: Inputs) -> DataFrame:
    return _slice(i).select("claim_id", "policy_id", "timestamp")


@query
def first_slice(i: Inputs) -> DataFrame:
    """Slice of an empty sink: from the first claim on."""
    return files.next_slice(i.claims(), None, 72).select("claim_id", "policy_id", "timestamp")


@query
def labels_for_slice(i: Inputs) -> DataFrame:
    return files.labels_for_slice(i.labels(), _slice(i), _already_there(i))


_DAY_OLD, _DAY_NEW = "2024-03-01", "2024-05-01"


def _state(i: Inputs, day: str) -> DataFrame:
    at = F.lit(day).cast("timestamp_ntz")
    valid = (F.col(START) <= at) & (F.col(END).isNull() | (F.col(END) > at))
    return i.history().filter(valid).select("policy_id", "gender", "region_type", "vehicle_year", "annual_premium_eur")


def _changes(i: Inputs) -> tuple[DataFrame, DataFrame]:
    """Policies on one day, and their changes to a later day on which rural ones have left."""
    old, new = _state(i, _DAY_OLD), _state(i, _DAY_NEW).filter("region_type <> 'rural'")
    return old, merge.snapshot_diff(old, new, ["policy_id"])


@query
def snapshot_diff(i: Inputs) -> DataFrame:
    return _changes(i)[1]


@query
def publish_changes(i: Inputs) -> DataFrame:
    old, changes = _changes(i)
    return merge.publish_changes(changes, old, ["policy_id"])


@query
def publish_feed(i: Inputs) -> DataFrame:
    """Three states published as a change feed that comes out of order and twice."""
    old, changes = _changes(i)
    new = changes.drop("op").limit(0)
    states = [new, old, _state(i, "2024-04-01"), _state(i, _DAY_NEW).filter("region_type <> 'rural'")]
    feed = [merge.snapshot_diff(a, b, ["policy_id"]).withColumn("version", F.lit(n)) for n, (a, b) in enumerate(zip(states, states[1:]))]
    path = scratch_path(i.spark, "published")
    for n in (2, 0, 1, 2, 0):
        publication.publish(feed[n], path, ["policy_id"], buckets=8)
    return publication.read_published(i.spark, path)


def _two_snapshots(i: Inputs) -> str:
    path = scratch_path(i.spark, "training_snapshots")
    spine = training_spine(i.enriched())
    meta = {"label_col": "is_fraud", "spine": "claims"}
    snapshots.write_snapshot(labelled_only(spine), path, {**meta, "note": "labelled"}, "timestamp")
    snapshots.write_snapshot(spine, path, {**meta, "note": "everything"}, "timestamp")
    return path


@query
def snapshot_time_travel(i: Inputs) -> DataFrame:
    """Version 0 read back after version 1 was written."""
    return snapshots.read_snapshot(i.spark, _two_snapshots(i), 0).select(
        "claim_id", "policy_id", "timestamp", "is_fraud"
    )


@query
def snapshot_history(i: Inputs) -> DataFrame:
    return snapshots.snapshot_history(i.spark, _two_snapshots(i)).select(
        "snapshot_id",
        "num_rows",
        "num_columns",
        F.col("meta")["note"].alias("note"),
        F.col("meta")["max_event_date"].alias("max_event_date"),
        F.col("meta")["previous_max_date"].alias("previous_max_date"),
    )


# --- data quality -----------------------------------------------------------------------------


@query
def dq_rule_counts_policies(i: Inputs) -> DataFrame:
    return quality.rule_counts(i.feed(), POLICY_RULES)


@query
def dq_rule_counts_claims(i: Inputs) -> DataFrame:
    return quality.expect_all(i.claims(), CLAIM_RULES)[1]


@query
def dq_rule_counts_labels(i: Inputs) -> DataFrame:
    dated = i.labels().withColumnRenamed("label_available_timestamp", "label_available_date")
    return quality.rule_counts(dated, LABEL_RULES)


@query
def dq_quarantine(i: Inputs) -> DataFrame:
    return quality.quarantined(quality.flag_quarantine(i.claims(), CLAIM_RULES))


@query
def dq_clean(i: Inputs) -> DataFrame:
    return i.clean_claims()


@query
def dq_quarantine_three_valued(i: Inputs) -> DataFrame:
    """Flag with undecided rows left undecided."""
    return quality.flag_quarantine(i.claims(), CLAIM_RULES, null_policy="drop").select(
        "claim_id", "is_quarantined"
    )


@query
def dq_policies_quarantine(i: Inputs) -> DataFrame:
    return quality.quarantined(quality.flag_quarantine(i.feed(), POLICY_RULES))


@query
def dq_violations(i: Inputs) -> DataFrame:
    return quality.violations(i.claims(), CLAIM_RULES).select("claim_id", "rule", "outcome")


# --- spines and row features ------------------------------------------------------------------


@query
def training_spine_rows(i: Inputs) -> DataFrame:
    return training_spine(i.enriched())


@query
def labelled_spine_rows(i: Inputs) -> DataFrame:
    return labelled_only(training_spine(i.enriched()))


@query
def inference_spine_rows(i: Inputs) -> DataFrame:
    return inference_spine(i.claims())


@query
def production_rows(i: Inputs) -> DataFrame:
    """Inference rows after the last day the model has seen."""
    return since(inference_spine(i.claims()), dt.date(2024, 1, 20)).select("claim_id", "timestamp")


@query
def profile_bands(i: Inputs) -> DataFrame:
    return i.profile()


@query
def profile_bands_fixed_day(i: Inputs) -> DataFrame:
    """Bands of the raw feed, nulls included, with the new-policy flag as of one day."""
    versions = i.feed().withColumnsRenamed({"policy_updated_at": START, "feed_id": END})
    out = profile_features(versions, as_of=dt.date(2024, 6, 1))
    return out.select(
        F.col(END).alias("feed_id"),
        "age_group",
        "vehicle_segment",
        "risk_level_by_premium",
        "driver_experience_years",
        "is_new_policy_risk",
    )


def _training_set(i: Inputs) -> DataFrame:
    spine = training_spine(i.enriched())
    return training.enrich_in_one_pass(spine, i.profile(), count_on=i.policy_keys())


@query
def row_feature_columns(i: Inputs) -> DataFrame:
    out = row_features(_training_set(i)).select(
        "claim_id", "is_frequent_claimant", "is_immediate_fraud_risk", "log_premium", "is_activity_spike"
    )
    return rounded(out, 8, "log_premium")


@query
def flag_columns(i: Inputs) -> DataFrame:
    flags = ["is_new_policy_risk", "police_report_filed", "telematics_anomaly", "outside_business_hours"]
    return flags_to_double(_training_set(i), flags).select("claim_id", *[f"{f}_dbl" for f in flags])


# --- joins ------------------------------------------------------------------------------------


@query
def late_label_join(i: Inputs) -> DataFrame:
    return i.enriched()


@query
def labels_or_zero(i: Inputs) -> DataFrame:
    return labels.labels_or_zero(i.claims(), i.clean_labels()).select("claim_id", "policy_id", "is_fraud")


@query
def latest_label(i: Inputs) -> DataFrame:
    """Labels united with a second, later opinion on every claim of the same day."""
    later = i.labels().selectExpr(
        "claim_id",
        "1 - is_fraud AS is_fraud",
        "label_available_timestamp + (claim_id % 3 - 1) * INTERVAL '1' DAY AS label_available_timestamp",
    )
    return labels.latest_label(i.labels().unionByName(later))


@query
def asof_profile(i: Inputs) -> DataFrame:
    spine = i.claims().select("claim_id", "policy_id", "timestamp")
    return asof.asof_join(spine, [training.profile_lookup(i.profile())], "timestamp", count_on=i.policy_keys())


@query
def asof_profile_valid(i: Inputs) -> DataFrame:
    """Values of the version that is valid at the claim; a version without an end still is."""
    table = asof.FeatureTable(i.history(), ("policy_id",), START)
    lookup = asof.FeatureLookup(table, ("gender", "vehicle_year"), valid_to=END, unique=True)
    spine = i.claims().select("claim_id", "policy_id", "timestamp")
    return asof.asof_join(spine, [lookup], "timestamp", count_on=i.policy_keys())


@query
def asof_last_click(i: Inputs) -> DataFrame:
    """Each purchase with the user's last click before or at it."""
    events = i.table("events")
    clicks = events.filter("event_type = 'click'").selectExpr(
        "user_id", "ts AS click_ts", "event_id AS click_id", "value AS click_value"
    )
    buys = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    lookup = asof.FeatureLookup(
        asof.FeatureTable(clicks, ("user_id",), "click_ts"), ("click_id", "click_value", "click_ts")
    )
    return asof.asof_join(buys, [lookup], "ts")


@query
def asof_behaviour(i: Inputs) -> DataFrame:
    """Inference features, made of all raw claims, looked up for the valid claims."""
    features = inference_features(i.claims(), i.clean_labels(), count_on=i.claim_keys())
    spine = i.clean_claims().select("claim_id", "policy_id", "timestamp")
    lookup = training.behaviour_lookup(features)
    return _round_features(asof.asof_join(spine, [lookup], "timestamp", count_on=i.claim_keys()))


@query
def training_set(i: Inputs) -> DataFrame:
    """Spine, profile and behaviour in one exchange per policy."""
    return _round_features(_training_set(i))


@query
def training_set_by_lookup(i: Inputs) -> DataFrame:
    """The same set from two feature tables and two as-of lookups."""
    enriched = i.enriched()
    behaviour = rolling_features(enriched, count_on=i.claim_keys())
    spine = training_spine(enriched)
    return _round_features(
        training.enrich_by_lookup(spine, i.profile(), behaviour, count_on=i.policy_keys())
    )


@query
def inference_set(i: Inputs) -> DataFrame:
    """Unlabelled claims after a day, with profile and behaviour."""
    spine = since(inference_spine(i.claims()), dt.date(2024, 1, 20))
    features = inference_features(i.claims(), i.clean_labels(), count_on=i.claim_keys())
    return _round_features(
        training.enrich_by_lookup(spine, i.profile(), features, label=None, count_on=i.policy_keys())
    )


def _scored(i: Inputs, labels_until: str) -> DataFrame:
    """All scored claims, with the labels known before a day."""
    at = F.lit(labels_until).cast("timestamp_ntz")
    known = F.when(F.col("label_available_timestamp") < at, F.col("is_fraud")).cast("long")
    return i.scored().select("claim_id", "policy_id", "timestamp", known.alias("is_fraud"), "prob_fraud")


def _scored_before(i: Inputs, day: str) -> DataFrame:
    """A scored table up to a day, labels known for the first days only."""
    return _scored(i, day).filter(F.col("timestamp") < F.lit(day).cast("timestamp_ntz"))


@query
def pending_claims(i: Inputs) -> DataFrame:
    spine = inference_spine(i.claims()).select("claim_id", "policy_id", "timestamp")
    return merge.pending(spine, _scored_before(i, "2024-01-16"))


@query
def pending_labels(i: Inputs) -> DataFrame:
    return merge.pending_labels(i.clean_labels(), _scored_before(i, "2024-01-16"))


@query
def merge_insert(i: Inputs) -> DataFrame:
    """The claims of a first run, then all that are scored."""
    return merge.merge_insert(_scored_before(i, "2024-01-16"), _scored(i, "2024-01-16"))


@query
def merge_update(i: Inputs) -> DataFrame:
    target = _scored(i, "2024-01-16")
    known = i.clean_labels().withColumn("is_fraud", F.col("is_fraud").cast("long"))
    return merge.merge_update(target, merge.pending_labels(known, target))


# --- checks and aggregates --------------------------------------------------------------------


@query
def row_counts(i: Inputs) -> DataFrame:
    return i.claims().agg(F.count(F.lit(1)).alias("n_rows"))


@query
def null_profile(i: Inputs) -> DataFrame:
    return checks.null_profile(_training_set(i))


@query
def row_consistency(i: Inputs) -> DataFrame:
    return checks.row_consistency(training_spine(i.enriched()), _training_set(i))


@query
def class_balance(i: Inputs) -> DataFrame:
    return checks.class_balance(training_spine(i.enriched()))


@query
def count_by_prediction(i: Inputs) -> DataFrame:
    return rounded(checks.count_by(i.scored(), "prediction"), 8, "pct_0", "pct_1")


@query
def duplicate_versions(i: Inputs) -> DataFrame:
    """Key and time pairs the raw feed holds more than once."""
    return checks.duplicate_keys(i.feed(), ["policy_id", "policy_updated_at"])


@query
def class_weights(i: Inputs) -> DataFrame:
    return rounded(checks.class_weights(labelled_only(i.enriched())), 8, "weight_fraud", "weight_legit")


def _claim_splits(i: Inputs, even: bool = False) -> dict[str, DataFrame]:
    """The first 20 days train, 5 days validation, the rest test; ``even``: features rounded as in ``training_set``.

    Fitting reads its rows many times, so the training set is written as a snapshot first.
    """
    path = scratch_path(i.spark, "training_set")
    made = _round_features(_training_set(i)) if even else _training_set(i)
    version = snapshots.write_snapshot(labelled_only(made), path)
    rows = snapshots.read_snapshot(i.spark, path, version)
    spec = split.SplitSpec(dt.date(2024, 1, 1), dt.date(2024, 1, 20), dt.date(2024, 1, 25))
    return split.temporal_split(rows, "timestamp", spec)


@query
def training_rows_weighted(i: Inputs) -> DataFrame:
    """Train and validation rows united, weighted by their own class counts."""
    spec = split.SplitSpec(dt.date(2024, 1, 1), dt.date(2024, 1, 20), dt.date(2024, 1, 25))
    rows = labelled_only(training_spine(i.enriched()))
    weighted = split.training_rows(split.temporal_split(rows, "timestamp", spec), "train_val")
    return rounded(weighted.select("claim_id", "is_fraud", "class_weight"), 8, "class_weight")


# --- windows ----------------------------------------------------------------------------------


@query
def rolling_training(i: Inputs) -> DataFrame:
    out = rolling_features(i.enriched(), count_on=i.claim_keys())
    return _round_features(out.select("claim_id", "policy_id", "timestamp", *FEATURES))


@query
def rolling_inference(i: Inputs) -> DataFrame:
    both = labels.labels_or_zero(i.claims(), i.clean_labels())
    out = rolling_features(both, count_on=i.claim_keys())
    return _round_features(out.select("claim_id", "policy_id", "timestamp", *FEATURES))


@query
def rolling_skewed(i: Inputs) -> DataFrame:
    """Counts, sums and maxima with every third claim moved to one policy. Means of many cents tie in their last digit and are left out."""
    moved = F.when(F.col("claim_id") % 3 == 0, F.lit(-1).cast("long")).otherwise(F.col("policy_id"))
    rows = i.enriched().withColumn("policy_id", moved)
    plain = [f for f in FEATURES if not f.startswith("avg_") and not f.endswith("_ratio")]
    out = rolling_features(rows, count_on=i.claim_keys()).select("claim_id", "policy_id", "timestamp", *plain)
    return rounded(out, 6, *[f for f in plain if f.startswith("sum_")])


@query
def fraud_confirmed_strict(i: Inputs) -> DataFrame:
    out = confirmed_fraud_strict(i.enriched(), count_on=i.claim_keys())
    return out.select("claim_id", "policy_id", "timestamp", "num_fraud_confirmed_strict_30d")


@query
def scd2_history(i: Inputs) -> DataFrame:
    return i.history()


@query
def scd2_current(i: Inputs) -> DataFrame:
    return current_versions(i.history())


def _narrow_feed(i: Inputs) -> DataFrame:
    return i.feed().select("policy_id", "policy_updated_at", "feed_id", "region_type", "has_telematics")


@query
def scd2_collapsed(i: Inputs) -> DataFrame:
    """Few tracked columns, so that many changes change nothing."""
    return scd2(_narrow_feed(i), ["policy_id"], "policy_updated_at", tie_breaker=["feed_id"], count_on=i.feed_keys())


@query
def scd2_uncollapsed(i: Inputs) -> DataFrame:
    return scd2(
        _narrow_feed(i),
        ["policy_id"],
        "policy_updated_at",
        exclude=["has_telematics"],
        tie_breaker=["feed_id"],
        collapse_unchanged=False,
        count_on=i.feed_keys(),
    )


# --- streaming --------------------------------------------------------------------------------


def _zoned(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("timestamp") for n in names})


def _stream_of(i: Inputs, df: DataFrame, name: str) -> tuple[str, DataFrame]:
    path = scratch_path(i.spark, name)
    df.write.parquet(path)
    return path, files.stream_table(i.spark, path, i.spark.read.parquet(path).schema)


def _consume(i: Inputs, stateful: DataFrame, out: str, state: str) -> None:
    cores = i.spark.sparkContext.defaultParallelism
    flows.append_stream(stateful, out, state, state_partitions=cores).awaitTermination()


@query
def stream_late_label_join(i: Inputs) -> DataFrame:
    """The stream-stream join over all claims and labels.

    A later claim and label close the watermark, so every claim has come out.
    """
    claims = _zoned(i.clean_claims().select("claim_id", "policy_id", "timestamp"), "timestamp")
    known = _zoned(i.clean_labels(), "label_available_timestamp")
    claim_path, claim_stream = _stream_of(i, claims, "stream_claims")
    label_path, label_stream = _stream_of(i, known, "stream_labels")
    joined = flows.stream_late_labels(claim_stream, label_stream, claim_ts="timestamp")
    out, state = scratch_path(i.spark, "stream_joined"), scratch_path(i.spark, "stream_joined_ckpt")
    _consume(i, joined, out, state)
    much_later = F.expr("max(timestamp) + INTERVAL 365 DAYS").alias("timestamp")
    claims.agg(F.lit(-1).cast("long").alias("claim_id"), F.lit(-1).cast("long").alias("policy_id"), much_later).write.mode("append").parquet(claim_path)
    late_label = F.expr("max(label_available_timestamp) + INTERVAL 365 DAYS").alias("label_available_timestamp")
    known.agg(F.lit(-2).cast("long").alias("claim_id"), F.lit(0).alias("is_fraud"), late_label).write.mode("append").parquet(label_path)
    _consume(i, joined, out, state)
    return files.read_table(i.spark, out).filter("claim_id >= 0").select(
        "claim_id", "policy_id", *_ntz("timestamp"), "is_fraud", *_ntz("label_available_timestamp")
    )


@query
def stream_label_outcomes(i: Inputs) -> DataFrame:
    """Per day: claims with a label, claims that still wait, and labels that came too late.

    Labels of even claims come first. Then the watermarks pass the claims of the first half, and the other labels come.
    """
    cut = F.lit("2024-01-16").cast("timestamp")
    claims = _zoned(i.clean_claims().select("claim_id", "timestamp"), "timestamp")
    known = _zoned(i.clean_labels(), "label_available_timestamp")
    claim_path, claim_stream = _stream_of(i, claims.filter(F.col("timestamp") < cut), "outcome_claims")
    label_path, label_stream = _stream_of(i, known.filter("claim_id % 2 = 0"), "outcome_labels")
    joined = flows.stream_late_labels(claim_stream, label_stream, claim_ts="timestamp")
    out, state = scratch_path(i.spark, "outcomes"), scratch_path(i.spark, "outcomes_ckpt")
    _consume(i, joined, out, state)
    # A claim and a label that are 200 days later close the first half.
    far = F.expr("max(timestamp) + INTERVAL 200 DAYS").alias("timestamp")
    claims.agg(F.lit(-1).cast("long").alias("claim_id"), far).write.mode("append").parquet(claim_path)
    late_label = F.expr("max(label_available_timestamp) + INTERVAL 200 DAYS").alias("label_available_timestamp")
    known.agg(F.lit(-2).cast("long").alias("claim_id"), F.lit(0).alias("is_fraud"), late_label).write.mode("append").parquet(label_path)
    _consume(i, joined, out, state)
    # The other labels find their claims gone; the claims of the second half, a year later, wait.
    known.filter("claim_id % 2 <> 0").write.mode("append").parquet(label_path)
    later = claims.filter(F.col("timestamp") >= cut).withColumn("timestamp", F.expr("timestamp + INTERVAL 366 DAYS"))
    later.write.mode("append").parquet(claim_path)
    _consume(i, joined, out, state)
    read, waiting = files.read_table(i.spark, out), flows.waiting_rows(i.spark, state)
    real = "claim_id >= 0"
    return flows.label_outcomes(read.filter(real), waiting.filter(real), i.spark.read.parquet(label_path), claim_ts="timestamp")


def _routed(i: Inputs) -> str:
    _, stream = _stream_of(i, i.claims(), "stream_raw_claims")
    path = scratch_path(i.spark, "stream_routes")
    state = scratch_path(i.spark, "stream_routes_ckpt")
    flows.route_stream(stream, CLAIM_RULES, path, state).awaitTermination()
    return path


def _plain_claims(i: Inputs, routed: DataFrame) -> DataFrame:
    return routed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in i.claims().schema])


@query
def stream_quarantine(i: Inputs) -> DataFrame:
    return _plain_claims(i, flows.read_route(i.spark, _routed(i), dead_letter=True))


@query
def stream_clean(i: Inputs) -> DataFrame:
    return _plain_claims(i, flows.read_route(i.spark, _routed(i)))


@query
def stream_rule_counts(i: Inputs) -> DataFrame:
    """Outcomes of all rules, counted while the claims of two batches are routed."""
    path, stream = _stream_of(i, i.claims().filter("claim_id % 2 = 0"), "stream_counted_claims")
    out, state, counts = (scratch_path(i.spark, f"stream_counted_{n}") for n in ("routes", "ckpt", "rules"))
    flows.route_stream(stream, CLAIM_RULES, out, state, counts=counts).awaitTermination()
    i.claims().filter("claim_id % 2 <> 0 or claim_id is null").write.mode("append").parquet(path)
    flows.route_stream(stream, CLAIM_RULES, out, state, counts=counts).awaitTermination()
    return flows.read_rule_counts(i.spark, counts)


@query
def stream_spine(i: Inputs) -> DataFrame:
    """The stateless spine of a stream of enriched claims."""
    _, stream = _stream_of(i, i.enriched(), "stream_enriched")
    out, state = scratch_path(i.spark, "stream_spine"), scratch_path(i.spark, "stream_spine_ckpt")
    flows.append_stream(training_spine(stream), out, state).awaitTermination()
    return files.read_table(i.spark, out)


@query
def stream_scd2(i: Inputs) -> DataFrame:
    """History kept by a stream of the whole clean feed that arrives in two parts, newer changes first."""
    feed = i.clean_feed()
    cut = F.lit("2024-04-01").cast("timestamp_ntz")
    path, stream = _stream_of(i, feed.filter(F.col("policy_updated_at") >= cut), "stream_feed")
    out, state = scratch_path(i.spark, "stream_history"), scratch_path(i.spark, "stream_history_ckpt")
    args = (out, state, ["policy_id"], "policy_updated_at")
    history.scd2_stream(stream, *args, tie_breaker=["feed_id"], buckets=16).awaitTermination()
    feed.filter(F.col("policy_updated_at") < cut).write.mode("append").parquet(path)
    history.scd2_stream(stream, *args, tie_breaker=["feed_id"], buckets=16).awaitTermination()
    return history.read_history(i.spark, out, ["policy_id"])


@query
def stream_tumbling(i: Inputs) -> DataFrame:
    """Daily windows of a stream; a much later claim closes the last one."""
    claims = _zoned(i.claims().select("policy_id", "timestamp", "claimed_amount_eur"), "timestamp")
    path, stream = _stream_of(i, claims, "stream_tumbling")
    daily = flows.tumbling_features(stream, delay="1 day")
    out, state = scratch_path(i.spark, "stream_daily"), scratch_path(i.spark, "stream_daily_ckpt")
    _consume(i, daily, out, state)
    closing = F.expr("max(timestamp) + INTERVAL 30 DAYS").alias("timestamp")
    claims.agg(F.lit(-1).cast("long").alias("policy_id"), closing, F.lit(0.0).alias("claimed_amount_eur")).write.mode("append").parquet(path)
    _consume(i, daily, out, state)
    read = files.read_table(i.spark, out).withColumn("window_start", *_ntz("window_start"))
    return rounded(rounded(read, 6, "sum_amount"), 8, "avg_amount")


@query
def tumbling_daily(i: Inputs) -> DataFrame:
    return rounded(rounded(flows.tumbling_features(i.claims()), 6, "sum_amount"), 8, "avg_amount")


# --- end to end -------------------------------------------------------------------------------

_WAREHOUSES: dict[tuple[str, str], pipeline.Paths] = {}


def _warehouse(i: Inputs) -> pipeline.Paths:
    """Two daily runs over landed files: the first claims with all labels and the policy file, then the other claims and
    the same policy file again, with a much later claim and label that close the watermarks. Built once a session."""
    key = (i.spark.sparkContext.applicationId, i.folder)
    if key in _WAREHOUSES:
        return _WAREHOUSES[key]
    paths = pipeline.Paths(scratch_path(i.spark, "landing"), scratch_path(i.spark, "warehouse"))
    text, cut = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", F.lit("2024-01-16").cast("timestamp_ntz")
    newest = i.clean_feed().groupBy("policy_id", "policy_updated_at").agg(F.max_by(F.struct("*"), "feed_id").alias("row")).select("row.*")
    feed = newest.withColumn("policy_id", F.col("policy_id").cast("string")).select(*[f.name for f in files.POLICY_SCHEMA.fields])
    feed.write.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(paths.source("context"))

    def land(claims: DataFrame) -> None:
        named = claims.withColumns({c: F.col(c).cast("string") for c in ("claim_id", "policy_id")})
        named.withColumn("timestamp", F.date_format("timestamp", text)).write.mode("append").json(paths.source("events/claims/2024/01"))

    known = i.clean_labels().select(F.col("claim_id").cast("string"), "is_fraud", F.date_format("label_available_timestamp", text).alias("label_available_date"))
    known.write.mode("append").json(paths.source("events/labels/2024/01"))
    land(i.claims().filter(F.col("timestamp") < cut))
    pipeline.run_features(i.spark, paths)
    land(i.claims().filter(F.col("timestamp") >= cut))
    last = [("closing", "closing", "2025-06-01T00:00:00", "theft", 1.0, 1, 0, 0, 0)]
    i.spark.createDataFrame(last, files.CLAIM_SCHEMA).write.mode("append").json(paths.source("events/claims/2025/06"))
    i.spark.createDataFrame([("none", 0, "2025-06-02T00:00:00")], files.LABEL_SCHEMA).write.mode("append").json(paths.source("events/labels/2025/06"))
    pipeline.run_features(i.spark, paths)
    return _WAREHOUSES.setdefault(key, paths)


def _numbered(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("long") for c in ("claim_id", "policy_id") if c in df.columns})


@query
def pipeline_policy_history(i: Inputs) -> DataFrame:
    """The policy history after both runs; the second one found nothing new in the file."""
    kept = files.read_table(i.spark, _warehouse(i).table("silver_policies_history"))
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("policy_updated_at", START, END)}
    return _numbered(kept).withColumns(times).select(*i.history().columns)


@query
def pipeline_spine(i: Inputs) -> DataFrame:
    """The streamed spine: every valid claim with the label that came in time."""
    rows = _numbered(files.read_table(i.spark, _warehouse(i).table("gold_spine")).filter("claim_id <> 'closing'"))
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("timestamp", "label_available_timestamp")})


@query
def pipeline_training_set(i: Inputs) -> DataFrame:
    """The labelled training set from the gold tables of both runs."""
    paths = _warehouse(i)
    spine, profile, behaviour = (files.read_table(i.spark, paths.table(f"gold_{n}")) for n in ("spine", "profile", "behaviour"))
    rows = _numbered(labelled_only(training.enrich_by_lookup(spine, profile, behaviour)))
    return _round_features(rows.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")))


@query
def pipeline_inference_spine(i: Inputs) -> DataFrame:
    """Raw claims of both runs, as the scoring flow reads them."""
    rows = files.read_table(i.spark, _warehouse(i).table("gold_inference_spine")).filter("claim_id <> 'closing'")
    return _numbered(rows).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


# --- evaluation -------------------------------------------------------------------------------


@query
def confusion(i: Inputs) -> DataFrame:
    return rounded(metrics.confusion(i.scored()), 8, "row_pct")


@query
def class_report(i: Inputs) -> DataFrame:
    return rounded(metrics.class_report(i.scored()), 8, "precision", "recall", "f1")


@query
def binary_metrics(i: Inputs) -> DataFrame:
    out = metrics.binary_metrics(i.scored())
    return rounded(out, 8, *out.columns)


@query
def pr_curve(i: Inputs) -> DataFrame:
    return rounded(metrics.pr_curve(i.scored()), 8, "precision", "recall")


@query
def roc_curve(i: Inputs) -> DataFrame:
    return rounded(metrics.roc_curve(i.scored()), 8, "fpr", "tpr")


@query
def threshold_sweep(i: Inputs) -> DataFrame:
    return rounded(metrics.threshold_sweep(i.scored()), 8, "threshold", "precision", "recall", "f1")


@query
def best_threshold(i: Inputs) -> DataFrame:
    return rounded(metrics.best_threshold(i.scored()), 8, "threshold", "f1")


@query
def calibration(i: Inputs) -> DataFrame:
    return rounded(metrics.calibration(i.scored()), 8, "mean_score", "fraction_positive")


#: Six linear scores of amount, parties and report: made up, so that SQL can follow them, and so that no two rows tie by chance.
_RUNS = tuple(
    leaderboard.LinearModel(f"run_{k}", (a, b, c), -1.5, 0.5)
    for k, (a, b, c) in enumerate([(0.01, 0.0, 0.0), (0.0, 0.5, 0.25), (0.02, -0.30001, 0.0), (-0.01, 0.0, 0.50001), (0.005, 0.10001, -0.20003), (0.01, 0.0, 0.0)])
)


def _board(i: Inputs) -> DataFrame:
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    rows = labelled_only(i.enriched()).select("is_fraud", "timestamp", "claimed_amount_eur", "n_parties_involved", "police_report_filed")
    features = F.array(*[F.col(c).cast("double") for c in ("claimed_amount_eur", "n_parties_involved", "police_report_filed")])
    return leaderboard.leaderboard(rows.filter(F.col("timestamp") < cut), rows.filter(F.col("timestamp") >= cut), features, _RUNS)


@query
def model_leaderboard(i: Inputs) -> DataFrame:
    """Six runs, scored and compared in one scan, by position."""
    board = _board(i)
    return rounded(board, 8, *[c for c in board.columns if c not in ("run_tag", "position")])


@query
def leaderboard_filters(i: Inputs) -> DataFrame:
    return leaderboard.worth_a_look(_board(i), least=0.04, gap=0.002).select("run_tag", "overfits")


@query
def leaderboard_decisions(i: Inputs) -> DataFrame:
    """A champion that ties with the best stays; a weaker one and a missing one are replaced."""
    board = _board(i)
    first = board.orderBy("position").limit(1).first()["run_tag"]
    out = [leaderboard.decide(board, c).withColumn("case", F.lit(n)) for n, c in enumerate((first, "run_3", None))]
    table = out[0].unionByName(out[1]).unionByName(out[2])
    return table.select("case", "champion", "challenger", "promoted")


# --- temporal split ---------------------------------------------------------------------------


@query
def temporal_split_rolling(i: Inputs) -> DataFrame:
    spec = split.SplitSpec.rolling(dt.date(2000, 12, 31))
    return split.with_split(i.table("orders"), "o_orderdate", spec).select("o_orderkey", "o_orderdate", "split")


@query
def temporal_split_fixed(i: Inputs) -> DataFrame:
    """The fixed split on order dates moved 24 years ahead."""
    moved = i.table("orders").selectExpr("o_orderkey", "o_orderdate + INTERVAL 24 YEARS AS ts")
    return split.with_split(moved, "ts", split.SplitSpec.fixed())


@query
def temporal_split_midnight(i: Inputs) -> DataFrame:
    """Split ends at midnight of the last day: later rows of that day are in no split."""
    last = split.max_event_date(i.claims())
    spec = split.SplitSpec(dt.date(2024, 1, 1), dt.date(2024, 1, 20), dt.date(2024, 1, 25), last, True)
    return split.with_split(i.claims(), "timestamp", spec).groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


# --- monitoring -------------------------------------------------------------------------------

_RATES = ("precision", "recall", "f1", "accuracy")


@query
def slice_metrics(i: Inputs) -> DataFrame:
    slices = {
        "theft": "accident_type = 'theft'",
        "no police report": "police_report_filed = 0",
        "many parties": "n_parties_involved >= 3",
    }
    return rounded(monitor.slice_metrics(i.scored(), slices), 8, *_RATES)


@query
def fairness(i: Inputs) -> DataFrame:
    """Groups by gender of the policy holder at the claim."""
    table = asof.FeatureTable(i.history(), ("policy_id",), START)
    lookup = asof.FeatureLookup(table, ("gender",), unique=True)
    with_gender = asof.asof_join(i.scored(), [lookup], "timestamp", count_on=i.policy_keys())
    out = monitor.fairness(with_gender, "gender")
    return rounded(out, 8, *[c for c in out.columns if c not in ("group", "n", "n_labelled")])


@query
def fairness_reference(i: Inputs) -> DataFrame:
    """Groups by accident type against one of them."""
    out = monitor.fairness(i.scored(), "accident_type", reference="parking")
    return rounded(out, 8, *[c for c in out.columns if c not in ("group", "n", "n_labelled")])


@query
def metrics_over_time(i: Inputs) -> DataFrame:
    return rounded(monitor.metrics_over_time(i.scored()), 8, *_RATES)


def _halves(i: Inputs) -> tuple[DataFrame, DataFrame]:
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    rows = i.claims()
    return rows.filter(F.col("timestamp") >= cut), rows.filter(F.col("timestamp") < cut)


@query
def drift_numeric(i: Inputs) -> DataFrame:
    out = monitor.numeric_drift(*_halves(i), ["claimed_amount_eur", "n_parties_involved"])
    names = [f"{s}_{v}" for s in ("baseline", "current") for v in ("null_rate", "mean", "std")]
    return rounded(out, 8, *names, "psi")


@query
def drift_numeric_quantile(i: Inputs) -> DataFrame:
    """Drift over quantile bins against stored sketches of the baseline, one for each of its days."""
    current, baseline = _halves(i)
    parts = baseline.withColumn("day", F.to_date("timestamp"))
    path = scratch_path(i.spark, "baseline_sketches")
    monitor.baseline_sketches(parts, ["claimed_amount_eur", "n_parties_involved"], by=["day"]).write.parquet(path)
    out = monitor.quantile_drift(current, i.spark.read.parquet(path))
    names = [f"{s}_{v}" for s in ("baseline", "current") for v in ("null_rate", "mean", "std")]
    return rounded(out, 8, *names, "psi")


@query
def drift_categorical(i: Inputs) -> DataFrame:
    out = monitor.categorical_drift(*_halves(i), ["accident_type", "outside_business_hours"])
    return rounded(out, 8, "baseline_null_rate", "current_null_rate", "total_variation")


# --- model, checked by rows only --------------------------------------------------------------

_SCORED_AT = dt.datetime(2024, 2, 1)


@query
def model_scores(i: Inputs) -> DataFrame:
    """A model fitted on the training rows scores the test rows."""
    splits = _claim_splits(i)
    fitted = model.fit_model(split.training_rows(splits))
    return model.score(fitted, splits["test"], 1, _SCORED_AT)


@query
def model_score_checks(i: Inputs) -> DataFrame:
    """What must hold of every scored test row, whatever the fit."""
    params = model.ModelParams(threshold=0.4)
    splits = _claim_splits(i)
    scored = model.score(model.fit_model(split.training_rows(splits), params), splits["test"], 1, _SCORED_AT)
    return scored.select(
        "claim_id",
        "policy_id",
        *_ntz("timestamp"),
        F.col("is_fraud").isNull().alias("label_is_open"),
        (F.col("prediction") == (F.col("prob_fraud") > params.threshold).cast("long")).alias("prediction_follows"),
        F.col("prob_fraud").between(0, 1).alias("is_probability"),
        "model_version",
    )


def _prepared(i: Inputs) -> tuple[dict[str, DataFrame], preparation.Prepared]:
    splits = _claim_splits(i, even=True)
    return splits, preparation.fit_preparation(splits["train"])


@query
def prepared_features(i: Inputs) -> DataFrame:
    """Features of the test rows, prepared by what the training rows teach."""
    splits, fitted = _prepared(i)
    return rounded(preparation.prepare(splits["test"], fitted, ["claim_id"]), 6, "value")


@query
def fitted_categories(i: Inputs) -> DataFrame:
    return _prepared(i)[1].categories.select("column", "value", "n", F.col("place").cast("long").alias("place"))


@query
def model_optimality(i: Inputs) -> DataFrame:
    """Every coefficient of a fit, and whether its optimality residual is below a bound."""
    splits, fitted = _prepared(i)
    weighted = split.training_rows(splits)
    params = model.ModelParams(reg_param=0.01, elastic_net_param=0.5)
    trained = model.fit_model(weighted, params)
    table = model.coefficients(trained, weighted)
    long = preparation.prepare(weighted, fitted, ["claim_id"])
    out = preparation.optimality(long, weighted, table, trained.stages[-1].intercept, ["claim_id"], params.reg_param, params.elastic_net_param)
    return out.select("feature", (F.col("residual") < 1e-3).alias("is_optimal"))


@query
def model_coefficients(i: Inputs) -> DataFrame:
    weighted = split.training_rows(_claim_splits(i))
    return model.coefficients(model.fit_model(weighted), weighted)


@query
def model_baseline(i: Inputs) -> DataFrame:
    """Best model of the grid against none, then the test rows as it scores them."""
    splits = _claim_splits(i)
    search = model.grid_search(splits)
    params = next(p for p in model.DEFAULT_GRID if p.tag == search.best)
    challenger = model.fit_model(split.training_rows(splits, "train_val"), params)
    decision = model.compare_models(splits["test"], None, challenger)
    assert decision.challenger_wins
    return model.baseline(challenger, splits["test"], 1, _SCORED_AT)


@query
def grid_search(i: Inputs) -> DataFrame:
    return model.grid_search(_claim_splits(i)).table
