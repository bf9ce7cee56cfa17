"""Training and inference sets from claims, labels and policy history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import epoch_ms, epoch_us
from tidemark.operators.asof import (
    FeatureLookup,
    FeatureTable,
    build_training_set,
    last_known,
    running_by_hours,
    united,
    unpack,
)
from tidemark.operators.profile import PROFILE_FEATURES
from tidemark.operators.rolling import FEATURES, in_place, in_slices
from tidemark.operators.scd2 import START
from tidemark.operators.skew import RUNNING_ROWS_PER_KEY, hot_keys, split_hot

KEY, TS = "policy_id", "timestamp"
# Rows of claims and versions that a task sorts, at a policy's rows the least: what a task holds does not grow with the input.
ROWS_PER_TASK = 100_000
EXCLUDED = ("label_available_timestamp",)


def profile_lookup(profile: DataFrame, unique: bool = True) -> FeatureLookup:
    """Profile of the policy version valid at the claim."""
    return FeatureLookup(FeatureTable(profile, (KEY,), START), PROFILE_FEATURES, unique=unique)


def behaviour_lookup(features: DataFrame) -> FeatureLookup:
    """Rolling features known at the claim. Rows of one instant carry equal features."""
    return FeatureLookup(FeatureTable(features, (KEY,), TS), FEATURES)


def enrich_by_lookup(
    spine: DataFrame,
    profile: DataFrame,
    behaviour: DataFrame,
    label: str | None = "is_fraud",
    count_on: DataFrame | None = None,
) -> DataFrame:
    """Spine plus both feature tables, as two as-of lookups sharing one exchange."""
    lookups = [profile_lookup(profile), behaviour_lookup(behaviour)]
    return build_training_set(spine, lookups, TS, label, EXCLUDED, count_on=count_on)


def enrich_in_one_pass(
    claims: DataFrame,
    profile: DataFrame,
    max_rows_per_key: int = RUNNING_ROWS_PER_KEY,
    count_on: DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """The same rows when the behaviour features come from the spine's own claims.

    A claim then always finds its own features, so they are computed beside the profile
    lookup: claims and versions meet in one exchange on the policy, followed by one window for
    the rolling frames and one for the lookup. ``claims`` has the spine columns. ``count_on`` is
    a cheaper table with the rows per policy. Policies are dealt over tasks of about ``rows_per_task`` rows of it; a size
    of shuffle blocks says little of the memory that sorted rows take, and a fixed number of tasks takes more with every row.
    """
    if count_on is None:
        count_on = claims.select(KEY).unionByName(profile.select(KEY))
    hot = hot_keys(count_on, [KEY], max_rows_per_key)
    lookup = profile_lookup(profile)
    versions = lookup.rows("__f0")
    timed = claims.withColumn("__us", epoch_us(claims, TS))
    tasks = 1 + count_on.count() // rows_per_task
    if hot is None:
        done = _one_exchange(timed, versions, lookup, tasks)
    else:
        plain, hot_claims = split_hot(timed, hot)
        plain_versions, hot_versions = split_hot(versions, hot)
        done = _one_exchange(plain, plain_versions, lookup, tasks).unionByName(
            _hot_policies(hot_claims, hot_versions, lookup)
        )
    return done.drop(*EXCLUDED)


def _one_exchange(timed: DataFrame, versions: DataFrame, lookup: FeatureLookup, tasks: int) -> DataFrame:
    rows = united(timed.withColumn("__ms", epoch_ms(timed, TS)), [versions]).repartition(tasks, KEY)
    # Versions carry no claim, amount or label, so they add nothing to the rolling frames.
    rows = rows.withColumn("__ms", F.coalesce("__ms", F.expr("__us div 1000")))
    rolled = in_place(rows, [KEY], "claimed_amount_eur", "is_fraud", "claim_id")
    others = [c for c in rolled.columns if c != "__f0"]
    matched = rolled.select(*others, *last_known(["__f0"], [KEY])).filter("__spine")
    done = unpack(matched.drop("__spine", "__ms"), ["__f0"], [lookup])
    names = [c for c in timed.columns if c != "__us"]
    return done.select(*names, *PROFILE_FEATURES, *FEATURES)


def _hot_policies(timed: DataFrame, versions: DataFrame, lookup: FeatureLookup) -> DataFrame:
    cut = timed.withColumn("__ms", epoch_ms(timed, TS)).withColumn("__halo", F.lit(True))
    rolled = in_slices(cut, KEY, "claimed_amount_eur", "is_fraud", "claim_id")
    matched = running_by_hours(rolled.drop("__ms"), [versions], ["__f0"], [KEY])
    done = unpack(matched, ["__f0"], [lookup])
    names = [c for c in timed.columns if c != "__us"]
    return done.select(*names, *PROFILE_FEATURES, *FEATURES)
