"""As-of joins: ties, missing matches, validity, null and hot keys."""

from __future__ import annotations

import random

import pytest
from helpers import at, rows, same
from pyspark.sql import functions as F

from tidemark.operators.asof import FeatureLookup, FeatureTable, asof_join, build_training_set
from tidemark.operators.profile import PROFILE_FEATURES
from tidemark.operators.rolling import rolling_features
from tidemark.operators.spine import training_spine
from tidemark.plans import training


def spine_of(spark, data):
    return spark.createDataFrame(data, "id int, k string, t timestamp_ntz")


def table_of(spark, data):
    return spark.createDataFrame(data, "k string, ft timestamp_ntz, v int, until timestamp_ntz")


def lookup(table, features=("v",), **options):
    return FeatureLookup(FeatureTable(table, ("k",), "ft"), features, **options)


def test_ties_match_and_earlier_rows_do_not(spark):
    spine = spine_of(spark, [(1, "a", at(2)), (2, "a", at(1)), (3, "a", at(1, us=1)), (4, "b", at(9)), (5, None, at(9))])
    table = table_of(spark, [("a", at(1, us=1), 7, None), ("a", at(2), 8, None), (None, at(1), 9, None)])
    assert rows(asof_join(spine, [lookup(table)], "t"), "id", "v") == [
        (1, 8), (2, None), (3, 7), (4, None), (5, None)
    ]


def test_a_match_with_null_fields_is_a_match(spark):
    spine = spine_of(spark, [(1, "a", at(3))])
    table = table_of(spark, [("a", at(1), 7, None), ("a", at(2), None, None)])
    assert rows(asof_join(spine, [lookup(table)], "t"), "id", "v") == [(1, None)]


def test_closed_version_does_not_match(spark):
    spine = spine_of(spark, [(1, "a", at(2)), (2, "a", at(3)), (3, "a", at(4))])
    table = table_of(spark, [("a", at(1), 7, at(3)), ("a", at(4), 8, None)])
    strict = asof_join(spine, [lookup(table, valid_to="until")], "t")
    assert rows(strict, "id", "v") == [(1, 7), (2, None), (3, 8)]
    assert rows(asof_join(spine, [lookup(table)], "t"), "id", "v") == [(1, 7), (2, 7), (3, 8)]


def test_repeated_feature_rows_do_not_depend_on_order(spark):
    spine = spine_of(spark, [(1, "a", at(2))])
    data = [("a", at(1), v, None) for v in (3, 9, 5)]
    for order in (data, data[::-1]):
        assert rows(asof_join(spine, [lookup(table_of(spark, order))], "t"), "id", "v") == [(1, 9)]


def _brute_force(spine, table):
    out = []
    for i, k, t in spine:
        found = [(ft, v) for fk, ft, v, _ in table if k is not None and fk == k and ft <= t]
        out.append((i, max(found)[1] if found else None))
    return sorted(out, key=repr)


def test_hot_keys_against_brute_force(spark):
    rng = random.Random(3)

    def key(i):
        return "hot" if i % 3 else rng.choice(["a", "b", None])

    def stamp():
        return at(rng.randint(1, 5), rng.randint(0, 3), 0, 0, rng.choice([0, 0, 1, 2]))

    spine = [(i, key(i), stamp()) for i in range(300)]
    table = list({(k, ft): (k, ft, i, None) for i, (k, ft) in enumerate((key(i), stamp()) for i in range(120))}.values())
    want = _brute_force(spine, table)
    for limit in (10**6, 200, 50, 0):
        got = asof_join(spine_of(spark, spine), [lookup(table_of(spark, table), unique=True)], "t", limit)
        assert rows(got, "id", "v") == want


def test_two_lookups_share_one_exchange(spark):
    spine = spine_of(spark, [(1, "a", at(5)), (2, "b", at(5))])
    first = lookup(table_of(spark, [("a", at(1), 1, None)]), unique=True)
    second = FeatureLookup(
        FeatureTable(table_of(spark, [("b", at(1), 2, None)]).withColumnRenamed("v", "w"), ("k",), "ft"), ("w",), unique=True
    )
    out = asof_join(spine, [first, second], "t")
    assert rows(out, "id", "v", "w") == [(1, 1, None), (2, None, 2)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_label_must_be_in_the_spine(spark):
    spine = spine_of(spark, [(1, "a", at(5))])
    with pytest.raises(ValueError):
        build_training_set(spine, [], "t", label="is_fraud")


def test_one_pass_equals_lookups_also_for_hot_policies(spark, inputs):
    enriched = inputs.enriched()
    spine, profile = training_spine(enriched), inputs.profile()
    by_lookup = training.enrich_by_lookup(spine, profile, rolling_features(enriched))
    assert by_lookup.count() == spine.count()
    same(training.enrich_in_one_pass(spine, profile), by_lookup)
    same(training.enrich_in_one_pass(spine, profile, max_rows_per_key=60), by_lookup)


def test_no_feature_from_the_future(spark, inputs):
    history = inputs.history()
    table = FeatureTable(history, ("policy_id",), "__START_AT")
    out = asof_join(inputs.claims(), [FeatureLookup(table, ("__START_AT",), unique=True)], "timestamp")
    assert out.filter("__START_AT > timestamp").isEmpty()
    assert not out.filter("__START_AT IS NOT NULL").isEmpty()


def test_one_pass_deals_policies_over_more_tasks_the_more_rows_there_are(spark):
    versions = [(f"p{k}", at(1), *(["x"] * 9)) for k in range(30)]
    kinds = ", ".join(f"{c} string" for c in PROFILE_FEATURES)
    profile = spark.createDataFrame(versions, f"policy_id string, __START_AT timestamp_ntz, {kinds}")
    claims = spark.createDataFrame(
        [(f"c{k}", f"p{k % 30}", at(2 + k // 30), float(k), k % 2) for k in range(90)],
        "claim_id string, policy_id string, timestamp timestamp_ntz, claimed_amount_eur double, is_fraud int",
    ).withColumn("label_available_timestamp", F.lit(None).cast("timestamp_ntz"))
    one, many = (training.enrich_in_one_pass(claims, profile, rows_per_task=n) for n in (1000, 10))
    assert one.rdd.getNumPartitions() == 1
    assert many.rdd.getNumPartitions() == 1 + 120 // 10
    same(many, one)
    held = many.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    assert many.count() == 90 and held < 90
