"""Rolling features: bounds of the windows, leakage, and hot keys."""

from __future__ import annotations

import math
import random
import re
import time

import pytest
from helpers import at, rows, same
from pyspark.sql import functions as F

from tidemark.operators.confirmed import confirmed_fraud_strict
from tidemark.operators.rolling import FEATURES, rolling_features

SCHEMA = "claim_id long, policy_id string, timestamp timestamp_ntz, claimed_amount_eur double, is_fraud int"


def claims(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def by_id(df, *columns):
    return {r[0]: tuple(r[1:]) for r in df.select("claim_id", *columns).collect()}


def test_window_bounds_and_empty_windows(spark):
    data = [
        (1, "p", at(1), 10.0, 1),
        (2, "p", at(2), 20.0, 0),  # exactly 24 h later: still inside
        (3, "p", at(2, us=1000), 5.0, 0),  # 24 h and 1 ms later: claim 1 is outside
        (4, "p", at(2, us=1500), None, 0),  # same millisecond as claim 3
        (5, "q", at(2), 7.0, None),
    ]
    out = by_id(
        rolling_features(claims(spark, data)),
        "count_claims_24h", "sum_amount_24h", "avg_amount_7d", "max_amount_30d",
        "num_fraud_confirmed_30d", "claims_7d_vs_avg_30d_ratio",
    )
    assert out[1] == (0, 0.0, None, None, 0, 1.0)
    assert out[2] == (1, 10.0, 10.0, 10.0, 1, 10.0 / (10.0 + 1e-6))
    assert out[3][:5] == (1, 20.0, 15.0, 20.0, 1)
    assert out[4] == out[3]
    assert out[5] == (0, 0.0, None, None, 0, 1.0)


def test_zoned_and_zoneless_stamps_agree(spark):
    data = [(i, "p", at(1 + i // 3, i % 24), float(i), i % 2) for i in range(40)]
    plain = claims(spark, data)
    zoned = plain.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    same(
        rolling_features(plain).select("claim_id", *FEATURES),
        rolling_features(zoned).select("claim_id", *FEATURES),
    )


def test_later_rows_change_nothing(spark, inputs):
    enriched = inputs.enriched()
    cut = F.lit(at(15)).cast("timestamp_ntz")
    early = enriched.filter(F.col("timestamp") < cut)
    same(
        rolling_features(early).select("claim_id", *FEATURES),
        rolling_features(enriched).filter(F.col("timestamp") < cut).select("claim_id", *FEATURES),
    )


def _skewed(spark, seed, n=400):
    """One policy holds most rows; many rows share a millisecond or a whole hour."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        policy = "hot" if i % 4 else rng.choice(["a", "b", None])
        stamp = at(
            rng.randint(1, 28), rng.randint(0, 2) * 11, rng.choice([0, 0, 30]), 0,
            rng.choice([0, 0, 999, 1000, 5000]), rng.choice([1, 2, 3]),
        )
        data.append((i, policy, stamp, rng.choice([None, 1.5, 2.25, 100.0]), rng.choice([None, 0, 1])))
    return claims(spark, data)


def test_hot_keys_give_the_same_features(spark):
    for seed in (1, 2):
        df = _skewed(spark, seed)
        plain = rolling_features(df)
        for limit in (0, 60):
            same(rolling_features(df, max_rows_per_key=limit), plain)


def test_hot_keys_on_given_data(spark, inputs):
    enriched = inputs.enriched()
    same(
        rolling_features(enriched, max_rows_per_key=60).select("claim_id", *FEATURES),
        rolling_features(enriched).select("claim_id", *FEATURES),
    )


def test_hot_keys_without_times_and_with_decimals(spark):
    data = [(900 + i, "hot" if i % 2 else "a", None, 6.0, 1) for i in range(4)]
    df = _skewed(spark, 3).unionByName(claims(spark, data))
    for kind in ("double", "decimal(12,2)", "decimal(38,2)", "long"):
        typed = df.withColumn("claimed_amount_eur", F.col("claimed_amount_eur").cast(kind))
        plain = rolling_features(typed)
        if kind == "double":
            assert by_id(plain, "count_claims_30d", "sum_amount_30d")[901] == (2, 12.0)
        for limit in (0, 60):
            got = rolling_features(typed, max_rows_per_key=limit)
            assert dict(got.dtypes) == dict(plain.dtypes)
            same(got, plain)


def _strict_by_brute_force(data, days=30):
    out = {}
    for i, policy, t, _, known in data:
        ms = lambda x: int((x - at(1)).total_seconds() * 1000 // 1)
        out[i] = sum(
            1
            for j, p, c, f, l in data
            if p == policy and f == 1 and l is not None
            and ms(t) - days * 86_400_000 <= ms(c) <= ms(t) - 1 and ms(l) <= ms(t) - 1
        )
    return out


def test_confirmed_fraud_against_brute_force(spark):
    rng = random.Random(5)
    data = []
    for i in range(300):
        stamp = at(rng.randint(1, 28), rng.randint(0, 3), 0, 0, rng.choice([0, 1000]), rng.choice([1, 2]))
        known = rng.choice([None, stamp, at(rng.randint(1, 28), 1, month=rng.choice([1, 2, 3]))])
        data.append((i, "hot" if i % 3 else "cold", stamp, rng.choice([0, 1, None]), known))
    df = spark.createDataFrame(
        data,
        "claim_id long, policy_id string, timestamp timestamp_ntz, is_fraud int, "
        "label_available_timestamp timestamp_ntz",
    )
    want = _strict_by_brute_force(data)
    for limit in (10**6, 150, 0):
        got = by_id(confirmed_fraud_strict(df, max_rows_per_key=limit), "num_fraud_confirmed_strict_30d")
        assert {k: v[0] for k, v in got.items()} == want


def test_strict_count_never_exceeds_plain_count(spark, inputs):
    both = confirmed_fraud_strict(rolling_features(inputs.enriched()))
    assert both.filter("num_fraud_confirmed_strict_30d > num_fraud_confirmed_30d").isEmpty()
    assert not both.filter("num_fraud_confirmed_strict_30d < num_fraud_confirmed_30d").isEmpty()


def test_one_exchange_for_all_windows(spark, inputs):
    plan = rolling_features(inputs.claims().withColumn("is_fraud", F.lit(0)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(policy_id#\d+L, __slice#", text)) == 1
    # The claims are scanned once; beside them the key column alone, to count rows per key and in all.
    assert len(re.findall(r"FileScan.*event_type", text)) == 1
    assert "SlidingWindow" not in text and len(re.findall(r"Sort \[policy_id", text)) == 2
    assert rows(plan.limit(1))


def test_a_key_with_many_rows_is_linear(spark):
    """20,000 rows of one key within a month: a frame that is added up anew for every row takes minutes here."""
    n = 20_000
    df = spark.range(n).selectExpr(
        "id AS claim_id", "'hot' AS policy_id", "timestamp_millis(1704067200000 + id * 120000) AS timestamp",
        "CAST(id % 100 AS double) AS claimed_amount_eur", "CAST(id % 50 = 0 AS int) AS is_fraud",
    )
    start = time.time()
    got = rolling_features(df).agg(F.sum("count_claims_30d"), F.max("max_amount_30d"), F.max("count_claims_24h"), F.sum("sum_amount_7d")).first()
    assert time.time() - start < 30
    week, month, day = 7 * 720, 30 * 720, 720
    sums = [0.0]
    for i in range(n):
        sums.append(sums[-1] + i % 100)
    want = sum(sums[i] - sums[max(0, i - week)] for i in range(n))
    assert tuple(got) == (sum(min(i, month) for i in range(n)), 99.0, day, want)


def test_small_amounts_after_a_burst_keep_their_digits(spark):
    data = [(i, "p", at(1, 0, 0, 0, 1000 * i), 1e11 + 0.3, 0) for i in range(50)] + [(100 + i, "p", at(20, i), 0.1, 0) for i in range(5)]
    data += [(200, "q", at(1), float("inf"), 0), (201, "q", at(2), 1.0, 0), (202, "q", at(20), float("nan"), 0), (203, "q", at(21), 5.0, 0), (204, "q", at(29), 7.0, 0)]
    data += [(205, "q", at(1, 12), 1e300, 0), (206, "q", at(3), 1.0, 0)]
    out = by_id(rolling_features(claims(spark, data)), "sum_amount_7d", "avg_amount_7d")
    assert out[104] == (pytest.approx(0.4, abs=1e-15), pytest.approx(0.1, abs=1e-15))
    assert out[206] == (float("inf"), float("inf")) and math.isnan(out[203][0]) and out[204] == (0.0, None)


def test_slices_at_the_edge_of_a_month(spark):
    month, rng = 30 * 86_400_000, random.Random(8)
    around = [k * month + d for k in range(650, 654) for d in (-1, 0, 1, month // 2, month - 86_400_000, 86_400_000)]
    data = [(i, rng.choice(["a", "b"]), rng.choice(around), rng.choice([None, float(rng.randint(-9, 99))]), rng.choice([0, 1])) for i in range(200)]
    df = spark.createDataFrame(data, "claim_id long, policy_id string, ms long, claimed_amount_eur double, is_fraud int").withColumn("timestamp", F.timestamp_millis("ms"))
    whole, cut = (rolling_features(df, max_rows_per_key=limit) for limit in (10**6, 0))
    same(cut, whole)
    got = by_id(whole, "count_claims_30d", "sum_amount_30d", "max_amount_30d", "count_claims_7d", "num_fraud_confirmed_30d")
    for i, policy, t, _, _ in data:
        inside = {d: [r for r in data if r[1] == policy and t - d * 86_400_000 <= r[2] <= t - 1] for d in (7, 30)}
        amounts = [r[3] for r in inside[30] if r[3] is not None]
        assert got[i] == (len(inside[30]), sum(amounts), max(amounts, default=None), len(inside[7]), sum(r[4] for r in inside[30]))
