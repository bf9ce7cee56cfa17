"""Slices, fairness, drift, and quality over time."""

from __future__ import annotations

import math

import numpy as np
import pytest
from helpers import at, rows

from tidemark.operators import monitor

SCHEMA = "g string, is_fraud int, prediction int"
DATA = [("a", 1, 1), ("a", 1, 0), ("a", 0, 0), ("b", 1, 1), ("b", 0, 1), ("b", None, 1), ("c", None, 0), (None, 0, 0)]


def test_slices_may_overlap(spark):
    df = spark.createDataFrame(DATA, SCHEMA).withColumnRenamed("g", "grp")
    # A slice only sees columns that are still there.
    out = monitor.slice_metrics(df, {"a or b": "grp IN ('a', 'b')", "b": "grp = 'b'"})
    got = {r["slice"]: r for r in out.collect()}
    assert [got[s]["n"] for s in ("all", "a or b", "b")] == [8, 6, 3]
    assert (got["b"]["tp"], got["b"]["fp"], got["b"]["n_labelled"], got["b"]["precision"]) == (1, 1, 2, 0.5)
    assert got["all"]["recall"] == pytest.approx(2 / 3)


def test_fairness_against_everyone_and_a_group(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    got = {r["group"]: r for r in monitor.fairness(df, "g").collect()}
    assert (got["a"]["tpr"], got["b"]["tpr"], got["c"]["tpr"]) == (0.5, 1.0, None)
    assert got["a"]["equal_opportunity_diff"] == pytest.approx(0.5 - 2 / 3)
    assert got["b"]["statistical_parity_diff"] == pytest.approx(1.0 - 4 / 8)
    against = {r["group"]: r for r in monitor.fairness(df, "g", reference="a").collect()}
    assert against["a"]["predictive_parity_diff"] == 0.0
    assert against["b"]["predictive_parity_diff"] == pytest.approx(-0.5)
    assert None in against


def _psi(now, then, edges):
    def shares(values):
        bins = np.searchsorted(edges, values, side="left")
        return [max(np.mean(bins == b), 1e-6) for b in range(len(edges) + 1)]

    pairs = [(a, b) for a, b in zip(shares(now), shares(then)) if a > 1e-6 or b > 1e-6]
    return sum((a - b) * math.log(a / b) for a, b in pairs)


def test_numeric_drift(spark):
    rng = np.random.default_rng(2)
    then, now = rng.normal(10, 2, 500), rng.normal(11, 3, 400)
    base = spark.createDataFrame([(float(v),) for v in then] + [(None,)] * 5, "x double")
    current = spark.createDataFrame([(float(v),) for v in now] + [(None,)] * 40, "x double")
    row = monitor.numeric_drift(current, base, ["x"]).first()
    low, high = then.min(), then.max()
    edges = [low + (high - low) * (i / 10) for i in range(1, 10)]
    assert row["psi"] == pytest.approx(_psi(now, then, edges))
    assert row["baseline_std"] == pytest.approx(then.std(ddof=1))
    assert row["current_mean"] == pytest.approx(now.mean())
    assert row["current_null_rate"] == pytest.approx(40 / 440)
    quantile = monitor.numeric_drift(current, base, ["x"], method="quantile").first()
    assert quantile["psi"] > 0.05
    assert monitor.numeric_drift(base, base, ["x"]).first()["psi"] == pytest.approx(0.0)


def test_quantile_drift_reads_sketches_alone(spark, tmp_path):
    rng = np.random.default_rng(5)
    then, now = rng.normal(10, 2, 900), rng.normal(11, 3, 400)
    base = spark.createDataFrame([(i % 7, float(v), i % 3) for i, v in enumerate(then)] + [(8, None, None)] * 5, "part int, x double, y int")
    current = spark.createDataFrame([(float(v), 1) for v in now] + [(None, None)] * 40, "x double, y int")
    monitor.baseline_sketches(base, ["x", "y"], by=["part"]).write.parquet(f"{tmp_path}/sketches")
    stored = spark.read.parquet(f"{tmp_path}/sketches")
    assert stored.count() == 16
    got = {r["column"]: r for r in monitor.quantile_drift(current, stored).collect()}
    row, edges = got["x"], [float(np.sort(then)[math.ceil(i / 10 * 900) - 1]) for i in range(1, 10)]
    assert row["psi"] == pytest.approx(_psi(now, then, edges))
    assert row["baseline_std"] == pytest.approx(then.std(ddof=1)) and row["baseline_mean"] == pytest.approx(then.mean())
    assert row["current_std"] == pytest.approx(now.std(ddof=1)) and row["current_mean"] == pytest.approx(now.mean())
    assert (row["baseline_rows"], row["current_rows"]) == (905, 440)
    assert row["current_null_rate"] == pytest.approx(40 / 440)
    # Equal edges leave empty bins, which count on neither side.
    assert got["y"]["psi"] == pytest.approx(_psi(np.ones(400), np.arange(900) % 3, [0, 0, 0, 1, 1, 1, 2, 2, 2]))


def test_quantile_drift_of_a_large_baseline_is_close(spark):
    base = spark.range(200_000).selectExpr("CAST(pmod(hash(id), 1000003) AS double) AS x")
    same_shape = spark.range(200_000, 230_000).selectExpr("CAST(pmod(hash(id), 1000003) AS double) AS x")
    sketches = monitor.baseline_sketches(base, ["x"], size=1024)
    row = monitor.quantile_drift(same_shape, sketches).first()
    assert 0 <= row["psi"] < 0.005 and row["baseline_rows"] == 200_000
    assert monitor.quantile_drift(same_shape.selectExpr("x / 2 AS x"), sketches).first()["psi"] > 1


def test_quantile_drift_without_values(spark):
    empty, gone = spark.createDataFrame([], "x double"), spark.createDataFrame([(None,), (None,)], "x double")
    some = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    row = monitor.quantile_drift(gone, monitor.baseline_sketches(some, ["x"])).first()
    assert (row["current_rows"], row["current_null_rate"], row["current_mean"], row["baseline_mean"]) == (2, 1.0, None, 1.5)
    row = monitor.quantile_drift(empty, monitor.baseline_sketches(some, ["x"])).first()
    assert (row["current_rows"], row["current_null_rate"]) == (0, None)
    row = monitor.quantile_drift(some, monitor.baseline_sketches(gone, ["x"])).first()
    assert (row["baseline_rows"], row["baseline_null_rate"], row["baseline_mean"], row["current_mean"]) == (2, 1.0, None, 1.5)


def test_large_offset_keeps_the_spread(spark):
    values = [1e9 + v for v in (0.0, 1.0, 2.0, 3.0)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert monitor.numeric_drift(df, df, ["x"]).first()["current_std"] == pytest.approx(np.std([0, 1, 2, 3], ddof=1))


def test_column_that_is_null_on_one_side(spark):
    base = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    gone = spark.createDataFrame([(None,), (None,)], "x double")
    row = monitor.numeric_drift(gone, base, ["x"]).first()
    assert (row["current_rows"], row["current_null_rate"], row["current_mean"]) == (2, 1.0, None)


def test_categorical_drift(spark):
    base = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "x string")
    current = spark.createDataFrame([("a",), ("c",)], "x string")
    out = monitor.categorical_drift(current, base, ["x"])
    assert rows(out) == [("x", 0.25, 0.0, 0.5)]


def test_windows_per_version(spark):
    data = [(at(1, 3), "v1", 1, 1), (at(1, 4), "v1", 0, 1), (at(1, 5), "v2", 1, 0), (at(2), "v1", None, 0)]
    df = spark.createDataFrame(data, "inference_timestamp timestamp_ntz, model_version string, is_fraud int, prediction int")
    out = monitor.metrics_over_time(df)
    assert rows(out, "window_start", "model_version", "n", "precision") == [
        (at(1), "v1", 2, 0.5), (at(1), "v2", 1, 0.0), (at(2), "v1", 1, 0.0)
    ]
