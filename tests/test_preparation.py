"""Preparation tables against the library's stages, and the optimality of a fit."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.functions.columns import route_columns
from tidemark.operators import model, preparation
from tidemark.operators.checks import with_class_weights

SCHEMA = (
    "claim_id long, is_fraud int, claimed_amount_eur double, n_parties_involved int, count_claims_30d long, is_new_policy_risk int, "
    "claims_7d_vs_avg_30d_ratio double, police_report_filed int, gender string, region_type string, constant int"
)


@pytest.fixture(scope="module")
def claims(spark):
    rng = random.Random(7)
    data = []
    for i in range(400):
        y = int(rng.random() < 0.2)
        amount = None if i % 19 == 0 else max(0.0, round(rng.gauss(100 + 60 * y, 30), 2))
        data.append((
            i, y, amount, rng.choice([None, 1, 2, 3]), rng.randint(0, 4), rng.choice([0, 1, None]),
            rng.choice([None, float("nan"), 0.5, 1.0, 2.5]), rng.choice([0, 1, None]), rng.choice(["F", "M", None]), rng.choice(["urban", "urban", "rural", "coast"]), 3,
        ))
    return with_class_weights(spark.createDataFrame(data, SCHEMA)).repartition(3)


def _by_library(claims, rows):
    """Features by name and row, of the library's stages fitted on ``claims``."""
    routes = route_columns(claims.drop(model.WEIGHT).schema)
    fitted = Pipeline(stages=[*model.preparation_stages(routes), model.classifier(model.ModelParams())]).fit(claims)
    names = model._feature_names(fitted)
    out = {}
    for r in fitted.transform(rows).select("claim_id", vector_to_array(model.FEATURES).alias("x")).collect():
        out.update({(r["claim_id"], n): x for n, x in zip(names, r["x"])})
    return names, out


def test_prepared_features_equal_the_library(claims):
    fitted = preparation.fit_preparation(claims.drop(model.WEIGHT))
    unseen = claims.filter("claim_id < 3").withColumns({"gender": F.lit("other"), "claim_id": F.col("claim_id") + 1000})
    rows = claims.unionByName(unseen)
    names, want = _by_library(claims, rows)
    got = {(r["claim_id"], r["feature"]): r["value"] for r in preparation.prepare(rows, fitted, ["claim_id"]).collect()}
    assert {r["feature"] for r in fitted.features.filter("kept").collect()} == set(names)
    assert "constant_filled" not in names and "gender_is___unknown" in names
    for key, x in want.items():
        assert got.get(key, 0.0) == pytest.approx(x, rel=1e-9, abs=1e-12), key
    assert set(got) <= set(want)
    assert [tuple(r) for r in fitted.categories.filter("column = 'region_type'").orderBy("place").select("value", "place").collect()][0] == ("urban", 0)


def test_settings_decide(claims):
    plain = preparation.fit_preparation(claims.drop(model.WEIGHT))
    strict = preparation.fit_preparation(claims.drop(model.WEIGHT), settings=preparation.Settings(middle=0.9, least_variance=1.0, scale=False))
    assert strict.fills.first()["claimed_amount_eur"] > plain.fills.first()["claimed_amount_eur"]
    kept = {r["feature"] for r in strict.features.filter("kept").collect()}
    assert "claimed_amount_eur_filled" in kept and "gender_is_F" not in kept
    amounts = preparation.prepare(claims, strict, ["claim_id"]).filter("feature = 'claimed_amount_eur_filled'")
    assert amounts.agg(F.max("value")).first()[0] == claims.agg(F.max("claimed_amount_eur")).first()[0]


def test_a_null_that_nothing_fills_stops_the_query(claims):
    fitted = preparation.fit_preparation(claims.drop(model.WEIGHT))
    holed = claims.withColumn("count_claims_30d", F.lit(None).cast("long"))
    with pytest.raises(Exception, match="null in count_claims_30d"):
        preparation.prepare(holed, fitted, ["claim_id"]).collect()


@pytest.mark.parametrize(("reg", "net"), [(0.01, 0.0), (0.02, 0.5)])
def test_a_fit_is_optimal_and_a_changed_one_is_not(claims, reg, net):
    params = model.ModelParams(reg, net, 200)
    trained = model.fit_model(claims, params)
    long = preparation.prepare(claims, preparation.fit_preparation(claims.drop(model.WEIGHT)), ["claim_id"])
    table = model.coefficients(trained, claims)

    def residuals(fitted, intercept):
        out = preparation.optimality(long, claims, fitted, intercept, ["claim_id"], reg, net)
        return {r["feature"]: r["residual"] for r in out.collect()}

    at = residuals(table, trained.stages[-1].intercept)
    assert len(at) == table.count() + 1 and max(at.values()) < 1e-3
    if net:
        assert table.filter("coefficient = 0").count() > 0
    moved = table.withColumn("coefficient", F.when(F.col("feature") == "claimed_amount_eur_filled", F.col("coefficient") + 0.3).otherwise(F.col("coefficient")))
    assert residuals(moved, trained.stages[-1].intercept)["claimed_amount_eur_filled"] > 1e-2


def test_optimality_equals_a_plain_gradient(claims):
    long = preparation.prepare(claims, preparation.fit_preparation(claims.drop(model.WEIGHT)), ["claim_id"])
    names = sorted({r["feature"] for r in long.select("feature").distinct().collect()})
    beta = {n: 0.1 * k - 0.5 for k, n in enumerate(names)}
    table = long.sparkSession.createDataFrame(list(beta.items()), "feature string, coefficient double")
    ids = [r["claim_id"] for r in claims.select("claim_id").collect()]
    x = np.zeros((len(ids), len(names)))
    for r in long.collect():
        x[ids.index(r["claim_id"]), names.index(r["feature"])] = r["value"]
    rows = {r["claim_id"]: (r["is_fraud"], r["class_weight"]) for r in claims.collect()}
    y, w = np.array([rows[i] for i in ids]).T
    b = np.array([beta[n] for n in names])
    e = w * (1 / (1 + np.exp(-(x @ b + 0.2))) - y) / w.sum()
    got = {r["feature"]: r["gradient"] for r in preparation.optimality(long, claims, table, 0.2, ["claim_id"], 0.1, 0.25).collect()}
    assert np.allclose([got[n] for n in names], x.T @ e + 0.075 * b) and np.isclose(got["(intercept)"], e.sum())
