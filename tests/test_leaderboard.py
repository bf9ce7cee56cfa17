"""Many models in one scan against one model at a time, and the decision between them."""

from __future__ import annotations

import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.operators import leaderboard, metrics, model
from tidemark.operators.checks import with_class_weights

SCHEMA = "is_fraud int, a double, b double"


def _rows(spark, n, seed):
    rng = random.Random(seed)
    data = []
    for _ in range(n):
        y = rng.choice([0, 0, 0, 1, None])
        data.append((y, round(rng.gauss(0.8 * (y or 0), 1), 1), rng.choice([0.0, 1.0, 2.0])))
    return spark.createDataFrame([*data, (1, None, 1.0), (0, None, 0.0)], SCHEMA)


RUNS = [leaderboard.LinearModel("m1", (1.0, 0.0), -1.0), leaderboard.LinearModel("m2", (-0.5, 0.4), 0.0, 0.6), leaderboard.LinearModel("m0", (1.0, 0.0), -1.0)]
FEATURES = ("a", "b")


def test_a_board_equals_one_model_at_a_time(spark):
    train, validation = _rows(spark, 300, 1), _rows(spark, 200, 2)
    board = {r["run_tag"]: r.asDict() for r in leaderboard.leaderboard(train, validation, F.array(*FEATURES), RUNS).collect()}
    for run in RUNS:
        for side, rows in (("train", train), ("val", validation)):
            one = metrics.binary_metrics(leaderboard.score_all(rows, F.array(*FEATURES), [run])).first().asDict()
            for name, value in one.items():
                assert board[run.run_tag][f"{side}_{name}"] == pytest.approx(value, abs=1e-12)
        assert board[run.run_tag]["gap_auc_pr"] == pytest.approx(board[run.run_tag]["train_auc_pr"] - board[run.run_tag]["val_auc_pr"])
    assert sorted(r["position"] for r in board.values()) == [1, 2, 3]
    assert board["m1"]["position"] == board["m0"]["position"] + 1  # equal values go by name


def test_the_input_is_scanned_once_a_side(spark, tmp_path):
    for side in ("train", "val"):
        _rows(spark, 50, 3).write.parquet(f"{tmp_path}/{side}")
    board = leaderboard.leaderboard(*(spark.read.parquet(f"{tmp_path}/{s}") for s in ("train", "val")), F.array(*FEATURES), RUNS)
    board.collect()
    plan = board._jdf.queryExecution().executedPlan().toString()
    assert plan[: plan.find("Initial Plan")].count("FileScan parquet") == 2


def test_only_a_strictly_better_run_is_promoted(spark):
    board = leaderboard.leaderboard(_rows(spark, 300, 1), _rows(spark, 200, 2), F.array(*FEATURES), RUNS)

    def decision(champion):
        r = leaderboard.decide(board, champion).first()
        return r["champion"], r["challenger"], r["promoted"]

    assert decision("m1") == ("m1", "m0", False)  # a tie is no win
    assert decision("m2") == ("m2", "m0", True)
    assert decision(None) == (None, "m0", True) and decision("gone") == (None, "m0", True)
    assert {r["run_tag"] for r in leaderboard.worth_a_look(board, least=2.0).collect()} == set()


def test_fitted_models_score_as_the_library_does(spark):
    rows = with_class_weights(_rows(spark, 300, 4).filter("is_fraud is not null and a is not null").selectExpr(
        "is_fraud", "a + 5 AS claimed_amount_eur", "cast(b AS int) AS n_parties_involved", "1L AS count_claims_30d", "0 AS is_new_policy_risk", "1.0D AS claims_7d_vs_avg_30d_ratio", "'x' AS gender"
    ))
    fitted = model.fit_model(rows, model.ModelParams(0.01, 0.5, 50, 0.4))
    ready = fitted.transform(rows)
    mine = leaderboard.score_all(ready.drop("prediction"), vector_to_array(model.FEATURES), [leaderboard.LinearModel.of("r", fitted)], ("probability",))
    both = mine.select(model.probability().alias("theirs"), "prob_fraud", "prediction")
    assert both.filter(F.abs(F.col("theirs") - F.col("prob_fraud")) > 1e-12).isEmpty()
    assert both.filter((F.col("theirs") > 0.4).cast("long") != F.col("prediction")).isEmpty()
