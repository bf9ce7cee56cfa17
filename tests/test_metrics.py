"""Evaluation tables against plain computations on the same rows."""

from __future__ import annotations

import random

import numpy as np
import pytest
from helpers import rows, same
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from tidemark.operators import metrics

SCHEMA = "is_fraud int, prob_fraud double, prediction long"


def scored(spark, n=600, seed=1, digits=2):
    rng = random.Random(seed)
    data = []
    for _ in range(n):
        y = rng.choice([0, 0, 0, 1, None])
        p = round(min(1.0, max(0.0, rng.gauss(0.35 + 0.2 * (y or 0), 0.2))), digits)
        data.append((y, p, int(p >= 0.5)))
    return spark.createDataFrame(data, SCHEMA), [(y, p) for y, p, _ in data if y is not None]


def test_thresholds_are_those_of_an_even_grid(spark):
    df, _ = scored(spark)
    got = [r[0] for r in metrics.threshold_sweep(df).orderBy("threshold").select("threshold").collect()]
    assert got == list(np.linspace(0.01, 0.99, 99))


def test_sweep_against_plain_counts(spark):
    df, pairs = scored(spark)
    got = {r["threshold"]: r for r in metrics.threshold_sweep(df).collect()}
    best = (-1.0, 0.0)
    for t in np.linspace(0.01, 0.99, 99):
        tp = sum(1 for y, p in pairs if y == 1 and p >= t)
        fp = sum(1 for y, p in pairs if y == 0 and p >= t)
        fn = sum(1 for y, p in pairs if y == 1 and p < t)
        row = got[float(t)]
        assert (row["tp"], row["fp"], row["fn"]) == (tp, fp, fn)
        p, r = (tp / (tp + fp) if tp + fp else 0.0), (tp / (tp + fn) if tp + fn else 0.0)
        f = 2 * p * r / (p + r) if p + r else 0.0
        assert (row["precision"], row["recall"], row["f1"]) == pytest.approx((p, r, f))
        best = max(best, (row["f1"], -float(t)))
    found = metrics.best_threshold(df).first()
    assert (found["f1"], -found["threshold"]) == best


def test_sweep_without_rows_or_with_extreme_scores(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert {tuple(r)[1:] for r in metrics.threshold_sweep(empty).collect()} == {(0, 0, 0, 0.0, 0.0, 0.0)}
    edge = spark.createDataFrame([(1, 1.0, 1), (0, 0.0, 0), (1, None, 0)], SCHEMA)
    assert {(r["tp"], r["fp"], r["fn"]) for r in metrics.threshold_sweep(edge).collect()} == {(1, 0, 0)}


def _points(pairs):
    out = []
    for t in sorted({p for _, p in pairs}):
        out.append((t, sum(y == 1 and p >= t for y, p in pairs), sum(y == 0 and p >= t for y, p in pairs)))
    return out


@pytest.mark.parametrize("bits", [0, 1, 5, 12, 20])
def test_running_totals_do_not_depend_on_the_ranges(spark, bits):
    df, pairs = scored(spark, seed=bits + 1)
    got = metrics.score_totals(df, bits=bits)
    assert rows(got, "threshold", "tp", "fp") == sorted(_points(pairs), key=repr)


def test_ranges_never_fall_as_the_score_grows(spark):
    rng = random.Random(0)
    edges = [float(np.nextafter(2.0**k, s)) for k in range(-1074, 1024, 3) for s in (-np.inf, np.inf)] + [2.0**k for k in range(-1074, 1024)]
    values = [*edges, 0.0, 5e-324, 1.7976931348623157e308, float("inf"), *[rng.random() for _ in range(500)], *[rng.gauss(0, 1e9) for _ in range(500)]]
    values += [-v for v in values]
    df = spark.createDataFrame([(v,) for v in values], "s double")
    for bits in (0, 12, 20):
        got = df.select("s", metrics._range_of(F.col("s"), bits).alias("r")).orderBy("s").collect()
        numbers = [r["r"] for r in got]
        assert numbers == sorted(numbers)
        assert len(set(numbers)) > 1000


def test_extreme_scores(spark):
    values = [(i % 2, v, 0) for i, v in enumerate([float("inf"), float("-inf"), -0.0, 0.0, 1e-7, -5.5, 2.0, 1.0, 0.9999])]
    df = spark.createDataFrame(values, SCHEMA)
    assert rows(metrics.score_totals(df), "threshold", "tp", "fp") == sorted(_points([(y, p + 0.0) for y, p, _ in values]), key=repr)


@pytest.mark.parametrize("table", ["binary_metrics", "pr_curve", "roc_curve"])
def test_the_input_is_scanned_once(spark, table, tmp_path):
    df, _ = scored(spark)
    df.write.parquet(f"{tmp_path}/scored")
    out = getattr(metrics, table)(spark.read.parquet(f"{tmp_path}/scored"))
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.find("Initial Plan")]
    assert final.count("FileScan parquet") == 1 and "ReusedExchange" in final


def test_metrics_of_rows_without_scores_or_labels(spark):
    df = spark.createDataFrame([(1, None, 1), (0, 0.3, 0), (1, 0.3, 0), (None, 0.9, 1), (0, 0.1, None)], SCHEMA)
    areas, cells = metrics.curve_areas(df).first(), metrics.label_metrics(df).first()
    assert metrics.binary_metrics(df).first().asDict() == {**areas.asDict(), **cells.asDict()}
    nothing = metrics.binary_metrics(df.limit(0)).first()
    assert nothing["auc_roc"] is None and nothing["accuracy"] == 0.0


def test_rows_without_a_score_take_no_part(spark):
    df = spark.createDataFrame([(1, 0.5, 1), (1, None, 0), (0, None, 0), (0, 0.2, 0)], SCHEMA)
    assert rows(metrics.score_totals(df), "threshold", "tp", "fp", "positives") == [(0.2, 1, 1, 1), (0.5, 1, 0, 1)]
    assert rows(metrics.calibration(df), "bin", "n") == [(1, 1), (4, 1)]


def test_one_score_holding_most_rows(spark):
    data = [(i % 2, 0.5, 1) for i in range(300)] + [(1, 0.9, 1), (0, 0.1, 0)]
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(metrics.score_totals(df), "threshold", "tp", "fp") == [(0.1, 151, 151), (0.5, 151, 150), (0.9, 1, 0)]


def test_curves_and_their_end_points(spark):
    df = spark.createDataFrame([(1, 0.9, 1), (0, 0.9, 1), (1, 0.4, 0), (0, 0.2, 0)], SCHEMA)
    assert rows(metrics.pr_curve(df), "threshold", "precision", "recall") == sorted(
        [(0.9, 0.5, 0.5), (0.4, round(2 / 3, 8), 1.0), (0.2, 0.5, 1.0), (None, 1.0, 0.0)], key=repr
    )
    assert rows(metrics.roc_curve(df), "threshold", "fpr", "tpr") == sorted(
        [(0.9, 0.5, 0.5), (0.4, 0.5, 1.0), (0.2, 1.0, 1.0), (None, 0.0, 0.0)], key=repr
    )


def test_curves_without_positives(spark):
    df = spark.createDataFrame([(0, 0.9, 1), (0, 0.2, 0)], SCHEMA)
    assert {r["recall"] for r in metrics.pr_curve(df).filter("threshold IS NOT NULL").collect()} == {1.0}
    assert {r["tpr"] for r in metrics.roc_curve(df).filter("threshold IS NOT NULL").collect()} == {None}


def test_areas_and_label_metrics_equal_the_library(spark):
    df, _ = scored(spark, digits=3)
    known = df.filter("is_fraud IS NOT NULL").withColumn("prediction", F.col("prediction").cast("double"))
    got = metrics.binary_metrics(df).first().asDict()
    for name, metric in (("auc_roc", "areaUnderROC"), ("auc_pr", "areaUnderPR")):
        exact = BinaryClassificationEvaluator(labelCol="is_fraud", rawPredictionCol="prob_fraud", metricName=metric, numBins=0)
        assert got[name] == pytest.approx(exact.evaluate(known), abs=1e-12)
    for name, metric in (("f1", "f1"), ("precision", "weightedPrecision"), ("recall", "weightedRecall"), ("accuracy", "accuracy")):
        library = MulticlassClassificationEvaluator(labelCol="is_fraud", predictionCol="prediction", metricName=metric)
        assert got[name] == pytest.approx(library.evaluate(known), abs=1e-12)


def test_confusion_and_report(spark):
    df = spark.createDataFrame([(1, 0.9, 1), (0, 0.9, 1), (1, 0.4, 0), (0, 0.2, 0), (0, 0.1, 0), (None, 0.9, 1)], SCHEMA)
    assert rows(metrics.confusion(df)) == [(0, 0, 2, 66.66666667), (0, 1, 1, 33.33333333), (1, 0, 1, 50.0), (1, 1, 1, 50.0)]
    report = {r[0]: tuple(r[1:]) for r in metrics.class_report(df).collect()}
    assert report["Fraud"] == (0.5, 0.5, 0.5, 2)
    assert report["Legit"] == pytest.approx((2 / 3, 2 / 3, 2 / 3, 3))
    assert report["accuracy"] == (None, None, 0.6, 5)
    assert report["weighted avg"][2] == pytest.approx(0.6)
    never = df.withColumn("prediction", F.lit(0))
    assert {r[0]: r[1] for r in metrics.class_report(never).collect()}["Fraud"] == 0.0


def test_calibration_bins_include_their_upper_edge(spark):
    edges = np.linspace(0.0, 1.0, 11)
    values = [0.0, 0.05, 0.1, 0.30000000000000004, 0.3, 0.95, 1.0]
    df = spark.createDataFrame([(i % 2, v, 0) for i, v in enumerate(values)], SCHEMA)
    want = {}
    for i, v in enumerate(values):
        want.setdefault(int(np.searchsorted(edges[1:-1], v)), []).append((i % 2, v))
    got = {r["bin"]: r for r in metrics.calibration(df).collect()}
    assert set(got) == set(want)
    for b, members in want.items():
        assert got[b]["n"] == len(members)
        assert got[b]["mean_score"] == pytest.approx(np.mean([v for _, v in members]))
        assert got[b]["fraction_positive"] == pytest.approx(np.mean([y for y, _ in members]))


def test_order_of_rows_does_not_matter(spark):
    df, _ = scored(spark, n=200)
    same(metrics.pr_curve(df.orderBy(F.desc("prob_fraud"))), metrics.pr_curve(df.repartition(7)))


def test_a_nan_score_is_no_score(spark):
    frame = spark.createDataFrame([(1, float("nan"), 1.0), (0, 0.2, 0.0)], "is_fraud int, prob_fraud double, prediction double")
    with pytest.raises(Exception, match="NaN in prob_fraud"):
        metrics.curve_areas(frame).collect()
