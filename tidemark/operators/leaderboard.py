"""Many linear models on the same rows, compared in one scan.

Every row meets all models at once: its features are one array, the models an array of coefficient arrays, unfolded to one
scored row a model. Metrics are those of all rows, grouped by run, so a board of any number of models reads
its input once. A champion is one more run.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.metrics import binary_metrics

# Sums in no fixed order: differences below this many digits are none.
DIGITS = 12
METRICS = ("auc_roc", "auc_pr", "f1", "precision", "recall", "accuracy")


@dataclass(frozen=True)
class LinearModel:
    """A logistic model on an array of features."""

    run_tag: str
    coefficients: tuple[float, ...]
    intercept: float = 0.0
    threshold: float = 0.5

    @classmethod
    def of(cls, run_tag: str, fitted) -> LinearModel:
        """The classifier of a fitted pipeline, on its scaled features."""
        last = fitted.stages[-1]
        return cls(run_tag, tuple(last.coefficients.toArray().tolist()), last.intercept, last.getThreshold())


def score_all(df: DataFrame, features: Column, models: Sequence[LinearModel], keep: Sequence[str] = ("is_fraud",)) -> DataFrame:
    """``keep, run_tag, prob_fraud, prediction``: every row under every model; a null feature makes a null score and no prediction."""

    def run(m: LinearModel) -> Column:
        weights = F.array(*[F.lit(float(c)) for c in m.coefficients])
        products = F.zip_with(F.col("__x"), weights, lambda a, b: a * b)
        margin = F.aggregate(products, F.lit(float(m.intercept)), lambda total, x: total + x)
        chance = 1 / (1 + F.exp(-margin))
        return F.struct(F.lit(m.run_tag).alias("run_tag"), chance.alias("prob_fraud"), F.lit(float(m.threshold)).alias("__t"))

    scored = df.select(*keep, features.alias("__x")).select(*keep, F.inline(F.array(*map(run, models))))
    return scored.select(*keep, "run_tag", "prob_fraud", (F.col("prob_fraud") > F.col("__t")).cast("long").alias("prediction"))


def leaderboard(train: DataFrame, validation: DataFrame, features: Column, models: Sequence[LinearModel], label: str = "is_fraud") -> DataFrame:
    """One row a run: the six metrics on both sides, the gaps of both areas, and the position by the area under the
    validation PR curve, ties by run tag."""
    sides = train.withColumn("side", F.lit("train")).unionByName(validation.withColumn("side", F.lit("val")), allowMissingColumns=True)
    found = binary_metrics(score_all(sides, features, models, (label, "side")), label, by=("run_tag", "side"))
    wide = found.groupBy("run_tag").agg(*[F.max(F.when(F.col("side") == s, F.col(m))).alias(f"{s}_{m}") for s in ("train", "val") for m in METRICS])
    gaps = [(F.col(f"train_{m}") - F.col(f"val_{m}")).alias(f"gap_{m}") for m in ("auc_pr", "auc_roc")]
    order = Window.orderBy(F.round("val_auc_pr", DIGITS).desc_nulls_last(), "run_tag")  # one row a run
    return wide.select("*", *gaps, F.row_number().over(order).alias("position"))


def worth_a_look(board: DataFrame, least: float = 0.1, gap: float = 0.05) -> DataFrame:
    """Runs above a validation PR area, with whether they lose more than ``gap`` of it from train to validation."""
    return board.filter(F.col("val_auc_pr") > least).withColumn("overfits", F.col("gap_auc_pr") > gap)


def decide(board: DataFrame, champion: str | None, metric: str = "val_auc_pr") -> DataFrame:
    """One row ``champion, challenger, champion_value, challenger_value, promoted``: the best other run wins only if it is
    strictly better, or if there is no champion on the board."""
    value = F.round(metric, DIGITS)
    own = F.col("run_tag") == F.lit(champion)
    best = F.max_by(F.struct("run_tag", value.alias("value")), F.when(~F.coalesce(own, F.lit(False)), F.struct(value, -F.col("position"))))
    both = board.agg(best.alias("new"), F.max(F.when(own, F.struct("run_tag", value.alias("value")))).alias("old"))
    wins = F.when(F.col("old").isNull(), True).otherwise(F.coalesce(F.col("new.value") > F.col("old.value"), F.lit(False)))
    return both.select(
        F.col("old.run_tag").alias("champion"), F.col("new.run_tag").alias("challenger"),
        F.col("old.value").alias("champion_value"), F.col("new.value").alias("challenger_value"), wins.alias("promoted"),
    )
