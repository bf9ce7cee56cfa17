"""Preparation of features as fitted tables, and the certificate of a fitted classifier.

The tables say what a fit learned from its rows: medians, categories by frequency, and the variance and scale of every
feature. Each is an aggregate, combined before its shuffle, and they are applied by joins and expressions, so a
preparation can be stored, compared, and read as data. The numbers are those of the library's stages. Prepared rows are
long: one row per row key and feature; categories that a row does not have are left out, they are 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import ColumnRoutes, route_columns
from tidemark.operators.profile import ROW_FEATURES

UNKNOWN = "__unknown"


@dataclass(frozen=True)
class Settings:
    """``middle``: the share of values below the one that stands for a missing value. ``least_variance``: a feature
    that varies no more is left out. ``accuracy``: of the quantile, 1 / accuracy of the rows off at most. ``scale``: divide by the deviation."""

    middle: float = 0.5
    least_variance: float = 0.01
    accuracy: int = 10_000
    scale: bool = True


@dataclass(frozen=True)
class Prepared:
    """``fills``: one row, a column for each imputed column. ``categories``: column, value, n, place (most frequent first, then by
    value). ``features``: feature, variance, deviation, kept."""

    routes: ColumnRoutes
    settings: Settings
    fills: DataFrame
    categories: DataFrame
    features: DataFrame


def _present(c: str) -> Column:
    """The value as a double, null where it is missing; NaN is missing."""
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def _dense(routes: ColumnRoutes, fills: Column) -> dict[str, Column]:
    """Expressions of the features that every row has, by name."""
    filled = {f"{c}_filled": F.coalesce(_present(c), fills[c]) for c in routes.imputed}
    plain = {c: F.col(c).cast("double") for c in routes.zero_filled}
    flags = {f"{c}_dbl": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in routes.flags}
    return {**filled, **plain, **flags, **{name: F.expr(sql).cast("double") for name, sql in ROW_FEATURES.items()}}


def _cells(columns: Sequence[str]) -> Column:
    return F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])


def _feature_of(value: Column) -> Column:
    return F.concat("column", F.lit("_is_"), value)


def fit_preparation(df: DataFrame, routes: ColumnRoutes | None = None, settings: Settings = Settings()) -> Prepared:
    """What ``df`` teaches. Three narrow passes: middles, categories, and the moments of all other features at once."""
    routes = routes or route_columns(df.schema)
    fills = df.agg(*[F.percentile_approx(_present(c), settings.middle, settings.accuracy).alias(c) for c in routes.imputed])
    seen = df.select(F.inline(_cells(routes.categorical))).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    by_use = Window.partitionBy("column").orderBy(F.desc("n"), "value")
    categories = seen.filter("value IS NOT NULL").withColumn("place", F.row_number().over(by_use) - 1)
    dense = _dense(routes, fills.select(F.struct("*")).scalar())
    moments = df.agg(*[F.struct(F.lit(name).alias("feature"), F.var_samp(x).alias("variance")).alias(f"f{k}") for k, (name, x) in enumerate(dense.items())])
    every = moments.select(F.inline(F.array(*moments.columns)))
    # A category is 1 on its rows and 0 elsewhere. A missing value is a category of its own, for rows to come as well.
    whole = df.agg(F.count(F.lit(1))).scalar()
    named = seen.select("column", F.coalesce("value", F.lit(UNKNOWN)).alias("value"), "n")
    spare = df.sparkSession.createDataFrame([(c, UNKNOWN, 0) for c in routes.categorical], "column string, value string, n long")
    ones = named.unionByName(spare).groupBy("column", "value").agg(F.sum("n").alias("n"))
    share = F.col("n") / F.col("whole")
    coded = ones.withColumn("whole", whole).select(
        _feature_of(F.col("value")).alias("feature"), F.try_divide(share * (1 - share) * F.col("whole"), F.col("whole") - 1).alias("variance")
    )
    features = every.unionByName(coded).select(
        "feature", "variance", F.sqrt("variance").alias("deviation"), (F.coalesce("variance", F.lit(0.0)) > settings.least_variance).alias("kept")
    )
    return Prepared(routes, settings, fills, categories, features)


def prepare(df: DataFrame, fitted: Prepared, keys: Sequence[str]) -> DataFrame:
    """``keys, feature, value`` of the kept features. A value that the fit has not seen is the missing one.

    A null left in a feature that is not imputed stops the query, as a gate.
    """
    dense = _dense(fitted.routes, fitted.fills.select(F.struct("*")).scalar())

    def gated(name: str, x: Column) -> Column:
        return F.coalesce(x, F.raise_error(F.lit(f"null in {name}")).cast("double"))

    plain = F.array(*[F.struct(F.lit(name).alias("feature"), gated(name, x).alias("x")) for name, x in dense.items()])
    numbers = df.select(*keys, F.inline(plain))
    coded = df.select(*keys, F.inline(_cells(fitted.routes.categorical))).join(fitted.categories.select("column", "value", "place"), ["column", "value"], "left")
    known = F.when(F.col("place").isNotNull(), F.col("value")).otherwise(F.lit(UNKNOWN))
    ones = coded.select(*keys, _feature_of(known).alias("feature"), F.lit(1.0).alias("x"))
    kept = fitted.features.filter("kept").select("feature", "deviation")
    value = F.col("x") / F.col("deviation") if fitted.settings.scale else F.col("x")
    return numbers.unionByName(ones).join(kept, "feature").select(*keys, "feature", value.alias("value"))


def optimality(
    prepared: DataFrame, rows: DataFrame, fitted: DataFrame, intercept: float, keys: Sequence[str], reg_param: float, elastic_net_param: float, label: str = "is_fraud", weight: str = "class_weight"
) -> DataFrame:
    """``feature, coefficient, gradient, residual``: how far a penalised weighted logistic fit is from its optimum.

    ``prepared``: long features of ``rows``, which have the keys, the label and the weight; ``fitted``: feature,
    coefficient. ``gradient`` is that of the mean weighted loss with the ridge part; ``residual`` what no subgradient of
    the lasso part can cancel, 0 at the optimum. The intercept is the feature named ``(intercept)``. One join on
    the row key for the margins, one sum a feature.
    """
    lasso, ridge = reg_param * elastic_net_param, reg_param * (1 - elastic_net_param)
    margins = prepared.join(fitted, "feature").groupBy(*keys).agg(F.sum(F.col("value") * F.col("coefficient")).alias("m"))
    scored = rows.select(*keys, F.col(label).cast("double").alias("y"), F.col(weight).alias("w")).join(margins, list(keys), "left")
    chance = 1 / (1 + F.exp(-(F.coalesce("m", F.lit(0.0)) + F.lit(intercept))))
    errors = scored.select(*keys, (F.col("w") * (chance - F.col("y"))).alias("e"), "w")
    total = scored.agg(F.sum("w")).scalar()
    slopes = prepared.join(errors, list(keys)).groupBy("feature").agg(F.sum(F.col("value") * F.col("e")).alias("slope"))
    gradient = F.coalesce("slope", F.lit(0.0)) / total + ridge * F.col("coefficient")
    pulled = F.when(F.col("coefficient") != 0, F.abs(F.col("gradient") + F.signum("coefficient") * lasso)).otherwise(F.greatest(F.lit(0.0), F.abs("gradient") - lasso))
    table = fitted.join(slopes, "feature", "left").withColumn("gradient", gradient).select("feature", "coefficient", "gradient", pulled.alias("residual"))
    level = errors.agg((F.sum("e") / F.sum("w")).alias("gradient"))
    free = level.select(F.lit("(intercept)").alias("feature"), F.lit(intercept).alias("coefficient"), "gradient", F.abs("gradient").alias("residual"))
    return table.unionByName(free)
