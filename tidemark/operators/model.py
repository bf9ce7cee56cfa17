"""Preparation, training, scoring and comparison of the classification model."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (
    Imputer,
    OneHotEncoder,
    OneHotEncoderModel,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    VarianceThresholdSelector,
    VarianceThresholdSelectorModel,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.util import inheritable_thread_target

from tidemark.functions.columns import ColumnRoutes, route_columns
from tidemark.operators.metrics import best_thresholds, binary_metrics, curve_areas, label_metrics
from tidemark.operators.profile import ROW_FEATURES, flag_sql, row_feature_sql
from tidemark.operators.split import TRAIN, VALIDATION, training_rows

LABEL, WEIGHT, FEATURES = "is_fraud", "class_weight", "model_input"

# Preparation settings.
IMPUTER_STRATEGY = "median"
VARIANCE_THRESHOLD = 0.01
INDEXER_ORDER = "frequencyDesc"
# Grid of the search.
REG_PARAMS = (0.001, 0.01, 0.1)
ELASTIC_NET_PARAMS = (0.0, 0.5)
MAX_ITERS = (100,)
# Fixed value: how many coefficients a report shows.
TOP_COEFFICIENTS = 30


@dataclass(frozen=True)
class ModelParams:
    reg_param: float = REG_PARAMS[0]
    elastic_net_param: float = ELASTIC_NET_PARAMS[0]
    max_iter: int = MAX_ITERS[0]
    threshold: float = 0.5

    @property
    def tag(self) -> str:
        return f"penalty={self.reg_param:g} lasso={self.elastic_net_param:g} steps={self.max_iter}"


DEFAULT_GRID = tuple(
    ModelParams(r, e, i) for r, e, i in product(REG_PARAMS, ELASTIC_NET_PARAMS, MAX_ITERS)
)


def _select_all_and(expressions: list[str]) -> str:
    return ", ".join(["SELECT *", *expressions]) + " FROM __THIS__"


def preparation_stages(routes: ColumnRoutes) -> list:
    """Impute, cast flags, add row features, index, one-hot, assemble, select, scale.

    Nulls left after imputation stop the assembler: that is the quality gate.
    """
    imputed = [f"{c}_filled" for c in routes.imputed]
    indexed = [f"{c}_code" for c in routes.categorical]
    encoded = [f"{c}_is" for c in routes.categorical]
    assembled = [
        *imputed,
        *routes.zero_filled,
        *[f"{c}_dbl" for c in routes.flags],
        *encoded,
        *ROW_FEATURES,
    ]
    return [
        Imputer(inputCols=routes.imputed, outputCols=imputed, strategy=IMPUTER_STRATEGY),
        SQLTransformer(statement=_select_all_and(flag_sql(routes.flags))),
        SQLTransformer(statement=_select_all_and(row_feature_sql())),
        StringIndexer(
            inputCols=routes.categorical,
            outputCols=indexed,
            handleInvalid="keep",
            stringOrderType=INDEXER_ORDER,
        ),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid="keep", dropLast=True),
        VectorAssembler(inputCols=assembled, outputCol="all_features", handleInvalid="error"),
        VarianceThresholdSelector(
            featuresCol="all_features",
            outputCol="varied_features",
            varianceThreshold=VARIANCE_THRESHOLD,
        ),
        StandardScaler(
            inputCol="varied_features", outputCol=FEATURES, withMean=False, withStd=True
        ),
    ]


def classifier(params: ModelParams) -> LogisticRegression:
    """Weighted elastic-net logistic regression; scaling is done before it."""
    return LogisticRegression(
        featuresCol=FEATURES,
        labelCol=LABEL,
        weightCol=WEIGHT,
        maxIter=params.max_iter,
        regParam=params.reg_param,
        elasticNetParam=params.elastic_net_param,
        family="binomial",
        standardization=False,
        threshold=params.threshold,
    )


def fit_model(weighted: DataFrame, params: ModelParams = ModelParams()) -> PipelineModel:
    """Fit preparation and classifier on rows that carry ``class_weight``."""
    routes = route_columns(weighted.drop(WEIGHT).schema)
    return Pipeline(stages=[*preparation_stages(routes), classifier(params)]).fit(weighted)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# --- scoring ----------------------------------------------------------------------------------


def probability(column: str = "probability"):
    """The probability of class 1 as a plain column."""
    return vector_to_array(F.col(column)).getItem(1)


def _predicted(model: PipelineModel, df: DataFrame, version: int | str, now: dt.datetime | None):
    return model.transform(df).select(
        *df.columns,
        F.col("prediction").cast("long").alias("prediction"),
        probability().alias("prob_fraud"),
        F.lit(version).alias("model_version"),
        (F.lit(now) if now else F.current_timestamp()).alias("inference_timestamp"),
    )


def score(
    model: PipelineModel, df: DataFrame, version: int | str, now: dt.datetime | None = None
) -> DataFrame:
    """Input columns, a null label to be filled later, prediction, probability, version, time."""
    unlabelled = df.drop(LABEL)
    scored = _predicted(model, unlabelled, version, now)
    names = unlabelled.columns
    rest = [c for c in scored.columns if c not in names]
    return scored.select(*names, F.lit(None).cast("long").alias(LABEL), *rest)


def baseline(
    model: PipelineModel, test: DataFrame, version: int | str, now: dt.datetime | None = None
) -> DataFrame:
    """The labelled test rows as scored by the winner: what monitoring compares with."""
    return _predicted(model, test, version, now)


# --- evaluation -------------------------------------------------------------------------------


def evaluate(predictions: DataFrame) -> dict[str, float]:
    """Exact areas under ROC and PR, weighted F1, precision and recall, accuracy.

    The areas are those of ``curve_areas``, so a promotion and the metric tables never disagree.
    """
    areas = curve_areas(predictions.withColumn("prob_fraud", probability()), LABEL, "prob_fraud").first().asDict()
    return {**areas, **label_metrics(predictions).first().asDict()}


def _feature_names(model: PipelineModel) -> list[str]:
    """Names after one-hot expansion and variance selection, read off the fitted stages."""
    indexers = [s for s in model.stages if isinstance(s, StringIndexerModel)]
    labels = {name: values for s in indexers for name, values in zip(s.getOutputCols(), s.labelsArray)}
    encoders = [s for s in model.stages if isinstance(s, OneHotEncoderModel)]
    expanded = {}
    for s in encoders:
        for source, name, size in zip(s.getInputCols(), s.getOutputCols(), s.categorySizes):
            categories = [*labels.get(source, ()), "__unknown"]
            slots = size - 1 if s.getDropLast() and s.getHandleInvalid() != "keep" else size
            expanded[name] = [f"{name}_{c}" for c in categories[:slots]]
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    names = [n for column in assembler.getInputCols() for n in expanded.get(column, [column])]
    selector = next(s for s in model.stages if isinstance(s, VarianceThresholdSelectorModel))
    return [names[i] for i in selector.selectedFeatures]


def coefficients(model: PipelineModel, df: DataFrame, n: int | None = None) -> DataFrame:
    """(feature, coefficient), largest absolute value first; the first ``n`` if it is given."""
    pairs = zip(_feature_names(model), model.stages[-1].coefficients.toArray().tolist())
    table = df.sparkSession.createDataFrame(list(pairs), "feature string, coefficient double")
    table = table.orderBy(F.abs("coefficient").desc(), "feature")
    return table if n is None else table.limit(n)


@dataclass(frozen=True)
class Search:
    """Result of a grid search: one row per run, best first, and the fitted models by tag."""

    table: DataFrame
    models: Mapping[str, PipelineModel] = field(repr=False)

    @property
    def best(self) -> str:
        return self.table.first()["run_tag"]


_RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_tag", T.StringType()),
        T.StructField("reg_param", T.DoubleType()),
        T.StructField("elastic_net_param", T.DoubleType()),
        T.StructField("max_iter", T.IntegerType()),
        *[
            T.StructField(f"{side}_{m}", T.DoubleType())
            for side in ("train", "val")
            for m in ("auc_roc", "auc_pr", "f1", "precision", "recall", "accuracy")
        ],
        T.StructField("gap_auc_pr", T.DoubleType()),
        T.StructField("gap_auc_roc", T.DoubleType()),
        T.StructField("best_threshold", T.DoubleType()),
        T.StructField("best_f1", T.DoubleType()),
        T.StructField("total_iterations", T.IntegerType()),
        T.StructField("final_loss", T.DoubleType()),
    ]
)


def grid_search(
    splits: Mapping[str, DataFrame],
    grid: Sequence[ModelParams] = DEFAULT_GRID,
    parallelism: int = 3,
) -> Search:
    """Fit every grid point on train, score on train and the temporal validation split.

    The preparation does not depend on the grid, so it is fitted once and its output kept for
    all fits, ``parallelism`` of which run side by side. All fitted models are then scored together:
    the metrics of any number of runs read the rows once.
    """
    spark = splits[TRAIN].sparkSession
    weighted = training_rows(dict(splits), TRAIN)
    routes = route_columns(splits[TRAIN].schema)
    preparation = Pipeline(stages=preparation_stages(routes)).fit(weighted)
    train = preparation.transform(weighted).select(LABEL, WEIGHT, FEATURES)
    validation = preparation.transform(splits[VALIDATION]).select(LABEL, FEATURES)
    train.persist(StorageLevel.MEMORY_AND_DISK)
    validation.persist(StorageLevel.MEMORY_AND_DISK)

    def run(params: ModelParams):
        return classifier(params).fit(train)

    pool = ThreadPool(max(1, min(parallelism, len(grid))))
    try:
        fits = pool.map(inheritable_thread_target(spark)(run), grid)
        measured = _measured(fits, train, validation)
    finally:
        pool.close()
        train.unpersist()
        validation.unpersist()
    runs = [(_run_row(params, fitted, *measured[k]), fitted) for k, (params, fitted) in enumerate(zip(grid, fits))]
    rows = [tuple(row[f.name] for f in _RUN_SCHEMA) for row, _ in runs]
    table = spark.createDataFrame(rows, _RUN_SCHEMA).orderBy(F.desc("val_auc_pr"), "run_tag")
    models = {
        params.tag: PipelineModel(stages=[*preparation.stages, fitted])
        for params, (_, fitted) in zip(grid, runs)
    }
    return Search(table, models)


_METRICS = ("auc_roc", "auc_pr", "f1", "precision", "recall", "accuracy")


def _scored(fits: Sequence, df: DataFrame) -> DataFrame:
    """``is_fraud, run, prob_fraud, prediction``: every row under every model, read once."""
    for k, fitted in enumerate(fits):
        own = {fitted.rawPredictionCol: f"raw_{k}", fitted.probabilityCol: f"chance_{k}", fitted.predictionCol: f"prediction_{k}"}
        df = fitted.transform(df, own)
    runs = [F.struct(F.lit(k).alias("run"), probability(f"chance_{k}").alias("prob_fraud"), F.col(f"prediction_{k}").alias("prediction")) for k in range(len(fits))]
    return df.select(LABEL, F.inline(F.array(*runs)))


def _measured(fits: Sequence, train: DataFrame, validation: DataFrame) -> list[tuple[dict, dict, dict]]:
    """(metrics on train, metrics on validation, best threshold on validation) of every model; each row is scored once."""
    parts = [_scored(fits, df).withColumn("side", F.lit(side)) for side, df in (("train", train), ("val", validation))]
    sides = parts[0].unionByName(parts[1]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found = {(r["run"], r["side"]): r.asDict() for r in binary_metrics(sides, LABEL, by=("run", "side")).collect()}  # two rows a run
        best = {r["run"]: r.asDict() for r in best_thresholds(sides.filter("side = 'val'"), ["run"]).collect()}
    finally:
        sides.unpersist()
    # A side without labelled rows has no metrics.
    of = [{s: {m: found[k, s][m] if (k, s) in found else None for m in _METRICS} for s in ("train", "val")} for k in range(len(fits))]
    return [(x["train"], x["val"], best.get(k, {"threshold": None, "f1": None})) for k, x in enumerate(of)]


def _run_row(params: ModelParams, fitted, seen: dict, unseen: dict, best: dict) -> dict:
    return {
        "run_tag": params.tag,
        "reg_param": float(params.reg_param),
        "elastic_net_param": float(params.elastic_net_param),
        "max_iter": params.max_iter,
        **{f"train_{m}": v for m, v in seen.items()},
        **{f"val_{m}": v for m, v in unseen.items()},
        "gap_auc_pr": seen["auc_pr"] - unseen["auc_pr"],
        "gap_auc_roc": seen["auc_roc"] - unseen["auc_roc"],
        "best_threshold": best["threshold"],
        "best_f1": best["f1"],
        "total_iterations": fitted.summary.totalIterations,
        "final_loss": float(fitted.summary.objectiveHistory[-1]),
    }


@dataclass(frozen=True)
class Decision:
    challenger_wins: bool
    reason: str
    challenger: Mapping[str, float]
    champion: Mapping[str, float] | None


def compare_models(
    test: DataFrame, champion: PipelineModel | None, challenger: PipelineModel, metric: str = "auc_pr"
) -> Decision:
    """Both models on the same rows; the challenger must be strictly better, or alone."""
    new = evaluate(challenger.transform(test))
    if champion is None:
        return Decision(True, "no champion yet", new, None)
    old = evaluate(champion.transform(test))
    wins = new[metric] > old[metric]
    reason = f"{metric}: challenger {new[metric]:.4f}, champion {old[metric]:.4f}"
    return Decision(wins, reason, new, old)
