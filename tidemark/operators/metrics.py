"""Evaluation tables of a scored table, computed over all rows where they are.

A scored table has a 0/1 label, a score in [0, 1] and, where needed, a 0/1 prediction. Rows
without a label, or without a score where the score is used, take no part.

Running totals over the score are global, so a plain window would put every distinct score in
one task. Rows are combined to one per score, which carries all counts that any table here needs, so the input
is read once. Scores are then cut into fixed ranges, 4,096 to every power of two; a window runs inside each range, and
each range adds the totals of the ranges above it. Ranges follow from the score alone: nothing is counted
or sampled before the query runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# 99 thresholds 0.01 + i * 0.01, and 10 calibration bins.
SWEEP_START, SWEEP_STEP, SWEEP_COUNT = 0.01, 0.01, 99
CALIBRATION_BINS = 10
CLASS_NAMES = ((0, "Legit"), (1, "Fraud"))

# Bits of a score's mantissa that name its range.
_RANGE_BITS = 12


def labelled(df: DataFrame, *columns: str) -> DataFrame:
    """Rows without nulls in the given columns. A NaN among them stops the query: it is no score, and dropping it would flatter the model."""
    kinds = {f.name: f.dataType for f in df.schema}
    for name in columns:
        known = F.col(name).isNotNull()
        if isinstance(kinds.get(name), (T.FloatType, T.DoubleType)):
            known = F.when(F.isnan(name), F.raise_error(F.lit(f"NaN in {name}")).cast("boolean")).otherwise(known)
        df = df.filter(known)
    return df


def safe_ratio(num: Column, den: Column, empty: float | None = 0.0) -> Column:
    return F.when(den > 0, num / den).otherwise(F.lit(empty).cast("double"))


def f1_of(precision: Column, recall: Column) -> Column:
    return safe_ratio(2 * precision * recall, precision + recall)


def _cells(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: tn, fp, fn, tp."""
    y, p = F.col(label), F.col(prediction)
    return labelled(df, label).agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def confusion(df: DataFrame, label: str = "is_fraud", prediction: str = "prediction") -> DataFrame:
    """Four rows (label, prediction, n, row_pct), row_pct in percent of the label's rows."""
    cells = _cells(df, label, prediction)

    def cell(y: int, p: int, n: str, total: Column):
        pct = safe_ratio(F.col(n) * 100, total, None)
        return F.struct(
            F.lit(y).alias("label"), F.lit(p).alias("prediction"), F.col(n).alias("n"), pct.alias("row_pct")
        )

    negatives, positives = F.col("tn") + F.col("fp"), F.col("fn") + F.col("tp")
    return cells.select(
        F.inline(
            F.array(
                cell(0, 0, "tn", negatives),
                cell(0, 1, "fp", negatives),
                cell(1, 0, "fn", positives),
                cell(1, 1, "tp", positives),
            )
        )
    )


def _per_class() -> dict[int, dict[str, Column]]:
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    out = {}
    for cls, hit, false_alarm, missed in ((0, tn, fn, fp), (1, tp, fp, fn)):
        precision = safe_ratio(hit, hit + false_alarm)
        recall = safe_ratio(hit, hit + missed)
        out[cls] = {
            "precision": precision,
            "recall": recall,
            "f1": f1_of(precision, recall),
            "support": hit + missed,
        }
    return out


def class_report(df: DataFrame, label: str = "is_fraud", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted means."""
    per_class = _per_class()
    legit, fraud = per_class[0], per_class[1]
    total = legit["support"] + fraud["support"]
    names = ("precision", "recall", "f1")

    def row(name: str, values: dict[str, Column], support: Column):
        cols = [values[m].cast("double").alias(m) for m in names]
        return F.struct(F.lit(name).alias("class_name"), *cols, support.alias("support"))

    accuracy = safe_ratio(F.col("tn") + F.col("tp"), total)
    macro = {m: (legit[m] + fraud[m]) / 2 for m in names}
    weighted = {
        m: safe_ratio(legit[m] * legit["support"] + fraud[m] * fraud["support"], total) for m in names
    }
    rows = [row(name, per_class[c], per_class[c]["support"]) for c, name in CLASS_NAMES]
    rows.append(row("accuracy", {"precision": F.lit(None), "recall": F.lit(None), "f1": accuracy}, total))
    rows.append(row("macro avg", macro, total))
    rows.append(row("weighted avg", weighted, total))
    return _cells(df, label, prediction).select(F.inline(F.array(*rows)))


def label_metrics(df: DataFrame, label: str = "is_fraud", prediction: str = "prediction") -> DataFrame:
    """One row: support-weighted F1, precision and recall, and accuracy."""
    return _cells(df, label, prediction).select(*_weighted_metrics())


def _weighted_metrics() -> list[Column]:
    """The four metrics of a row of cells."""
    per_class = _per_class()
    total = per_class[0]["support"] + per_class[1]["support"]

    def weighted(m: str) -> Column:
        return safe_ratio(
            per_class[0][m] * per_class[0]["support"] + per_class[1][m] * per_class[1]["support"], total
        )

    return [
        weighted("f1").alias("f1"),
        weighted("precision").alias("precision"),
        weighted("recall").alias("recall"),
        safe_ratio(F.col("tn") + F.col("tp"), total).alias("accuracy"),
    ]


# --- curves -----------------------------------------------------------------------------------


def _range_of(score: Column, bits: int) -> Column:
    """A whole number that never falls as the score grows: its power of two and the first ``bits`` of its mantissa.

    The power comes from a logarithm, which may be one off beside a power of two; the line through each power's
    scores meets the next one's there, so the order holds all the same.
    """
    size = F.least(F.abs(score), F.lit(1.7976931348623157e308))
    power = F.floor(F.log2(size)).cast("double")
    line = power + size / F.pow(F.lit(2.0), power) + 1074.0
    number = F.floor(line * float(1 << bits)) + 1
    return F.when(score == 0, F.lit(0).cast("long")).when(score < 0, -number).otherwise(number)


def _by_score(df: DataFrame, label: str, score: str, prediction: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Rows combined to one per score, label and, if given, prediction, with positives and negatives; there a null score is one more, which is neither."""
    value = F.col(score).cast("double")
    if prediction is None:
        rows, predicted = labelled(df, label, score), []
    else:
        known = F.when(F.isnan(value), F.raise_error(F.lit(f"NaN in {score}")).cast("boolean")).otherwise(True)
        rows, predicted = labelled(df, label).filter(known), [F.col(prediction).cast("double").alias("p")]
    narrow = rows.select(*by, value.alias("threshold"), F.col(label).alias("y"), *predicted)
    n = narrow.groupBy(*narrow.columns).agg(F.count(F.lit(1)).alias("rows"))
    known = F.col("threshold").isNotNull()
    return n.select("*", *[F.when(known & (F.col("y") == v), F.col("rows")).otherwise(0).alias(side) for side, v in (("pos", 1), ("neg", 0))])


def _with_totals(by_score: DataFrame, bits: int = _RANGE_BITS, by: Sequence[str] = ()) -> DataFrame:
    """Adds those at each score, those at or above it (tp, fp) and the totals of the whole table, or of each group ``by``.

    Both sides of the join come from one exchange of ``by_score``; the smaller has a row per range.
    """
    by = list(by)
    placed = by_score.withColumn("range", F.coalesce(_range_of(F.col("threshold"), bits), F.lit(-(1 << 62))))
    above = Window.partitionBy(*by).orderBy(F.col("range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(*by)
    carried = placed.groupBy(*by, "range").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).select(
        *[F.col(c).alias(f"carry_{c}") for c in (*by, "range")],
        F.coalesce(F.sum("p").over(above), F.lit(0)).alias("tp_above"),
        F.coalesce(F.sum("n").over(above), F.lit(0)).alias("fp_above"),
        F.sum("p").over(everything).alias("positives"),
        F.sum("n").over(everything).alias("negatives"),
    )
    # A range frame takes all rows of a score together.
    inside, alike = Window.partitionBy(*by, "range").orderBy(F.col("threshold").desc()), Window.partitionBy(*by, "range", "threshold")
    running = placed.select(
        "*", *[F.sum(c).over(inside).alias(f"{c}_in") for c in ("pos", "neg")], *[F.sum(c).over(alike).alias(f"{c}_at") for c in ("pos", "neg")]
    )
    same = F.col("range") == F.col("carry_range")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"carry_{c}"))
    return running.join(carried, same).select(
        *by_score.columns,
        "range",
        "pos_at",
        "neg_at",
        (F.col("pos_in") + F.col("tp_above")).alias("tp"),
        (F.col("neg_in") + F.col("fp_above")).alias("fp"),
        "positives",
        "negatives",
    )


def score_totals(df: DataFrame, label: str = "is_fraud", score: str = "prob_fraud", bits: int = _RANGE_BITS) -> DataFrame:
    """Per distinct score: own positives and negatives, and those at or above it (tp, fp), with
    the totals of the whole table."""
    totals = _with_totals(_by_score(df, label, score), bits)
    kept = ["threshold", F.col("pos_at").alias("pos"), F.col("neg_at").alias("neg"), "tp", "fp", "positives", "negatives"]
    return totals.select(*kept, F.row_number().over(Window.partitionBy("range", "threshold").orderBy("y")).alias("nth")).filter("nth = 1").drop("nth")


def pr_curve(df: DataFrame, label: str = "is_fraud", score: str = "prob_fraud") -> DataFrame:
    """One point per distinct score, and the end point recall 0, precision 1 with no threshold.

    Without positives recall is 1 at every threshold.
    """
    totals = score_totals(df, label, score)
    points = totals.select(
        "threshold",
        "tp",
        "fp",
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        safe_ratio(F.col("tp"), F.col("positives"), 1.0).alias("recall"),
    )
    return points.unionByName(_end_point(points, precision=1.0, recall=0.0))


def roc_curve(df: DataFrame, label: str = "is_fraud", score: str = "prob_fraud") -> DataFrame:
    """One point per distinct score, and the start point (0, 0) with no threshold."""
    totals = score_totals(df, label, score)
    points = totals.select(
        "threshold",
        "tp",
        "fp",
        safe_ratio(F.col("fp"), F.col("negatives"), None).alias("fpr"),
        safe_ratio(F.col("tp"), F.col("positives"), None).alias("tpr"),
    )
    return points.unionByName(_end_point(points, fpr=0.0, tpr=0.0))


def _end_point(points: DataFrame, **values: float) -> DataFrame:
    fixed = {"threshold": None, "tp": 0, "fp": 0, **values}
    row = tuple(fixed[c] for c in points.columns)
    return points.sparkSession.createDataFrame([row], points.schema)


def _areas() -> tuple[list[Column], list[Column]]:
    """Sums over the scores, and from them both areas; see ``curve_areas``."""
    tp, fp, pos, neg, pos_at, neg_at = (F.col(c) for c in ("tp", "fp", "pos", "neg", "pos_at", "neg_at"))
    precision = F.try_divide(tp, tp + fp)
    seen_before = tp - pos_at + fp - neg_at
    precision_before = F.when(seen_before > 0, (tp - pos_at) / seen_before).otherwise(precision)
    half = F.lit(0.5)
    sums = [
        F.sum(neg * (tp + tp - pos_at) * half).alias("roc"),
        F.sum(pos * (precision + precision_before) * half).alias("pr"),
        F.max("positives").alias("p"),
        F.max("negatives").alias("n"),
    ]
    out = [
        safe_ratio(F.col("roc") / F.nullif("p", F.lit(0)), F.col("n"), None).alias("auc_roc"),
        safe_ratio(F.col("pr"), F.col("p"), None).alias("auc_pr"),
    ]
    return sums, out


def curve_areas(df: DataFrame, label: str = "is_fraud", score: str = "prob_fraud") -> DataFrame:
    """One row: exact areas under the ROC and PR curves by trapezoids.

    The point before each score follows from the score's own counts, so no ordering of the
    points is needed. The PR curve starts at recall 0 with the precision of the first point.
    """
    sums, areas = _areas()
    return _with_totals(_by_score(df, label, score)).agg(*sums).select(*areas)


def binary_metrics(
    df: DataFrame, label: str = "is_fraud", score: str = "prob_fraud", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """The six metrics: both areas, weighted F1, precision, recall, accuracy; one row, or one per group ``by``. One pass over the input."""
    sums, areas = _areas()
    corners = {"tn": (0, 0), "fp": (0, 1), "fn": (1, 0), "tp": (1, 1)}
    cells = [
        F.coalesce(F.sum(F.when((F.col("y") == y) & (F.col("p") == p), F.col("rows"))), F.lit(0)).alias(f"sum_{name}") for name, (y, p) in corners.items()
    ]
    totals = _with_totals(_by_score(df, label, score, prediction, by), by=by)
    found = (totals.groupBy(*by) if by else totals).agg(*sums, *cells)
    both = found.select(*by, *areas, *[F.col(f"sum_{name}").alias(name) for name in corners])
    return both.select(*by, "auc_roc", "auc_pr", *_weighted_metrics())


# --- thresholds -------------------------------------------------------------------------------


def _threshold(i: Column) -> Column:
    return F.lit(SWEEP_START) + i * F.lit(SWEEP_STEP)


def _thresholds_reached(score: Column) -> Column:
    """How many thresholds are <= score. The quotient is at most one off, so three exact
    comparisons around it settle the count."""
    guess = F.floor((score - SWEEP_START) / SWEEP_STEP) - 1
    low = F.greatest(F.lit(0), F.least(F.lit(SWEEP_COUNT), guess)).cast("int")
    count = low
    for i in range(3):
        index = low + i
        count = count + F.when((index < SWEEP_COUNT) & (_threshold(index) <= score), 1).otherwise(0)
    return count


def threshold_sweep(df: DataFrame, label: str = "is_fraud", score: str = "prob_fraud") -> DataFrame:
    """99 rows: precision, recall and F1 of ``score >= threshold``, 0 where undefined.

    One pass: rows are counted by the number of thresholds they reach (at most 100 groups); the
    sums over the thresholds run on those groups.
    """
    reached = _reached(df, label, score)
    steps = df.sparkSession.range(1, SWEEP_COUNT + 1, numPartitions=1).select(
        F.col("id").cast("int").alias("reached")
    )
    filled = steps.join(F.broadcast(reached), "reached", "left").select(
        "reached", F.coalesce("pos", F.lit(0)).alias("pos"), F.coalesce("neg", F.lit(0)).alias("neg")
    )
    at_least = Window.orderBy(F.col("reached").desc())
    positives = reached.agg(F.sum("pos")).scalar()
    swept = filled.select(
        _threshold(F.col("reached") - 1).alias("threshold"),
        F.sum("pos").over(at_least).alias("tp"),
        F.sum("neg").over(at_least).alias("fp"),
    ).withColumn("fn", F.coalesce(positives, F.lit(0)) - F.col("tp"))
    return _with_rates(swept)


def _reached(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives by the number of thresholds they reach: at most 100 rows, or 100 per group ``by``."""
    y = F.col(label)
    return (
        labelled(df, label, score)
        .groupBy(*by, _thresholds_reached(F.col(score)).alias("reached"))
        .agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))
    )


def _with_rates(swept: DataFrame) -> DataFrame:
    """Adds precision, recall and F1 to rows of tp, fp, fn."""
    return swept.withColumn(
        "precision", safe_ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    ).withColumn("recall", safe_ratio(F.col("tp"), F.col("tp") + F.col("fn"))).withColumn(
        "f1", f1_of(F.col("precision"), F.col("recall"))
    )


def _best_of(swept: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    best = F.max_by(F.struct("threshold", "f1"), F.struct("f1", -F.col("threshold"))).alias("b")
    return (swept.groupBy(*by) if by else swept).agg(best).select(*by, "b.threshold", "b.f1")


def best_threshold(df: DataFrame, label: str = "is_fraud", score: str = "prob_fraud") -> DataFrame:
    """One row: the threshold of the largest F1, the lowest one on a tie."""
    return _best_of(threshold_sweep(df, label, score))


def best_thresholds(df: DataFrame, by: Sequence[str], label: str = "is_fraud", score: str = "prob_fraud") -> DataFrame:
    """``best_threshold`` of every group ``by``, in one pass over the rows; a group without labelled scores has no row."""
    counts = _reached(df, label, score, by).groupBy(*by).agg(F.collect_list(F.struct("reached", "pos", "neg")).alias("counts"), F.sum("pos").alias("positives"))
    steps = counts.select("*", F.explode(F.sequence(F.lit(1), F.lit(SWEEP_COUNT))).alias("step"))

    def at_least(side: str) -> Column:
        here = F.filter("counts", lambda c: c["reached"] >= F.col("step"))
        return F.aggregate(here, F.lit(0).cast("long"), lambda total, c: total + c[side])

    swept = steps.select(*by, "positives", _threshold(F.col("step") - 1).alias("threshold"), at_least("pos").alias("tp"), at_least("neg").alias("fp"))
    return _best_of(_with_rates(swept.withColumn("fn", F.col("positives") - F.col("tp"))), by)


def calibration(
    df: DataFrame, label: str = "is_fraud", score: str = "prob_fraud", bins: int = CALIBRATION_BINS
) -> DataFrame:
    """Per non-empty equal-width bin: rows, mean score, share of positives.

    A bin includes its upper edge: a score equal to an inner edge lies in the bin below it.
    """
    p = F.col(score)
    index = sum(
        (F.when(F.lit(i * (1.0 / bins)) < p, 1).otherwise(0) for i in range(1, bins)), F.lit(0)
    )
    return (
        labelled(df, label, score)
        .groupBy(index.alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(p).alias("mean_score"),
            F.avg((F.col(label) == 1).cast("int")).alias("fraction_positive"),
        )
    )
