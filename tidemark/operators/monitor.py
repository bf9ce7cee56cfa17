"""Monitoring of scored tables: slices, fairness, drift and quality over time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.metrics import f1_of, safe_ratio

_PSI_FLOOR = 1e-6


def _counts(label: str, prediction: str) -> list[Column]:
    y, p = F.col(label), F.col(prediction)
    return [
        F.count(F.lit(1)).alias("n"),
        F.count_if(p == 1).alias("n_flagged"),
        F.count(y).alias("n_labelled"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
    ]


def _rates(df: DataFrame) -> DataFrame:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return (
        df.withColumn("precision", safe_ratio(tp, tp + fp))
        .withColumn("recall", safe_ratio(tp, tp + fn))
        .withColumn("f1", f1_of(F.col("precision"), F.col("recall")))
        .withColumn("accuracy", safe_ratio(tp + tn, F.col("n_labelled")))
    )


def slice_metrics(
    scored: DataFrame,
    slices: Mapping[str, str],
    label: str = "is_fraud",
    prediction: str = "prediction",
) -> DataFrame:
    """Counts and metrics of the whole table and of each slice, given as name -> SQL predicate.

    Slices may overlap; all of them are counted in one pass by listing the slices of each row.
    """
    names = F.array(
        F.lit("all"), *[F.when(F.expr(sql), F.lit(name)) for name, sql in slices.items()]
    )
    rows = scored.select(label, prediction, F.explode(F.array_compact(names)).alias("slice"))
    return _rates(rows.groupBy("slice").agg(*_counts(label, prediction)))


def fairness(
    scored: DataFrame,
    group: str,
    label: str = "is_fraud",
    prediction: str = "prediction",
    reference: str | None = None,
) -> DataFrame:
    """Per group: true-positive rate, precision and positive rate, and each one's difference
    from the reference group, or from the whole table if none is given.

    The three differences are equal opportunity, predictive parity and statistical parity.
    Rates over no rows are null.
    """
    groups = scored.groupBy(F.col(group).alias("group")).agg(*_counts(label, prediction))

    def rates() -> list[Column]:
        tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
        return [
            safe_ratio(tp, tp + fn, None).alias("tpr"),
            safe_ratio(tp, tp + fp, None).alias("precision"),
            safe_ratio(F.col("n_flagged"), F.col("n"), None).alias("positive_rate"),
        ]

    base = groups if reference is None else groups.filter(F.col("group") == reference)
    totals = base.agg(*[F.sum(c).alias(c) for c in ("n", "n_flagged", "tp", "fp", "fn")])
    compared = totals.select(F.struct(*rates())).scalar()
    return (
        groups.select("group", "n", "n_labelled", *rates())
        .withColumn("__ref", compared)
        .select(
            "group",
            "n",
            "n_labelled",
            "tpr",
            "precision",
            "positive_rate",
            (F.col("tpr") - F.col("__ref.tpr")).alias("equal_opportunity_diff"),
            (F.col("precision") - F.col("__ref.precision")).alias("predictive_parity_diff"),
            (F.col("positive_rate") - F.col("__ref.positive_rate")).alias("statistical_parity_diff"),
        )
    )


def metrics_over_time(
    scored: DataFrame,
    ts: str = "inference_timestamp",
    width: str = "1 day",
    version: str = "model_version",
    label: str = "is_fraud",
    prediction: str = "prediction",
) -> DataFrame:
    """Counts and metrics per time window and model version."""
    start = F.window(ts, width)["start"].alias("window_start")
    return _rates(scored.groupBy(start, version).agg(*_counts(label, prediction)))


# --- drift ------------------------------------------------------------------------------------


def _edges(baseline: DataFrame, columns: Sequence[str], bins: int, method: str) -> Column:
    """A struct with the inner bin edges of each column, as one scalar subquery."""
    if method == "width":
        def edges(c: str) -> Column:
            low, high = F.min(c).cast("double"), F.max(c).cast("double")
            return F.array(*[low + (high - low) * F.lit(i / bins) for i in range(1, bins)])
    elif method == "quantile":
        def edges(c: str) -> Column:
            return F.percentile_approx(F.col(c).cast("double"), [i / bins for i in range(1, bins)], 10_000)
    else:
        raise ValueError(f"method {method!r}: use 'width' or 'quantile'")
    return baseline.agg(F.struct(*[edges(c).alias(c) for c in columns])).scalar()


def _numeric_bins(df: DataFrame, columns: Sequence[str], edges: Column, bins: int, side: str) -> DataFrame:
    with_edges = df.select(*columns).withColumn("__e", edges)
    placed = []
    for c in columns:
        x = F.col(c).cast("double")
        above = [F.when(x > F.col(f"__e.{c}")[i], 1).otherwise(0) for i in range(bins - 1)]
        bin_no = F.when(x.isNotNull(), sum(above, F.lit(0)))
        placed.append(F.struct(F.lit(c).alias("column"), bin_no.alias("bin"), x.alias("x")))
    return (
        with_edges.select(F.inline(F.array(*placed)))
        .groupBy("column", "bin")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("x").alias("mean"),
            (F.var_pop("x") * F.count("x")).alias("m2"),
        )
        .withColumn("side", F.lit(side))
    )


def numeric_drift(
    current: DataFrame,
    baseline: DataFrame,
    columns: Sequence[str],
    bins: int = 10,
    method: str = "width",
) -> DataFrame:
    """Per column: null rate, mean and standard deviation on both sides, and the population
    stability index over the baseline's bins (equal width, or quantiles).

    Each table is read once, whatever the number of columns, and combined to one row per column
    and bin before its shuffle.
    """
    edges = _edges(baseline, columns, bins, method)
    sides = _numeric_bins(baseline, columns, edges, bins, "b").unionByName(
        _numeric_bins(current, columns, edges, bins, "c")
    )

    def of(side: str, value: str) -> Column:
        return F.sum(F.when(F.col("side") == side, F.col(value)))

    per_bin = sides.groupBy("column", "bin").agg(
        *[F.coalesce(of(s, v), F.lit(0)).alias(f"{s}_{v}") for s in "bc" for v in ("n", "mean", "m2")]
    )
    cell = F.struct(*[f"{s}_{v}" for s in "bc" for v in ("n", "mean", "m2")])
    totals = per_bin.groupBy("column").agg(
        *[F.sum(f"{s}_n").alias(f"{s}_rows") for s in "bc"],
        # At most ``bins`` cells.
        F.collect_list(F.when(F.col("bin").isNotNull(), cell)).alias("cells"),
    )

    def over_cells(value) -> Column:
        return F.aggregate(F.transform("cells", value), F.lit(0.0), lambda a, x: a + x)

    def share(n: Column, side: str) -> Column:
        return F.greatest(F.try_divide(n, F.col(f"{side}_valid")), F.lit(_PSI_FLOOR))

    def term(c: Column) -> Column:
        now, then = share(c["c_n"], "c"), share(c["b_n"], "b")
        return (now - then) * F.ln(now / then)

    psi = over_cells(term)
    out = _moments(_moments(totals, "b", over_cells), "c", over_cells)
    return out.select(
        "column",
        F.col("b_rows").alias("baseline_rows"),
        F.col("c_rows").alias("current_rows"),
        F.col("b_null_rate").alias("baseline_null_rate"),
        F.col("c_null_rate").alias("current_null_rate"),
        F.col("b_mean").alias("baseline_mean"),
        F.col("c_mean").alias("current_mean"),
        F.col("b_std").alias("baseline_std"),
        F.col("c_std").alias("current_std"),
        psi.alias("psi"),
    )


def _moments(totals: DataFrame, side: str, over_cells) -> DataFrame:
    """Mean and standard deviation of one side, joined from those of its bins."""
    n, mean = F.col(f"{side}_valid"), F.col(f"{side}_mean")

    def squares(c: Column) -> Column:
        return c[f"{side}_m2"] + c[f"{side}_n"] * F.pow(c[f"{side}_mean"] - mean, F.lit(2.0))

    return (
        totals.withColumn(f"{side}_valid", over_cells(lambda c: c[f"{side}_n"].cast("double")))
        .withColumn(
            f"{side}_mean",
            safe_ratio(over_cells(lambda c: c[f"{side}_n"] * c[f"{side}_mean"]), n, None),
        )
        .withColumn(f"{side}_m2", over_cells(squares))
        .withColumn(f"{side}_std", F.when(n > 1, F.sqrt(F.col(f"{side}_m2") / (n - 1))))
        .withColumn(f"{side}_null_rate", 1 - n / F.col(f"{side}_rows"))
    )


# Size of a quantile sketch: exact up to about as many values, then ranks are off by about 2.3 / k at most (99 %).
SKETCH_SIZE = 8_192


def baseline_sketches(baseline: DataFrame, columns: Sequence[str], by: Sequence[str] = (), size: int = SKETCH_SIZE) -> DataFrame:
    """What drift needs of a baseline: per column, and per part named by ``by`` (such as a day), its counts, moments and a
    mergeable quantile sketch. One pass, combined before its shuffle; a few hundred kB a row at most, whatever the rows."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns]
    return (
        baseline.select(*by, F.inline(F.array(*cells)))
        .groupBy(*by, "column")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count("x").alias("n_valid"),
            F.avg("x").alias("mean"),
            (F.var_pop("x") * F.count("x")).alias("m2"),
            F.kll_sketch_agg_double("x", size).alias("sketch"),
        )
    )


def merged_sketches(parts: DataFrame, size: int = SKETCH_SIZE) -> DataFrame:
    """One row per column of any number of parts: counts, mean, squared deviations and one sketch."""
    whole = parts.groupBy("column").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_valid").alias("n_valid"),
        F.collect_list(F.struct("n_valid", "mean", "m2")).alias("cells"),  # one a part
        F.kll_merge_agg_double("sketch", size).alias("sketch"),
    )

    def over_cells(value) -> Column:
        return F.aggregate(F.transform("cells", value), F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))

    n = F.col("n_valid")
    mean = whole.withColumn("mean", F.when(n > 0, over_cells(lambda c: c["n_valid"] * c["mean"]) / n))
    squares = over_cells(lambda c: c["m2"] + c["n_valid"] * F.pow(c["mean"] - F.col("mean"), F.lit(2.0)))
    return mean.withColumn("m2", squares).select("column", "n_rows", "n_valid", "mean", "m2", "sketch")


def quantile_drift(current: DataFrame, sketches: DataFrame, bins: int = 10) -> DataFrame:
    """As ``numeric_drift``, over bins at the baseline's quantiles, from its sketches alone: the baseline is not read again.

    An edge is the smallest value with at least its share of the baseline at or below it, and lies in the bin
    below; columns with many equal values have empty bins. ``sketches`` may hold any number of parts of the baseline.
    """
    base = merged_sketches(sketches)
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    some = F.col("n_valid") > 0
    base = base.withColumn("edges", F.when(some, F.kll_sketch_get_quantile_double("sketch", shares)))
    # Sketches take constants only: the edges, a few numbers a column, come here first.
    found = {r["column"]: r["edges"] for r in base.select("column", "edges").collect()}
    ranks = F.lit(None).cast("array<double>")
    for c, edges in found.items():
        if edges is not None:
            ranks = F.when(F.col("column") == c, F.kll_sketch_get_rank_double("sketch", F.array(*map(F.lit, edges)))).otherwise(ranks)
    base = base.withColumn("ranks", ranks).drop("sketch")
    columns = list(found)
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in sorted(columns)]
    # One row a column is broadcast.
    rows = current.select(F.inline(F.array(*cells))).join(F.broadcast(base.select("column", "edges")), "column")
    bin_no = F.when(F.col("x").isNotNull(), F.size(F.filter(F.coalesce("edges", F.array().cast("array<double>")), lambda e: F.col("x") > e)))
    now = rows.groupBy("column", bin_no.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean"), (F.var_pop("x") * F.count("x")).alias("m2")
    )
    cell = F.struct("bin", "n", "mean", "m2")
    totals = now.groupBy("column").agg(
        F.sum("n").alias("c_rows"),
        F.sum(F.when(F.col("bin").isNotNull(), F.col("n"))).alias("c_valid"),
        F.collect_list(F.when(F.col("bin").isNotNull(), cell)).alias("cells"),  # at most ``bins``
    )
    both = base.join(totals, "column", "left").withColumn("cells", F.coalesce("cells", F.array().cast("array<struct<bin:int,n:bigint,mean:double,m2:double>>")))
    both = both.withColumn("c_valid", F.coalesce("c_valid", F.lit(0)))

    def over_cells(value) -> Column:
        return F.aggregate(F.transform("cells", value), F.lit(0.0), lambda a, x: a + x)

    mean = F.when(F.col("c_valid") > 0, over_cells(lambda c: c["n"] * c["mean"]) / F.col("c_valid"))
    both = both.withColumn("c_mean", mean)
    m2 = over_cells(lambda c: c["m2"] + c["n"] * F.pow(c["mean"] - F.col("c_mean"), F.lit(2.0)))

    def floored(share: Column) -> Column:
        return F.greatest(F.coalesce(share, F.lit(0.0)), F.lit(_PSI_FLOOR))

    def term(i: Column) -> Column:
        rank = F.when(i == bins - 1, F.lit(1.0)).otherwise(F.get("ranks", i)) - F.when(i == 0, F.lit(0.0)).otherwise(F.get("ranks", i - 1))
        n = F.aggregate("cells", F.lit(0).cast("long"), lambda a, c: a + F.when(c["bin"] == i, c["n"]).otherwise(F.lit(0).cast("long")))
        then, share = floored(F.when(some, rank)), floored(F.try_divide(n, F.col("c_valid")))
        return (share - then) * F.ln(share / then)

    numbers = F.sequence(F.lit(0), F.lit(bins - 1))
    psi = F.aggregate(F.transform(numbers, term), F.lit(0.0), lambda a, x: a + x)

    def spread(squares: Column, n: str) -> Column:
        return F.when(F.col(n) > 1, F.sqrt(squares / (F.col(n) - 1)))

    return both.select(
        "column",
        F.col("n_rows").alias("baseline_rows"),
        F.coalesce("c_rows", F.lit(0)).alias("current_rows"),
        (1 - F.col("n_valid") / F.col("n_rows")).alias("baseline_null_rate"),
        F.when(F.col("c_rows") > 0, 1 - F.col("c_valid") / F.col("c_rows")).alias("current_null_rate"),
        F.col("mean").alias("baseline_mean"),
        F.col("c_mean").alias("current_mean"),
        spread(F.col("m2"), "n_valid").alias("baseline_std"),
        spread(m2, "c_valid").alias("current_std"),
        psi.alias("psi"),
    )


def categorical_drift(current: DataFrame, baseline: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: null rate on both sides and the total variation distance of the shares of
    all values, null being one of them."""

    def melted(df: DataFrame, side: str) -> DataFrame:
        cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
        return (
            df.select(F.inline(F.array(*cells)))
            .groupBy("column", "value")
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("side", F.lit(side))
        )

    def of(side: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("side") == side, F.col("n"))), F.lit(0))

    values = (
        melted(baseline, "b")
        .unionByName(melted(current, "c"))
        .groupBy("column", "value")
        .agg(of("b").alias("b"), of("c").alias("c"))
    )
    n_baseline, n_current = (d.agg(F.count(F.lit(1))).scalar() for d in (baseline, current))
    b, c = F.try_divide(F.col("b"), n_baseline), F.try_divide(F.col("c"), n_current)
    missing = F.col("value").isNull()
    return values.groupBy("column").agg(
        F.sum(F.when(missing, b).otherwise(0.0)).alias("baseline_null_rate"),
        F.sum(F.when(missing, c).otherwise(0.0)).alias("current_null_rate"),
        (F.sum(F.abs(c - b)) / 2).alias("total_variation"),
    )
