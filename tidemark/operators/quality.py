"""Data-quality rules: counts, quarantine flag, routes and the list of broken rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.rules import Rule

FLAG = "is_quarantined"


def _all_hold(rules: Sequence[Rule]) -> str:
    return " AND ".join(f"({rule.constraint})" for rule in rules)


def rule_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows passed, failed and undecided per rule, all rules counted in one pass.

    A predicate that is null counts as undecided.
    """
    counted = df.agg(*[F.struct(F.lit(rule.name).alias("rule"), *cells).alias(f"r{i}") for i, (rule, cells) in enumerate(_outcomes(rules))])
    return counted.select(F.inline(F.array(*[f"r{i}" for i in range(len(rules))])))


OUTCOMES = ("passed", "failed", "undecided")


def _outcomes(rules: Sequence[Rule]) -> list[tuple[Rule, list[Column]]]:
    """Per rule the counts of its three outcomes."""

    def cells(rule: Rule) -> list[Column]:
        holds = F.expr(rule.constraint)
        return [F.count_if(c).alias(name) for name, c in zip(OUTCOMES, (holds, ~holds, holds.isNull()))]

    return [(rule, cells(rule)) for rule in rules]


def observed(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, Observation]:
    """``df`` that counts the outcomes of all rules while an action reads it; ``observed_counts`` has them afterwards.

    Nothing is read for the counts' sake. Every row counts once, also where a task had to run again.
    """
    seen = Observation()
    named = [c.alias(f"{i}_{name}") for i, (_, cells) in enumerate(_outcomes(rules)) for name, c in zip(OUTCOMES, cells)]
    return df.observe(seen, *named), seen


def observed_counts(spark: SparkSession, rules: Sequence[Rule], seen: Observation) -> DataFrame:
    """The counts of ``rule_counts`` from a finished action."""
    found = seen.get
    rows = [(rule.name, *[found[f"{i}_{name}"] for name in OUTCOMES]) for i, rule in enumerate(rules)]
    return spark.createDataFrame(rows, "rule string, passed long, failed long, undecided long")


def expect_all(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Warn-only check: every row is kept, the counts come back beside them."""
    return df, rule_counts(df, rules)


def flag_quarantine(
    df: DataFrame, rules: Sequence[Rule], null_policy: str = "quarantine", flag: str = FLAG
) -> DataFrame:
    """Add ``flag`` = not all rules hold.

    The conjunction is three-valued. With ``null_policy="drop"`` an undecided row keeps a null
    flag, so it is on neither route; with ``"quarantine"`` it is quarantined, and the two
    routes together hold every row.
    """
    broken = F.expr(f"NOT ({_all_hold(rules)})")
    if null_policy == "quarantine":
        broken = F.coalesce(broken, F.lit(True))
    elif null_policy != "drop":
        raise ValueError(f"null_policy {null_policy!r}: use 'quarantine' or 'drop'")
    return df.withColumn(flag, broken)


def quarantined(df: DataFrame, flag: str = FLAG) -> DataFrame:
    """Dead-letter route."""
    return df.filter(F.col(flag)).drop(flag)


def clean(df: DataFrame, flag: str = FLAG) -> DataFrame:
    """Valid route."""
    return df.filter(~F.col(flag)).drop(flag)


def violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per input row and rule it does not satisfy, with ``rule`` and ``outcome``."""
    found = F.array_compact(
        F.array(
            *[
                F.when(
                    F.expr(rule.constraint).isNull(),
                    F.struct(F.lit(rule.name).alias("rule"), F.lit("undecided").alias("outcome")),
                ).when(
                    ~F.expr(rule.constraint),
                    F.struct(F.lit(rule.name).alias("rule"), F.lit("failed").alias("outcome")),
                )
                for rule in rules
            ]
        )
    )
    return df.select("*", F.inline(found))
