"""Routing of table columns to model stages by type and name."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Columns never used as features, and whole-number columns that are flags.
NOT_FEATURES = ("is_fraud", "claim_id", "policy_id", "timestamp")
FLAG_COLUMNS = (
    "has_telematics",
    "is_new_policy_risk",
    "police_report_filed",
    "telematics_anomaly",
    "outside_business_hours",
)
# Name prefixes of aggregates that are 0, or null, on an empty window.
ZERO_PREFIXES = (
    "count_",
    "sum_",
    "num_fraud_",
)
NULL_PREFIXES = ("avg_", "max_amount", "min_amount")

# Byte and short columns are left out on purpose, as in the behaviour being matched.
_NUMERIC = (T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


@dataclass(frozen=True)
class ColumnRoutes:
    numeric: list[str] = field(default_factory=list)
    flags: list[str] = field(default_factory=list)
    categorical: list[str] = field(default_factory=list)

    @property
    def zero_filled(self) -> list[str]:
        return [c for c in self.numeric if c.startswith(ZERO_PREFIXES)]

    @property
    def imputed(self) -> list[str]:
        """Plain numerics first, then aggregates that are null on an empty window."""
        nullable = [
            c for c in self.numeric if c.startswith(NULL_PREFIXES) and not c.startswith(ZERO_PREFIXES)
        ]
        plain = [c for c in self.numeric if not c.startswith(ZERO_PREFIXES + NULL_PREFIXES)]
        return plain + nullable


def route_columns(
    schema: T.StructType,
    exclude: tuple[str, ...] = NOT_FEATURES,
    flags: tuple[str, ...] = FLAG_COLUMNS,
) -> ColumnRoutes:
    """Sort the fields of ``schema`` into numeric, flag and categorical feature columns.

    Types outside the three groups (dates, timestamps, nested) are no features.
    """
    routes = ColumnRoutes()
    for f in schema.fields:
        if f.name in exclude:
            continue
        if f.name in flags or isinstance(f.dataType, T.BooleanType):
            routes.flags.append(f.name)
        elif isinstance(f.dataType, _NUMERIC):
            routes.numeric.append(f.name)
        elif isinstance(f.dataType, T.StringType):
            routes.categorical.append(f.name)
    return routes
