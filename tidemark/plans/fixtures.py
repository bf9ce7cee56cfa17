"""Insurance-shaped inputs derived from the given star-schema tables.

The SQL runs in Spark and, with ``TIMESTAMP`` for ``TIMESTAMP_NTZ``, as plain SQL. Claims come
from ``events``, the policy change feed from ``orders`` and ``customer``, labels from
``events``; labels of one event type are never resolved and have no date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.rules import CLAIMS, LABELS, POLICIES, rules_for
from tidemark.operators.labels import join_late_labels
from tidemark.operators.profile import profile_features
from tidemark.operators.quality import clean, flag_quarantine
from tidemark.operators.scd2 import scd2

CLAIMS_SQL = """
SELECT event_id AS claim_id, user_id AS policy_id, ts AS timestamp,
       CASE WHEN event_id % 101 = 7 THEN 'unknown_type'
            WHEN event_type = 'click' THEN 'rear_end' WHEN event_type = 'view' THEN 'parking'
            WHEN event_type = 'purchase' THEN 'theft' WHEN event_type = 'signup' THEN 'hit_and_run'
            ELSE 'vandalism' END AS accident_type,
       CASE WHEN event_id % 97 = 5 THEN NULL WHEN event_id % 89 = 3 THEN -1 - value
            ELSE value END AS claimed_amount_eur,
       CAST(CASE WHEN event_id % 83 = 1 THEN 0 ELSE 1 + event_id % 3 END AS INT) AS n_parties_involved,
       CAST(event_id % 2 AS INT) AS telematics_anomaly,
       CAST(CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS INT) AS police_report_filed,
       CAST(CASE WHEN hour(ts) BETWEEN 8 AND 18 THEN 0 ELSE 1 END AS INT) AS outside_business_hours
FROM {events}
"""

LABELS_SQL = """
SELECT event_id AS claim_id,
       CAST(CASE WHEN event_id % 25 = 0 THEN 1 ELSE 0 END AS INT) AS is_fraud,
       CASE WHEN event_type <> 'signup'
            THEN ts + (event_id * 13 % 40) * INTERVAL '1' DAY + INTERVAL '1' HOUR
       END AS label_available_timestamp
FROM {events}
"""

FEED_SQL = """
SELECT o.o_custkey AS policy_id, o.o_orderkey AS feed_id,
       TIMESTAMP_NTZ'2024-01-01 00:00:00' + (o.o_orderkey % 200) * INTERVAL '1' DAY AS policy_updated_at,
       CAST(CASE WHEN o.o_orderkey % 61 = 0 THEN NULL ELSE 16 + o.o_orderkey % 70 END AS INT) AS policyholder_age,
       CASE WHEN o.o_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
       CASE WHEN o.o_orderkey % 3 = 0 THEN 'urban' WHEN o.o_orderkey % 3 = 1 THEN ' suburban '
            ELSE 'rural' END AS region_type,
       CAST(2005 + o.o_orderkey % 23 AS INT) AS vehicle_year,
       o.o_totalprice / 250 AS annual_premium_eur,
       CAST(o.o_orderkey % 2 AS INT) AS has_telematics,
       o.o_orderpriority AS coverage_type, c.c_mktsegment AS vehicle_type,
       CAST(DATE '2024-01-01' + CAST(o.o_orderkey % 150 AS INT) AS DATE) AS policy_start_date,
       CAST(o.o_orderkey % 30 AS INT) AS bonus_malus_years
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
"""

TRACKED = (
    "policyholder_age",
    "gender",
    "region_type",
    "vehicle_year",
    "annual_premium_eur",
    "has_telematics",
    "coverage_type",
    "vehicle_type",
    "policy_start_date",
    "bonus_malus_years",
)


class Inputs:
    """The derived inputs of one data folder, as lazy tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.folder = sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def claims(self) -> DataFrame:
        return self.spark.sql(CLAIMS_SQL, events=self.table("events"))

    def labels(self) -> DataFrame:
        return self.spark.sql(LABELS_SQL, events=self.table("events"))

    def feed(self) -> DataFrame:
        return self.spark.sql(
            FEED_SQL, orders=self.table("orders"), customer=self.table("customer")
        )

    def clean_claims(self) -> DataFrame:
        return clean(flag_quarantine(self.claims(), rules_for(CLAIMS)))

    def clean_labels(self) -> DataFrame:
        dated = self.labels().withColumnRenamed("label_available_timestamp", "label_available_date")
        kept = clean(flag_quarantine(dated, rules_for(LABELS)))
        return kept.withColumnRenamed("label_available_date", "label_available_timestamp")

    def clean_feed(self) -> DataFrame:
        return clean(flag_quarantine(self.feed(), rules_for(POLICIES)))

    def enriched(self) -> DataFrame:
        """Valid claims with the label that arrived in time."""
        return join_late_labels(self.clean_claims(), self.clean_labels(), claim_ts="timestamp")

    def claim_keys(self) -> DataFrame:
        """One row per claim with its policy: what hot keys are counted on."""
        return self.table("events").selectExpr("user_id AS policy_id")

    def feed_keys(self) -> DataFrame:
        return self.table("orders").selectExpr("o_custkey AS policy_id")

    def policy_keys(self) -> DataFrame:
        return self.claim_keys().unionByName(self.feed_keys())

    def history(self) -> DataFrame:
        return scd2(
            self.clean_feed(),
            ["policy_id"],
            "policy_updated_at",
            tie_breaker=["feed_id"],
            count_on=self.feed_keys(),
        )

    def profile(self) -> DataFrame:
        return profile_features(self.history())

    def scored(self) -> DataFrame:
        """Enriched claims with a score made from the amount, in place of a model's."""
        return self.enriched().selectExpr(
            "*",
            "claimed_amount_eur / 500 AS prob_fraud",
            "CAST(CASE WHEN claimed_amount_eur / 500 >= 0.2D THEN 1 ELSE 0 END AS BIGINT) AS prediction",
            "CASE WHEN day(timestamp) <= 15 THEN 'v1' ELSE 'v2' END AS model_version",
            "timestamp + INTERVAL '2' HOUR AS inference_timestamp",
        )
