"""Rules, routes, and the three-valued flag."""

from __future__ import annotations

import pytest
from helpers import at, rows

from tidemark.functions.rules import CATALOGUE, CLAIMS, LABELS, POLICIES, rules_for
from tidemark.operators import quality
from tidemark.session import scratch_path
from tidemark.sources import files
from tidemark.streaming import flows

SCHEMA = (
    "claim_id string, policy_id string, timestamp timestamp_ntz, claimed_amount_eur double, accident_type string, "
    "n_parties_involved int, telematics_anomaly int, police_report_filed int, outside_business_hours int"
)
GOOD = ("1", "p", at(1), 10.0, "theft", 1, 0, 0, 1)
RULES = rules_for(CLAIMS)


def frame(spark, *changes):
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    data = [GOOD]
    for i, change in enumerate(changes):
        row = dict(zip(names, GOOD), claim_id=str(i + 2))
        row.update(change)
        data.append(tuple(row[n] for n in names))
    return spark.createDataFrame(data, SCHEMA)


def test_catalogue_sizes():
    assert [len(rules_for(t)) for t in (POLICIES, CLAIMS, LABELS)] == [8, 9, 3]
    assert len(CATALOGUE) == 20


def test_routes_hold_every_row_by_default(spark):
    df = frame(spark, {"claimed_amount_eur": None}, {"accident_type": "other"}, {"claimed_amount_eur": -1.0, "policy_id": None})
    flagged = quality.flag_quarantine(df, RULES)
    assert rows(quality.clean(flagged), "claim_id") == [("1",)]
    assert rows(quality.quarantined(flagged), "claim_id") == [("2",), ("3",), ("4",)]
    assert quality.clean(flagged).columns == df.columns


def test_undecided_rows_are_on_neither_route_when_dropped(spark):
    df = frame(spark, {"claimed_amount_eur": None}, {"accident_type": "other"}, {"claimed_amount_eur": None, "n_parties_involved": 0})
    flagged = quality.flag_quarantine(df, RULES, null_policy="drop")
    assert rows(quality.clean(flagged), "claim_id") == [("1",)]
    assert rows(quality.quarantined(flagged), "claim_id") == [("3",), ("4",)]
    with pytest.raises(ValueError):
        quality.flag_quarantine(df, RULES, null_policy="keep")


def test_counts_and_violations(spark):
    df = frame(spark, {"claimed_amount_eur": None, "n_parties_involved": 0})
    kept, counts = quality.expect_all(df, RULES)
    assert kept is df
    by_rule = {r[0]: r[1:] for r in counts.collect()}
    assert by_rule["valid_amount"] == (1, 0, 1)
    assert by_rule["valid_parties"] == (1, 1, 0)
    assert by_rule["valid_claim_id"] == (2, 0, 0)
    assert rows(quality.violations(df, RULES), "claim_id", "rule", "outcome") == [
        ("2", "valid_amount", "undecided"), ("2", "valid_parties", "failed")
    ]


def test_padded_region_is_valid(spark):
    region = next(r for r in rules_for(POLICIES) if r.name == "valid_region")
    df = spark.createDataFrame([(" urban ",), ("coast",), (None,)], "region_type string")
    assert quality.rule_counts(df, [region]).first()[1:] == (1, 1, 1)


def test_streamed_routes_equal_the_batch_routes(spark):
    df = frame(spark, {"claimed_amount_eur": None}, {"accident_type": "other"}, {"n_parties_involved": 3})
    source, out, state = (scratch_path(spark, f"t_route_{n}") for n in ("in", "out", "ckpt"))
    for part in ("claim_id <= '2'", "claim_id > '2'"):
        df.filter(part).write.mode("append").parquet(source)
        stream = files.stream_table(spark, source, df.schema)
        flows.route_stream(stream, RULES, out, state).awaitTermination()
    flagged = quality.flag_quarantine(df, RULES)
    assert rows(flows.read_route(spark, out)) == rows(quality.clean(flagged))
    assert rows(flows.read_route(spark, out, dead_letter=True)) == rows(quality.quarantined(flagged))


def test_rules_are_counted_while_routing(spark):
    df = frame(spark, {"claimed_amount_eur": None}, {"accident_type": "other"}, {"n_parties_involved": 0})
    source, out, state, counts = (scratch_path(spark, f"t_count_{n}") for n in ("in", "out", "ckpt", "rules"))
    for part in ("claim_id <= '2'", "claim_id > '2'"):
        df.filter(part).write.mode("append").parquet(source)
        stream = files.stream_table(spark, source, df.schema)
        flows.route_stream(stream, RULES, out, state, null_policy="drop", counts=counts).awaitTermination()
    # Rows on neither route count as well.
    assert rows(flows.read_rule_counts(spark, counts)) == rows(quality.rule_counts(df, RULES))
    seen, observation = quality.observed(df, RULES)
    seen.write.format("noop").mode("overwrite").save()
    assert rows(quality.observed_counts(spark, RULES, observation)) == rows(quality.rule_counts(df, RULES))


def test_stateful_streams_keep_their_state_on_disk(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        source, out, state = (scratch_path(spark, f"t_disk_{n}") for n in ("in", "out", "ckpt"))
        claims = spark.createDataFrame([(1, "2024-01-01 00:00:00")], "claim_id int, t string").selectExpr("claim_id", "to_timestamp(t) AS incident_timestamp")
        claims.write.parquet(f"{source}/claims")
        labels = claims.selectExpr("claim_id + 1 AS claim_id", "0 AS is_fraud", "incident_timestamp AS label_available_timestamp")
        labels.write.parquet(f"{source}/labels")
        joined = flows.stream_late_labels(files.stream_table(spark, f"{source}/claims", claims.schema), files.stream_table(spark, f"{source}/labels", labels.schema))
        flows.append_stream(joined, out, state, state_partitions=2).awaitTermination()
        assert "RocksDBStateStoreProvider" in "".join(r[0] for r in spark.read.text(f"{state}/offsets/0").collect())
        assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")
        assert rows(flows.waiting_rows(spark, state), "claim_id") == [(1,)]
        assert rows(flows.waiting_rows(spark, state, "right"), "claim_id") == [(2,)]
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
