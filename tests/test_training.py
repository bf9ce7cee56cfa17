"""Spines, bands, checks, splits, routing, and the model."""

from __future__ import annotations

import datetime as dt

import pytest
from helpers import at, rows, same
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import route_columns
from tidemark.functions.time import epoch_ms, epoch_us, parse_event_time, truncate_to_ms
from tidemark.operators import checks, labels, model, profile, spine, split
from tidemark.session import scratch_path


def test_epoch_of_all_time_types(spark):
    df = spark.createDataFrame([(at(1, us=1999), dt.datetime(1969, 12, 31, 23, 59, 59, 999_500), dt.date(1970, 1, 2))], "a timestamp_ntz, b timestamp_ntz, d date")
    df = df.withColumn("z", F.col("a").cast("timestamp")).withColumn("y", F.col("b").cast("timestamp"))
    got = df.select(epoch_ms(df, "a"), epoch_ms(df, "z"), epoch_us(df, "a"), epoch_us(df, "z"), epoch_ms(df, "b"), epoch_ms(df, "y"), epoch_us(df, "d")).first()
    start = 1704067200000
    assert tuple(got) == (start + 1, start + 1, start * 1000 + 1999, start * 1000 + 1999, 0, 0, 86_400_000_000)


def test_zoneless_stamps_do_not_depend_on_the_session_zone(spark):
    # The second stamp falls into the hour New York skips in spring.
    data = [(at(1, 5, 6, 7, 123456),), (at(10, 2, 30, 0, 999_999, month=3),), (dt.datetime(1969, 12, 31, 23, 59, 59, 999_999),)]
    df = spark.createDataFrame(data, "t timestamp_ntz").coalesce(1)

    def numbers():
        columns = [epoch_us(df, "t"), epoch_ms(df, "t"), truncate_to_ms(df, "t").cast("string")]
        return [tuple(r) for r in df.select(*columns).collect()]

    utc = numbers()
    assert utc[1] == (1710037800999999, 1710037800999, "2024-03-10 02:30:00.999")
    assert utc[2] == (-1, 0, "1969-12-31 23:59:59.999")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert numbers() == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_text_that_is_no_time_is_null(spark):
    df = spark.createDataFrame([("2024-01-01T05:00:00",), ("2024-01-01 05:00:00",), ("soon",), (None,)], "t string")
    parsed = [r[0] for r in df.select(parse_event_time("t").cast("timestamp_ntz")).collect()]
    assert parsed == [at(1, 5), at(1, 5), None, None]


def test_label_joins(spark):
    claims = spark.createDataFrame([("a", at(1)), ("b", at(1)), ("c", at(1))], "claim_id string, incident_timestamp timestamp_ntz")
    known = spark.createDataFrame(
        [("a", 1, at(1)), ("a", 0, at(1, month=2)), ("a", 1, at(1, 0, 0, 1, month=2)), ("b", 1, at(31, month=1))],
        "claim_id string, is_fraud int, label_available_timestamp timestamp_ntz",
    )
    before = known.withColumn("label_available_timestamp", F.col("label_available_timestamp") - F.expr("INTERVAL 60 DAYS"))
    joined = labels.join_late_labels(claims, known)
    # Both ends of the interval match; a second label doubles the claim; a later one does not.
    assert rows(joined, "claim_id", "is_fraud") == sorted([("a", 0), ("a", 1), ("b", 1), ("c", None)], key=repr)
    assert rows(labels.join_late_labels(claims, before), "is_fraud") == [(None,)] * 3
    assert rows(labels.labels_or_zero(claims, known), "claim_id", "is_fraud") == [("a", 0), ("a", 1), ("a", 1), ("b", 1), ("c", 0)]
    assert rows(labels.latest_label(known), "claim_id", "is_fraud") == [("a", 1), ("b", 1)]


def test_nulls_fall_into_the_last_band(spark):
    schema = (
        "policy_id string, policyholder_age int, gender string, region_type string, vehicle_year int, annual_premium_eur double, "
        "has_telematics int, coverage_type string, vehicle_type string, policy_start_date date, bonus_malus_years int, "
        "__START_AT timestamp_ntz, __END_AT timestamp_ntz"
    )
    def row(age, year, premium, start):
        return ("p", age, "F", "urban", year, premium, 1, "x", "y", start, 4, at(1, month=6), None)
    data = [row(24, 2022, 499.99, dt.date(2024, 3, 4)), row(25, 2015, 500.0, dt.date(2024, 3, 3)), row(65, 2014, 1200.0, None), row(None, None, None, None)]
    df = spark.createDataFrame(data, schema)
    bands = ["age_group", "vehicle_segment", "risk_level_by_premium", "is_new_policy_risk"]
    assert [tuple(r) for r in profile.profile_features(df).select(*bands).collect()] == [
        ("novel", "new", "low_risk", 1), ("standard", "mid_age", "medium_risk", 0), ("senior", "old", "high_risk", 0), ("senior", "old", "high_risk", 0)
    ]
    later = profile.profile_features(df, as_of=dt.date(2025, 1, 1))
    assert {r[0] for r in later.select("is_new_policy_risk").collect()} == {0}


def test_row_features_of_nulls(spark):
    df = spark.createDataFrame([(2, 1, 0.0, 1.3), (None, 1, None, None), (1, None, 9.0, 1.2)], "count_claims_30d long, is_new_policy_risk int, claimed_amount_eur double, claims_7d_vs_avg_30d_ratio double")
    out = profile.row_features(df).select(*profile.ROW_FEATURES)
    assert [tuple(r) for r in out.collect()] == [(1, 1, 0.0, 1), (0, 0, 0.0, 0), (0, 0, pytest.approx(2.302585093), 0)]


def test_spine_cuts_label_time_to_milliseconds(spark, inputs):
    out = spine.training_spine(inputs.enriched())
    stamps = [r[0] for r in out.filter("label_available_timestamp IS NOT NULL").select("label_available_timestamp").limit(50).collect()]
    assert stamps and all(s.microsecond % 1000 == 0 for s in stamps)
    assert out.schema["label_available_timestamp"].dataType.simpleString() == "timestamp_ntz"


def test_checks(spark):
    df = spark.createDataFrame([("a", 1), ("b", 0), ("c", None), ("c", 0)], "k string, is_fraud int")
    assert rows(checks.class_balance(df)) == sorted([(None, 1, 25.0), (0, 2, 50.0), (1, 1, 25.0)], key=repr)
    assert rows(checks.null_profile(df)) == [("is_fraud", 4, 1), ("k", 4, 0)]
    assert tuple(checks.row_consistency(df, df.limit(3)).first()) == (4, 3, False)
    checks.assert_unique(df.limit(3), ["k"])
    with pytest.raises(ValueError, match="'c'"):
        checks.assert_unique(df, ["k"])
    weights = checks.with_class_weights(df)
    assert rows(weights, "is_fraud", "class_weight") == sorted([(1, 2.0), (0, round(2 / 3, 8)), (0, round(2 / 3, 8)), (None, round(2 / 3, 8))], key=repr)
    only = df.filter("is_fraud = 0")
    assert tuple(checks.class_weights(only).first()) == (2, 0, 2, 1.0, 0.5)


def test_months_before():
    assert split.months_before(dt.date(2024, 3, 31), 1) == dt.date(2024, 2, 29)
    assert split.months_before(dt.date(2023, 12, 31), 12) == dt.date(2022, 12, 31)
    assert split.months_before(dt.date(2024, 1, 15), 1) == dt.date(2023, 12, 15)
    assert split.SplitSpec.fixed().train_start == dt.date(2019, 12, 31)


def test_splits_cover_whole_days_without_overlap(spark):
    data = [(dt.datetime(2022, 12, 31, 23, 59),), (dt.datetime(2023, 1, 1),), (dt.datetime(2023, 12, 31, 12),), (dt.datetime(2024, 5, 1),), (dt.datetime(2019, 12, 30),)]
    df = spark.createDataFrame(data, "t timestamp_ntz")
    named = split.with_split(df, "t", split.SplitSpec.fixed())
    assert [r[0] for r in named.orderBy("t").select("split").collect()] == [None, "train", "validation", "validation", "test"]
    parts = split.temporal_split(df, "t", split.SplitSpec.fixed())
    assert {k: v.count() for k, v in parts.items()} == {"train": 1, "validation": 2, "test": 1}
    midnight = split.SplitSpec.fixed(inclusive_midnight=True)
    assert {k: v.count() for k, v in split.temporal_split(df, "t", midnight).items()} == {"train": 0, "validation": 1, "test": 1}
    assert split.max_event_date(df, "t") == dt.date(2024, 5, 1)


def test_training_modes_recompute_weights(spark):
    schema = "is_fraud int, n int"
    parts = {s: spark.createDataFrame(d, schema) for s, d in (("train", [(1, 1), (0, 2)]), ("validation", [(0, 3), (0, 4)]), ("test", [(1, 5)]))}
    assert split.training_rows(parts, "train").count() == 2
    both = split.training_rows(parts, "train_val")
    assert rows(both.filter("is_fraud = 1"), "class_weight") == [(2.0,)]
    assert split.training_rows(parts, "all").count() == 5


def test_routes_by_type_and_prefix():
    schema = T.StructType.fromDDL(
        "claim_id long, policy_id string, timestamp timestamp, is_fraud int, count_claims_7d long, sum_amount_7d double, "
        "avg_amount_7d double, max_amount_30d double, amount decimal(10,2), age int, has_telematics int, vip boolean, gender string, start date"
    )
    routes = route_columns(schema)
    assert routes.flags == ["has_telematics", "vip"]
    assert routes.categorical == ["gender"]
    assert routes.zero_filled == ["count_claims_7d", "sum_amount_7d"]
    assert routes.imputed == ["amount", "age", "avg_amount_7d", "max_amount_30d"]


@pytest.fixture(scope="module")
def training_splits(spark, inputs):
    from tidemark.plans.training import enrich_in_one_pass
    from tidemark.sources import snapshots

    path = scratch_path(spark, "t_training")
    rows_ = spine.labelled_only(enrich_in_one_pass(spine.training_spine(inputs.enriched()), inputs.profile()))
    snapshots.write_snapshot(rows_.coalesce(2), path)
    spec = split.SplitSpec(dt.date(2024, 1, 1), dt.date(2024, 1, 20), dt.date(2024, 1, 25))
    return split.temporal_split(snapshots.read_snapshot(spark, path), "timestamp", spec)


def test_search_score_compare_and_save(spark, training_splits):
    search = model.grid_search(training_splits, model.DEFAULT_GRID[:2])
    table = search.table.collect()
    assert len(table) == 2 and table[0]["val_auc_pr"] >= table[1]["val_auc_pr"]
    assert all(r["gap_auc_pr"] == pytest.approx(r["train_auc_pr"] - r["val_auc_pr"]) for r in table)
    best = search.models[search.best]
    test = training_splits["test"]

    # One preparation for all grid points gives what a separate fit gives.
    params = next(p for p in model.DEFAULT_GRID if p.tag == search.best)
    alone = model.fit_model(split.training_rows(training_splits), params)
    assert list(alone.stages[-1].coefficients) == pytest.approx(list(best.stages[-1].coefficients), abs=1e-6)

    scored = model.score(best, test, 3, dt.datetime(2024, 2, 1))
    assert scored.columns[-5:] == ["is_fraud", "prediction", "prob_fraud", "model_version", "inference_timestamp"]
    assert scored.count() == test.count()
    assert scored.filter("is_fraud IS NOT NULL OR prob_fraud < 0 OR prob_fraud > 1").isEmpty()
    assert scored.filter("(prob_fraud > 0.5) <> (prediction = 1)").isEmpty()
    assert model.baseline(best, test, 3).columns == [*test.columns, "prediction", "prob_fraud", "model_version", "inference_timestamp"]

    assert not model.compare_models(test, best, best).challenger_wins
    assert model.compare_models(test, None, best).challenger_wins

    shown = model.coefficients(best, test, model.TOP_COEFFICIENTS).collect()
    sizes = [abs(r["coefficient"]) for r in shown]
    assert 0 < len(shown) <= model.TOP_COEFFICIENTS and sizes == sorted(sizes, reverse=True)
    everything = model.coefficients(best, test)
    assert everything.count() == len(best.stages[-1].coefficients)

    path = scratch_path(spark, "t_model")
    model.save_model(best, path)
    same(model.load_model(path).transform(test).select("claim_id", "prediction"), best.transform(test).select("claim_id", "prediction"))


def test_models_of_a_grid_are_measured_together(spark):
    from pyspark.ml.linalg import Vectors

    from tidemark.operators.metrics import best_threshold

    data = [(k % 3 // 2 if k % 11 else None, 1.0, Vectors.dense([k % 7, (k * k) % 5])) for k in range(80)]
    df = spark.createDataFrame(data, ["is_fraud", "class_weight", "model_input"])
    train, validation = df.filter("is_fraud IS NOT NULL"), df.filter("class_weight > 0")
    fits = [model.classifier(p).fit(train) for p in model.DEFAULT_GRID[:3]]
    sc, jobs = spark.sparkContext, []
    try:
        for n in (1, 3):
            sc.setJobGroup(f"measured {n}", "")
            got = model._measured(fits[:n], train, validation)
            jobs.append(len(sc.statusTracker().getJobIdsForGroup(f"measured {n}")))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1]  # not one set of jobs a model
    for fitted, (seen, unseen, best) in zip(fits, got, strict=True):
        on_val = fitted.transform(validation)
        assert seen == pytest.approx(model.evaluate(fitted.transform(train)))
        assert unseen == pytest.approx(model.evaluate(on_val))
        alone = best_threshold(on_val.select("is_fraud", model.probability().alias("prob_fraud"))).first()
        assert (best["threshold"], best["f1"]) == (alone["threshold"], pytest.approx(alone["f1"]))


def test_a_null_left_after_imputation_stops_the_model(spark, training_splits):
    fitted = model.fit_model(split.training_rows(training_splits))
    broken = training_splits["test"].withColumn("count_claims_7d", F.lit(None).cast("long"))
    with pytest.raises(Exception, match="(?i)null"):
        model.score(fitted, broken, 1).collect()
