"""Type-2 histories: ties, unchanged rows, late rows, invariants, hot keys, streams."""

from __future__ import annotations

import random

from helpers import at, rows, same
from pyspark.sql import functions as F

from tidemark.operators.scd2 import END, START, current_versions, scd2
from tidemark.session import scratch_path
from tidemark.sources import files
from tidemark.streaming import history as stream_history

SCHEMA = "k string, seq timestamp_ntz, id int, x string, noise int"


def feed_of(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def versions(df):
    return rows(df, "k", START, END, "x")


DATA = [
    ("a", at(1), 1, "u", 0),
    ("a", at(3), 2, "u", 1),  # no change
    ("a", at(5), 3, None, 0),
    ("a", at(5), 4, "v", 0),  # wins by tie-breaker
    ("a", at(7), 5, "v", 0),
    ("a", at(7), 5, "v", 0),  # exact copy
    ("b", at(2), 6, None, 0),
]


def test_ties_collapse_and_validity(spark):
    out = scd2(feed_of(spark, DATA), ["k"], "seq", exclude=["noise"], tie_breaker=["id"])
    assert versions(out) == [
        ("a", at(1), at(5), "u"), ("a", at(5), None, "v"), ("b", at(2), None, None)
    ]
    assert rows(current_versions(out), "k", "x") == [("a", "v"), ("b", None)]
    assert "noise" not in out.columns and "id" not in out.columns


def test_without_collapse_every_instant_is_a_version(spark):
    out = scd2(
        feed_of(spark, DATA), ["k"], "seq", exclude=["noise"], tie_breaker=["id"], collapse_unchanged=False
    )
    assert [v[1] for v in versions(out) if v[0] == "a"] == [at(1), at(3), at(5), at(7)]


def test_row_order_does_not_matter(spark):
    shuffled = DATA[:]
    random.Random(4).shuffle(shuffled)
    same(scd2(feed_of(spark, DATA), ["k"], "seq"), scd2(feed_of(spark, shuffled), ["k"], "seq"))


def test_intervals_are_contiguous_with_one_open_end(spark, inputs):
    out = inputs.history()
    ends = out.groupBy("policy_id").agg(F.count_if(F.col(END).isNull()).alias("open"))
    assert ends.filter("open <> 1").isEmpty()
    joined = out.alias("a").join(
        out.alias("b"), (F.col("a.policy_id") == F.col("b.policy_id")) & (F.col(f"a.{END}") == F.col(f"b.{START}")), "left_anti"
    )
    assert joined.filter(F.col(END).isNotNull()).isEmpty()
    assert out.filter(F.col(END) <= F.col(START)).isEmpty()


def test_hot_keys_give_the_same_history(spark):
    rng = random.Random(9)
    data = [
        (rng.choice(["hot", "hot", "hot", "a", "b"]), at(rng.randint(1, 9), rng.randint(0, 3), rng.choice([0, 30])), i, rng.choice("xyy") if i % 7 else None, 0)
        for i in range(400)
    ]
    feed = feed_of(spark, data)
    for collapse in (True, False):
        options = {"exclude": ["noise"], "tie_breaker": ["id"], "collapse_unchanged": collapse}
        plain = scd2(feed, ["k"], "seq", **options)
        for limit in (150, 0):
            same(scd2(feed, ["k"], "seq", max_rows_per_key=limit, **options), plain)


def test_numbered_sequence(spark):
    feed = spark.createDataFrame([("a", n, str(n // 100_000)) for n in range(0, 500_000, 20_000)], "k string, n long, x string")
    plain = scd2(feed, ["k"], "n")
    assert rows(plain, START, END)[:2] == [(0, 100_000), (100_000, 200_000)]
    same(scd2(feed, ["k"], "n", max_rows_per_key=0), plain)


def test_hot_keys_with_sequences_of_any_type(spark):
    rng = random.Random(11)
    data = [(rng.choice(["hot", "hot", "a"]), rng.choice([None, *range(-20, 60)]), i, rng.choice(["x", "y", None])) for i in range(300)]
    # Without a sequence value first, and then the same state again: one version.
    data += [("n", None, 1, "u"), ("n", 1, 2, "u"), ("n", 2, 3, "v")]
    feed = spark.createDataFrame(data, "k string, n int, id int, x string")
    for kind in ("string", "decimal(10,3)", "double", "long", "date"):
        value = F.date_add(F.lit("2024-01-01").cast("date"), F.col("n")) if kind == "date" else F.col("n").cast(kind)
        typed = feed.select("k", value.alias("seq"), "id", "x")
        for collapse in (True, False):
            plain = scd2(typed, ["k"], "seq", tie_breaker=["id"], collapse_unchanged=collapse)
            assert plain.filter("k = 'n'").count() == (2 if collapse else 3)
            for limit in (0, 150):
                got = scd2(typed, ["k"], "seq", tie_breaker=["id"], collapse_unchanged=collapse, max_rows_per_key=limit)
                assert got.dtypes == plain.dtypes
                same(got, plain)


def test_one_exchange(spark, inputs):
    plan = scd2(inputs.feed(), ["policy_id"], "policy_updated_at", tie_breaker=["feed_id"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Window [") == 3
    assert text.count("Exchange hashpartitioning(policy_id") == 1


def test_stream_in_any_order_equals_batch(spark):
    feed = feed_of(spark, DATA).drop("noise")
    source, out, state = (scratch_path(spark, f"t_scd2_{n}") for n in ("in", "out", "ckpt"))
    parts = [F.col("seq") >= F.lit(at(5)), F.col("k") == "b", (F.col("k") == "a") & (F.col("seq") < F.lit(at(5)))]
    for part in parts:
        feed.filter(part).write.mode("append").parquet(source)
        stream = files.stream_table(spark, source, feed.schema)
        stream_history.scd2_stream(stream, out, state, ["k"], "seq", tie_breaker=["id"], buckets=4).awaitTermination()
    same(stream_history.read_history(spark, out, ["k"]), scd2(feed, ["k"], "seq", tie_breaker=["id"]))


def _streamed(spark, feed, parts, name, after=None, **options):
    """The history after the parts of the feed have come one after another."""
    source, out, state = (scratch_path(spark, f"t_scd2_{name}_{n}") for n in ("in", "out", "ckpt"))
    for part in parts:
        part.write.mode("append").parquet(source)
        stream = files.stream_table(spark, source, feed.schema)
        stream_history.scd2_stream(stream, out, state, ["k"], "seq", buckets=2, **options).awaitTermination()
        if after:
            after(out)
    return out


def test_stored_rows_grow_with_the_changes(spark):
    rng = random.Random(2)
    data = [(rng.choice("abcdef"), at(1 + i // 20, i % 20), i, rng.choice("xy"), 0) for i in range(200)]
    feed = feed_of(spark, data).drop("noise")
    sizes = []
    out = _streamed(
        spark, feed, [feed.filter(F.col("id").between(20 * n, 20 * n + 39)) for n in range(0, 10, 2)], "grow",
        lambda path: sizes.append({r["state"]: r["n_rows"] for r in stream_history.stored_rows(spark, path).collect()}), tie_breaker=["id"],
    )
    same(stream_history.read_history(spark, out, ["k"]), scd2(feed, ["k"], "seq", tie_breaker=["id"]))
    # Every change is closed once; tails hold a row per key, and at most three of them are kept.
    assert [s["closed"] for s in sizes] == [40 * (n + 1) - 6 for n in range(5)]
    assert all(s["open"] <= 3 * 6 for s in sizes)


def test_stream_of_shuffled_changes_with_ties_and_nulls(spark):
    rng = random.Random(4)
    data = [(rng.choice(["hot", "hot", "a", None]), rng.choice([None, *[at(d, h) for d in range(1, 8) for h in (0, 6)]]), i, rng.choice(["x", "y", None]), 0) for i in range(240)]
    rng.shuffle(data)
    feed = feed_of(spark, data).drop("noise")
    parts = [feed.filter(F.col("id") % 3 == n) for n in range(3)]
    for name, options in (("mixed", {}), ("hot", {"max_rows_per_key": 5, "collapse_unchanged": False})):
        out = _streamed(spark, feed, parts, name, tie_breaker=["id"], **options)
        collapse = options.get("collapse_unchanged", True)
        for limit in (10**6, 3):
            got = stream_history.read_history(spark, out, ["k"], limit)
            same(got, scd2(feed, ["k"], "seq", tie_breaker=["id"], collapse_unchanged=collapse))


def test_a_batch_that_runs_again_changes_nothing(spark):
    feed = feed_of(spark, DATA).drop("noise")
    source, out = (scratch_path(spark, f"t_scd2_again_{n}") for n in ("in", "out"))
    for n, part in enumerate([F.col("seq") < F.lit(at(5)), F.col("seq") >= F.lit(at(5))]):
        feed.filter(part).write.mode("append").parquet(source)
        stream = files.stream_table(spark, source, feed.schema)
        # A fresh checkpoint: the second run takes all files as batch 0 once more, then nothing is new.
        state = scratch_path(spark, "t_scd2_again_ckpt")
        stream_history.scd2_stream(stream, out, state, ["k"], "seq", tie_breaker=["id"], buckets=2).awaitTermination()
        first = rows(stream_history.read_history(spark, out, ["k"]))
        state = scratch_path(spark, "t_scd2_again_ckpt")
        stream_history.scd2_stream(stream, out, state, ["k"], "seq", tie_breaker=["id"], buckets=2).awaitTermination()
        assert rows(stream_history.read_history(spark, out, ["k"])) == first
    same(stream_history.read_history(spark, out, ["k"]), scd2(feed, ["k"], "seq", tie_breaker=["id"]))
