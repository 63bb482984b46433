"""Time-line operators against brute force, whole and cut into slices."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cardwarden.operators import timeline
from cardwarden.operators.slices import SLICE, SlicePolicy, hot_keys, mark_slices

START = datetime(2026, 1, 1)


def make_rows(seed):
    """One user holds a third of the rows, and many rows share a time."""
    rng = random.Random(seed)
    rows = []
    for i in range(180):
        user = 1 if i % 3 == 0 else rng.randrange(2, 9)
        at = START + timedelta(minutes=rng.randrange(0, 400), microseconds=rng.choice([0, 0, 1]))
        kind = rng.choice(["hit", "hit", "reset", "other"])
        rows.append((i, user, at, kind, Decimal(rng.randrange(1, 1000)) / 100))
    return rows


@pytest.fixture(scope="module", params=[1, 2, 3])
def data(spark, request):
    rows = make_rows(request.param)
    frame = spark.createDataFrame(
        rows, "id bigint, user_id bigint, ts timestamp, kind string, amount decimal(15,2)"
    ).repartition(5)
    return rows, frame


POLICIES = [SlicePolicy(), SlicePolicy(rows_per_slice=10, oversample=3), SlicePolicy(25, 1)]


@pytest.mark.parametrize("policy", POLICIES)
def test_prev_eligible(data, policy):
    rows, frame = data
    found = timeline.prev_eligible(
        frame, "user_id", "ts", "id", ["amount"], F.col("kind") != "other", policy=policy
    )
    got = {r.id: (r.prev.id, r.prev.amount) if r.prev else None for r in found.collect()}
    for i, user, at, _, _ in rows:
        earlier = [r for r in rows if r[1] == user and r[2] < at and r[3] != "other"]
        best = max(earlier, key=lambda r: (r[2], r[0]), default=None)
        assert got[i] == ((best[0], best[4]) if best else None)
    assert len(got) == len(rows)


@pytest.mark.parametrize("policy", POLICIES)
def test_previous_row(data, policy):
    rows, frame = data
    found = timeline.previous_row(frame, "user_id", "ts", "id", ["kind"], policy=policy)
    got = {r.id: r.prev.id if r.prev else None for r in found.collect()}
    for i, user, at, *_ in rows:
        earlier = [r for r in rows if r[1] == user and (r[2], r[0]) < (at, i)]
        best = max(earlier, key=lambda r: (r[2], r[0]), default=None)
        assert got[i] == (best[0] if best else None)


@pytest.mark.parametrize("policy", POLICIES)
def test_trailing_totals(data, policy):
    rows, frame = data
    found = timeline.trailing_totals(frame, "user_id", "ts", 60, "amount", policy=policy)
    got = {r.id: (r.trailing_count, r.trailing_sum) for r in found.collect()}
    assert len(got) == len(rows)
    for i, user, at, *_ in rows:
        inside = [
            r for r in rows if r[1] == user and at - timedelta(minutes=60) <= r[2] <= at
        ]
        assert got[i] == (len(inside), sum(r[4] for r in inside))


@pytest.mark.parametrize("policy", POLICIES)
def test_runs_since_reset(data, policy):
    rows, frame = data
    found = timeline.runs_since_reset(
        frame, "user_id", "ts", "id", F.col("kind") == "hit", F.col("kind") == "reset", policy=policy
    )
    got = {r.id: r.hits_since_reset for r in found.collect()}
    counts = {}
    for i, user, at, kind, _ in sorted(rows, key=lambda r: (r[2], r[0])):
        n = counts.get(user, 0)
        counts[user] = n + 1 if kind == "hit" else 0 if kind == "reset" else n
        assert got[i] == counts[user]


def test_only_frequent_keys_are_cut(data):
    _, frame = data
    timed = frame.withColumn("_at", F.unix_micros("ts"))
    assert [r.user_id for r in hot_keys(timed, ["user_id"], "_at", SlicePolicy(40)).collect()] == [1]
    assert hot_keys(timed, ["user_id"], "_at", SlicePolicy()) is None
    assert hot_keys(timed, ["user_id"], "_at", SlicePolicy(100)) is None


@pytest.mark.parametrize("shape", ["stray", "burst", "even", "one_time"])
def test_slices_keep_the_limit_under_skew(spark, shape):
    """A stray time, or nearly all rows in a short while, fills no slice beyond the limit."""
    at = {
        "stray": F.when(F.col("id") == 0, 0).otherwise(10**15 + F.col("id")),
        "burst": F.when(F.col("id") % 10 == 0, F.col("id") * 10**9).otherwise(5 * 10**12 + F.col("id")),
        "even": F.col("id") * 1000,
        "one_time": F.lit(7),
    }[shape]
    rows = spark.range(0, 20_000, 1, 4).select(F.lit(1).alias("user_id"), at.cast("bigint").alias("_at"))
    policy = SlicePolicy(1000, 4)
    marked = mark_slices(rows, hot_keys(rows, ["user_id"], "_at", policy), ["user_id"], "_at")
    found = marked.groupBy(SLICE).agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("a"), F.max("_at").alias("b"))
    sizes = found.orderBy(SLICE).collect()
    assert sum(r.n for r in sizes) == 20_000
    assert all(x.b < y.a for x, y in zip(sizes, sizes[1:]))
    if shape == "one_time":
        assert len(sizes) == 1
    else:
        assert max(r.n for r in sizes) <= policy.rows_per_slice


def test_span_edges_are_inclusive(spark):
    rows = [(1, 1, START), (2, 1, START + timedelta(minutes=60)),
            (3, 1, START + timedelta(minutes=60, microseconds=1))]
    frame = spark.createDataFrame(rows, "id int, user_id int, ts timestamp")
    got = timeline.trailing_count(frame, "user_id", "ts", 60, out="n").collect()
    assert {r.id: r.n for r in got} == {1: 1, 2: 2, 3: 2}
