"""Versions in force and stored sketches against plain code."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cardwarden.operators import merchant, sketches
from cardwarden.operators.slices import SlicePolicy
from cardwarden.operators.versions import in_force

START = datetime(2024, 1, 1)


def _data(spark, seed):
    dice = random.Random(seed)
    rows = [(i, dice.choice([1, 1, 1, 2, 3, 9, None]), START + timedelta(hours=dice.randrange(200))) for i in range(400)]
    marks = [(k, START + timedelta(hours=dice.randrange(200)), dice.randrange(5)) for k in (1, 1, 1, 2, 3) for _ in range(9)]
    marks += [(1, marks[0][1], 7), (None, START, 3)]
    return (
        rows, marks, spark.createDataFrame(rows, "id long, m int, ts timestamp").repartition(4),
        spark.createDataFrame(marks, "m long, since timestamp, v int"),
    )


@pytest.mark.parametrize("policy", [SlicePolicy(), SlicePolicy(rows_per_slice=25)])
@pytest.mark.parametrize("seed", range(2))
def test_versions_in_force(spark, seed, policy):
    rows, marks, frame, versions = _data(spark, seed)
    met = in_force(frame, versions, "m", "ts", "since", ["v"], policy=policy)
    assert met.columns == ["id", "m", "ts", "version"]
    got = {r["id"]: r["version"] and r["version"]["v"] for r in met.collect()}
    for key, m, ts in rows:
        if m is not None:
            assert got[key] == max(((s, v) for k, s, v in marks if k == m and s <= ts), default=(None, None))[1]
    assert len(got) == len(rows)


def test_gate_follows_the_versions(spark):
    payments = spark.createDataFrame(
        [(1, 5, START, "a"), (2, 5, START + timedelta(days=2), "b"), (3, 6, START + timedelta(days=2), "b"), (4, 5, START + timedelta(days=4), "c")],
        "transaction_id long, merchant_id long, transaction_timestamp timestamp, batch_id string",
    )
    versions = spark.createDataFrame(
        [(5, START + timedelta(days=2), 1), (5, START + timedelta(days=3), 0)], "merchant_id long, valid_from timestamp, is_blacklisted int"
    )
    gated = merchant.gate_by_versions(payments, versions)
    assert {r["transaction_id"]: r["rejected"] for r in gated.collect()} == {1: False, 2: True, 3: True, 4: False}
    single = merchant.gate_by_versions(payments, versions, mode="row")
    assert {r["transaction_id"] for r in single.filter("rejected").collect()} == {2}
    with pytest.raises(ValueError):
        merchant.gate_by_versions(payments, versions, mode="none")


def test_sketches_of_any_period(spark, tmp_path):
    """Days stored, replayed and added to; estimates within the stated error of the exact counts."""
    rows = spark.range(60_000).select(
        (F.col("id") % 3).alias("m"), (F.col("id") * 7919 % 20_011).alias("u"),
        F.timestamp_seconds(1704067200 + F.col("id") % 12 * 86400).alias("ts"),
    )
    first, later = rows.filter("u % 4 < 3"), rows.filter("u % 4 = 3")
    sketches.write_days(sketches.daily_sketches(first, ["m"], "ts", "u"), str(tmp_path))
    sketches.write_days(sketches.daily_sketches(first, ["m"], "ts", "u"), str(tmp_path))
    stored = spark.read.parquet(str(tmp_path))
    more = sketches.add_to_days(stored, sketches.daily_sketches(later.filter("day(ts) <= 5"), ["m"], "ts", "u"), ["m"])
    sketches.write_days(spark.createDataFrame(more.collect(), more.schema), str(tmp_path))
    seen = first.unionByName(later.filter("day(ts) <= 5"))
    for low, high in ((1, 12), (3, 6), (9, 9)):
        exact = {r["m"]: (r["n"], r["u"]) for r in seen.filter(f"day(ts) BETWEEN {low} AND {high}").groupBy("m").agg(
            F.count("u").alias("n"), F.count_distinct("u").alias("u")).collect()}
        period = F.dayofmonth("day").between(low, high)
        for r in sketches.distinct_over(spark.read.parquet(str(tmp_path)), ["m"], period).collect():
            n, u = exact.pop(r["m"])
            assert r["n"] == n and abs(r["estimate"] - u) <= max(1, sketches.relative_error() * u)
        assert not exact
    whole = sketches.distinct_over(spark.read.parquet(str(tmp_path)), []).first()
    assert abs(whole["estimate"] - seen.select("u").distinct().count()) <= sketches.relative_error() * 20_011
    assert sketches.distinct_over(spark.read.parquet(str(tmp_path)), ["m"], F.col("day") > "2030-01-01").collect() == []
