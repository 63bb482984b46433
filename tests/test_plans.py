"""Plan shapes: what reaches the scan, what shuffles, what is broadcast."""

import re

import pytest

import seed as s
from cardwarden.operators import geo, joins, structuring
from cardwarden.operators.slices import SlicePolicy
from cardwarden.plans.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"
PYTHON = {"r1_3_geo_velocity_declining", "r1_3_sliced", "r1_6_apply_declines"}
# Most scans of tables a plan may hold; scans of stored results count too.
SCANS = {
    "r1_2_geo_velocity": 1, "l1_login_state": 1, "l2_lockout_events": 1, "r2_7_structuring_trailing": 1,
    "r3_2_block_batch": 8, "rp_e1_transaction_board": 7, "rp_e2_alerts_with_trail": 2, "snk2_upsert_open_alerts": 6,
    "r2_8_structuring_alerts": 9, "r2_8_structuring_audit": 8, "r9_detect_all": 4,
}
# Most shuffles of rows by key, broadcasts off; sorts of the result not counted.
SHUFFLES = {
    "r1_2_geo_velocity": 1, "l1_login_state": 1, "l2_lockout_events": 1, "r2_7_structuring_trailing": 1,
    "rp_e1_transaction_board": 6, "rp_e2_alerts_with_trail": 2,
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def no_broadcast(spark):
    """Plans as for tables beyond the broadcast threshold."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.fixture(autouse=True)
def whole_texts(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")


def stored(spark, folder):
    s.tables(spark)["transactions"].write.parquet(f"{folder}/t")
    return spark.read.parquet(f"{folder}/t")


def test_report_filters_and_columns_reach_the_scan(spark, tmp_path, seed):
    text = plan(structuring.structuring_report(stored(spark, tmp_path), seed["users"], s.T))
    pushed = re.search(r"PushedFilters: \[([^\n]*)", text).group(1)
    for part in ("GreaterThanOrEqual(transaction_timestamp", "EqualTo(transaction_status,completed)",
                 "LessThan(transaction_amount"):
        assert part in pushed
    columns = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "ip_address" not in columns and "latitude" not in columns


def test_velocity_shuffles_payments_once(no_broadcast, tmp_path):
    text = plan(geo.judge_velocity(stored(no_broadcast, tmp_path)))
    # Without frequent keys there is one window, one shuffle and nothing else.
    assert text.count("Exchange hashpartitioning(user_id") == 1 and text.count("Exchange") == 1
    assert text.count("FileScan") == 1
    assert "PushedFilters: [IsNotNull(latitude), IsNotNull(longitude)]" in text


def test_sliced_plan_broadcasts_only_frequent_keys(no_broadcast, tmp_path):
    text = plan(geo.judge_velocity(stored(no_broadcast, tmp_path), policy=SlicePolicy(1, 1)))
    assert 1 <= text.count("BroadcastExchange") <= 2 and "_starts" in text
    assert text.count("hashpartitioning(user_id") >= 1


@pytest.mark.parametrize("name", list(SCANS))
def test_tables_are_not_read_again_and_again(no_broadcast, name):
    text = plan(QUERIES[name](no_broadcast, FOLDER))
    assert text.count("FileScan") <= SCANS[name]


@pytest.mark.parametrize("name", list(SHUFFLES))
def test_rows_are_shuffled_once_per_key(no_broadcast, name):
    text = plan(QUERIES[name](no_broadcast, FOLDER))
    assert text.count("Exchange hashpartitioning") <= SHUFFLES[name]


def test_aggregates_combine_before_the_shuffle(no_broadcast, tmp_path, seed):
    text = plan(structuring.structuring_report(stored(no_broadcast, tmp_path), seed["users"], s.T))
    assert "partial_sum(transaction_amount" in text


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.endswith("_stream") and not n.startswith(("st1", "st5"))))
def test_no_cross_join_and_no_needless_python(no_broadcast, name):
    text = plan(QUERIES[name](no_broadcast, FOLDER))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    if name not in PYTHON:
        assert "MapInArrow" not in text and "MapInPandas" not in text


def test_relative_time_filter_is_pushed(spark, tmp_path):
    text = plan(joins.since(stored(spark, tmp_path), "transaction_timestamp", 7, "day", s.T))
    assert "GreaterThanOrEqual(transaction_timestamp" in text
