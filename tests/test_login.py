from datetime import timedelta

import pytest

import seed as s
from cardwarden.operators import login
from cardwarden.operators.slices import SlicePolicy

KINDS = {
    "f": ("login_failure", "failure"), "s": ("login_success", "success"),
    "u": ("account_unlocked", "success"), "m": ("mfa_failure", "failure"),
}


def log(spark, marks, account=1, first=1):
    return s.rows(spark, "authentication_audit_log", [
        {"log_id": first + i, "auth_id": account, "employee_id": f"EMP-{account}", "username_attempted": "x",
         "event_type": KINDS[m][0], "login_status": KINDS[m][1], "ip_address": f"10.0.0.{i % 3}",
         "geo_country": "US", "mfa_used": False, "event_timestamp": s.T + timedelta(minutes=i)}
        for i, m in enumerate(marks)
    ])


def state(spark, marks, **options):
    return login.login_state(log(spark, marks), s.T + timedelta(hours=1), **options).first()


POLICIES = [SlicePolicy(), SlicePolicy(2, 2)]


@pytest.mark.parametrize("policy", POLICIES)
def test_five_failures_lock(spark, policy):
    row = state(spark, "fffff", policy=policy)
    assert row.failed_attempts == 5
    assert row.locked_until == s.T + timedelta(minutes=4 + 30)
    assert row.is_locked is False
    assert state(spark, "ffff", policy=policy).locked_until is None


@pytest.mark.parametrize("policy", POLICIES)
def test_success_resets(spark, policy):
    row = state(spark, "ffffffsf", policy=policy)
    assert (row.failed_attempts, row.locked_until) == (1, None)
    assert row.last_login_at == s.T + timedelta(minutes=6) and row.last_login_ip == "10.0.0.0"


@pytest.mark.parametrize("policy", POLICIES)
def test_only_success_clears_the_counter(spark, policy):
    row = state(spark, "fffffumff", policy=policy)
    assert row.failed_attempts == 7
    assert row.locked_until == s.T + timedelta(minutes=8 + 30)


@pytest.mark.parametrize("policy", POLICIES)
def test_each_failure_from_the_fifth_extends_the_lock(spark, policy):
    rows = login.lockout_events(log(spark, "fffffffsfffff"), policy=policy).collect()
    assert sorted((r.log_id, r.failed_attempts) for r in rows) == [(5, 5), (6, 6), (7, 7), (13, 5)]


def test_state_reaches_the_accounts(spark):
    accounts = s.rows(spark, "authentication", [
        {"auth_id": i, "employee_id": f"EMP-{i}", "username": f"u{i}", "role": "bank_employee",
         "is_active": True, "failed_attempts": 2, "must_change_password": False} for i in (1, 2)
    ])
    after = login.apply_login_state(accounts, login.login_state(log(spark, "fffff"), s.T), s.T)
    rows = {r.auth_id: r for r in after.collect()}
    assert (rows[1].failed_attempts, rows[1].updated_at) == (5, s.T)
    assert (rows[2].failed_attempts, rows[2].updated_at) == (2, None)
    health = {r.auth_id: r.account_health for r in login.account_directory(after, s.T).collect()}
    assert health == {1: "🔒 Locked", 2: "✅ Active"}


def test_summaries_list_all_addresses(spark):
    events = log(spark, "fffff").unionByName(log(spark, "ff", account=None, first=50))
    rows = {r.employee_id: r for r in login.failure_summary(events).collect()}
    assert rows["EMP-1"].ips_used == "10.0.0.0, 10.0.0.0, 10.0.0.1, 10.0.0.1, 10.0.0.2"
    assert rows["EMP-1"].total_failures == 5 and rows["EMP-None"].total_failures == 2


def test_groups_without_key_and_long_lists(spark):
    from cardwarden.operators.textlists import text_counts, text_lists

    frame = spark.createDataFrame(
        [(None, "b"), (None, "a"), (None, None), ("k", None), *[("long", f"t{i % 40}") for i in range(80)]],
        "k string, v string",
    )
    got = {r.k: r.texts for r in text_lists(frame, ["k"], "v", "texts").collect()}
    assert got[None] == "a, b" and got["k"] is None
    # A group beyond the bound keeps its one row, or ends the query with its name.
    assert got["long"].split(", ") == sorted(f"t{i % 40}" for i in range(80))
    with pytest.raises(Exception, match="texts of more than 100 bytes in one group, use text_counts: long"):
        text_lists(frame, ["k"], "v", "texts", most_bytes=100).collect()
    counted = {(r.k, r.v): r.n for r in text_counts(frame, ["k"], "v").collect()}
    assert counted["long", "t3"] == 2 and counted[None, None] == 1 and len(counted) == 44
