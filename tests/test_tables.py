import pytest
from pyspark.sql import functions as F

import seed as s
from cardwarden.operators import changes, joins, quality
from cardwarden.operators.slices import SlicePolicy
from cardwarden.plans import reports
from cardwarden.sources import tables
from cardwarden.sources.schemas import TABLES


def test_ingest_types_and_missing_columns(spark):
    raw = spark.createDataFrame([("7", "12.345", "1")], "user_id string, transaction_amount string, is_online string")
    typed = tables.ingest(raw, "transactions")
    assert [f.dataType for f in typed.schema] == [f.dataType for f in TABLES["transactions"].schema]
    row = typed.first()
    assert str(row.transaction_amount) == "12.35" and row.is_online is True and row.card_id is None


def test_defaults_and_ids(spark):
    raw = spark.createDataFrame([(None, 1), ("EUR", 2), (None, 3)], "currency_code string, user_id int")
    filled = tables.fill_defaults(raw, "transactions", s.T, id_offset=100, id_order="user_id").orderBy("user_id").collect()
    assert [r.currency_code for r in filled] == ["USD", "EUR", "USD"]
    assert [r.transaction_id for r in filled] == [101, 102, 103]
    assert {r.transaction_timestamp for r in filled} == {s.T}
    assert {r.transaction_status for r in filled} == {"completed"}


@pytest.mark.parametrize("rows_per_slice, store", [(2_000_000, False), (20, True), (3, False)])
def test_numbers_are_dense_and_ordered(spark, rows_per_slice, store):
    frame = spark.range(150).select((F.col("id") * F.col("id") % 97).alias("k"), "id").unionByName(
        spark.createDataFrame([(None, 900)], "k bigint, id bigint")
    ).repartition(6)
    got = tables.number_rows(frame, "k", ["id"], offset=10, rows_per_slice=rows_per_slice, checkpoint=store).collect()
    rows = sorted(((r.k is not None, r.k, r.id), r.row_id) for r in got if r.k is not None)
    assert sorted(r.row_id for r in got) == list(range(11, 162))
    assert [n for _, n in rows] == list(range(12, 162))


@pytest.mark.parametrize("most, default, want", [(8, 2_000_000, 8), (8, 40, 50), (500, 2_000_000, 500)])
def test_small_slices_make_no_task_each(spark, monkeypatch, most, default, want):
    """A thousand rows in slices of two: as many ranges as allowed, more only where the default limit needs them."""
    monkeypatch.setattr(tables, "MOST_RANGES", most)
    monkeypatch.setattr(tables, "ROWS_PER_SLICE", default)
    made = []
    original = tables.stored
    monkeypatch.setattr(tables, "stored", lambda df: made.append(original(df)) or made[-1])
    frame = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    got = tables.number_rows(frame, "k", ["id"], rows_per_slice=2)
    assert 0.8 * want <= made[-1].select("_part").distinct().count() <= want
    rows = sorted((r.row_id, r.k, r.id) for r in got.collect())
    assert [(i, k) for k, i in sorted((i % 7, i) for i in range(1000))] == [(r[2], r[1]) for r in rows]
    assert [r[0] for r in rows] == list(range(1, 1001))


def test_formats_round_trip(spark, tmp_path):
    users = tables.ingest(s.tables(spark)["users"], "users")
    users.write.parquet(f"{tmp_path}/users.parquet")
    users.write.json(f"{tmp_path}/users.json")
    users.write.option("header", True).csv(f"{tmp_path}/users.csv")
    for fmt in ("parquet", "json", "csv"):
        assert tables.scan(spark, str(tmp_path), "users", fmt).exceptAll(users).isEmpty()


def test_append_and_day_pruning(spark, tmp_path):
    path = f"{tmp_path}/txns"
    rows = s.payments(spark, *[s.payment(i, 1, 1, 1, 10, -1440 * i) for i in range(6)])
    tables.write_by_day(rows, path)
    tables.write_by_day(s.payments(spark, s.payment(9, 1, 1, 1, 10, 0)), path)
    stored = spark.read.parquet(path)
    assert stored.count() == 7
    recent = tables.since_days(stored, s.T, 48)
    assert {r.transaction_id for r in recent.collect()} == {0, 1, 2, 9}
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    tables.append(rows.limit(1), f"{tmp_path}/more")
    tables.append(rows.limit(1), f"{tmp_path}/more")
    assert spark.read.parquet(f"{tmp_path}/more").count() == 2


def test_update_takes_nulls_and_keeps_others(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, v string, w int")
    new = spark.createDataFrame([(1, None)], "k int, v string")
    rows = {r.k: (r.v, r.w) for r in changes.update_from(target, new, "k", ["v"]).collect()}
    assert rows == {1: (None, 1), 2: ("b", 2)}
    stamped = {r.k: r.updated_at for r in changes.touch(target, new, "k", s.T).collect()}
    assert stamped == {1: s.T, 2: None}


def test_deletes_reach_children(spark):
    child = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "c int, p int")
    gone = spark.createDataFrame([(10,)], "p int")
    assert {r.c for r in changes.cascade(child, gone, "p").collect()} == {2, 3}
    assert {r.c: r.p for r in changes.cascade(child, gone, "p", "set_null").collect()} == {1: None, 2: 20, 3: None}
    assert {r.c for r in changes.delete_keys(child, gone).collect()} == {2, 3}
    with pytest.raises(ValueError):
        changes.cascade(child, gone, "p", "restrict")


def test_checks_on_declared_rules(spark):
    bad = s.rows(spark, "authentication", [
        {"auth_id": 1, "employee_id": "a", "username": "u", "role": "bank_employee", "is_active": False},
        {"auth_id": 2, "employee_id": "b", "username": "u", "role": "guest", "is_active": True, "failed_attempts": -1},
        {"auth_id": 3, "employee_id": "c", "username": "w", "is_active": True},
    ])
    broken = quality.table_check_violations(bad, "authentication").collect()
    assert sorted((r.auth_id, r.rule) for r in broken) == [
        (1, "inactive_has_date"), (2, "failed_attempts"), (2, "role"),
    ]
    assert [(r.username, r.n) for r in quality.duplicate_keys(bad, ["username"]).collect()] == [("u", 2)]
    missing = quality.null_violations(bad, TABLES["authentication"].required, "auth_id").collect()
    assert (3, "role") in {(r.auth_id, r.column_name) for r in missing}
    events = s.rows(spark, "authentication_audit_log", [
        {"log_id": i, "auth_id": a} for i, a in enumerate([1, 11, None])
    ])
    assert [r.auth_id for r in quality.orphans(events, bad, "auth_id").collect()] == [11]
    long = s.rows(spark, "users", [{"user_id": 1, "country_iso_code": "USA", "email": "e"}])
    found = quality.length_violations(long, TABLES["users"].lengths, "user_id").collect()
    assert [(r.user_id, r.column_name) for r in found] == [(1, "country_iso_code")]


def test_every_table_rule_parses(spark):
    for name, table in TABLES.items():
        empty = spark.createDataFrame([], table.schema)
        assert quality.table_check_violations(empty, name).isEmpty() if table.checks else True
        assert quality.null_violations(empty, table.required, table.key).isEmpty()


@pytest.mark.parametrize("policy", [SlicePolicy(), SlicePolicy(2, 3)])
def test_left_many_equals_left_join(spark, policy):
    left = spark.createDataFrame([(1, "a"), (1, "z"), (2, "b"), (3, "d"), (None, "c")], "k int, v string")
    right = spark.createDataFrame([(1, i) for i in range(40)] + [(3, 6), (4, 1), (None, 7)], "k int, w int")
    want = left.join(right, "k", "left")
    got = joins.left_many(left, right, "k", policy).select(want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


@pytest.mark.parametrize("policy", [SlicePolicy(), SlicePolicy(3, 2)])
def test_lookup_equals_null_safe_left_join(spark, policy):
    rows = spark.createDataFrame([(i % 3 or None, i) for i in range(30)] + [(9, 99)], "k int, v int")
    table = spark.createDataFrame([(1, "a"), (None, "n"), (5, "x")], "k int, w string")
    got = sorted((r.v, r.w) for r in joins.lookup(rows, table, "k", policy).collect())
    names = {1: "a", None: "n"}
    assert got == [(i, names.get(i % 3 or None)) for i in range(30)] + [(99, None)]


def test_sort_orders(spark):
    users = spark.createDataFrame([(1, "low"), (2, "high"), (3, "medium")], "user_id int, risk_profile string")
    assert [r.user_id for r in joins.order_by_risk(users).collect()] == [3, 1, 2]
    assert [r.user_id for r in joins.order_by_risk(users, rank_risk=True).collect()] == [2, 3, 1]
    roles = spark.createDataFrame([("bank_employee",), ("super_admin",), ("compliance_officer",)], "role string")
    from cardwarden.functions.expr import ROLE_RANK

    ordered = [r.role for r in joins.order_by_rank(roles, "role", ROLE_RANK).collect()]
    assert ordered == ["super_admin", "compliance_officer", "bank_employee"]


def test_reports_on_seed_rows(seed):
    assert [r.user_id for r in reports.users_by_risk(seed).collect()] == [3, 4, 1, 2, 5, 6]
    assert reports.merchants_by_risk(seed).first().merchant_id == 4
    assert reports.cards_with_holder(seed).first().card_holder == "John Doe"
    board = reports.transaction_board(seed)
    assert board.count() == 11 and board.first().transaction_status == "completed"
    assert "device_id" in reports.transactions_with_parties(seed).columns
    assert reports.users_with_alerts(seed).isEmpty()
    volume = reports.merchant_volume(seed, s.T).first()
    assert (volume.merchant_name, volume.total_transactions) == ("Wire hub", 5)
