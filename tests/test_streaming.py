"""Streams against the batch form, for several splits of the input."""

import random
from datetime import timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import seed as s
from cardwarden.operators import geo, login
from cardwarden.sources import adapters
from cardwarden.sources.schemas import TABLES
from cardwarden.streaming import detect, stateful


def write_parts(spark, table, records, at, parts, folder):
    """One file per part, in time order."""
    ordered = sorted(records, key=lambda r: (r[at], r[TABLES[table].key]))
    size = -(-len(ordered) // parts)
    for start in range(0, len(ordered), size):
        s.rows(spark, table, ordered[start:start + size]).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, table, folder):
    schema = s.rows(spark, table, []).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def run(spark, frame, folder):
    query = (
        frame.writeStream.format("parquet").option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    )
    assert query.awaitTermination(240) and query.exception() is None
    return spark.read.parquet(f"{folder}/out")


PLACES = [s.SHREVEPORT, s.DALLAS, s.HOUSTON, s.MOSCOW]


def random_payments(n=90):
    rng = random.Random(7)
    return [
        s.payment(i, 1, rng.choice([1, 2, 3, 7]), 1 if i % 3 == 0 else rng.randrange(2, 5),
                  rng.randrange(100, 9000), rng.randrange(0, 4000), rng.choice(PLACES),
                  status=rng.choice(["completed"] * 4 + ["declined"]), mcc=rng.choice(["5942", "6051"]))
        for i in range(n)
    ]


@pytest.mark.parametrize("parts", [1, 3])
def test_travel_stream_equals_batch(spark, tmp_path, parts):
    records = random_payments()
    write_parts(spark, "transactions", records, "transaction_timestamp", parts, f"{tmp_path}/in")
    got = run(spark, stateful.geo_velocity_stream(stream(spark, "transactions", f"{tmp_path}/in")), tmp_path)
    want = geo.judge_velocity_declining(s.payments(spark, *records))
    assert got.count() == want.count() == 90
    assert want.filter("violation").count() > 5
    same = [c for c in want.columns]
    assert got.select(same).exceptAll(want.select(same)).isEmpty()


def test_travel_stream_marks_late_rows(spark, tmp_path):
    for i, row in enumerate([s.payment(1, 1, 1, 1, 10, 60, s.MOSCOW), s.payment(2, 1, 1, 1, 10, 50, s.DALLAS)]):
        write_parts(spark, "transactions", [row], "transaction_timestamp", 1, f"{tmp_path}/in/part={i}")
    source = spark.readStream.schema(s.payments(spark).schema).option("maxFilesPerTrigger", 1).parquet(
        f"{tmp_path}/in/*"
    )
    rows = {r.transaction_id: r for r in run(spark, stateful.geo_velocity_stream(source), tmp_path).collect()}
    # Nothing was accepted before the late payment's time, so it has no reference.
    assert not rows[1].violation and not rows[2].violation and not rows[2].late
    assert rows[2].prev_transaction_id is None


def arriving(spark, folder, parts):
    """Payments as a stream of files, one per micro-batch, in arrival order."""
    for row in parts:
        write_parts(spark, "transactions", row, "transaction_timestamp", 1, f"{folder}/in/a")
    return spark.readStream.schema(s.payments(spark).schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/a")


LATE = [
    [s.payment(1, 1, 1, 1, 10, 0, s.SHREVEPORT), s.payment(2, 1, 1, 1, 10, 600, s.SHREVEPORT)],
    [s.payment(3, 1, 1, 1, 10, 5, s.MOSCOW), s.payment(4, 1, 1, 1, 10, 660, s.DALLAS)],
    [s.payment(5, 1, 1, 1, 10, 300, s.DALLAS), s.payment(6, 1, 1, 1, 10, 600, s.TOKYO)],
]
# Payment 3 comes after payment 2 but lies before it: judged against payment 1. Payment 6 has the
# time of payment 2 and is judged against payment 5, the latest strictly earlier one.
JUDGED_LATE = {1: (None, False), 2: (1, False), 3: (1, True), 4: (2, False), 5: (1, False), 6: (5, True)}


def test_late_and_equal_time_payments_are_judged(spark, tmp_path, seed):
    got = run(spark, stateful.geo_velocity_stream(arriving(spark, tmp_path, LATE)), tmp_path).collect()
    assert {r.transaction_id: (r.prev_transaction_id, r.violation) for r in got} == JUDGED_LATE
    store = detect.DetectionStore(spark, f"{tmp_path}/store", full_every=2)
    for no, rows in enumerate(LATE):
        detect.run_batch(store, s.payments(spark, *rows), no, seed["merchants"], seed["alerts"])
    judged = store.read_all("geo_judged").collect()
    assert {r.transaction_id: (r.prev_transaction_id, r.violation) for r in judged} == JUDGED_LATE


def test_ids_go_on_from_the_highest(spark, tmp_path, seed):
    initial = s.rows(spark, "alerts", [
        {"alert_id": 5_000_000_000, "transaction_id": 1, "card_id": 1, "user_id": 9, "alert_type": "other",
         "alert_status": "open"}
    ])
    store = detect.DetectionStore(spark, str(tmp_path), full_every=2)
    for no in range(3):
        batch = s.payments(spark, s.payment(10 + no, 3, 4, 3, 9999, no, s.DALLAS))
        detect.run_batch(store, batch, no, seed["merchants"], initial)
    ids = [r.alert_id for r in store.snapshot(2, initial).orderBy("alert_id").collect()]
    assert ids == [5_000_000_000 + i for i in range(4)]
    # Blocked alerts never merge, so they are not carried from batch to batch.
    assert store.open_alerts(3, initial).isEmpty()


@pytest.mark.parametrize("parts", [2])
def test_login_stream_equals_batch(spark, tmp_path, parts):
    rng = random.Random(3)
    records = [
        {"log_id": i, "auth_id": rng.choice([1, 1, 2, 3, None]), "username_attempted": "x",
         **dict(zip(("event_type", "login_status"), rng.choice(
             [("login_failure", "failure")] * 5 + [("login_success", "success"), ("logout", "success")]))),
         "ip_address": f"10.0.0.{i}", "mfa_used": False, "event_timestamp": s.T + timedelta(minutes=i)}
        for i in range(80)
    ]
    write_parts(spark, "authentication_audit_log", records, "event_timestamp", parts, f"{tmp_path}/in")
    source = stream(spark, "authentication_audit_log", f"{tmp_path}/in")
    out = run(spark, login_frame(source), tmp_path)
    last = F.max_by(
        F.struct("failed_attempts", "locked_until", "last_login_at", "last_login_ip"),
        F.struct("event_timestamp", "log_id"),
    )
    got = out.groupBy("auth_id").agg(last.alias("s")).select("auth_id", "s.*")
    log = s.rows(spark, "authentication_audit_log", records)
    want = login.login_state(log, s.T).select(
        F.col("auth_id").cast("bigint"), "failed_attempts", "locked_until", "last_login_at", "last_login_ip"
    )
    assert got.exceptAll(want).isEmpty() and got.count() == want.count() == 3
    locks = out.filter("failed_attempts >= 5").select("log_id")
    assert locks.exceptAll(login.lockout_events(log).select("log_id")).isEmpty()


def login_frame(source):
    return stateful.login_state_stream(source)


def detection(spark, folder, parts, seed, records):
    write_parts(spark, "transactions", records, "transaction_timestamp", parts, f"{folder}/in")
    store = detect.DetectionStore(spark, f"{folder}/store", full_every=2)
    query = detect.start_detection(
        stream(spark, "transactions", f"{folder}/in"), store, seed["merchants"], seed["alerts"],
        f"{folder}/checkpoint",
    )
    assert query.awaitTermination(600) and query.exception() is None
    return store


def test_detection_stream(spark, tmp_path, seed):
    records = random_payments(60)
    store = detection(spark, tmp_path, 3, seed, records)
    judged = store.read_all("transactions")
    whole = geo.judge_velocity_declining(s.payments(spark, *records))
    assert judged.count() == 60
    flagged = judged.filter("geo_violation").select("transaction_id")
    want = whole.filter("violation").select("transaction_id")
    assert flagged.exceptAll(want).isEmpty() and want.exceptAll(flagged).isEmpty()
    assert judged.filter("geo_violation AND transaction_status <> 'declined'").isEmpty()
    alerts = store.snapshot(2, seed["alerts"])
    assert alerts.groupBy("user_id", "alert_type").count().filter("count > 1").isEmpty()
    assert alerts.select("alert_id").distinct().count() == alerts.count()
    # Every payment is judged by every rule that looks at it.
    audit = store.read_all("audit").groupBy("changed_by").count().collect()
    assert {r.changed_by: r["count"] for r in audit} == {"geo": 60, "structuring": 60, "merchant": 60}
    # A replay of the last batch leaves the same tables.
    before = [tuple(r) for r in alerts.orderBy("alert_id").collect()]
    last = sorted(records, key=lambda r: (r["transaction_timestamp"], r["transaction_id"]))[40:]
    detect.run_batch(store, s.payments(spark, *last), 2, seed["merchants"], seed["alerts"])
    after = [tuple(r) for r in store.snapshot(2, seed["alerts"]).orderBy("alert_id").collect()]
    assert before == after and store.read_all("transactions").count() == 60


def test_detection_rejects_a_batch(spark, tmp_path, seed):
    store = detect.DetectionStore(spark, str(tmp_path))
    batch = s.payments(spark, s.payment(1, 1, 1, 1, 80, 0, s.DALLAS), s.payment(2, 3, 4, 3, 9999, 0, s.DALLAS))
    detect.run_batch(store, batch, 0, seed["merchants"], seed["alerts"])
    assert store.read_all("transactions", batch.schema).isEmpty()
    assert store.read("rejected", 0).count() == 2
    # The next batch finds no history and no accepted points.
    clean = s.payments(spark, s.payment(3, 1, 1, 1, 80, 0, s.DALLAS))
    detect.run_batch(store, clean, 1, seed["merchants"], seed["alerts"])
    assert store.read("transactions", 1).count() == 1
    (alert,) = store.read("alerts", 0).collect()
    assert (alert.alert_type, alert.user_id, alert.alert_id) == ("blacklisted_merchant", 3, 1)
    assert [r.new_status for r in store.read("audit", 0).collect()] == ["blocked"]


def test_structuring_reaches_back_into_history(spark, tmp_path, seed):
    store = detect.DetectionStore(spark, str(tmp_path))
    for no, (amount, minutes) in enumerate([(6000, 0), (6000, 60), (100, 60 * 60)]):
        batch = s.payments(spark, s.payment(no + 1, 1, 1, 1, amount, minutes, s.DALLAS, mcc="5942"))
        detect.run_batch(store, batch, no, seed["merchants"], seed["alerts"])
    rows = {r.transaction_id: r for r in store.read_all("transactions").collect()}
    assert [rows[i].violation for i in (1, 2, 3)] == [False, True, False]
    assert rows[3].txn_count == 1
    (alert,) = store.snapshot(2, seed["alerts"]).collect()
    assert (alert.transaction_id, alert.alert_type) == (2, "structuring_aml")


EVENTS = "/root/testdata/sf0.001"
TOO_LATE = "CAST(least(floor((dayofmonth(ts) - 1) / 6) + CASE WHEN event_id % 7 = 3 THEN 1 ELSE 0 END, 4) AS int)"


def micro_batches(place):
    """Rows (part, ts, event_id) of each file, in the order the files are read."""
    found = sorted(place.glob("**/*.parquet"), key=lambda f: f.stat().st_mtime)
    assert len({f.stat().st_mtime for f in found}) == len(found)
    part = [int(next(x for x in f.parts if x.startswith("__part="))[7:]) for f in found]
    tables = [pq.read_table(f, partitioning=None).to_pydict() for f in found]
    return [[(n, *x) for x in zip(t["ts"], t["event_id"])] for n, t in zip(part, tables)]


def test_arriving_files_are_bounded_and_in_order(spark, tmp_path):
    def judged(rows):
        place = tmp_path / f"in{rows}"
        source = adapters.arriving(spark, EVENTS, "transactions", str(place), TOO_LATE, 5, rows_per_file=rows)
        frame = stateful.geo_velocity_stream(source, look_back_hours=24 * 40)
        got = run(spark, frame, tmp_path / f"run{rows}").select("transaction_id", "prev_transaction_id", "violation", "late")
        return micro_batches(place), sorted(map(tuple, got.collect()), key=str)

    few, want = judged(500_000)
    many, got = judged(120)
    assert len(few) == 5 and max(map(len, many)) <= 120 and len(many) > 5
    assert sorted(x for f in many for x in f) == [x for f in many for x in f] == [x for f in few for x in sorted(f)]
    assert got == want


def test_whole_parts_in_several_files(spark, tmp_path):
    source = adapters.arriving(
        spark, EVENTS, "transactions", str(tmp_path / "in"), TOO_LATE, 5, rows_per_file=50, whole_parts=True
    )
    files = micro_batches(tmp_path / "in")
    each = len(files) // 5
    assert each > 1 and [f[0][0] for f in files] == [part for part in range(5) for _ in range(each)]
    sizes = []
    query = source.writeStream.foreachBatch(lambda df, _: sizes.append(df.count()))
    query.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    payments = adapters.tables(spark, EVENTS)["transactions"].count()
    assert len(sizes) == 5 and sum(sizes) == payments
