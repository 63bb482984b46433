"""Structuring and merchant rules, alert upsert."""

from datetime import timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

import seed as s
from cardwarden.functions import expr
from cardwarden.operators import alerts, merchant, structuring


def by_id(df, key="transaction_id"):
    return {r[key]: r for r in df.collect()}


BATCH = [s.payment(20 + i, 6, 2, 6, a, 0) for i, a in enumerate([9800, 9500, 9100, 8700])]


def on_insert(spark, history, batch):
    return structuring.structuring_on_insert(
        s.payments(spark, *history) if history else s.payments(spark, s.payment(0, 9, 9, 9, 1, -9999)),
        s.payments(spark, *batch), s.T,
    )


def test_one_small_payment_is_safe(spark):
    judged = on_insert(spark, [], [s.payment(1, 3, 2, 3, 800, 0)])
    row = judged.first()
    assert (row.violation, row.txn_count, row.aggregate_total) == (False, 1, D("800.00"))


def test_batch_is_judged_after_it_landed(spark, seed):
    judged = on_insert(spark, [], BATCH)
    rows = by_id(judged)
    assert {r.aggregate_total for r in rows.values()} == {D("37100.00")}
    assert all(r.violation and r.txn_count == 4 and r.severity == "CRITICAL" for r in rows.values())
    hits = structuring.structuring_hits(judged)
    done = alerts.upsert_open_alerts(seed["alerts"], hits, alerts.STRUCTURING, s.T)
    (alert,) = done.snapshot().collect()
    assert (alert.transaction_id, alert.user_id, alert.risk_score, alert.hits) == (20, 6, D("1.00"), 4)
    audit = by_id(structuring.structuring_audit(judged, seed["alerts"], s.T))
    assert len(audit) == 4
    assert audit[20].change_reason.startswith("New alert raised")
    assert audit[21].change_reason.startswith("Existing alert updated")
    # A later batch refreshes the alert instead of opening one.
    more = on_insert(spark, BATCH, [s.payment(30, 6, 2, 6, 7500, 0)])
    again = alerts.upsert_open_alerts(
        done.snapshot().drop("hits"), structuring.structuring_hits(more), alerts.STRUCTURING, s.T
    ).snapshot().collect()
    assert [(a.transaction_id, a.hits) for a in again] == [(20, 1)]
    audit = structuring.structuring_audit(more, done.snapshot(), s.T).collect()
    assert audit[0].change_reason.startswith("Existing alert updated: $44600.00 in 5")


def test_window_and_limit_edges(spark):
    edge = [
        s.payment(1, 1, 2, 1, "9999.99", -48 * 60), s.payment(2, 1, 2, 1, "0.01", 0),
        s.payment(3, 2, 2, 2, "9999.99", -48 * 60, seconds=-1), s.payment(4, 2, 2, 2, "0.01", 0),
        s.payment(5, 3, 2, 3, "10000.00", 0), s.payment(6, 3, 2, 3, "9000", 0),
        s.payment(7, 4, 2, 4, "6000", 0, status="pending"), s.payment(8, 4, 2, 4, "9000", 0),
    ]
    users = s.rows(spark, "users", [{"user_id": u, "first_name": "A", "last_name": str(u)} for u in range(1, 5)])
    report = structuring.structuring_report(s.payments(spark, *edge), users, s.T).collect()
    assert [(r.user_id, r.aggregate_total, r.calculated_risk_score, r.severity_level) for r in report] == [
        (1, D("10000.00"), D("0.72"), "LOW")
    ]
    assert report[0].span_minutes == 2880 and report[0].amount_over_threshold == D("0.00")
    judged = by_id(structuring.structuring_on_insert(
        s.payments(spark, *edge[:1]), s.payments(spark, *edge[1:]), s.T
    ))
    # Every arriving row is judged, also one that does not count itself.
    assert len(judged) == 7 and judged[2].violation and not judged[5].violation
    one = structuring.structuring_report(s.payments(spark, *edge), users, s.T, user_id=2)
    assert one.isEmpty()


def test_trailing_form_ends_at_each_payment(spark):
    rows = [s.payment(i, 1, 2, 1, 4000, 600 * i) for i in range(6)]
    judged = by_id(structuring.structuring_trailing(s.payments(spark, *rows)))
    assert [judged[i].txn_count for i in range(6)] == [1, 2, 3, 4, 5, 5]
    assert [judged[i].violation for i in range(6)] == [False, False, True, True, True, True]


def test_band_on_seed_rows(seed):
    rows = structuring.structuring_band(seed["transactions"], seed["users"]).collect()
    assert sorted((r.transaction_id, r.txn_count_in_window) for r in rows) == [(9, 3), (10, 4), (11, 5)]
    assert {r.flag for r in rows} == {expr.FLAG_STRUCTURING}
    (recent,) = structuring.structuring_band_recent(seed["transactions"], seed["users"], s.T).collect()
    assert (recent.user_id, recent.txn_count, recent.total_amount) == (6, 5, D("14800.00"))


def test_report_consumers(seed):
    report, raised, summary = structuring.detect_structuring(
        seed["transactions"], seed["users"], seed["alerts"], s.T
    )
    (row,) = report.collect()
    assert (row.user_id, row.txn_count_in_window, row.severity_level) == (6, 5, "MEDIUM")
    (alert,) = raised.collect()
    assert (alert.transaction_id, alert.card_id, alert.alert_status) == (None, 6, "open")
    (total,) = summary.collect()
    assert (total.total_suspects_detected, total.new_alerts_raised) == (1, 1)
    assert total.analysis_window_end - total.analysis_window_start == timedelta(hours=48)
    _, none, summary = structuring.detect_structuring(
        seed["transactions"], seed["users"], seed["alerts"], s.T, raise_alerts=False
    )
    assert none.isEmpty() and summary.first().new_alerts_raised == 0


def test_clean_merchant_is_clear(spark, seed):
    judged = merchant.flag_high_risk_mcc(s.payments(spark, s.payment(1, 1, 1, 1, 120, 0, mcc="5942")), seed["merchants"])
    row = judged.first()
    assert (row.flagged, row.risk_flag) == (False, expr.RISK_CLEAR)
    assert merchant.mcc_audit(judged, s.T).first().change_reason.startswith("Clear: CLEAR, category 5942, $120.00 at ")


MIXED = [s.payment(1, 1, 1, 1, 80, 0, mcc="5942"), s.payment(2, 3, 4, 3, 9999, 0, mcc="5999")]


def test_a_blacklisted_row_rejects_its_whole_batch(spark, seed):
    batch = s.payments(spark, *MIXED)
    accepted, rejected = merchant.block_batch(batch, seed["merchants"], batch_id=None)
    assert accepted.isEmpty() and rejected.count() == 2
    (alert,) = merchant.blocked_alerts(rejected, seed["merchants"], s.T).collect()
    assert (alert.transaction_id, alert.user_id, alert.risk_score) == (None, 3, D("0.95"))
    (entry,) = merchant.blocked_audit(rejected, seed["merchants"], s.T).collect()
    assert (entry.transaction_id, entry.new_status) == (None, "blocked")
    clean = s.payments(spark, MIXED[0])
    assert merchant.block_batch(clean, seed["merchants"], batch_id=None)[0].count() == 1


def test_batches_and_rows_are_rejected_apart(spark, seed):
    rows = s.payments(spark, *MIXED, s.payment(3, 1, 1, 1, 5, 0), s.payment(4, 1, 99, 1, 5, 0)).withColumn(
        "batch_id", F.when(F.col("transaction_id") < 3, 1).otherwise(2)
    )
    accepted, rejected = merchant.block_batch(rows, seed["merchants"])
    assert set(by_id(accepted)) == {3, 4} and set(by_id(rejected)) == {1, 2}
    accepted, rejected = merchant.block_batch(rows, seed["merchants"], mode="row")
    assert set(by_id(accepted)) == {1, 3, 4} and set(by_id(rejected)) == {2}
    with pytest.raises(ValueError):
        merchant.gate(rows, seed["merchants"], mode="all")


def test_updates_pass_the_same_gate(spark, seed):
    txns = seed["transactions"]
    moved = txns.filter("transaction_id = 1").withColumn("merchant_id", F.lit(4))
    after, rejected = merchant.block_updates(moved, txns, seed["merchants"])
    assert by_id(after)[1].merchant_id == 1 and rejected.count() == 1
    moved = txns.filter("transaction_id = 1").withColumn("merchant_id", F.lit(2))
    after, rejected = merchant.block_updates(moved, txns, seed["merchants"])
    assert by_id(after)[1].merchant_id == 2 and rejected.isEmpty()
    assert after.count() == txns.count()


def test_flagged_categories_open_then_refresh(spark, seed):
    rows = [
        s.payment(1, 5, 3, 5, 9500, 0, mcc="6051"), s.payment(2, 5, 5, 5, 4500, 1, mcc="7995"),
        s.payment(3, 5, 5, 5, 10, 2, mcc="7995", status="reversed"), s.payment(4, 5, 99, 5, 10, 3, mcc="6051"),
    ]
    judged = merchant.flag_high_risk_mcc(s.payments(spark, *rows), seed["merchants"])
    assert set(by_id(judged)) == {1, 2, 4}
    # An unknown merchant leaves the score empty.
    assert by_id(judged)[4].risk_score is None
    hits = merchant.mcc_hits(judged.filter("transaction_id < 4"))
    (alert,) = alerts.upsert_open_alerts(seed["alerts"], hits, alerts.HIGH_RISK_MCC, s.T).snapshot().collect()
    assert (alert.transaction_id, alert.risk_score, alert.hits) == (1, D("0.90"), 2)
    assert alert.alert_message.startswith("Payment 1 ")


def test_screen_uses_the_merchant_category(seed):
    rows = by_id(merchant.merchant_screen(seed["transactions"], seed["users"], seed["merchants"]))
    assert set(rows) == {6, 7, 8, 9, 10, 11}
    assert rows[6].risk_flag == expr.FLAG_BLACKLISTED and rows[7].risk_flag == expr.FLAG_MCC


def test_profile_counts_a_payment_once_per_alert(spark, seed):
    raised = s.rows(spark, "alerts", [
        {"alert_id": i, "transaction_id": 6, "card_id": 5, "user_id": 5, "alert_type": "other",
         "alert_status": "open"} for i in (1, 2)
    ])
    def profile(**options):
        return by_id(merchant.merchant_risk_profile(seed["merchants"], seed["transactions"], raised, **options), "merchant_id")

    whole = profile()
    assert len(whole) == 8
    assert (whole[4].total_transactions, whole[4].total_volume, whole[4].alerts_raised) == (2, D("9600.00"), 2)
    assert (whole[5].total_transactions, whole[5].total_volume, whole[5].avg_transaction) == (0, 0, 0)
    once = profile(fanout_safe=True, merchant_id=4)
    assert list(once) == [4]
    assert (once[4].total_transactions, once[4].total_volume, once[4].alerts_raised) == (1, D("4800.00"), 2)


def hits_frame(spark, rows):
    return spark.createDataFrame(
        rows,
        "transaction_id bigint, card_id int, user_id int, alert_type string, risk_score decimal(14,2), "
        "alert_message string, note string",
    )


def test_policies_refresh_their_own_columns(spark):
    stored = s.rows(spark, "alerts", [
        {"alert_id": 1, "transaction_id": 7, "card_id": 1, "user_id": 1, "alert_type": "a",
         "risk_score": D("0.10"), "alert_message": "old", "alert_status": "open"},
        {"alert_id": 2, "transaction_id": 8, "card_id": 1, "user_id": 1, "alert_type": "a",
         "risk_score": D("0.10"), "alert_message": "old", "alert_status": "acknowledged"},
        {"alert_id": 3, "transaction_id": 9, "card_id": 1, "user_id": 1, "alert_type": "b",
         "risk_score": D("0.10"), "alert_message": "old", "alert_status": "open"},
    ])
    hits = hits_frame(spark, [
        (20, 5, 1, "a", D("0.90"), "first", "n1"), (21, 6, 1, "a", D("0.50"), "last", "n2"),
        (22, 5, 1, "b", D("0.70"), "b", "n3"), (23, 5, 2, "a", D("0.60"), "x", "n4"),
        (24, 6, 2, "a", D("0.40"), "y", "n5"),
    ])
    policies = {"a": alerts.GEO_DECLINING, "b": alerts.STRUCTURING}
    done = alerts.upsert_open_alerts(stored, hits, policies, s.T)
    kept = by_id(done.kept, "alert_id")
    # The last hit counts, not the highest; the card stays.
    assert (kept[1].transaction_id, kept[1].risk_score, kept[1].alert_message, kept[1].card_id) == (21, D("0.50"), "last", 1)
    assert (kept[2].transaction_id, kept[2].alert_message, kept[2].hits) == (8, "old", None)
    assert (kept[3].transaction_id, kept[3].risk_score, kept[3].alert_message) == (9, D("0.70"), "old")
    (new,) = done.opened.collect()
    assert (new.user_id, new.transaction_id, new.card_id, new.risk_score, new.alert_message) == (2, 24, 5, D("0.40"), "y")
    evidence = alerts.upsert_open_alerts(stored, hits, alerts.GEO_EVIDENCE, s.T)
    assert by_id(evidence.kept, "alert_id")[1].transaction_id == 7
    assert evidence.opened.first().transaction_id == 23
    again = alerts.upsert_open_alerts(done.snapshot().drop("hits"), hits, policies, s.T)
    assert again.opened.isEmpty()
    values = [c for c in stored.columns]
    assert again.kept.select(values).exceptAll(done.snapshot().select(values)).isEmpty()


def test_notes_are_rows_and_can_be_joined(spark):
    hits = hits_frame(spark, [(i, 1, 1, "a", D("0.50"), "m", f"note {i}") for i in (3, 1, 2)])
    notes = alerts.note_rows(hits, s.T)
    chosen = spark.createDataFrame([(1, "a"), (2, "a")], "user_id int, alert_type string")
    texts = {r.user_id: r for r in alerts.render_notes(chosen, notes).collect()}
    assert (texts[1].part, texts[2].part) == (0, 0)
    assert texts[1].investigation_notes.split("\r\n")[1::2] == ["note 1", "note 2", "note 3"]
    assert texts[2].investigation_notes == ""
    parts = alerts.render_notes(chosen, notes, ids_per_part=2).filter("user_id = 1").orderBy("part").collect()
    assert [p.part for p in parts] == [0, 1]
    assert "\r\n".join(p.investigation_notes for p in parts) == texts[1].investigation_notes
