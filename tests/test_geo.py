import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

import seed as s
from cardwarden.functions import expr
from cardwarden.operators import alerts, changes, geo, slices
from cardwarden.operators.slices import SlicePolicy
from cardwarden.operators.travel_fold import Track


def verdicts(judged):
    return {r.transaction_id: r for r in judged.collect()}


TRIPS = [
    s.payment(1, 1, 1, 1, 85, 0, s.SHREVEPORT),
    s.payment(2, 1, 3, 1, 4200, 0, s.MOSCOW, seconds=20),
    s.payment(3, 3, 8, 3, 15, 0, s.DALLAS),
    s.payment(4, 3, 2, 3, 1800, 0, s.TOKYO, seconds=30),
    s.payment(5, 1, 2, 1, 3300, 0, s.SYDNEY, seconds=40),
    s.payment(6, 5, 2, 5, 250, 0, s.HOUSTON),
]


def test_declining_cases(spark):
    judged = verdicts(geo.judge_velocity_declining(s.payments(spark, *TRIPS)))
    assert {i for i, r in judged.items() if r.violation} == {2, 4, 5}
    assert (judged[2].severity, judged[2].risk_score) == ("CRITICAL", D("1.00"))
    # The declined Moscow row is skipped: Sydney is compared with Shreveport.
    assert judged[5].prev_transaction_id == 1
    assert judged[1].prev_transaction_id is None and judged[1].severity == "NONE"
    assert judged[6].prev_transaction_id is None


def test_velocity_keeps_violating_rows_as_reference(spark):
    judged = verdicts(geo.judge_velocity(s.payments(spark, *TRIPS)))
    assert {i for i, r in judged.items() if r.violation} == {2, 4, 5}
    assert judged[5].prev_transaction_id == 2


def test_return_trip_differs_between_the_forms(spark):
    rows = s.payments(
        spark,
        s.payment(1, 1, 1, 1, 10, 0, s.SHREVEPORT),
        s.payment(2, 1, 1, 1, 10, 10, s.MOSCOW),
        s.payment(3, 1, 1, 1, 10, 20, s.SHREVEPORT),
    )
    assert {r.transaction_id for r in geo.geo_velocity(rows).collect()} == {2, 3}
    assert {r.transaction_id for r in geo.geo_velocity_declining(rows).collect()} == {2}


def test_rows_without_coordinates_and_ignored_status(spark):
    rows = s.payments(
        spark,
        s.payment(1, 1, 1, 1, 10, 0, s.SHREVEPORT, status="reversed"),
        s.payment(2, 1, 1, 1, 10, 5),
        s.payment(3, 1, 1, 1, 10, 10, s.MOSCOW, status="declined"),
        s.payment(4, 1, 1, 1, 10, 20, s.MOSCOW),
    )
    kept = verdicts(geo.judge_velocity(rows))
    assert set(kept) == {1, 3, 4}
    assert kept[3].prev_transaction_id is None and kept[4].prev_transaction_id == 3
    declining = verdicts(geo.judge_velocity_declining(rows))
    assert declining[4].prev_transaction_id is None


def test_speed_limit_is_exclusive(spark):
    # 900 km/h exactly is allowed: set the limit to the measured speed.
    rows = s.payments(
        spark, s.payment(1, 1, 1, 1, 10, 0, s.HOUSTON), s.payment(2, 1, 1, 1, 10, 60, s.DALLAS)
    )
    speed = verdicts(geo.judge_velocity(rows))[2].required_speed_kmh
    for limit, hit in ((speed, False), (speed - D("0.0100"), True)):
        limit = limit.quantize(D("0.01"), rounding="ROUND_UP") if not hit else limit.quantize(D("0.01"))
        assert verdicts(geo.judge_velocity(rows, float(limit)))[2].violation is hit
        assert verdicts(geo.judge_velocity_declining(rows, float(limit)))[2].violation is hit


def test_planar_pairs_on_seed_rows(seed):
    pairs = geo.geo_planar_pairs(seed["transactions"], seed["users"]).collect()
    assert [(p.transaction_id, p.user_name, p.minutes_apart, p.flag) for p in pairs] == [
        (6, "Michael Brown", 2, expr.FLAG_TRAVEL)
    ]
    assert (pairs[0].location_before, pairs[0].location_after) == ("US", "RU")


PLACES = [s.SHREVEPORT, s.NEW_YORK, s.DALLAS, s.HOUSTON, s.MOSCOW, s.TOKYO]


def random_payments(seed, n=240):
    """A third of the rows belong to user 1; several rows share a second."""
    rng = random.Random(seed)
    return [
        s.payment(
            i, 1, 1, 1 if i % 3 == 0 else rng.randrange(2, 7), 10, rng.randrange(0, 9000),
            rng.choice(PLACES[:4] * 3 + PLACES), seconds=rng.choice([0, 0, 30]),
            status=rng.choice(["completed"] * 5 + ["declined", "reversed"]),
        )
        for i in range(n)
    ]


def folded_plainly(rows, max_kmh=900):
    """The rule row by row, without the package's fold."""
    import math

    def speed(a, b):
        la, lb = (math.radians(float(r["latitude"])) for r in (a, b))
        dl = math.radians(float(b["longitude"]) - float(a["longitude"]))
        cos = math.sin(la) * math.sin(lb) + math.cos(la) * math.cos(lb) * math.cos(dl)
        km = 6371 * math.acos(max(-1.0, min(1.0, cos)))
        gap = (b["transaction_timestamp"] - a["transaction_timestamp"]).total_seconds()
        return km / (round(max(1, gap) / 3600, 6))

    accepted, out = {}, {}
    ordered = sorted(rows, key=lambda r: (r["transaction_timestamp"], r["transaction_id"]))
    for row in ordered:
        points = accepted.setdefault(row["user_id"], [])
        before = [p for p in points if p["transaction_timestamp"] < row["transaction_timestamp"]]
        previous = before[-1] if before else None
        bad = previous is not None and speed(previous, row) > max_kmh
        out[row["transaction_id"]] = (previous and previous["transaction_id"], bad)
        if not bad and row["transaction_status"] == "completed":
            points.append(row)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("policy", [SlicePolicy(), SlicePolicy(12, 3)])
def test_declining_fold_against_plain_rule(spark, seed, policy):
    rows = random_payments(seed)
    judged = geo.judge_velocity_declining(s.payments(spark, *rows), policy=policy)
    got = {r.transaction_id: (r.prev_transaction_id, r.violation) for r in judged.collect()}
    assert got == folded_plainly(rows)
    assert any(bad for _, bad in got.values())


def test_wrong_guesses_are_folded_again(spark):
    """Every slice begins far from its true entry point."""
    rows = [s.payment(0, 1, 1, 1, 10, 0, s.SHREVEPORT)]
    rows += [
        s.payment(i, 1, 1, 1, 10, i, s.MOSCOW if i % 2 else s.SYDNEY) for i in range(1, 40)
    ]
    judged = geo.judge_velocity_declining(s.payments(spark, *rows), policy=SlicePolicy(5, 4))
    got = {r.transaction_id: (r.prev_transaction_id, r.violation) for r in judged.collect()}
    assert got == folded_plainly(rows)
    assert all(previous == 0 and bad for i, (previous, bad) in got.items() if i)


@pytest.mark.parametrize("policy", [SlicePolicy(), SlicePolicy(12, 3)])
def test_history_then_batch_equals_one_run(spark, policy):
    rows = sorted(random_payments(4), key=lambda r: (r["transaction_timestamp"], r["transaction_id"]))
    cut = rows[120]["transaction_timestamp"]
    first = [r for r in rows if r["transaction_timestamp"] < cut]
    second = [r for r in rows if r["transaction_timestamp"] >= cut]
    before = geo.judge_velocity_declining(s.payments(spark, *first))
    points = geo.last_accepted_points(before)
    after = geo.judge_velocity_declining(
        s.payments(spark, *second), last_accepted=points, policy=policy
    )
    want = folded_plainly(rows)
    got = {r.transaction_id: (r.prev_transaction_id, r.violation) for r in after.collect()}
    assert got == {r["transaction_id"]: want[r["transaction_id"]] for r in second}


def test_late_rows_are_marked(spark):
    points = geo.last_accepted_points(
        geo.judge_velocity_declining(s.payments(spark, s.payment(1, 1, 1, 1, 10, 60, s.MOSCOW)))
    )
    late = geo.judge_velocity_declining(
        s.payments(spark, s.payment(2, 1, 1, 1, 10, 50, s.TOKYO), s.payment(3, 1, 1, 1, 10, 70, s.MOSCOW)),
        last_accepted=points,
    )
    got = verdicts(late)
    assert got[2].late and not got[2].violation and got[2].prev_transaction_id is None
    assert not got[3].late and got[3].prev_transaction_id == 1


def test_track_keeps_strict_order():
    track = Track()
    a, b, c = (10_000_000, 1, 0.0, 0.0), (10_000_000, 2, 0.0, 90.0), (90_000_000_000_000, 3, 0.0, 90.0)
    assert track.step(a, True, 9_000_000) == (None, False, False)
    assert track.step(b, True, 9_000_000) == (None, False, False)
    # The larger id of the latest time is the reference.
    assert track.step(c, True, 9_000_000) == (b, False, False)


def test_alerts_audit_and_declines(spark, seed):
    txns = s.payments(spark, *TRIPS)
    judged = geo.judge_velocity_declining(txns)
    hits = geo.geo_hits(judged.filter("violation"))
    opened = alerts.upsert_open_alerts(seed["alerts"], hits, alerts.GEO_DECLINING, s.T).snapshot()
    got = {r.user_id: r for r in opened.collect()}
    assert set(got) == {1, 3}
    assert (got[1].transaction_id, got[1].hits, got[3].hits) == (5, 2, 1)
    audit = {r.transaction_id: r for r in geo.geo_audit(judged, s.T).collect()}
    assert len(audit) == 6
    assert (audit[2].previous_status, audit[2].new_status) == ("completed", "declined")
    assert (audit[1].previous_status, audit[1].new_status) == (None, "completed")
    assert audit[1].change_reason == "No violation: no prior point"
    assert "9171.1882 km" in audit[2].change_reason
    declined = judged.filter("violation").select(
        "transaction_id", F.lit("declined").alias("transaction_status")
    )
    after = changes.update_from(txns, declined, "transaction_id", ["transaction_status"])
    status = {r.transaction_id: r.transaction_status for r in after.collect()}
    assert {i for i, v in status.items() if v == "declined"} == {2, 4, 5}


def test_evidence_rows(spark):
    txns = s.payments(spark, *TRIPS)
    rows = geo.evidence_rows(geo.geo_velocity(txns), txns).collect()
    assert {r.original_transaction_id for r in rows} == {2, 4, 5}
    assert {r.transaction_status for r in rows} == {"reversed"}
    assert "transaction_id" not in rows[0]


def test_audit_can_show_actual_status(spark):
    rows = [
        s.payment(1, 1, 1, 1, 10, 0, s.SHREVEPORT),
        s.payment(2, 1, 1, 1, 10, 1, s.MOSCOW, status="pending"),
    ]
    judged = geo.judge_velocity(s.payments(spark, *rows))
    audit = {r.transaction_id: r for r in geo.geo_audit(judged, s.T, actual_status=True).collect()}
    assert audit[2].previous_status == "pending"


def test_slices_bound_the_rows_of_a_task(spark):
    rows = s.payments(spark, *[s.payment(i, 1, 1, 1, 10, i, s.DALLAS) for i in range(400)])
    timed = rows.withColumn("_at", expr.micros("transaction_timestamp"))
    policy = SlicePolicy(100, 4)
    marked = slices.mark_slices(timed, slices.hot_keys(timed, ["user_id"], "_at", policy), ["user_id"], "_at")
    sizes = [r["count"] for r in marked.groupBy(slices.SLICE).count().collect()]
    assert len(sizes) == 16 and max(sizes) <= 26
    order = marked.orderBy("_at").select(slices.SLICE).collect()
    assert [r[0] for r in order] == sorted(r[0] for r in order)
