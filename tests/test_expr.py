import math
from datetime import datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from cardwarden.functions import expr, register_sql_functions


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def dec(text, kind="decimal(15,2)"):
    return F.lit(text).cast(kind)


@pytest.mark.parametrize(
    "ratio, risk, severity",
    [
        ("1.00", "0.70", "LOW"), ("1.01", "0.70", "LOW"), ("1.03", "0.71", "LOW"), ("1.49", "0.80", "LOW"),
        ("1.50", "0.87", "MEDIUM"), ("1.99", "0.87", "MEDIUM"), ("2.00", "0.93", "HIGH"),
        ("2.99", "0.93", "HIGH"), ("3.00", "0.97", "HIGH"), ("4.99", "0.97", "HIGH"),
        ("5.00", "1.00", "CRITICAL"), ("80000.00", "1.00", "CRITICAL"),
    ],
)
def test_travel_scores(spark, ratio, risk, severity):
    r = dec(ratio, "decimal(10,2)")
    assert value(spark, expr.travel_risk(r)) == D(risk)
    assert value(spark, expr.travel_severity(r)) == severity


@pytest.mark.parametrize(
    "total, n, score, severity",
    [
        ("10000.00", 2, "0.72", "LOW"), ("10999.99", 3, "0.74", "LOW"), ("11000.00", 3, "0.74", "MEDIUM"),
        ("14999.99", 4, "0.79", "MEDIUM"), ("15000.00", 4, "0.79", "HIGH"), ("19999.99", 5, "0.85", "HIGH"),
        ("20000.00", 5, "1.00", "CRITICAL"), ("37100.00", 4, "1.00", "CRITICAL"),
        ("10000.00", 120, "1.90", "LOW"), ("19000.00", 20000, "200.79", "HIGH"),
    ],
)
def test_structuring_scores(spark, total, n, score, severity):
    assert value(spark, expr.structuring_risk_score(dec(total), 10000, F.lit(n))) == D(score)
    assert value(spark, expr.structuring_severity(dec(total), 10000)) == severity


def test_structuring_score_can_be_clamped_and_stored(spark):
    clamped = expr.structuring_risk_score(dec("10000"), 10000, F.lit(120), clamp=True)
    assert value(spark, clamped) == D("1.00")
    large = expr.structuring_risk_score(dec("19000"), 10000, F.lit(20000))
    assert value(spark, expr.alert_score(large)) == D("200.79")
    # Totals far above a single payment's type.
    assert value(spark, expr.structuring_risk_score(dec("20000000000000.00", "decimal(25,2)"), 10000, F.lit(2))) == D("1.00")
    assert value(spark, expr.structuring_severity(dec("20000000000000.00", "decimal(25,2)"), 10000)) == "CRITICAL"
    assert value(spark, expr.structuring_risk_score(dec("5"), 0, F.lit(2))) == D("1.00")


@pytest.mark.parametrize(
    "black, mcc, risk, flag",
    [
        (True, "5942", "0.10", expr.RISK_BLOCKED), (False, "6051", "0.10", expr.RISK_FLAGGED),
        (False, "5942", "0.75", expr.RISK_WATCH), (False, "5942", "0.74", expr.RISK_MONITOR),
        (False, "5942", "0.50", expr.RISK_MONITOR), (False, "5942", "0.49", expr.RISK_CLEAR),
        (False, None, None, expr.RISK_CLEAR),
    ],
)
def test_merchant_flag(spark, black, mcc, risk, flag):
    column = expr.merchant_risk_flag(F.lit(black), F.lit(mcc).cast("string"), dec(risk, "decimal(3,2)"))
    assert value(spark, column) == flag


def test_high_risk_codes(spark):
    for code in expr.HIGH_RISK_MCC:
        assert value(spark, expr.is_high_risk_mcc(F.lit(code))) is True
    assert value(spark, expr.is_high_risk_mcc(F.lit("5942"))) is False
    assert value(spark, expr.is_high_risk_mcc(F.lit(None).cast("string"))) is False


def point(lat, lon):
    return F.lit(lat).cast("decimal(10,8)"), F.lit(lon).cast("decimal(11,8)")


def test_distances(spark):
    houston, moscow = point("29.7604", "-95.3698"), point("55.7558", "37.6173")
    # By the spherical law of cosines.
    la, lb, dl = math.radians(29.7604), math.radians(55.7558), math.radians(37.6173 + 95.3698)
    arc = math.acos(math.sin(la) * math.sin(lb) + math.cos(la) * math.cos(lb) * math.cos(dl))
    assert float(value(spark, expr.haversine_km(*houston, *moscow))) == pytest.approx(6371 * arc, abs=1e-4)
    assert value(spark, expr.haversine_km(*houston, *houston)) == D("0.0000")
    far = value(spark, expr.haversine_km(*point("0", "0"), *point("0", "180")))
    assert far == D("20015.0868")
    # One degree of longitude on the equator is 111 km on the flat map.
    assert value(spark, expr.planar_km(*point("0", "10"), *point("0", "11"))) == pytest.approx(111.0)
    assert value(spark, expr.planar_km(*point("0", "179"), *point("0", "-179"))) > 39000


def test_rounded_hours_of_short_gaps(spark):
    assert value(spark, expr.travel_hours(F.lit(1))) == D("0.000278")
    assert value(spark, expr.travel_hours(F.lit(0))) == D("0.000278")
    assert value(spark, expr.travel_minutes(F.lit(90))) == D("1.50")
    assert value(spark, expr.travel_speed(dec("1.0000", "decimal(12,4)"), F.lit(1))) == D("3597.1223")


def test_boundary_diff_counts_boundaries(spark):
    a, b = (F.lit(datetime(2026, 1, 1, 0, 0, 59)), F.lit(datetime(2026, 1, 1, 0, 1, 1)))
    assert value(spark, expr.boundary_diff("minute", a, b)) == 1
    assert value(spark, expr.boundary_diff("second", a, b)) == 2
    assert value(spark, expr.boundary_diff("minute", b, a)) == -1
    early = F.lit(datetime(1969, 12, 31, 23, 59, 59))
    assert value(spark, expr.boundary_diff("day", early, a)) == 20455


def test_text_functions(spark):
    assert value(spark, expr.full_name(F.lit("A"), F.lit("B"))) == "A B"
    assert value(spark, expr.full_name(F.lit("A"), F.lit(None).cast("string"))) is None
    assert value(spark, expr.coords_text(*point("32.5252", "-93.7502"))) == "32.52520000, -93.75020000"
    assert value(spark, expr.fmt_ts(F.lit(datetime(2026, 4, 1, 9, 5, 7)))) == "2026-04-01 09:05:07"
    assert value(spark, expr.lines("a", "b")) == "a\r\nb"


def health(spark, active=1, locked=None, change=0, failed=0, full=True):
    now = datetime(2026, 4, 1)
    lock = F.lit(locked).cast("timestamp")
    return value(
        spark,
        expr.account_health(F.lit(active), lock, F.lit(change), F.lit(failed), now, full),
    )


def test_account_health_order(spark):
    later, earlier = datetime(2026, 4, 2), datetime(2026, 4, 1)
    assert health(spark, active=0, locked=later) == expr.HEALTH_DEACTIVATED
    assert health(spark, locked=later, change=1) == expr.HEALTH_LOCKED
    assert health(spark, locked=earlier, change=1) == expr.HEALTH_MUST_CHANGE
    assert health(spark, change=1, full=False) == expr.HEALTH_ACTIVE
    assert [health(spark, failed=n) for n in (2, 3, 4, 5)] == [
        expr.HEALTH_ACTIVE, expr.HEALTH_AT_RISK, expr.HEALTH_AT_RISK, expr.HEALTH_ACTIVE,
    ]


def test_sql_functions_agree(spark):
    register_sql_functions(spark)
    row = spark.sql(
        """SELECT haversine_km(29.7604, -95.3698, 55.7558, 37.6173) AS km,
        planar_km(0, 10, 0, 11) AS flat, structuring_severity(15000, 10000) AS sev,
        structuring_risk_score(19999.99, 10000, 5) AS score, is_high_risk_mcc(NULL) AS none,
        merchant_risk_flag(false, '5942', 0.75) AS flag"""
    ).first()
    km = value(spark, expr.haversine_km(*point("29.7604", "-95.3698"), *point("55.7558", "37.6173")))
    assert row.km == km
    assert row.flat == pytest.approx(111.0)
    assert (row.sev, row.score, row.none, row.flag) == ("HIGH", D("0.85"), False, expr.RISK_WATCH)


def test_seeded_mod_is_repeatable(spark):
    a, b = (
        [r.v for r in spark.range(50).select(expr.seeded_mod("id", 72, 5).alias("v")).collect()]
        for _ in range(2)
    )
    assert a == b and all(0 <= v < 72 for v in a) and len(set(a)) > 20


def test_normalized_risk(spark):
    assert value(spark, expr.normalized_risk(dec("9.80", "decimal(4,2)"))) == D("0.98")
    assert value(spark, expr.normalized_risk(dec("0.98", "decimal(4,2)"))) == D("0.98")


def test_clock_and_group_expressions(spark):
    assert value(spark, expr.now_utc(datetime(2026, 4, 1))) == datetime(2026, 4, 1)
    assert value(spark, expr.now_utc()) is not None
    frame = spark.range(100).select((F.col("id") % 10).alias("k"), F.lit(None).cast("int").alias("none"))
    row = frame.agg(
        expr.distinct_count("k").alias("exact"), expr.distinct_count("k", approx=True).alias("about"),
        expr.sum0("none").alias("nothing"), expr.count_if(F.col("k") > 7).alias("high"),
    ).first()
    assert (row.exact, row.about, row.nothing, row.high) == (10, 10, 0, 20)
