"""Scalar functions as Column expressions; nothing here leaves the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Merchant category codes judged high risk by the flagging rule.
HIGH_RISK_MCC = ("6051", "7995", "4829", "6010", "6011", "5912", "7273", "5999")
# The shorter list used by the screening report.
SCREEN_MCC = ("6051", "7995", "4829", "6010", "6011")
# Order in which roles are listed.
ROLE_RANK = {"super_admin": 1, "compliance_officer": 2, "bank_employee": 3}
# Severity order of a customer's risk profile.
RISK_RANK = {"high": 1, "medium": 2, "low": 3}
# Fixed value: mean Earth radius in kilometres.
EARTH_RADIUS_KM = 6371.0
# Fixed value: kilometres per degree in the flat approximation.
KM_PER_DEGREE = 111.0

# Labels shown in reports.
FLAG_TRAVEL = "⚠ IMPOSSIBLE TRAVEL DETECTED"
FLAG_STRUCTURING = "⚠ STRUCTURING / AML PATTERN"
FLAG_BLACKLISTED = "🚫 BLACKLISTED MERCHANT"
FLAG_MCC = "⚠ HIGH-RISK MCC CATEGORY"
FLAG_SUSPICIOUS = "⚠ SUSPICIOUS"
RISK_BLOCKED = "BLOCKED: BLACKLISTED MERCHANT"
RISK_FLAGGED = "FLAGGED: HIGH-RISK MCC"
RISK_WATCH = "WATCH: HIGH RISK SCORE"
RISK_MONITOR = "MONITOR: MEDIUM RISK SCORE"
RISK_CLEAR = "CLEAR"
HEALTH_DEACTIVATED = "🔴 Deactivated"
HEALTH_LOCKED = "🔒 Locked"
HEALTH_MUST_CHANGE = "🔑 Must Change Password"
HEALTH_AT_RISK = "⚠ At Risk"
HEALTH_ACTIVE = "✅ Active"

_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def operand(value) -> Column:
    """A column stays a column; a plain number or text becomes a literal."""
    return value if isinstance(value, Column) else F.lit(value)


# --- text -----------------------------------------------------------------


def full_name(first: Column | str, last: Column | str) -> Column:
    """First and last name; unknown when either part is unknown."""
    return F.concat(col(first), F.lit(" "), col(last))


def coords_text(lat: Column | str, lon: Column | str) -> Column:
    return F.concat(col(lat).cast("string"), F.lit(", "), col(lon).cast("string"))


def flag(text: str) -> Column:
    return F.lit(text)


def label(cases: Sequence[tuple[Column, object]], default=None) -> Column:
    """First matching case wins."""
    (first, value), *rest = cases
    out = F.when(first, operand(value))
    for condition, result in rest:
        out = out.when(condition, operand(result))
    return out.otherwise(operand(default))


def map_case(column: Column | str, mapping: Mapping, default=None) -> Column:
    return label([(col(column) == key, value) for key, value in mapping.items()], default)


def fmt_ts(ts: Column | str) -> Column:
    return F.date_format(col(ts), "yyyy-MM-dd HH:mm:ss")


def lines(*parts) -> Column:
    """Parts joined by CR LF."""
    return F.concat_ws("\r\n", *[operand(p) for p in parts])


# --- time -----------------------------------------------------------------


def instant(value: datetime | date | str | Column | None) -> Column:
    """The given moment, or the time the query runs."""
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    return F.lit(value).cast("timestamp")


def now_utc(as_of=None) -> Column:
    return instant(as_of)


def micros(ts: Column | str) -> Column:
    """Microseconds since the epoch, for both timestamp kinds."""
    return F.unix_micros(col(ts).cast("timestamp"))


def shift(ts: Column | str, n: int | Column, unit: str) -> Column:
    """The moment moved by n seconds, minutes, hours or days."""
    seconds = operand(n) * F.lit(_SECONDS[unit])
    return col(ts) + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def boundary_diff(unit: str, start: Column | str, end: Column | str) -> Column:
    """Number of unit boundaries crossed from start to end."""

    def floored(ts):
        return F.unix_seconds(F.date_trunc(unit, col(ts).cast("timestamp")))

    return ((floored(end) - floored(start)) / F.lit(_SECONDS[unit])).cast("bigint")


# --- numbers --------------------------------------------------------------


def avg_round(column: Column | str, scale: int = 2) -> Column:
    return F.round(F.avg(col(column)), scale)


def sum0(column: Column | str) -> Column:
    return F.coalesce(F.sum(col(column)), F.lit(0))


def count_if(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("bigint")


def distinct_count(column: Column | str, approx: bool = False) -> Column:
    return F.approx_count_distinct(col(column)) if approx else F.count_distinct(col(column))


def seeded_mod(key: Column | str, n: int, seed: int = 0) -> Column:
    """A repeatable pseudo-random number in 0..n-1."""
    digest = F.md5(F.concat_ws(":", col(key).cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % n


# --- geography ------------------------------------------------------------


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance as decimal(12,4)."""
    phi1, lam1, phi2, lam2 = (F.radians(col(c).cast("double")) for c in (lat1, lon1, lat2, lon2))
    a = F.pow(F.sin((phi2 - phi1) / 2), 2) + F.cos(phi1) * F.cos(phi2) * F.pow(
        F.sin((lam2 - lam1) / 2), 2
    )
    rest = F.greatest(F.lit(0.0), 1 - a)
    return (2 * EARTH_RADIUS_KM * F.atan2(F.sqrt(a), F.sqrt(rest))).cast("decimal(12,4)")


def planar_km(lat1, lon1, lat2, lon2) -> Column:
    """Flat-map distance; does not wrap at the date line."""
    y1, x1, y2, x2 = (col(c).cast("double") for c in (lat1, lon1, lat2, lon2))
    dy = (y2 - y1) * KM_PER_DEGREE
    dx = (x2 - x1) * KM_PER_DEGREE * F.cos(F.radians((y1 + y2) / 2))
    return F.sqrt(F.pow(dy, 2) + F.pow(dx, 2))


def travel_hours(seconds: Column) -> Column:
    """Hours rounded to six digits; a gap below one second counts as one second."""
    gap = F.greatest(seconds, F.lit(1)).cast("decimal(18,6)")
    return (gap / F.lit(3600)).cast("decimal(18,6)")


def travel_minutes(seconds: Column) -> Column:
    gap = F.greatest(seconds, F.lit(1)).cast("decimal(18,6)")
    return (gap / F.lit(60)).cast("decimal(10,2)")


def travel_speed(km: Column, seconds: Column) -> Column:
    return (km / travel_hours(seconds)).cast("decimal(12,4)")


def travel_risk(ratio: Column | str) -> Column:
    """The steps of the score."""
    r = col(ratio)
    low = F.round(F.lit(0.70).cast("decimal(4,2)") + (r - 1) * F.lit(0.20).cast("decimal(4,2)"), 2)
    steps = [(r >= 5, "1.00"), (r >= 3, "0.97"), (r >= 2, "0.93"), (r >= 1.5, "0.87")]
    return label([(c, F.lit(v).cast("decimal(4,2)")) for c, v in steps], low.cast("decimal(4,2)"))


def travel_severity(ratio: Column | str) -> Column:
    """The steps of the severity."""
    r = col(ratio)
    return label([(r >= 5, "CRITICAL"), (r >= 2, "HIGH"), (r >= 1.5, "MEDIUM")], "LOW")


# --- structuring ----------------------------------------------------------


def _money(value) -> Column:
    """Wide enough for a total of all payments."""
    return operand(value).cast("decimal(25,2)")


def structuring_risk_score(total, threshold, n, clamp: bool = False) -> Column:
    """1.00 from twice the threshold on, else grows with count and excess.

    Fixed values: 0.70, a hundredth per payment, a tenth of the relative excess.
    The count term is unbounded, so the type is wide; clamp=True stops at 1.00.
    """
    total, threshold = _money(col(total)), _money(threshold)
    excess = ((total - threshold) / F.nullif(threshold, F.lit(0))).cast("decimal(38,16)") / 10
    share = operand(col(n)).cast("decimal(14,2)") / 100
    score = F.round(F.lit("0.70").cast("decimal(3,2)") + share + excess, 2).cast("decimal(14,2)")
    one = F.lit(1).cast("decimal(14,2)")
    if clamp:
        score = F.least(score, one)
    return F.when(total >= threshold * 2, one).otherwise(score)


def structuring_severity(total, threshold) -> Column:
    """The steps of the severity."""
    total, threshold = _money(col(total)), _money(threshold)
    return label(
        [
            (total >= threshold * F.lit("2.0").cast("decimal(2,1)"), "CRITICAL"),
            (total >= threshold * F.lit("1.5").cast("decimal(2,1)"), "HIGH"),
            (total >= threshold * F.lit("1.1").cast("decimal(2,1)"), "MEDIUM"),
        ],
        "LOW",
    )


def alert_score(score: Column | str) -> Column:
    """A score as stored on an alert, as wide as the structuring score."""
    return col(score).cast("decimal(14,2)")


def normalized_risk(score: Column | str) -> Column:
    """Scores above 1 are on a 0-10 scale; bring them to 0-1."""
    s = col(score)
    return F.when(s > 1, s / 10).otherwise(s).cast("decimal(4,2)")


# --- merchants ------------------------------------------------------------


def is_high_risk_mcc(mcc: Column | str, codes: Sequence[str] = HIGH_RISK_MCC) -> Column:
    return F.coalesce(col(mcc).isin(list(codes)), F.lit(False))


def merchant_risk_flag(is_blacklisted, mcc, risk, codes: Sequence[str] = HIGH_RISK_MCC) -> Column:
    risk = col(risk)
    return label(
        [
            (operand(col(is_blacklisted)).cast("boolean"), RISK_BLOCKED),
            (is_high_risk_mcc(mcc, codes), RISK_FLAGGED),
            (risk >= 0.75, RISK_WATCH),
            (risk >= 0.50, RISK_MONITOR),
        ],
        RISK_CLEAR,
    )


# --- accounts -------------------------------------------------------------


def account_health(
    active, locked_until, must_change, failed, as_of, with_must_change: bool = True
) -> Column:
    cases = [
        (~col(active).cast("boolean"), HEALTH_DEACTIVATED),
        (col(locked_until).cast("timestamp") > instant(as_of), HEALTH_LOCKED),
    ]
    if with_must_change:
        cases.append((col(must_change).cast("boolean"), HEALTH_MUST_CHANGE))
    cases.append((col(failed).between(3, 4), HEALTH_AT_RISK))
    return label(cases, HEALTH_ACTIVE)


def role_rank(role: Column | str) -> Column:
    return map_case(role, ROLE_RANK)


def risk_rank(risk_profile: Column | str) -> Column:
    return map_case(risk_profile, RISK_RANK)
