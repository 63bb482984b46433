"""For every registered query the same result in plain SQL, for an independent engine."""

from __future__ import annotations

import re

from cardwarden.sources import adapters

AS_OF = f"TIMESTAMP '{adapters.AS_OF}'"
ARRIVAL = "TIMESTAMP '2024-01-30 00:00:00'"


# Fixed values, written out here so that an error in the engine's own copy shows.
HIGH_RISK = "'6051', '7995', '4829', '6010', '6011', '5912', '7273', '5999'"
SCREEN = "'6051', '7995', '4829', '6010', '6011'"
FLAG_TRAVEL = "⚠ IMPOSSIBLE TRAVEL DETECTED"
FLAG_STRUCTURING = "⚠ STRUCTURING / AML PATTERN"
FLAG_BLACKLISTED = "🚫 BLACKLISTED MERCHANT"
FLAG_MCC = "⚠ HIGH-RISK MCC CATEGORY"
FLAG_SUSPICIOUS = "⚠ SUSPICIOUS"


def sql(select: str, **steps: str) -> str:
    """A query over the adapted tables it mentions, with further named steps."""
    text = " ".join([*steps.values(), select])
    adapted = {n: t for n, t in adapters.SQL.items() if re.search(rf"\b{n}\b", text)}
    parts = [f"{n} AS ({t})" for n, t in {**adapted, **steps}.items()]
    # Adapters read their own source first, so an adapted name never hides it.
    if not parts:
        return select
    return f"WITH RECURSIVE {', '.join(parts)} {select}"


def km(lat1, lon1, lat2, lon2) -> str:
    """Great-circle distance by the haversine of the angle."""
    def rad(c):
        return f"radians(CAST({c} AS DOUBLE))"

    half = (
        f"pow(sin(({rad(lat2)} - {rad(lat1)}) / 2), 2) + cos({rad(lat1)}) * cos({rad(lat2)})"
        f" * pow(sin(({rad(lon2)} - {rad(lon1)}) / 2), 2)"
    )
    return f"CAST(6371.0 * 2 * atan2(sqrt({half}), sqrt(greatest(0.0, 1 - ({half})))) AS DECIMAL(12,4))"


def planar(lat1, lon1, lat2, lon2) -> str:
    def d(c):
        return f"CAST({c} AS DOUBLE)"

    return (
        f"sqrt(pow(({d(lat2)} - {d(lat1)}) * 111.0, 2) + pow(({d(lon2)} - {d(lon1)}) * 111.0"
        f" * cos(radians(({d(lat1)} + {d(lat2)}) / 2)), 2))"
    )


def seconds(a, b) -> str:
    return f"greatest(1, date_diff('second', {a}, {b}))"


def speed(distance, a, b) -> str:
    hours = f"CAST(round({seconds(a, b)} / 3600.0, 6) AS DECIMAL(18,6))"
    return f"CAST(({distance}) / {hours} AS DECIMAL(12,4))"


def travel_risk(r) -> str:
    return (
        f"CAST(CASE WHEN {r} >= 5 THEN 1.00 WHEN {r} >= 3 THEN 0.97 WHEN {r} >= 2 THEN 0.93 "
        f"WHEN {r} >= 1.5 THEN 0.87 ELSE round(0.70 + ({r} - 1) * 0.20, 2) END AS DECIMAL(4,2))"
    )


def travel_severity(r) -> str:
    return (
        f"CASE WHEN {r} >= 5 THEN 'CRITICAL' WHEN {r} >= 2 THEN 'HIGH' "
        f"WHEN {r} >= 1.5 THEN 'MEDIUM' ELSE 'LOW' END"
    )


def structuring_score(total, threshold, n) -> str:
    return (
        f"CAST(CASE WHEN {total} >= 2 * {threshold} THEN 1 ELSE round(CAST(0.70 + {n} / 100.0 + "
        f"({total} - {threshold}) / ({threshold} * 10.0) AS DECIMAL(28,9)), 2) END AS DECIMAL(14,2))"
    )


def structuring_severity(total, threshold) -> str:
    return (
        f"CASE WHEN {total} >= 2.0 * {threshold} THEN 'CRITICAL' WHEN {total} >= 1.5 * {threshold} "
        f"THEN 'HIGH' WHEN {total} >= 1.1 * {threshold} THEN 'MEDIUM' ELSE 'LOW' END"
    )


def risk_flag(blacklisted, mcc, risk) -> str:
    return (
        f"CASE WHEN {blacklisted} THEN 'BLOCKED: BLACKLISTED MERCHANT' WHEN {mcc} IN ({HIGH_RISK}) "
        f"THEN 'FLAGGED: HIGH-RISK MCC' WHEN {risk} >= 0.75 THEN 'WATCH: HIGH RISK SCORE' "
        f"WHEN {risk} >= 0.50 THEN 'MONITOR: MEDIUM RISK SCORE' ELSE 'CLEAR' END"
    )


def health(must_change: bool) -> str:
    change = f"WHEN must_change_password = 1 THEN '🔑 Must Change Password'" if must_change else ""
    return (
        f"CASE WHEN is_active = 0 THEN '🔴 Deactivated' WHEN locked_until > {AS_OF} "
        f"THEN '🔒 Locked' {change} WHEN failed_attempts BETWEEN 3 AND 4 "
        f"THEN '⚠ At Risk' ELSE '✅ Active' END"
    )


NAME = "u.first_name || ' ' || u.last_name"

# --- travel rule ----------------------------------------------------------

LOCATED = """SELECT transaction_id AS id, user_id, card_id, transaction_timestamp AS ts,
 transaction_status AS st, latitude AS lat, longitude AS lon, ip_address AS ip
 FROM transactions WHERE latitude IS NOT NULL AND longitude IS NOT NULL"""

PAIRED = """SELECT l.*, p.id AS pid, p.ts AS pts, p.lat AS plat, p.lon AS plon, p.ip AS pip,
 row_number() OVER (PARTITION BY l.id ORDER BY p.ts DESC, p.id DESC) AS pick
 FROM located l LEFT JOIN located p ON p.user_id = l.user_id AND p.ts < l.ts AND p.st <> 'reversed'"""


def measured(source: str) -> str:
    distance = km("plat", "plon", "lat", "lon")
    return f"""SELECT *, CAST(speed / 900 AS DECIMAL(10,2)) AS ratio FROM (
      SELECT *, {speed('km', 'pts', 'ts')} AS speed FROM (
        SELECT *, {distance} AS km FROM {source}) a) b"""


MINUTES = f"CAST({seconds('pts', 'ts')} / 60.0 AS DECIMAL(10,2))"

GEO_MESSAGE = (
    f"'Impossible travel: ' || CAST(km AS VARCHAR) || ' km in ' || CAST({MINUTES} AS VARCHAR) || ' min needs ' || "
    "CAST(CAST(trunc(speed) AS BIGINT) AS VARCHAR) || ' km/h'"
)

GEO_SELECT = f"""SELECT id AS transaction_id, user_id, card_id, pid AS prev_transaction_id,
 km AS distance_km, CAST({seconds('pts', 'ts')} / 60.0 AS DECIMAL(10,2)) AS time_gap_minutes,
 speed AS required_speed_kmh, ratio AS speed_ratio, {travel_risk('ratio')} AS risk_score,
 {travel_severity('ratio')} AS severity, ip AS ip_address FROM measured WHERE speed > 900"""

GEO_BOTH = (
    GEO_SELECT.replace("ip AS ip_address", "m.ip AS ip_address, p.ip AS prev_ip_address").replace(
        "FROM measured", "FROM measured m LEFT JOIN (SELECT id AS x, ip FROM located) p ON p.x = m.pid"
    )
)

GEO_STEPS = {
    "located": LOCATED,
    "paired": PAIRED,
    "picked": "SELECT * FROM paired WHERE pick = 1",
    "measured": measured("picked"),
}

def _walk() -> str:
    """One step per payment of a customer; only accepted payments move the point."""
    fast = f"{speed(km('w.slat', 'w.slon', 'e.lat', 'e.lon'), 'w.sts', 'e.ts')} > 900"
    moves = f"(e.ok AND NOT coalesce({fast}, FALSE))"
    moved = ", ".join(
        f"CASE WHEN {moves} THEN e.{c} ELSE w.s{c} END" for c in ("id", "ts", "lat", "lon")
    )
    first = ", ".join(f"CASE WHEN ok THEN {c} END AS s{c}" for c in ("id", "ts", "lat", "lon"))
    return f"""
      SELECT user_id, rn, id, card_id, ts, lat, lon, ip, CAST(NULL AS BIGINT) AS pid, CAST(NULL AS TIMESTAMP) AS pts,
        CAST(NULL AS DECIMAL(10,8)) AS plat, CAST(NULL AS DECIMAL(11,8)) AS plon,
        {first}
      FROM ordered WHERE rn = 1
      UNION ALL
      SELECT e.user_id, e.rn, e.id, e.card_id, e.ts, e.lat, e.lon, e.ip, w.sid, w.sts, w.slat, w.slon, {moved}
      FROM walk w JOIN ordered e ON e.user_id = w.user_id AND e.rn = w.rn + 1"""


def walk_steps(source: str = "located") -> dict[str, str]:
    return {
        "located": LOCATED,
        "ordered": f"""SELECT *, st NOT IN ('declined', 'reversed') AS ok,
          row_number() OVER (PARTITION BY user_id ORDER BY ts, id) AS rn FROM {source}""",
        "walk": _walk(),
        "measured": measured("walk"),
    }


# --- structuring rule -----------------------------------------------------


def in_window(end: str = AS_OF) -> str:
    return (
        "transaction_status = 'completed' AND transaction_amount < 10000 AND transaction_timestamp "
        f"BETWEEN {end} - INTERVAL 48 HOUR AND {end}"
    )


def structuring_message(n: str, total: str) -> str:
    return (
        f"CAST({n} AS VARCHAR) || ' payments below $10000 add up to $' || "
        f"CAST(CAST({total} AS DECIMAL(25,0)) AS VARCHAR) || ' within 48 hours'"
    )


REPORT = f"""SELECT g.user_id, {NAME} AS full_name, u.email, u.risk_profile AS current_risk_profile,
 u.country_iso_code, n AS txn_count_in_window, total AS aggregate_total,
 CAST(10000 AS DECIMAL(15,2)) AS reporting_threshold,
 CAST(total - 10000 AS DECIMAL(25,2)) AS amount_over_threshold, min_single_txn, max_single_txn,
 avg_single_txn, 48 AS window_hours, first_txn_in_window, last_txn_in_window,
 date_diff('minute', first_txn_in_window, last_txn_in_window) AS span_minutes,
 {structuring_score('total', '10000', 'n')} AS calculated_risk_score,
 {structuring_severity('total', '10000')} AS severity_level, 'structuring_aml' AS alert_type,
 {structuring_message('n', 'total')} AS alert_message, latest_card_id
 FROM (SELECT user_id, count(*) AS n, CAST(sum(transaction_amount) AS DECIMAL(25,2)) AS total,
   min(transaction_amount) AS min_single_txn, max(transaction_amount) AS max_single_txn,
   CAST(sum(transaction_amount) / count(*) AS DECIMAL(19,6)) AS avg_single_txn,
   min(transaction_timestamp) AS first_txn_in_window, max(transaction_timestamp) AS last_txn_in_window,
   max(card_id) AS latest_card_id FROM transactions WHERE {in_window()} GROUP BY user_id
   HAVING count(*) >= 2 AND sum(transaction_amount) >= 10000) g
 JOIN users u ON u.user_id = g.user_id"""

RAISED = """SELECT CAST(NULL AS BIGINT) AS transaction_id, latest_card_id AS card_id, user_id, alert_type,
 CAST(calculated_risk_score AS DECIMAL(14,2)) AS risk_score, alert_message, 'open' AS alert_status,
 'Severity ' || severity_level AS investigation_notes FROM report r
 WHERE NOT EXISTS (SELECT 1 FROM alerts a WHERE a.user_id = r.user_id AND a.alert_type = r.alert_type
   AND a.alert_status = 'open')"""

SUMMARY = f"""(SELECT count(*) FROM report) AS total_suspects_detected,
 (SELECT count(*) FROM raised) AS new_alerts_raised, {AS_OF} - INTERVAL 48 HOUR AS analysis_window_start,
 {AS_OF} AS analysis_window_end, CAST(10000 AS DECIMAL(15,2)) AS threshold_used, 48 AS window_hours_used"""

ON_INSERT = f"""SELECT b.transaction_id, b.user_id, b.card_id, b.transaction_status,
 coalesce(w.n, 0) AS txn_count, CAST(coalesce(w.total, 0) AS DECIMAL(25,2)) AS aggregate_total,
 coalesce(w.n >= 2 AND w.total >= 10000, FALSE) AS violation, w.max_card_id
 FROM transactions b LEFT JOIN (SELECT user_id, count(*) AS n, sum(transaction_amount) AS total,
   max(card_id) AS max_card_id FROM transactions WHERE {in_window()} GROUP BY user_id) w
 ON w.user_id = b.user_id WHERE b.transaction_timestamp >= {ARRIVAL}"""

TRAILING = """SELECT *, coalesce(n >= 2 AND total >= 10000, FALSE) AS violation FROM (
 SELECT transaction_id, user_id, card_id, count(*) OVER w AS n,
   CAST(sum(transaction_amount) OVER w AS DECIMAL(25,2)) AS total FROM transactions
 WHERE transaction_status = 'completed' AND transaction_amount < 10000
 WINDOW w AS (PARTITION BY user_id ORDER BY transaction_timestamp
   RANGE BETWEEN INTERVAL 48 HOUR PRECEDING AND CURRENT ROW)) x"""


# --- alert upsert ---------------------------------------------------------


def upsert(refresh_transaction: bool | str, with_ids: bool = False) -> dict[str, str]:
    """Steps from hits(transaction_id, card_id, user_id, alert_type, risk_score, alert_message) to a snapshot.

    Payment and message are refreshed together or not at all; a text is the condition for it.
    """
    both = refresh_transaction if isinstance(refresh_transaction, str) else str(refresh_transaction).upper()

    def pick(new: str, old: str) -> str:
        return f"CASE WHEN {both} THEN {new} ELSE {old} END"

    last, first = pick("g.last_id", "a.transaction_id"), pick("l.transaction_id", "f.transaction_id")
    last_text, first_text = pick("l.alert_message", "a.alert_message"), pick("l.alert_message", "f.alert_message")
    new_id = (
        "(SELECT max(alert_id) FROM alerts) + row_number() OVER (ORDER BY g.user_id)"
        if with_ids else "CAST(NULL AS BIGINT)"
    )
    return {
        "grouped": """SELECT user_id, alert_type, min(transaction_id) AS first_id,
          max(transaction_id) AS last_id, count(*) AS hits FROM hits GROUP BY user_id, alert_type""",
        "kept": f"""SELECT a.alert_id, CASE WHEN g.hits IS NULL THEN a.transaction_id ELSE {last} END AS transaction_id,
          a.card_id, a.user_id, a.alert_type,
          CASE WHEN g.hits IS NULL THEN a.risk_score ELSE l.risk_score END AS risk_score,
          CASE WHEN g.hits IS NULL THEN a.alert_message ELSE {last_text} END AS alert_message,
          a.alert_status, a.created_at, g.hits
          FROM alerts a LEFT JOIN grouped g ON g.user_id = a.user_id AND g.alert_type = a.alert_type
            AND a.alert_status = 'open'
          LEFT JOIN hits l ON l.transaction_id = g.last_id AND l.alert_type = g.alert_type
            AND l.user_id = g.user_id""",
        "opened": f"""SELECT {new_id} AS alert_id, {first} AS transaction_id, f.card_id, g.user_id, g.alert_type,
          l.risk_score, {first_text} AS alert_message, 'open' AS alert_status, {AS_OF} AS created_at, g.hits
          FROM grouped g JOIN hits f ON f.transaction_id = g.first_id AND f.alert_type = g.alert_type
          JOIN hits l ON l.transaction_id = g.last_id AND l.alert_type = g.alert_type
          WHERE NOT EXISTS (SELECT 1 FROM alerts a WHERE a.user_id = g.user_id
            AND a.alert_type = g.alert_type AND a.alert_status = 'open')""",
    }


SNAPSHOT = "SELECT * FROM kept UNION ALL SELECT * FROM opened"


def score4(text: str) -> str:
    return f"CAST({text} AS DECIMAL(14,2))"


STRUCTURING_HITS = f"""SELECT transaction_id, CARD AS card_id, user_id, 'structuring_aml' AS alert_type,
 {score4(structuring_score('TOTAL', '10000', 'N'))} AS risk_score, MESSAGE AS alert_message FROM judged WHERE violation"""


def structuring_hits(card: str, total: str, n: str) -> str:
    text = STRUCTURING_HITS.replace("CARD", card).replace("MESSAGE", structuring_message(n, total))
    return text.replace("TOTAL", total).replace("N / 100", f"{n} / 100")



# --- merchant rule --------------------------------------------------------

BLOCKED = """SELECT DISTINCT t.batch_id FROM transactions t JOIN merchants m ON m.merchant_id = t.merchant_id
 WHERE m.is_blacklisted = 1"""

def text(column: str) -> str:
    return f"coalesce(CAST({column} AS VARCHAR), 'N/A')"


MCC_PAYMENT = (
    f"'Payment ' || CAST(transaction_id AS VARCHAR) || ' of $' || CAST(transaction_amount AS VARCHAR) || "
    f"' with category ' || {text('merchant_mcc')}"
)

BLOCKED_ROWS = f"""SELECT t.*, m.merchant_name, m.risk_score AS merchant_risk, m.merchant_category_code, m.fraud_report_count,
 'Blocked payment of ' || CAST(transaction_amount AS VARCHAR) || ' ' || currency_code || ' at ' || merchant_name AS alert_message,
 'Merchant ' || CAST(t.merchant_id AS VARCHAR) || ' ' || merchant_name || chr(13) || chr(10) || 'IP address ' || {text('ip_address')}
   || chr(13) || chr(10) || 'At (' || {text('latitude')} || ', ' || {text('longitude')} || ')' AS investigation_notes
 FROM transactions t JOIN merchants m ON m.merchant_id = t.merchant_id WHERE is_blacklisted = 1"""

MCC_JUDGED = f"""SELECT t.*, m.risk_score, m.merchant_name, coalesce(t.merchant_mcc IN ({HIGH_RISK}), FALSE) AS flagged,
 {risk_flag('FALSE', 't.merchant_mcc', 'm.risk_score')} AS risk_flag
 FROM transactions t LEFT JOIN merchants m ON m.merchant_id = t.merchant_id WHERE t.transaction_status <> 'reversed'"""

PROFILE_COLUMNS = f"""m.merchant_id, m.merchant_name, m.merchant_category_code AS mcc, m.country_iso_code,
 m.risk_score, m.is_blacklisted, m.fraud_report_count, m.merchant_category_code IN ({HIGH_RISK}) AS is_high_risk_mcc,
 {risk_flag('m.is_blacklisted = 1', 'm.merchant_category_code', 'm.risk_score')} AS risk_flag"""

# --- login ----------------------------------------------------------------

LOGIN_COUNTED = """SELECT *, sum(f) OVER (PARTITION BY auth_id, epoch ORDER BY event_timestamp, log_id
   ROWS UNBOUNDED PRECEDING) AS fails FROM (
 SELECT *, sum(s) OVER (PARTITION BY auth_id ORDER BY event_timestamp, log_id ROWS UNBOUNDED PRECEDING) AS epoch FROM (
  SELECT log_id, auth_id, event_timestamp, ip_address,
   CASE WHEN event_type = 'login_failure' AND login_status = 'failure' THEN 1 ELSE 0 END AS f,
   CASE WHEN event_type = 'login_success' AND login_status = 'success' THEN 1 ELSE 0 END AS s
  FROM login_log WHERE auth_id IS NOT NULL) a WHERE f + s = 1) b"""

LOCKOUTS = """SELECT log_id, auth_id, event_timestamp, CAST(fails AS INT) AS failed_attempts,
 event_timestamp + INTERVAL 30 MINUTE AS locked_until FROM counted WHERE f = 1 AND fails >= 5"""

HOME = """SELECT t.transaction_id, l.latitude AS hlat, l.longitude AS hlon, t.latitude AS lat, t.longitude AS lon
 FROM transactions t JOIN locations l ON l.user_id = t.user_id WHERE t.latitude IS NOT NULL"""


IN_ORDER = "CAST(least(floor((dayofmonth(transaction_timestamp) - 1) / 6), 4) AS INT)"


BURSTS = """SELECT user_id, card_id, transaction_id * 10 + k AS transaction_id,
 CAST(1500 + transaction_id % 2000 AS DECIMAL(15,2)) AS transaction_amount,
 transaction_timestamp + k * (CASE WHEN transaction_id % 3 = 0 THEN INTERVAL 40 MINUTE ELSE INTERVAL 10 MINUTE END)
   AS transaction_timestamp, 'completed' AS transaction_status
 FROM transactions, (VALUES (0), (1), (2)) v(k)"""


def detection(clock: str = AS_OF, part: str = "0") -> dict[str, str]:
    """All rules over the payments of unblocked batches, which arrive in parts; each part has its clock."""
    steps = walk_steps("accepted")
    steps.pop("located")
    return {
        "arrived": f"SELECT *, {part} AS part FROM transactions",
        "clocks": f"SELECT part, {clock} AS clock FROM arrived GROUP BY part",
        "blocked": """SELECT DISTINCT a.part, a.batch_id FROM arrived a JOIN merchants m ON m.merchant_id = a.merchant_id
          WHERE m.is_blacklisted = 1""",
        "passed": """SELECT a.* FROM arrived a WHERE NOT EXISTS
          (SELECT 1 FROM blocked b WHERE b.part = a.part AND b.batch_id = a.batch_id)""",
        "located": LOCATED,
        "accepted": "SELECT * FROM located WHERE id IN (SELECT transaction_id FROM passed)",
        **steps,
        "ruled": f"""SELECT t.*, CASE WHEN m.id IS NULL THEN t.transaction_status ELSE 'declined' END AS st,
          m.id IS NOT NULL AS geo, t.transaction_status <> 'reversed' AND t.merchant_mcc IN ({HIGH_RISK}) AS mcc
          FROM passed t LEFT JOIN (SELECT id FROM measured WHERE speed > 900) m ON m.id = t.transaction_id""",
        "windows": """SELECT c.part, j.user_id, count(*) AS n, sum(j.transaction_amount) AS total, max(j.card_id) AS max_card
          FROM clocks c JOIN ruled j ON j.part <= c.part AND j.transaction_timestamp BETWEEN c.clock - INTERVAL 48 HOUR AND c.clock
          WHERE j.st = 'completed' AND j.transaction_amount < 10000 GROUP BY c.part, j.user_id""",
        "final": """SELECT j.*, coalesce(w.n, 0) AS n, CAST(coalesce(w.total, 0) AS DECIMAL(25,2)) AS total,
          coalesce(w.n >= 2 AND w.total >= 10000, FALSE) AS violation, w.max_card, c.clock
          FROM ruled j JOIN clocks c ON c.part = j.part LEFT JOIN windows w ON w.part = j.part AND w.user_id = j.user_id""",
        "coded": f"""SELECT t.*, m.merchant_name, m.risk_score AS merchant_risk, m.fraud_report_count, c.clock,
          merchant_mcc IN ({HIGH_RISK}) AS flagged, {risk_flag('FALSE', 't.merchant_mcc', 'm.risk_score')} AS risk_flag
          FROM passed t JOIN clocks c ON c.part = t.part LEFT JOIN merchants m ON m.merchant_id = t.merchant_id
          WHERE t.transaction_status <> 'reversed'""",
        "far": f"""SELECT m.*, c.clock, coalesce(speed > 900, FALSE) AS hit, p.ip AS pip FROM measured m
          JOIN passed t ON t.transaction_id = m.id JOIN clocks c ON c.part = t.part
          LEFT JOIN (SELECT id AS x, ip FROM located) p ON p.x = m.pid""",
        "offences": BLOCKED_ROWS,
    }


DETECTED = """SELECT transaction_id, st AS transaction_status, geo AS geo_violation, violation AS structuring_violation,
 mcc AS mcc_flagged FROM final"""

_SCORE = f"CAST({structuring_score('total', '10000', 'n')} AS DECIMAL(14,2))"

HITS = f"""SELECT id AS transaction_id, card_id, user_id, 'impossible_travel' AS alert_type,
  CAST({travel_risk('ratio')} AS DECIMAL(14,2)) AS risk_score, {GEO_MESSAGE} AS alert_message FROM far WHERE hit
 UNION ALL SELECT transaction_id, max_card, user_id, 'structuring_aml', {_SCORE}, {structuring_message('n', 'total')}
  FROM final WHERE violation
 UNION ALL SELECT transaction_id, card_id, user_id, 'high_risk_mcc', CAST(merchant_risk AS DECIMAL(14,2)),
  {MCC_PAYMENT} || ' at ' || {text('merchant_name')} FROM coded WHERE flagged"""

AUDIT = f"""SELECT id AS transaction_id, CASE WHEN hit THEN 'completed' END AS previous_status,
  CASE WHEN hit THEN 'declined' ELSE 'completed' END AS new_status, 'geo' AS changed_by, clock AS changed_at,
  CASE WHEN hit THEN {GEO_MESSAGE} || ', severity ' || {travel_severity('ratio')}
   WHEN pid IS NULL THEN 'No violation: no prior point' ELSE 'No violation: within limit' END AS change_reason FROM far
 UNION ALL SELECT j.transaction_id, CASE WHEN violation THEN 'completed' END, 'completed', 'structuring', clock,
  CASE WHEN NOT violation THEN 'No violation' WHEN o.user_id IS NOT NULL OR j.transaction_id > first_id
   THEN 'Existing alert updated' ELSE 'New alert raised' END || ': $' || CAST(total AS VARCHAR) || ' in ' ||
   CAST(n AS VARCHAR) || ' payments' || CASE WHEN violation THEN ', risk ' || CAST({_SCORE} AS VARCHAR) ELSE '' END
  FROM final j LEFT JOIN (SELECT user_id, min(transaction_id) AS first_id FROM final WHERE violation GROUP BY user_id) f
   ON f.user_id = j.user_id LEFT JOIN (SELECT DISTINCT user_id FROM alerts WHERE alert_type = 'structuring_aml'
   AND alert_status = 'open') o ON o.user_id = j.user_id
 UNION ALL SELECT transaction_id, CASE WHEN flagged THEN 'completed' END, 'completed', 'merchant', clock,
  CASE WHEN flagged THEN 'Flagged' ELSE 'Clear' END || ': ' || risk_flag || ', category ' || merchant_mcc || ', $' ||
   CAST(transaction_amount AS VARCHAR) || ' at ' || {text('merchant_name')} || ' of risk ' || {text('merchant_risk')} FROM coded
 UNION ALL SELECT NULL, NULL, 'blocked', 'merchant', clock,
  concat('User ', user_id, ', card ', card_id, ', merchant ', merchant_id, ' ', merchant_name, ' of risk ', merchant_risk,
   ', $', transaction_amount, ', IP ', coalesce(ip_address, 'N/A')) FROM offences o JOIN arrived a USING (transaction_id)
  JOIN clocks c ON c.part = a.part"""
AUDIT = AUDIT.replace("FROM offences o JOIN arrived a USING (transaction_id)", "FROM offences JOIN (SELECT transaction_id, part FROM arrived) a USING (transaction_id)")


def stamp(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


NEWLINE = "chr(13) || chr(10)"
NOTES = f"""SELECT user_id, 'impossible_travel' AS alert_type, id AS transaction_id, clock AS noted_at,
  'From payment ' || CAST(pid AS VARCHAR) || ' at (' || CAST(plat AS VARCHAR) || ', ' || CAST(plon AS VARCHAR) || '), ' ||
  {stamp('pts')} || ', IP ' || coalesce(pip, 'N/A') || {NEWLINE} || 'To payment ' || CAST(id AS VARCHAR) || ' at (' ||
  CAST(lat AS VARCHAR) || ', ' || CAST(lon AS VARCHAR) || '), ' || {stamp('ts')} || ', IP ' || coalesce(ip, 'N/A') ||
  {NEWLINE} || 'Severity ' || {travel_severity('ratio')} || ', risk ' || CAST({travel_risk('ratio')} AS VARCHAR) AS note
  FROM far WHERE hit
 UNION ALL SELECT user_id, 'structuring_aml', transaction_id, clock, 'Payment ' || CAST(transaction_id AS VARCHAR) || ' ($' ||
  CAST(transaction_amount AS VARCHAR) || '), severity ' || {structuring_severity('total', '10000')} || ', risk ' ||
  CAST({_SCORE} AS VARCHAR) || ': $' || CAST(total AS VARCHAR) || ' in ' || CAST(n AS VARCHAR) || ' payments'
  FROM final WHERE violation
 UNION ALL SELECT user_id, 'high_risk_mcc', transaction_id, clock, {MCC_PAYMENT} || {NEWLINE} || 'Merchant ' ||
  {text('merchant_name')} || ', N/A, fraud reports ' || {text('fraud_report_count')} || ', ' || risk_flag || {NEWLINE} ||
  'IP address ' || {text('ip_address')} || ', device N/A' FROM coded WHERE flagged"""

GEO_ONLY = "coalesce(g.alert_type = 'impossible_travel', FALSE)"

ARRIVAL_ORDER = """SELECT *, st NOT IN ('declined', 'reversed') AS ok, row_number() OVER (PARTITION BY user_id ORDER BY
 CAST(least(floor((dayofmonth(ts) - 1) / 6) + CASE WHEN id % 7 = 3 THEN 1 ELSE 0 END, 4) AS INT), ts, id) AS rn FROM located"""


def arrival_walk() -> dict[str, str]:
    """One step per payment in order of arrival; the state is the list of all accepted points."""
    fast = f"{speed(km('r.lat', 'r.lon', 'lat', 'lon'), 'r.ts', 'ts')} > 900"
    return {
        "located": LOCATED,
        "ordered": ARRIVAL_ORDER,
        "walk": f"""
          SELECT user_id, rn, id, CAST(NULL AS BIGINT) AS pid, FALSE AS fast,
            CASE WHEN ok THEN [{{'ts': ts, 'id': id, 'lat': lat, 'lon': lon}}]
              ELSE list_filter([{{'ts': ts, 'id': id, 'lat': lat, 'lon': lon}}], lambda x: FALSE) END AS pts
          FROM ordered WHERE rn = 1
          UNION ALL
          SELECT user_id, rn, id, r.id, bad, CASE WHEN ok AND NOT bad
            THEN list_append(pts, {{'ts': ts, 'id': id, 'lat': lat, 'lon': lon}}) ELSE pts END FROM (
              SELECT *, coalesce({fast}, FALSE) AS bad FROM (
                SELECT e.*, w.pts, list_max(list_filter(w.pts, lambda x: x.ts < e.ts)) AS r
                FROM walk w JOIN ordered e ON e.user_id = w.user_id AND e.rn = w.rn + 1) a) b""",
    }


def in_time_walk() -> dict[str, str]:
    """The same over the payments that are not too late."""
    steps = arrival_walk()
    return steps | {"located": LOCATED.replace("FROM transactions", "FROM landed") + " AND NOT too_late"}


# Payments as they arrive, and which of them lie more than three days behind the latest of the earlier parts.
LANDED = """SELECT t.*, m.mark, coalesce(t.transaction_timestamp < m.mark, FALSE) AS too_late FROM (
   SELECT *, CAST(least(floor((dayofmonth(transaction_timestamp) - 1) / 6)
     + CASE WHEN transaction_id % 7 = 3 THEN 1 ELSE 0 END, 4) AS INT) AS part FROM transactions) t
 LEFT JOIN (SELECT part, date_trunc('milliseconds', max(latest) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING
     AND 1 PRECEDING)) - INTERVAL 3 DAY AS mark FROM (
     SELECT CAST(least(floor((dayofmonth(transaction_timestamp) - 1) / 6)
       + CASE WHEN transaction_id % 7 = 3 THEN 1 ELSE 0 END, 4) AS INT) AS part, max(transaction_timestamp) AS latest
     FROM transactions GROUP BY 1) x) m ON m.part = t.part"""

# Totals of the 48 hours up to the customer's latest payment, after each part.
KEPT_UP = """SELECT l.transaction_id, l.user_id, l.too_late, CASE WHEN l.too_late THEN 0 ELSE coalesce(w.n, 0) END AS txn_count,
   CAST(CASE WHEN l.too_late THEN 0 ELSE coalesce(w.total, 0) END AS DECIMAL(25,2)) AS aggregate_total,
   CASE WHEN NOT l.too_late THEN w.card END AS max_card_id,
   coalesce(NOT l.too_late AND w.n >= 2 AND w.total >= 10000, FALSE) AS violation
 FROM landed l LEFT JOIN (
   SELECT c.user_id, c.part, count(*) AS n, sum(p.transaction_amount) AS total, max(p.card_id) AS card FROM (
     SELECT a.user_id, a.part, max(b.transaction_timestamp) AS clock
     FROM (SELECT DISTINCT user_id, part FROM landed WHERE NOT too_late) a
     JOIN landed b ON b.user_id = a.user_id AND b.part <= a.part AND NOT b.too_late GROUP BY a.user_id, a.part) c
   JOIN landed p ON p.user_id = c.user_id AND p.part <= c.part AND NOT p.too_late
     AND p.transaction_status = 'completed' AND p.transaction_amount < 10000
     AND p.transaction_timestamp >= c.clock - INTERVAL 48 HOUR
   GROUP BY c.user_id, c.part) w ON w.user_id = l.user_id AND w.part = l.part"""


# --- declared rules, written out table by table -----------------------------


def _found(table: str, source: str, key: str, value: str, where: str, name: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, CAST({key} AS VARCHAR) AS row_key, '{value}' AS {name} "
        f"FROM {source} WHERE {where}"
    )


# Payments and their alerts after all changes.
CHANGED = """SELECT CASE WHEN transaction_id % 5 = 0 THEN merchant_id + 1 ELSE merchant_id END AS mid,
   CASE WHEN transaction_id % 5 = 0 THEN transaction_amount + 100 ELSE transaction_amount END AS amount,
   coalesce(a.n, 0) AS raised
 FROM transactions LEFT JOIN (SELECT transaction_id, count(*) AS n FROM alerts WHERE alert_id % 7 <> 0
   GROUP BY transaction_id) a USING (transaction_id) WHERE transaction_id % 11 <> 0"""

# The version of its merchant that each payment met.
VERSIONS = """SELECT merchant_id, TIMESTAMP '2024-01-02 00:00:00' AS since, is_blacklisted AS bad FROM merchants
 UNION ALL SELECT merchant_id, TIMESTAMP '2024-01-15 12:00:00', 1 FROM merchants WHERE merchant_id % 6 = 2
 UNION ALL SELECT merchant_id, TIMESTAMP '2024-01-20 00:00:00', 0 FROM merchants WHERE merchant_id % 10 = 3"""
MET = """SELECT t.transaction_id, t.batch_id, t.merchant_id, coalesce(arg_max(v.bad, v.since) = 1, FALSE) AS bad
 FROM transactions t LEFT JOIN versions v ON v.merchant_id = t.merchant_id AND v.since <= t.transaction_timestamp
 GROUP BY t.transaction_id, t.batch_id, t.merchant_id"""

# Customers that are closed, what hangs on them, and what stands in the way of deleting them.
CLOSED = "SELECT user_id FROM users WHERE account_status = 'closed'"
CLOSED_CARDS = "SELECT card_id, user_id FROM cards WHERE user_id IN (SELECT user_id FROM closed)"
IN_THE_WAY = " UNION ALL ".join(
    f"SELECT c.user_id, '{table}' AS table_name, '{column}' AS column_name FROM {table} x JOIN {parent} c ON c.{column} = x.{column}"
    for table in ("transactions", "alerts") for column, parent in (("user_id", "closed"), ("card_id", "closed_cards"))
)


def _go(free: str, **more: str) -> str:
    """Rows of the deletion for the customers of a step; more: table -> condition."""
    own = f"user_id IN (SELECT user_id FROM {free})"
    parts = [
        f"SELECT '{table}' AS table_name, CAST({_KEYS[table][1]} AS VARCHAR) AS row_key, 'delete' AS action, "
        f"CAST(NULL AS VARCHAR) AS column_name FROM {_KEYS[table][0]} WHERE {where}"
        for table, where in {
            "users": own, "cards": own, "user_known_locations": own, "user_devices": own,
            "authentication": "is_active = 0", **more,
        }.items()
    ]
    parts.append(
        "SELECT 'authentication_audit_log', CAST(log_id AS VARCHAR), 'set_null', 'auth_id' FROM login_log "
        "WHERE auth_id IN (SELECT auth_id FROM authentication WHERE is_active = 0)"
    )
    return " UNION ALL ".join(parts)


GONE_PAYMENTS = """SELECT transaction_id FROM transactions WHERE user_id IN (SELECT user_id FROM closed)
 OR card_id IN (SELECT card_id FROM closed_cards)"""

# table, adapted table, key
_KEYS = {
    "users": ("users", "user_id"), "cards": ("cards", "card_id"), "merchants": ("merchants", "merchant_id"),
    "transactions": ("transactions", "transaction_id"), "alerts": ("alerts", "alert_id"),
    "transaction_audit_log": ("audit", "audit_id"), "user_known_locations": ("locations", "location_id"),
    "user_devices": ("devices", "device_id"), "authentication": ("authentication", "auth_id"),
    "authentication_audit_log": ("login_log", "log_id"),
}

CHECKS = [
    _found(table, *_KEYS[table], rule, f"NOT ({holds})", "rule")
    for table, rule, holds in (
        ("users", "account_status", "account_status IN ('active', 'suspended', 'closed')"),
        ("users", "risk_profile", "risk_profile IN ('low', 'medium', 'high')"),
        ("cards", "card_type", "card_type IN ('debit', 'credit', 'prepaid')"),
        ("cards", "card_status", "card_status IN ('active', 'blocked', 'expired')"),
        ("merchants", "merchant_risk", "risk_score BETWEEN 0 AND 1"),
        ("transactions", "transaction_status", "transaction_status IN ('completed', 'pending', 'declined', 'reversed')"),
        ("transactions", "transaction_amount", "transaction_amount > 0"),
        ("alerts", "alert_status", "alert_status IN ('open', 'acknowledged', 'false_positive', 'confirmed_fraud')"),
        ("alerts", "alert_type", "alert_type IN ('impossible_travel', 'structuring_aml', 'blacklisted_merchant', "
         "'high_risk_mcc', 'velocity_breach', 'unknown_device', 'other')"),
        ("user_devices", "device_type", "device_type IN ('mobile', 'laptop', 'tablet', 'desktop', 'unknown')"),
        ("authentication", "role", "role IN ('super_admin', 'compliance_officer', 'bank_employee')"),
        ("authentication", "failed_attempts", "failed_attempts >= 0"),
        ("authentication", "inactive_has_date", "is_active = 1 OR deactivated_at IS NOT NULL"),
        ("authentication_audit_log", "event_type", "event_type IN ('login_success', 'login_failure', 'account_locked', "
         "'account_unlocked', 'logout', 'session_expired', 'password_changed', 'mfa_success', 'mfa_failure', "
         "'username_not_found', 'inactive_account', 'forced_logout')"),
        ("authentication_audit_log", "login_status", "login_status IN ('success', 'failure')"),
    )
]

ORPHANS = [
    _found(table, *_KEYS[table], column,
           f"{column} IS NOT NULL AND {column} NOT IN (SELECT {_KEYS[parent][1]} FROM {_KEYS[parent][0]})", "column_name")
    for table, column, parent in (
        ("cards", "user_id", "users"), ("transactions", "card_id", "cards"),
        ("transactions", "merchant_id", "merchants"), ("transactions", "user_id", "users"),
        ("alerts", "transaction_id", "transactions"), ("alerts", "card_id", "cards"), ("alerts", "user_id", "users"),
        ("transaction_audit_log", "transaction_id", "transactions"), ("user_known_locations", "user_id", "users"),
        ("user_devices", "user_id", "users"), ("authentication_audit_log", "auth_id", "authentication"),
    )
]

# Required columns: those the adapted table has, and those it lacks, which every row misses.
NULLS = [
    _found(table, *_KEYS[table], column, f"{column} IS NULL" if there else "TRUE", "column_name")
    for table, present, absent in (
        ("users", "user_id email account_status risk_profile", "account_created_at"),
        ("cards", "card_id user_id card_type card_status", "card_number_hash issued_date"),
        ("merchants", "merchant_id merchant_name risk_score is_blacklisted fraud_report_count", "created_at"),
        ("transactions", "transaction_id card_id merchant_id user_id transaction_amount currency_code "
         "transaction_timestamp transaction_status", ""),
        ("alerts", "alert_id card_id user_id alert_type alert_status created_at", ""),
        ("transaction_audit_log", "audit_id changed_at", ""),
        ("user_known_locations", "location_id user_id frequency_count", ""),
        ("user_devices", "device_id user_id is_trusted", "first_seen"),
        ("authentication", "auth_id employee_id role is_active failed_attempts must_change_password",
         "username mfa_enabled created_at"),
        ("authentication_audit_log", "log_id event_type login_status event_timestamp", "username_attempted mfa_used"),
    )
    for there, columns in ((True, present), (False, absent))
    for column in columns.split()
]

LENGTHS = [
    _found(table, *_KEYS[table], column, f"length({column}) > {most}", "column_name")
    for table, column, most in (
        ("users", "first_name", 100), ("users", "last_name", 100), ("users", "email", 150),
        ("users", "account_status", 20), ("users", "risk_profile", 20), ("users", "country_iso_code", 2),
        ("cards", "card_type", 20), ("cards", "card_status", 20), ("merchants", "merchant_name", 255),
        ("merchants", "merchant_category_code", 10), ("merchants", "country_iso_code", 2),
        ("transactions", "currency_code", 3), ("transactions", "merchant_country", 2),
        ("transactions", "merchant_mcc", 10), ("transactions", "transaction_status", 20),
        ("transactions", "ip_address", 45), ("alerts", "alert_type", 100), ("alerts", "alert_status", 30),
        ("transaction_audit_log", "previous_status", 50), ("transaction_audit_log", "new_status", 50),
        ("transaction_audit_log", "changed_by", 255), ("user_known_locations", "city", 100),
        ("user_known_locations", "country_iso_code", 2), ("user_devices", "device_id", 255),
        ("user_devices", "device_type", 50), ("authentication", "employee_id", 50), ("authentication", "role", 50),
        ("authentication_audit_log", "employee_id", 50), ("authentication_audit_log", "event_type", 50),
        ("authentication_audit_log", "login_status", 20), ("authentication_audit_log", "ip_address", 45),
        ("authentication_audit_log", "geo_country", 2),
    )
]


def oracle() -> dict[str, str]:
    return {
        "src1_scan": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
        "src2_ingest": sql(
            """SELECT transaction_id, CAST(card_id AS INT) AS card_id, CAST(user_id AS INT) AS user_id,
            transaction_amount, transaction_id % 2 = 1 AS is_online, CAST(NULL AS VARCHAR) AS device_id,
            transaction_timestamp FROM transactions"""
        ),
        "src3_fill_defaults": sql(
            """SELECT 1000 + row_number() OVER (ORDER BY transaction_timestamp, card_id, merchant_id, transaction_amount)
            AS transaction_id, CAST(card_id AS INT) AS card_id, 'USD' AS currency_code,
            CASE WHEN transaction_id % 10 = 0 THEN 'completed' ELSE transaction_status END AS transaction_status,
            transaction_timestamp FROM transactions"""
        ),
        "src3_sliced": sql(
            """SELECT transaction_id, user_id, transaction_timestamp, 7 + row_number() OVER
            (ORDER BY transaction_timestamp, transaction_id) AS place FROM transactions"""
        ),
        "src3_ties": sql(
            """SELECT transaction_id, user_id, 7 + row_number() OVER (ORDER BY
            CASE WHEN transaction_id % 2 = 0 THEN 500 ELSE user_id END, transaction_id) AS place FROM transactions"""
        ),
        "snk1_append": sql(
            """SELECT card_id, user_id, alert_type, risk_score, alert_message, alert_status, investigation_notes FROM raised
            UNION ALL SELECT card_id, user_id, 'blacklisted_merchant', CAST(merchant_risk AS DECIMAL(14,2)), alert_message,
              'open', investigation_notes FROM offences""",
            report=REPORT, raised=RAISED, offences=BLOCKED_ROWS,
        ),
        "snk2_upsert_open_alerts": sql(
            SNAPSHOT, judged=TRAILING,
            hits=structuring_hits("card_id", "total", "n"),
            **upsert(False, with_ids=True),
        ),
        "snk3_update_from": sql(
            """SELECT u.user_id, CASE WHEN a.user_id IS NULL THEN risk_profile ELSE 'high' END AS risk_profile,
            CASE WHEN a.user_id IS NULL THEN account_status ELSE 'suspended' END AS account_status FROM users u
            LEFT JOIN (SELECT DISTINCT user_id FROM alerts WHERE alert_status = 'confirmed_fraud') a
            ON a.user_id = u.user_id"""
        ),
        "snk4_delete_keys": sql(
            """SELECT card_id, user_id FROM cards WHERE user_id NOT IN
            (SELECT user_id FROM users WHERE account_status = 'closed')"""
        ),
        "snk5_shared_report": sql(
            f"""SELECT r.user_id, aggregate_total, CASE WHEN n.user_id IS NULL THEN 0 ELSE 1 END AS raised, {SUMMARY}
            FROM report r LEFT JOIN raised n ON n.user_id = r.user_id""",
            report=REPORT, raised=RAISED,
        ),
        "dq1_check_violations": sql(
            """SELECT auth_id, 'inactive_has_date' AS rule FROM authentication
            WHERE is_active = 0 AND deactivated_at IS NULL"""
        ),
        "dq1_declared": sql(" UNION ALL ".join(CHECKS)),
        "dq3_declared": sql(" UNION ALL ".join(ORPHANS)),
        "dq4_declared": sql(" UNION ALL ".join(NULLS)),
        "dq6_declared": sql(" UNION ALL ".join(LENGTHS)),
        "dq2_duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
            GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
        "dq3_orphans": sql(
            """SELECT log_id, auth_id FROM login_log WHERE auth_id IS NOT NULL AND auth_id NOT IN
            (SELECT auth_id FROM authentication WHERE is_active = 1)"""
        ),
        "dq4_null_violations": sql(
            """SELECT transaction_id, 'ip_address' AS column_name FROM transactions WHERE ip_address IS NULL
            UNION ALL SELECT transaction_id, 'latitude' FROM transactions WHERE latitude IS NULL
            UNION ALL SELECT transaction_id, 'longitude' FROM transactions WHERE longitude IS NULL"""
        ),
        "dq5_cascade": sql(
            """SELECT k AS auth_id, count(*) AS events, (SELECT count(*) FROM cards WHERE user_id NOT IN
              (SELECT user_id FROM users WHERE account_status = 'closed')) AS cards_left FROM (
            SELECT CASE WHEN auth_id IN (SELECT auth_id FROM authentication WHERE is_active = 0) THEN NULL
              ELSE auth_id END AS k FROM login_log) x GROUP BY k"""
        ),
        "dq5_graph": sql(
            _go("free"), closed=CLOSED, closed_cards=CLOSED_CARDS, way=IN_THE_WAY,
            free="SELECT user_id FROM closed WHERE user_id NOT IN (SELECT user_id FROM way)",
        ),
        "dq5_graph_blocked": sql(
            """SELECT 'users' AS root_table, CAST(user_id AS VARCHAR) AS root_key, table_name, column_name, count(*) AS n
            FROM way GROUP BY user_id, table_name, column_name""",
            closed=CLOSED, closed_cards=CLOSED_CARDS, way=IN_THE_WAY,
        ),
        "dq5_graph_all": sql(
            _go(
                "closed", transactions="transaction_id IN (SELECT transaction_id FROM gone)",
                alerts="user_id IN (SELECT user_id FROM closed) OR card_id IN (SELECT card_id FROM closed_cards) "
                "OR transaction_id IN (SELECT transaction_id FROM gone)",
                transaction_audit_log="transaction_id IN (SELECT transaction_id FROM gone)",
            ),
            closed=CLOSED, closed_cards=CLOSED_CARDS, gone=GONE_PAYMENTS,
        ),
        "dq5_graph_after": sql(
            """SELECT log_id, CASE WHEN auth_id IN (SELECT auth_id FROM authentication WHERE is_active = 0) THEN NULL
              ELSE auth_id END AS auth_id, 'login' AS kind FROM login_log
            UNION ALL SELECT audit_id, NULL, 'payment' FROM audit WHERE transaction_id IS NULL
              OR transaction_id NOT IN (SELECT transaction_id FROM gone)""",
            closed=CLOSED, closed_cards=CLOSED_CARDS, gone=GONE_PAYMENTS,
        ),
        "dq6_widened": sql(
            " UNION ALL ".join(LENGTHS),
            wide_users="SELECT * REPLACE (repeat(email, 8) AS email) FROM users",
            wide_merchants="SELECT * REPLACE ('X' || country_iso_code AS country_iso_code) FROM merchants",
        ).replace("FROM users WHERE length", "FROM wide_users WHERE length").replace(
            "FROM merchants WHERE length", "FROM wide_merchants WHERE length"
        ),
        "dq6_length_violations": sql(
            """SELECT user_id, 'email' AS column_name FROM users WHERE length(email) > 18
            UNION ALL SELECT user_id, 'last_name' FROM users WHERE length(last_name) > 9"""
        ),
        "p1_select_cols": sql("SELECT user_id, email FROM users"),
        "p2_full_name": sql(f"SELECT user_id, {NAME} AS full_name FROM users u"),
        "p3_coords_text": sql(
            """SELECT transaction_id, CAST(latitude AS VARCHAR) || ', ' || CAST(longitude AS VARCHAR) AS coordinates
            FROM transactions"""
        ),
        "p5_label": sql(
            """SELECT transaction_id, CASE WHEN transaction_amount >= 10000 THEN 'large'
            WHEN transaction_amount >= 1000 THEN 'medium' ELSE 'small' END AS size_label, 'seen' AS flag FROM transactions"""
        ),
        "p6_map_case": sql(
            """SELECT auth_id, CASE role WHEN 'super_admin' THEN '10.0.0.1' WHEN 'compliance_officer' THEN '10.0.0.2'
            ELSE '192.168.1.10' END AS address FROM authentication"""
        ),
        "p9_in_lists": sql(
            """SELECT transaction_id, transaction_status, merchant_country FROM transactions
            WHERE (transaction_status IN ('pending', 'declined') OR merchant_country NOT IN ('US', 'RU'))
            AND currency_code <> 'EUR'"""
        ),
        "p12_optional_eq": sql("SELECT merchant_id, country_iso_code FROM merchants WHERE country_iso_code = 'RU'"),
        "p14_since": sql(
            f"""SELECT transaction_id, transaction_timestamp FROM transactions
            WHERE transaction_timestamp >= {AS_OF} - INTERVAL 72 HOUR AND ip_address IS NOT NULL"""
        ),
        "j4_left_condition": sql(
            """SELECT u.user_id, a.alert_id FROM users u LEFT JOIN alerts a
            ON a.user_id = u.user_id AND a.alert_status = 'open'"""
        ),
        "j6_anti_join": sql("SELECT user_id FROM users WHERE user_id NOT IN (SELECT user_id FROM alerts)"),
        "j7_semi_join": sql(
            """SELECT card_id, user_id FROM cards c WHERE EXISTS (SELECT 1 FROM alerts a
            WHERE a.user_id = c.user_id AND a.alert_status = 'open')"""
        ),
        "j8_prev_eligible": sql(
            """SELECT transaction_id, prev_id, prev_merchant FROM (
            SELECT l.transaction_id, p.transaction_id AS prev_id, p.merchant_id AS prev_merchant,
              row_number() OVER (PARTITION BY l.transaction_id
                ORDER BY p.transaction_timestamp DESC, p.transaction_id DESC) AS pick
            FROM transactions l LEFT JOIN transactions p ON p.user_id = l.user_id
              AND p.transaction_timestamp < l.transaction_timestamp AND p.transaction_status <> 'reversed') x
            WHERE pick = 1"""
        ),
        "ag5_distinct_count": sql(
            """SELECT merchant_country, count(DISTINCT user_id) AS users,
            CAST(sum(CASE WHEN transaction_status = 'completed' THEN 1 ELSE 0 END) AS BIGINT) AS completed
            FROM transactions GROUP BY merchant_country"""
        ),
        "ag5_sketches": sql(
            """SELECT merchant_id, count(user_id) AS n, count(DISTINCT user_id) AS customers, TRUE AS within_error
            FROM transactions WHERE CAST(transaction_timestamp AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-17'
            GROUP BY merchant_id"""
        ),
        "st2_versions": sql(
            """SELECT transaction_id, batch_id, batch_id IN (SELECT batch_id FROM met WHERE bad) AS rejected FROM met""",
            versions=VERSIONS, met=MET,
        ),
        "st2_versions_rows": sql(
            "SELECT transaction_id, merchant_id, bad AS rejected FROM met", versions=VERSIONS, met=MET
        ),
        "ag6_text_list": sql(
            "SELECT user_id, string_agg(card_type, ', ' ORDER BY card_type) AS card_types FROM cards GROUP BY user_id"
        ),
        "ag8_global_aggregate": sql(
            """SELECT count(*) AS n, CAST(sum(transaction_amount) AS DECIMAL(25,2)) AS total,
            CAST(round(sum(transaction_amount) / count(*), 2) AS DECIMAL(19,2)) AS mean,
            min(transaction_timestamp) AS first_at, max(transaction_timestamp) AS last_at
            FROM transactions WHERE transaction_status = 'completed'"""
        ),
        "w1_lag_per_card": sql(
            """SELECT transaction_id, lag(transaction_timestamp) OVER w AS prev_timestamp,
            lag(merchant_country) OVER w AS prev_country FROM transactions
            WINDOW w AS (PARTITION BY card_id ORDER BY transaction_timestamp, transaction_id)"""
        ),
        "w2_trailing_count": sql(
            """SELECT transaction_id, user_id, transaction_timestamp, count(*) OVER (PARTITION BY user_id
            ORDER BY transaction_timestamp RANGE BETWEEN INTERVAL 1440 MINUTE PRECEDING AND CURRENT ROW) AS n_in_day
            FROM transactions"""
        ),
        "o3_latest_before": sql(
            """SELECT user_id, transaction_id, transaction_timestamp FROM (SELECT *, row_number() OVER
            (PARTITION BY user_id ORDER BY transaction_timestamp DESC, transaction_id DESC) AS pick
            FROM transactions WHERE transaction_timestamp < TIMESTAMP '2024-01-15 00:00:00') x WHERE pick = 1"""
        ),
        "o4_order_by_severity": sql(
            """SELECT user_id, risk_profile, CASE risk_profile WHEN 'high' THEN 1 WHEN 'medium' THEN 2 ELSE 3 END
            AS risk_rank FROM users"""
        ),
        "f2_round_and_cast": sql(
            """SELECT transaction_id, CAST(round(CAST(transaction_amount / 7 AS DECIMAL(20,6)), 2) AS DECIMAL(15,2)) AS rounded,
            CAST(trunc(transaction_amount) AS INT) AS whole, CAST(transaction_amount AS VARCHAR) AS amount_text
            FROM transactions"""
        ),
        "f5_boundary_diff": sql(
            "SELECT transaction_id, "
            + ", ".join(
                f"date_diff('{u}', TIMESTAMP '2024-01-01 00:00:30.5', transaction_timestamp) AS {u}s"
                for u in ("second", "minute", "hour", "day")
            )
            + " FROM transactions"
        ),
        "f4_shift_and_text": sql(
            """SELECT transaction_id, transaction_timestamp - INTERVAL 48 HOUR AS two_days_before,
            transaction_timestamp + INTERVAL 30 MINUTE AS half_hour_after,
            strftime(transaction_timestamp, '%Y-%m-%d %H:%M:%S') AS at_text,
            coalesce(ip_address, 'N/A') || chr(13) || chr(10) || merchant_mcc AS two_lines FROM transactions"""
        ),
        "f6_now": sql(
            f"""SELECT transaction_id, CAST(current_timestamp AS TIMESTAMP) > transaction_timestamp AS before_now,
            {AS_OF} <= transaction_timestamp AS after_clock FROM transactions"""
        ),
        "f11_seeded_mod": sql(
            """SELECT auth_id, CAST('0x' || substr(md5(auth_id || ':5'), 1, 8) AS BIGINT) % 72 AS hours_ago
            FROM authentication"""
        ),
        "u1_haversine_km": sql(
            f"SELECT transaction_id, CAST(round({km('hlat', 'hlon', 'lat', 'lon')}, 2) AS DECIMAL(12,2)) AS km FROM home",
            home=HOME,
        ),
        "u6_planar_km": sql(
            f"SELECT transaction_id, CAST(round({planar('hlat', 'hlon', 'lat', 'lon')}, 2) AS DECIMAL(12,2)) AS km FROM home",
            home=HOME,
        ),
        "u2_u3_structuring_score": sql(
            f"""SELECT user_id, {structuring_score('total', '200000', 'n')} AS score,
            {structuring_severity('total', '200000')} AS severity FROM (SELECT user_id,
            CAST(sum(transaction_amount) AS DECIMAL(25,2)) AS total, count(*) AS n FROM transactions GROUP BY user_id) x"""
        ),
        "u4_u5_merchant_flag": sql(
            f"""SELECT merchant_id, merchant_category_code IN ({HIGH_RISK}) AS is_high_risk,
            {risk_flag('is_blacklisted = 1', 'merchant_category_code', 'risk_score')} AS risk_flag,
            CAST(CASE WHEN fraud_report_count > 1 THEN fraud_report_count / 10.0 ELSE fraud_report_count END
              AS DECIMAL(4,2)) AS reports_share FROM merchants"""
        ),
        "u7_u8_travel_score": sql(
            f"""SELECT transaction_id, ratio, {travel_risk('ratio')} AS risk, {travel_severity('ratio')} AS severity
            FROM (SELECT transaction_id, CAST(transaction_amount * 0.0002 AS DECIMAL(10,2)) AS ratio FROM transactions) x
            WHERE ratio >= 1"""
        ),
        "u9_account_health": sql(
            f"SELECT auth_id, {health(True)} AS full_health, {health(False)} AS short_health FROM authentication"
        ),
        "u_sql_functions": sql(
            f"""SELECT g.user_id, CAST(round({km('l.latitude', 'l.longitude', '40.7128', '-74.0060')}, 2) AS DECIMAL(12,2)) AS km,
            CAST(round({planar('l.latitude', 'l.longitude', '40.7128', '-74.0060')}, 2) AS DECIMAL(12,2)) AS flat_km,
            {structuring_severity('total', '200000')} AS severity, {structuring_score('total', '200000', 'n')} AS score,
            merchant_category_code IN ({HIGH_RISK}) AS is_high_risk,
            {risk_flag('is_blacklisted = 1', 'merchant_category_code', 'risk_score')} AS risk_flag,
            CASE WHEN ratio >= 1 THEN {travel_risk('ratio')} END AS travel_score, {travel_severity('ratio')} AS travel_grade,
            {health(True)} AS health FROM (SELECT *, CAST(total / 50000 AS DECIMAL(10,2)) AS ratio FROM
              (SELECT user_id, CAST(sum(transaction_amount) AS DECIMAL(25,2)) AS total, count(*) AS n,
               max(merchant_id) AS merchant_id FROM transactions GROUP BY user_id) s) g
            JOIN locations l ON l.user_id = g.user_id JOIN authentication a ON a.auth_id = g.user_id
            JOIN merchants m ON m.merchant_id = g.merchant_id"""
        ),
        "r1_1_geo_planar_pairs": sql(
            f"""SELECT p.transaction_id, {NAME} AS user_name, p.card_id, pc AS location_before,
            merchant_country AS location_after, CAST(round(km, 2) AS DECIMAL(12,2)) AS distance_km, minutes_apart,
            ip_address, '{FLAG_TRAVEL}' AS flag FROM (
              SELECT *, {planar('plat', 'plon', 'latitude', 'longitude')} AS km,
                date_diff('minute', pts, transaction_timestamp) AS minutes_apart FROM lagged) p
            JOIN users u ON u.user_id = p.user_id WHERE km > 500 AND minutes_apart < 60""",
            lagged="""SELECT *, lag(transaction_timestamp) OVER w AS pts, lag(latitude) OVER w AS plat,
              lag(longitude) OVER w AS plon, lag(merchant_country) OVER w AS pc FROM transactions
              WINDOW w AS (PARTITION BY card_id ORDER BY transaction_timestamp, transaction_id)""",
        ),
        "r1_2_geo_velocity": sql(GEO_BOTH, **GEO_STEPS),
        "r1_3_geo_velocity_declining": sql(GEO_BOTH, **walk_steps()),
        "r1_2_sliced": sql(GEO_BOTH, **GEO_STEPS),
        "r1_3_sliced": sql(GEO_BOTH, **walk_steps()),
        "r1_4_geo_velocity_stream": sql(GEO_SELECT, **walk_steps()),
        "r1_5_evidence_rows": sql(
            """SELECT t.transaction_id AS original_transaction_id, t.user_id, t.card_id, t.transaction_amount,
            'reversed' AS transaction_status, t.transaction_timestamp FROM transactions t
            JOIN measured m ON m.id = t.transaction_id WHERE m.speed > 900""",
            **GEO_STEPS,
        ),
        "r1_6_apply_declines": sql(
            """SELECT t.transaction_id, CASE WHEN m.id IS NULL THEN t.transaction_status ELSE 'declined' END
            AS transaction_status FROM transactions t LEFT JOIN (SELECT id FROM measured WHERE speed > 900) m
            ON m.id = t.transaction_id""",
            **walk_steps(),
        ),
        "r1_7_geo_alerts": sql(
            SNAPSHOT, **walk_steps(),
            hits=f"""SELECT id AS transaction_id, card_id, user_id, 'impossible_travel' AS alert_type,
              {travel_risk('ratio')} AS risk_score, {GEO_MESSAGE} AS alert_message FROM measured WHERE speed > 900""",
            **upsert(True),
        ),
        "r1_8_geo_audit": sql(
            f"""SELECT id AS transaction_id, CASE WHEN hit THEN 'completed' END AS previous_status,
            CASE WHEN hit THEN 'reversed' ELSE 'completed' END AS new_status, 'geo' AS changed_by, {AS_OF} AS changed_at,
            CASE WHEN hit THEN {GEO_MESSAGE} || ', severity ' || {travel_severity('ratio')}
              WHEN pid IS NULL THEN 'No violation: no prior point' ELSE 'No violation: within limit' END AS change_reason
            FROM (SELECT *, coalesce(speed > 900, FALSE) AS hit FROM measured) x""",
            **GEO_STEPS,
        ),
        "r2_1_structuring_band": sql(
            f"""SELECT s.user_id, {NAME} AS user_name, card_id, transaction_id, transaction_amount,
            transaction_timestamp, txn_count_in_window, '{FLAG_STRUCTURING}' AS flag FROM (
              SELECT *, count(*) OVER (PARTITION BY user_id ORDER BY transaction_timestamp
                RANGE BETWEEN INTERVAL 2880 MINUTE PRECEDING AND CURRENT ROW) AS txn_count_in_window FROM transactions
              WHERE transaction_amount BETWEEN 1000 AND 6000 AND transaction_status = 'completed') s
            JOIN users u ON u.user_id = s.user_id WHERE txn_count_in_window >= 3"""
        ),
        "r2_2_structuring_band_recent": sql(
            f"""SELECT t.user_id, {NAME} AS user_name, count(*) AS txn_count,
            CAST(sum(transaction_amount) AS DECIMAL(25,2)) AS total_amount, min(transaction_amount) AS min_amount,
            max(transaction_amount) AS max_amount, min(transaction_timestamp) AS window_start,
            max(transaction_timestamp) AS window_end, '{FLAG_STRUCTURING}' AS flag
            FROM transactions t JOIN users u ON u.user_id = t.user_id
            WHERE transaction_amount BETWEEN 1000 AND 6000 AND transaction_status = 'completed'
              AND transaction_timestamp >= {AS_OF} - INTERVAL 48 HOUR
            GROUP BY t.user_id, u.first_name, u.last_name HAVING count(*) >= 3"""
        ),
        "r2_1_defaults": sql(
            f"""SELECT s.user_id, {NAME} AS user_name, card_id, transaction_id, transaction_amount,
            transaction_timestamp, txn_count_in_window, '{FLAG_STRUCTURING}' AS flag FROM (
              SELECT *, count(*) OVER (PARTITION BY user_id ORDER BY transaction_timestamp
                RANGE BETWEEN INTERVAL 60 MINUTE PRECEDING AND CURRENT ROW) AS txn_count_in_window FROM bursts
              WHERE transaction_amount BETWEEN 2000 AND 3000 AND transaction_status = 'completed') s
            JOIN users u ON u.user_id = s.user_id WHERE txn_count_in_window >= 3""",
            bursts=BURSTS,
        ),
        "r2_2_defaults": sql(
            f"""SELECT t.user_id, {NAME} AS user_name, count(*) AS txn_count,
            CAST(sum(transaction_amount) AS DECIMAL(25,2)) AS total_amount, min(transaction_amount) AS min_amount,
            max(transaction_amount) AS max_amount, min(transaction_timestamp) AS window_start,
            max(transaction_timestamp) AS window_end, '{FLAG_STRUCTURING}' AS flag
            FROM bursts t JOIN users u ON u.user_id = t.user_id
            WHERE transaction_amount BETWEEN 2000 AND 3000 AND transaction_status = 'completed'
              AND transaction_timestamp >= {AS_OF} - INTERVAL 1 HOUR
            GROUP BY t.user_id, u.first_name, u.last_name HAVING count(*) >= 3""",
            bursts=BURSTS,
        ),
        "r2_3_structuring_report": sql(REPORT),
        "r2_4_structuring_new_alerts": sql("SELECT * FROM raised", report=REPORT, raised=RAISED),
        "r2_5_structuring_summary": sql(
            f"SELECT {SUMMARY}",
            report=REPORT, raised=RAISED,
        ),
        "r2_6_structuring_on_insert": sql(
            f"""SELECT transaction_id, user_id, txn_count, aggregate_total, violation,
            CASE WHEN violation THEN {structuring_score('aggregate_total', '10000', 'txn_count')} END AS risk_score,
            CASE WHEN violation THEN {structuring_severity('aggregate_total', '10000')} END AS severity, max_card_id
            FROM judged""",
            judged=ON_INSERT,
        ),
        "r2_7_structuring_trailing": sql(
            f"""SELECT transaction_id, user_id, n AS txn_count, total AS aggregate_total, violation,
            {structuring_score('total', '10000', 'n')} AS risk_score,
            {structuring_severity('total', '10000')} AS severity FROM judged WHERE violation""",
            judged=TRAILING,
        ),
        "r2_7_sliced": sql(
            f"""SELECT transaction_id, user_id, n AS txn_count, total AS aggregate_total, violation,
            {structuring_score('total', '10000', 'n')} AS risk_score,
            {structuring_severity('total', '10000')} AS severity FROM judged WHERE violation""",
            judged=TRAILING,
        ),
        "r2_8_structuring_alerts": sql(
            SNAPSHOT, judged=ON_INSERT,
            hits=structuring_hits("max_card_id", "aggregate_total", "txn_count"),
            **upsert(False),
        ),
        "r2_8_structuring_audit": sql(
            f"""SELECT j.transaction_id, CASE WHEN violation THEN 'completed' END AS previous_status,
            'completed' AS new_status, 'structuring' AS changed_by, {AS_OF} AS changed_at,
            CASE WHEN NOT violation THEN 'No violation' WHEN o.user_id IS NOT NULL OR transaction_id > first_id
              THEN 'Existing alert updated' ELSE 'New alert raised' END || ': $' || CAST(aggregate_total AS VARCHAR)
              || ' in ' || CAST(txn_count AS VARCHAR) || ' payments' || CASE WHEN violation THEN ', risk ' ||
              CAST({score4(structuring_score('aggregate_total', '10000', 'txn_count'))} AS VARCHAR) ELSE '' END AS change_reason
            FROM judged j LEFT JOIN (SELECT user_id, min(transaction_id) AS first_id FROM judged WHERE violation
              GROUP BY user_id) f ON f.user_id = j.user_id
            LEFT JOIN (SELECT DISTINCT user_id FROM alerts WHERE alert_type = 'structuring_aml'
              AND alert_status = 'open') o ON o.user_id = j.user_id""",
            judged=ON_INSERT,
        ),
        "r3_1_merchant_screen": sql(
            f"""SELECT transaction_id, {NAME} AS user_name, merchant_name, merchant_category_code, transaction_amount,
            transaction_timestamp, ip_address, risk_score, is_blacklisted, fraud_report_count,
            CASE WHEN is_blacklisted = 1 THEN '{FLAG_BLACKLISTED}' WHEN merchant_category_code IN ({SCREEN})
              THEN '{FLAG_MCC}' ELSE 'MONITOR' END AS risk_flag
            FROM transactions t JOIN users u ON u.user_id = t.user_id JOIN merchants m ON m.merchant_id = t.merchant_id
            WHERE is_blacklisted = 1 OR merchant_category_code IN ({SCREEN})"""
        ),
        "r3_2_block_batch": sql(
            """SELECT transaction_id, batch_id, batch_id IN (SELECT batch_id FROM blocked) AS rejected FROM transactions""",
            blocked=BLOCKED,
        ),
        "r3_2_block_rows": sql(
            """SELECT transaction_id, t.merchant_id FROM transactions t JOIN merchants m
            ON m.merchant_id = t.merchant_id WHERE is_blacklisted = 1"""
        ),
        "r3_3_blocked_alerts": sql(
            f"""SELECT CAST(NULL AS BIGINT) AS transaction_id, card_id, user_id, 'blacklisted_merchant' AS alert_type,
            CAST(merchant_risk AS DECIMAL(14,2)) AS risk_score, alert_message, 'open' AS alert_status, investigation_notes,
            {AS_OF} AS created_at, merchant_id, merchant_name, merchant_category_code, fraud_report_count,
            transaction_amount, currency_code, merchant_mcc, merchant_country, ip_address, latitude, longitude
            FROM offences""",
            offences=BLOCKED_ROWS,
        ),
        "r9_blocked_alerts": sql(
            f"""SELECT CAST(NULL AS BIGINT) AS transaction_id, card_id, user_id, 'blacklisted_merchant' AS alert_type,
            CAST(merchant_risk AS DECIMAL(14,2)) AS risk_score, alert_message, 'open' AS alert_status, investigation_notes,
            {AS_OF} AS created_at, merchant_id, merchant_name, merchant_category_code, fraud_report_count,
            transaction_amount, currency_code, merchant_mcc, merchant_country, ip_address, latitude, longitude
            FROM offences""",
            offences=BLOCKED_ROWS,
        ),
        "r3_4_blocked_audit": sql(
            f"""SELECT CAST(NULL AS BIGINT) AS transaction_id, CAST(NULL AS VARCHAR) AS previous_status,
            'blocked' AS new_status, 'merchant' AS changed_by, {AS_OF} AS changed_at,
            concat('User ', user_id, ', card ', card_id, ', merchant ', t.merchant_id, ' ', merchant_name, ' of risk ',
              risk_score, ', $', transaction_amount, ', IP ', coalesce(ip_address, 'N/A')) AS change_reason
            FROM transactions t JOIN merchants m ON m.merchant_id = t.merchant_id WHERE is_blacklisted = 1"""
        ),
        "r3_5_block_updates": sql(
            """SELECT transaction_id, CASE WHEN changed AND NOT refused THEN merchant_id + 1 ELSE merchant_id END AS merchant_id,
            CASE WHEN changed AND NOT refused THEN 'completed' ELSE transaction_status END AS transaction_status,
            FALSE AS refused FROM gated
            UNION ALL SELECT transaction_id, merchant_id + 1, 'completed', TRUE FROM gated WHERE changed AND refused""",
            gated="""SELECT *, transaction_status = 'pending' AS changed, batch_id IN (SELECT c.batch_id FROM transactions c
                JOIN merchants m ON m.merchant_id = c.merchant_id + 1
                WHERE c.transaction_status = 'pending' AND m.is_blacklisted = 1) AS refused FROM transactions""",
        ),
        "r3_6_flag_high_risk_mcc": sql(
            "SELECT transaction_id, merchant_id, flagged, risk_flag, risk_score FROM judged", judged=MCC_JUDGED
        ),
        "r3_7_mcc_alerts": sql(
            SNAPSHOT, judged=MCC_JUDGED,
            hits=f"""SELECT transaction_id, card_id, user_id, 'high_risk_mcc' AS alert_type,
              CAST(risk_score AS DECIMAL(14,2)) AS risk_score, {MCC_PAYMENT} || ' at ' || {text('merchant_name')} AS alert_message
              FROM judged WHERE flagged""",
            **upsert(False),
        ),
        "r3_7_mcc_audit": sql(
            f"""SELECT transaction_id, CASE WHEN flagged THEN 'completed' END AS previous_status,
            'completed' AS new_status, 'merchant' AS changed_by, {AS_OF} AS changed_at,
            CASE WHEN flagged THEN 'Flagged' ELSE 'Clear' END || ': ' || risk_flag || ', category ' || merchant_mcc || ', $'
              || CAST(transaction_amount AS VARCHAR) || ' at ' || {text('merchant_name')} || ' of risk ' || {text('risk_score')}
              AS change_reason FROM judged""",
            judged=MCC_JUDGED,
        ),
        "r3_8_merchant_risk_profile": sql(
            f"""SELECT {PROFILE_COLUMNS}, count(t.transaction_id) AS total_transactions,
            CAST(coalesce(sum(t.transaction_amount), 0) AS DECIMAL(25,2)) AS total_volume,
            CAST(coalesce(max(t.transaction_amount), 0) AS DECIMAL(15,2)) AS largest_transaction,
            CAST(coalesce(sum(t.transaction_amount) / nullif(count(t.transaction_id), 0), 0) AS DECIMAL(19,6)) AS avg_transaction,
            count(DISTINCT a.alert_id) AS alerts_raised FROM merchants m
            LEFT JOIN transactions t ON t.merchant_id = m.merchant_id
            LEFT JOIN alerts a ON a.transaction_id = t.transaction_id GROUP BY ALL"""
        ),
        "r3_8_merchant_risk_profile_once": sql(
            f"""SELECT {PROFILE_COLUMNS}, count(t.transaction_id) AS total_transactions,
            CAST(coalesce(sum(t.transaction_amount), 0) AS DECIMAL(25,2)) AS total_volume,
            CAST(coalesce(max(t.transaction_amount), 0) AS DECIMAL(15,2)) AS largest_transaction,
            CAST(coalesce(sum(t.transaction_amount) / nullif(count(t.transaction_id), 0), 0) AS DECIMAL(19,6)) AS avg_transaction,
            CAST(coalesce(sum(a.n), 0) AS BIGINT) AS alerts_raised FROM merchants m
            LEFT JOIN transactions t ON t.merchant_id = m.merchant_id
            LEFT JOIN (SELECT transaction_id, count(DISTINCT alert_id) AS n FROM alerts GROUP BY transaction_id) a
              ON a.transaction_id = t.transaction_id GROUP BY ALL"""
        ),
        **{
            name: sql(
                f"""SELECT {PROFILE_COLUMNS}, CAST(coalesce(sum(t.w), 0) AS BIGINT) AS total_transactions,
                CAST(coalesce(sum(t.w * t.amount), 0) AS DECIMAL(25,2)) AS total_volume,
                CAST(coalesce(max(t.amount), 0) AS DECIMAL(15,2)) AS largest_transaction,
                CAST(coalesce(sum(t.w * t.amount) / nullif(sum(t.w), 0), 0) AS DECIMAL(19,6)) AS avg_transaction,
                CAST(coalesce(sum(t.raised), 0) AS BIGINT) AS alerts_raised FROM merchants m
                LEFT JOIN (SELECT *, {weight} AS w FROM changed) t ON t.mid = m.merchant_id GROUP BY ALL""",
                changed=CHANGED,
            )
            for name, weight in (("r3_8_incremental", "greatest(raised, 1)"), ("r3_8_incremental_once", "1"))
        },
        "r9_detect_all": sql(DETECTED, **detection()),
        "r9_alerts": sql(SNAPSHOT, **detection(), hits=HITS, **upsert(GEO_ONLY)),
        "r9_audit": sql(AUDIT, **detection()),
        "r9_notes": sql(NOTES, **detection()),
        "r9_rejected": sql(
            """SELECT transaction_id, batch_id, merchant_id, transaction_amount FROM transactions
            WHERE batch_id IN (SELECT batch_id FROM blocked)""",
            blocked=BLOCKED,
        ),
        # A part of a stream goes by the latest payment it holds.
        "st1_detect_stream": sql(DETECTED, **detection("max(transaction_timestamp)", IN_ORDER)),
        "st1_alerts": sql(
            """SELECT transaction_id, card_id, user_id, alert_type, risk_score, alert_message, alert_status FROM kept
            UNION ALL SELECT transaction_id, card_id, user_id, alert_type, risk_score, alert_message, alert_status FROM opened
            UNION ALL SELECT NULL, card_id, user_id, 'blacklisted_merchant', CAST(merchant_risk AS DECIMAL(14,2)), alert_message,
              'open' FROM offences""",
            **detection("max(transaction_timestamp)", IN_ORDER), hits=HITS, **upsert(GEO_ONLY),
        ),
        "st1_audit": sql(AUDIT, **detection("max(transaction_timestamp)", IN_ORDER)),
        "st5_late": sql(
            "SELECT id AS transaction_id, pid AS prev_transaction_id, fast AS violation, FALSE AS late FROM walk",
            **arrival_walk(),
        ),
        "st5_watermark": sql(
            """SELECT w.id AS transaction_id, w.pid AS prev_transaction_id, w.fast AS violation, FALSE AS too_late FROM walk w
            UNION ALL SELECT transaction_id, NULL, FALSE, TRUE FROM landed WHERE too_late AND latitude IS NOT NULL""",
            landed=LANDED, **in_time_walk(),
        ),
        "st4_window": sql(
            f"""SELECT transaction_id, user_id, txn_count, aggregate_total, violation,
            CASE WHEN violation THEN {structuring_score('aggregate_total', '10000', 'txn_count')} END AS risk_score,
            CASE WHEN violation THEN {structuring_severity('aggregate_total', '10000')} END AS severity,
            max_card_id, too_late FROM judged""",
            landed=LANDED, judged=KEPT_UP,
        ),
        "l1_login_state": sql(
            f"""SELECT auth_id, failed_attempts, locked_until, coalesce(locked_until > {AS_OF}, FALSE) AS is_locked,
            last_login_at, last_login_ip FROM (
              SELECT auth_id, CAST(arg_max(fails, (event_timestamp, log_id)) AS INT) AS failed_attempts,
                CASE WHEN arg_max(fails, (event_timestamp, log_id)) >= 5 THEN
                  max(CASE WHEN f = 1 THEN event_timestamp END) + INTERVAL 30 MINUTE END AS locked_until,
                max(CASE WHEN s = 1 THEN event_timestamp END) AS last_login_at,
                arg_max(ip_address, (event_timestamp, log_id)) FILTER (WHERE s = 1) AS last_login_ip
              FROM counted GROUP BY auth_id) x""",
            counted=LOGIN_COUNTED,
        ),
        "l2_lockout_events": sql(LOCKOUTS, counted=LOGIN_COUNTED),
        "l2_sliced": sql(LOCKOUTS, counted=LOGIN_COUNTED),
        "l1_apply_state": sql(
            f"""SELECT a.auth_id, CASE WHEN s.auth_id IS NULL THEN a.failed_attempts ELSE s.fails END AS failed_attempts,
            CASE WHEN s.auth_id IS NULL THEN a.locked_until WHEN s.fails >= 5 THEN s.last_failure + INTERVAL 30 MINUTE END
              AS locked_until, s.last_login_at, s.last_login_ip,
            CASE WHEN s.auth_id IS NULL THEN CAST(NULL AS TIMESTAMP) ELSE {AS_OF} END AS updated_at
            FROM authentication a LEFT JOIN (
              SELECT auth_id, CAST(arg_max(fails, (event_timestamp, log_id)) AS INT) AS fails,
                max(CASE WHEN f = 1 THEN event_timestamp END) AS last_failure,
                max(CASE WHEN s = 1 THEN event_timestamp END) AS last_login_at,
                arg_max(ip_address, (event_timestamp, log_id)) FILTER (WHERE s = 1) AS last_login_ip
              FROM counted GROUP BY auth_id) s ON s.auth_id = a.auth_id""",
            counted=LOGIN_COUNTED,
        ),
        "l3_login_state_stream": sql(LOCKOUTS, counted=LOGIN_COUNTED),
        "l4_touch": sql(
            f"""SELECT auth_id, CASE WHEN auth_id IN (SELECT auth_id FROM counted WHERE f = 1 AND fails >= 5)
            THEN {AS_OF} END AS updated_at FROM authentication""",
            counted=LOGIN_COUNTED,
        ),
        "l5_login_history": sql(
            """SELECT log_id, employee_id, event_type, login_status, ip_address, geo_country, event_timestamp
            FROM login_log"""
        ),
        "l6_failed_logins": sql(
            """SELECT log_id, employee_id, event_type, ip_address, geo_country, event_timestamp FROM login_log
            WHERE login_status = 'failure'"""
        ),
        "l7_suspicious_logins": sql(
            f"""SELECT log_id, event_type, ip_address, geo_country, event_timestamp, '{FLAG_SUSPICIOUS}' AS flag
            FROM login_log WHERE geo_country NOT IN ('US') OR event_type = 'username_not_found'
            OR event_type = 'account_locked'"""
        ),
        "l8_employee_history": sql(
            """SELECT log_id, event_type, login_status, ip_address, geo_country, event_timestamp FROM login_log
            WHERE employee_id = 'EMP-3'"""
        ),
        "l9_lockout_summary": sql(
            """SELECT employee_id, count(*) AS lockout_events, max(event_timestamp) AS last_lockout,
            string_agg(ip_address, ', ' ORDER BY ip_address) AS ips_involved FROM login_log
            WHERE event_type = 'account_locked' GROUP BY employee_id"""
        ),
        "l10_failure_summary": sql(
            """SELECT employee_id, count(*) AS total_failures, max(event_timestamp) AS last_failure,
            string_agg(ip_address, ', ' ORDER BY ip_address) AS ips_used FROM login_log
            WHERE login_status = 'failure' GROUP BY employee_id"""
        ),
        "l10_failures_by_address": sql(
            """SELECT employee_id, ip_address, count(*) AS n, max(event_timestamp) AS last_event FROM login_log
            WHERE login_status = 'failure' GROUP BY employee_id, ip_address"""
        ),
        "l11_account_status": sql(
            f"""SELECT auth_id, employee_id, role, is_active, must_change_password, failed_attempts, locked_until,
            {health(False)} AS account_health FROM authentication"""
        ),
        "l12_account_directory": sql(
            f"""SELECT auth_id, employee_id, role, is_active, must_change_password, failed_attempts, locked_until,
            deactivated_at, {health(True)} AS account_health FROM authentication"""
        ),
        "rp_a1_users_by_risk": sql("SELECT * FROM users"),
        "rp_a2_cards_with_holder": sql(
            f"""SELECT card_id, {NAME} AS card_holder, card_type, card_status, daily_limit FROM cards c
            JOIN users u ON u.user_id = c.user_id"""
        ),
        "rp_a3_merchants": sql("SELECT * FROM merchants"),
        "rp_a4_transactions": sql(
            f"""SELECT transaction_id, {NAME} AS user_name, merchant_name, transaction_amount, currency_code,
            transaction_timestamp, ip_address, latitude, longitude, transaction_status FROM transactions t
            JOIN users u ON u.user_id = t.user_id JOIN merchants m ON m.merchant_id = t.merchant_id"""
        ),
        "rp_a5_open_alerts": sql(
            f"""SELECT alert_id, {NAME} AS user_name, alert_type, risk_score, alert_message, alert_status, created_at FROM alerts a
            JOIN users u ON u.user_id = a.user_id WHERE alert_status = 'open'"""
        ),
        "rp_a6_employees_by_role": sql(
            "SELECT auth_id, employee_id, role, is_active, failed_attempts FROM authentication"
        ),
        "rp_a7_known_locations": sql(
            f"""SELECT location_id, {NAME} AS user_name, city, l.country_iso_code, latitude, longitude, frequency_count
            FROM locations l JOIN users u ON u.user_id = l.user_id"""
        ),
        "rp_a8_known_devices": sql(
            f"""SELECT device_id, {NAME} AS user_name, device_type, is_trusted FROM devices d
            JOIN users u ON u.user_id = d.user_id"""
        ),
        "rp_e1_transaction_board": sql(
            f"""SELECT t.transaction_id, {NAME} AS user_name, merchant_name, transaction_amount, transaction_status,
            ip_address, latitude, longitude, alert_type, a.risk_score, alert_status FROM transactions t
            JOIN users u ON u.user_id = t.user_id JOIN merchants m ON m.merchant_id = t.merchant_id
            LEFT JOIN alerts a ON a.transaction_id = t.transaction_id"""
        ),
        "rp_e2_alerts_with_trail": sql(
            """SELECT alert_id, alert_type, risk_score, alert_message, alert_status, created_at, previous_status, new_status, changed_by
            FROM alerts a LEFT JOIN audit l ON l.transaction_id = a.transaction_id"""
        ),
        "rp_e3_customers_with_alerts": sql(
            f"""SELECT u.user_id, {NAME} AS user_name, email, account_status, risk_profile, c.card_id, card_type,
            card_status, alert_type, alert_status, risk_score FROM users u JOIN cards c ON c.user_id = u.user_id
            LEFT JOIN alerts a ON a.user_id = u.user_id AND a.alert_status = 'open'"""
        ),
        "rp_f1_alert_summary": sql(
            """SELECT alert_type, count(*) AS total_alerts,
            CAST(sum(CASE WHEN alert_status = 'confirmed_fraud' THEN 1 ELSE 0 END) AS BIGINT) AS confirmed,
            CAST(sum(CASE WHEN alert_status = 'open' THEN 1 ELSE 0 END) AS BIGINT) AS open_count,
            CAST(round(CAST(sum(risk_score) / count(risk_score) AS DECIMAL(12,6)), 2) AS DECIMAL(10,2)) AS avg_risk_score
            FROM alerts GROUP BY alert_type"""
        ),
        "rp_f2_users_with_alerts": sql(
            f"""SELECT u.user_id, {NAME} AS user_name, u.risk_profile, count(a.alert_id) AS total_alerts,
            max(a.risk_score) AS max_risk_score FROM users u LEFT JOIN alerts a ON a.user_id = u.user_id
            GROUP BY u.user_id, u.first_name, u.last_name, u.risk_profile HAVING count(a.alert_id) > 0"""
        ),
        "rp_f3_merchant_volume": sql(
            f"""SELECT merchant_name, merchant_category_code, count(transaction_id) AS total_transactions,
            CAST(sum(transaction_amount) AS DECIMAL(25,2)) AS total_volume, is_blacklisted FROM transactions t
            JOIN merchants m ON m.merchant_id = t.merchant_id WHERE transaction_timestamp >= {AS_OF} - INTERVAL 7 DAY
            GROUP BY merchant_name, merchant_category_code, is_blacklisted"""
        ),
        "rp_g_dump_transactions": sql("SELECT * FROM transactions"),
        "rp_g_dump_alerts": sql("SELECT * FROM alerts"),
        "rp_g_dump_authentication": sql("SELECT * FROM authentication"),
        "p13_clustered": sql(
            """SELECT transaction_id, user_id, card_id, transaction_amount, transaction_timestamp, 'user' AS looked_up
            FROM transactions WHERE user_id = 11
            UNION ALL
            SELECT transaction_id, user_id, card_id, transaction_amount, transaction_timestamp, 'card'
            FROM transactions WHERE card_id = 24
            UNION ALL
            SELECT transaction_id, user_id, card_id, transaction_amount, transaction_timestamp, 'time'
            FROM transactions WHERE transaction_timestamp BETWEEN TIMESTAMP '2024-01-15 00:00:00'
                AND TIMESTAMP '2024-01-15 06:00:00'"""
        ),
        "rp_r1_located_transactions": sql(
            """SELECT transaction_id, user_id, card_id, merchant_id, transaction_amount, merchant_country, ip_address,
            CAST(latitude AS VARCHAR) || ', ' || CAST(longitude AS VARCHAR) AS coordinates, transaction_status,
            transaction_timestamp FROM transactions"""
        ),
        "rp_r2_alerts_of_type": sql("SELECT * FROM alerts WHERE alert_type = 'impossible_travel'"),
        "rp_r3_audit_of_actors": sql("SELECT * FROM audit WHERE changed_by IN ('geo', 'merchant')"),
        "rp_r4_declined_with_alert": sql(
            """SELECT t.transaction_id, t.user_id, transaction_amount, merchant_country, ip_address, transaction_status,
            transaction_timestamp, alert_id, alert_type, risk_score, alert_status FROM transactions t
            LEFT JOIN alerts a ON a.transaction_id = t.transaction_id AND a.alert_type = 'impossible_travel'
            WHERE transaction_status = 'declined'"""
        ),
        "rp_r5_transactions_with_risk_flag": sql(
            f"""SELECT transaction_id, {NAME} AS user_name, merchant_name, is_blacklisted,
            {risk_flag('is_blacklisted = 1', 'merchant_mcc', 'risk_score')} AS risk_flag, transaction_amount,
            transaction_status, transaction_timestamp FROM transactions t JOIN users u ON u.user_id = t.user_id
            JOIN merchants m ON m.merchant_id = t.merchant_id"""
        ),
    }
