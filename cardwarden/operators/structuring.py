"""Structuring rule: many payments below a reporting limit that add up to it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.functions import expr
from cardwarden.operators import alerts as alert_ops
from cardwarden.operators import joins, timeline
from cardwarden.operators.slices import DEFAULT_POLICY, FIND, Hot, SlicePolicy
from cardwarden.session import stored

ALERT_TYPE = "structuring_aml"
ACTOR = "structuring"

_TS = "transaction_timestamp"
_TOTAL = "decimal(25,2)"


def _in_band(txns: DataFrame, lo, hi) -> DataFrame:
    return txns.filter(
        F.col("transaction_amount").between(F.lit(lo).cast("decimal(15,2)"), F.lit(hi).cast("decimal(15,2)"))
        & (F.col("transaction_status") == "completed")
    )


def structuring_band(
    txns: DataFrame,
    users: DataFrame,
    lo: float = 2000,
    hi: float = 3000,
    minutes: int = 60,
    min_count: int = 3,
    policy: SlicePolicy = DEFAULT_POLICY,
    hot: Hot = FIND,
    sort: bool = True,
) -> DataFrame:
    """Payments in an amount band that follow enough others of the user within the span, by user and time."""
    band = _in_band(txns, lo, hi).select(
        "user_id", "card_id", "transaction_id", "transaction_amount", _TS
    )
    counted = timeline.trailing_count(
        band, "user_id", _TS, minutes, out="txn_count_in_window", policy=policy, hot=hot
    ).filter(F.col("txn_count_in_window") >= min_count)
    named = counted.join(users.select("user_id", "first_name", "last_name"), "user_id")
    if sort:
        named = named.orderBy("user_id", _TS, "transaction_id")
    return named.select(
        "user_id",
        expr.full_name("first_name", "last_name").alias("user_name"),
        "card_id", "transaction_id", "transaction_amount", _TS, "txn_count_in_window",
        expr.flag(expr.FLAG_STRUCTURING).alias("flag"),
    )


def structuring_band_recent(
    txns: DataFrame,
    users: DataFrame,
    as_of=None,
    hours: int = 1,
    lo: float = 2000,
    hi: float = 3000,
    min_count: int = 3,
    sort: bool = True,
) -> DataFrame:
    """Users with enough payments in the band during the last hours, most payments first."""
    recent = joins.since(_in_band(txns, lo, hi), _TS, hours, "hour", as_of)
    grouped = (
        recent.groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("txn_count"),
            F.sum("transaction_amount").cast(_TOTAL).alias("total_amount"),
            F.min("transaction_amount").alias("min_amount"),
            F.max("transaction_amount").alias("max_amount"),
            F.min(_TS).alias("window_start"),
            F.max(_TS).alias("window_end"),
        )
        .filter(F.col("txn_count") >= min_count)
    )
    named = grouped.join(users.select("user_id", "first_name", "last_name"), "user_id")
    if sort:
        named = named.orderBy(F.desc("txn_count"), "user_id")
    return named.select(
        "user_id",
        expr.full_name("first_name", "last_name").alias("user_name"),
        "txn_count", "total_amount", "min_amount", "max_amount", "window_start", "window_end",
        expr.flag(expr.FLAG_STRUCTURING).alias("flag"),
    )


def counts_below(threshold) -> Column:
    """Whether a payment is completed and stays under the limit by itself."""
    return (F.col("transaction_status") == "completed") & (
        F.col("transaction_amount") < F.lit(threshold).cast("decimal(15,2)")
    )


def _below(txns: DataFrame, threshold) -> DataFrame:
    return txns.filter(counts_below(threshold))


def _in_window(txns: DataFrame, as_of, hours: int) -> DataFrame:
    end = expr.instant(as_of)
    start = expr.shift(end, -hours, "hour")
    return txns.filter(
        F.col(_TS).between(joins.bound(txns, _TS, start), joins.bound(txns, _TS, end))
    )


def _message(count: Column, total: Column, threshold, hours: int) -> Column:
    return F.concat(
        count.cast("string"), F.lit(" payments below $"), F.lit(threshold).cast("int").cast("string"),
        F.lit(" add up to $"), total.cast("decimal(25,0)").cast("string"),
        F.lit(f" within {hours} hours"),
    )


def structuring_report(
    txns: DataFrame,
    users: DataFrame,
    as_of=None,
    threshold: float = 10000,
    min_count: int = 2,
    window_hours: int = 48,
    user_id=None,
    sort: bool = True,
) -> DataFrame:
    """Users whose payments below the limit reach it within the look-back, largest total first."""
    limit = F.lit(threshold).cast("decimal(15,2)")
    suspects = joins.optional_eq(
        _below(_in_window(txns, as_of, window_hours), threshold), "user_id", user_id
    )
    amount = "transaction_amount"
    grouped = (
        suspects.groupBy("user_id")
        .agg(
            F.count("transaction_id").alias("txn_count_in_window"),
            F.sum(amount).cast(_TOTAL).alias("aggregate_total"),
            F.min(amount).alias("min_single_txn"),
            F.max(amount).alias("max_single_txn"),
            F.avg(amount).cast("decimal(19,6)").alias("avg_single_txn"),
            F.min(_TS).alias("first_txn_in_window"),
            F.max(_TS).alias("last_txn_in_window"),
            F.max("card_id").alias("latest_card_id"),
        )
        .filter((F.col("txn_count_in_window") >= min_count) & (F.col("aggregate_total") >= limit))
    )
    total = F.col("aggregate_total")
    count = F.col("txn_count_in_window")
    named = grouped.join(users, "user_id")
    if sort:
        named = named.orderBy(F.desc("aggregate_total"), "user_id")
    return named.select(
        "user_id",
        expr.full_name("first_name", "last_name").alias("full_name"),
        "email",
        F.col("risk_profile").alias("current_risk_profile"),
        "country_iso_code",
        "txn_count_in_window",
        "aggregate_total",
        limit.alias("reporting_threshold"),
        (total - limit).cast(_TOTAL).alias("amount_over_threshold"),
        "min_single_txn", "max_single_txn", "avg_single_txn",
        F.lit(window_hours).alias("window_hours"),
        "first_txn_in_window", "last_txn_in_window",
        expr.boundary_diff("minute", "first_txn_in_window", "last_txn_in_window").alias("span_minutes"),
        expr.structuring_risk_score(total, threshold, count).alias("calculated_risk_score"),
        expr.structuring_severity(total, threshold).alias("severity_level"),
        F.lit(ALERT_TYPE).alias("alert_type"),
        _message(count, total, threshold, window_hours).alias("alert_message"),
        "latest_card_id",
    )


def structuring_new_alerts(report: DataFrame, alerts: DataFrame) -> DataFrame:
    """Alert rows for suspects without an open one; no single payment triggers them."""
    fresh = alert_ops.new_alerts(alerts, report)
    return fresh.select(
        F.lit(None).cast("bigint").alias("transaction_id"),
        F.col("latest_card_id").alias("card_id"),
        "user_id",
        "alert_type",
        expr.alert_score("calculated_risk_score").alias("risk_score"),
        "alert_message",
        F.lit("open").alias("alert_status"),
        F.concat(F.lit("Severity "), "severity_level").alias("investigation_notes"),
    )


def structuring_summary(
    report: DataFrame, raised: DataFrame, as_of=None, threshold: float = 10000,
    window_hours: int = 48,
) -> DataFrame:
    """One row: suspects found, alerts raised, the window and the parameters."""
    end = expr.instant(as_of)
    return report.agg(F.count(F.lit(1)).alias("total_suspects_detected")).select(
        "total_suspects_detected",
        raised.agg(F.count(F.lit(1))).scalar().alias("new_alerts_raised"),
        expr.shift(end, -window_hours, "hour").alias("analysis_window_start"),
        end.alias("analysis_window_end"),
        F.lit(threshold).cast("decimal(15,2)").alias("threshold_used"),
        F.lit(window_hours).alias("window_hours_used"),
    )


def detect_structuring(
    txns: DataFrame, users: DataFrame, alerts: DataFrame, as_of=None, raise_alerts: bool = True,
    **options,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Report, new alerts and summary from one evaluation of the report, which is stored."""
    report = stored(structuring_report(txns, users, as_of, sort=False, **options))
    raised = structuring_new_alerts(report, alerts)
    if not raise_alerts:
        raised = raised.limit(0)
    shown = {k: v for k, v in options.items() if k in ("threshold", "window_hours")}
    return report, raised, structuring_summary(report, raised, as_of, **shown)


def judged_by_totals(rows: DataFrame, threshold, min_count: int) -> DataFrame:
    total = F.coalesce(F.col("aggregate_total"), F.lit(0)).cast(_TOTAL)
    count = F.coalesce(F.col("txn_count"), F.lit(0)).cast("bigint")
    hit = (count >= min_count) & (total >= F.lit(threshold).cast("decimal(15,2)"))
    return rows.withColumns(
        {
            "txn_count": count,
            "aggregate_total": total,
            "violation": hit,
            "risk_score": F.when(hit, expr.structuring_risk_score(total, threshold, count)),
            "severity": F.when(hit, expr.structuring_severity(total, threshold)),
        }
    )


JUDGED = ["transaction_id", "user_id", "card_id", "transaction_amount", _TS, "transaction_status"]


def structuring_on_insert(
    history: DataFrame,
    batch: DataFrame,
    as_of=None,
    threshold: float = 10000,
    min_count: int = 2,
    window_hours: int = 48,
    hot: Hot = FIND,
) -> DataFrame:
    """Judge every arriving row against its user's window after the whole batch landed.

    Windows are totalled before anything is joined by user, so that a busy user
    reaches the join as one row.
    """
    landed = history.select(*JUDGED).unionByName(batch.select(*JUDGED))
    eligible = _below(_in_window(landed, as_of, window_hours), threshold)
    windows = eligible.groupBy("user_id").agg(
        F.count("transaction_id").alias("txn_count"),
        F.sum("transaction_amount").cast(_TOTAL).alias("aggregate_total"),
        F.max("card_id").alias("max_card_id"),
    )
    return judged_by_totals(joins.lookup(batch, windows, "user_id", hot=hot), threshold, min_count)


def structuring_trailing(
    txns: DataFrame,
    threshold: float = 10000,
    min_count: int = 2,
    window_hours: int = 48,
    policy: SlicePolicy = DEFAULT_POLICY,
    hot: Hot = FIND,
) -> DataFrame:
    """The same test on every eligible payment, with the window ending at its own time."""
    eligible = _below(txns, threshold).select(*JUDGED)
    totals = timeline.trailing_totals(
        eligible, "user_id", _TS, window_hours * 60, "transaction_amount",
        count_as="txn_count", sum_as="aggregate_total", policy=policy, hot=hot,
    )
    return judged_by_totals(totals, threshold, min_count)


def structuring_hits(judged: DataFrame, threshold: float = 10000, window_hours: int = 48) -> DataFrame:
    hits = judged.filter("violation")
    count, total = F.col("txn_count"), F.col("aggregate_total")
    note = F.concat(
        F.lit("Payment "), F.col("transaction_id").cast("string"), F.lit(" ($"),
        F.col("transaction_amount").cast("string"), F.lit("), severity "), F.col("severity"),
        F.lit(", risk "), expr.alert_score("risk_score").cast("string"), F.lit(": $"),
        total.cast("string"), F.lit(" in "), count.cast("string"), F.lit(" payments"),
    )
    return hits.select(
        "transaction_id",
        F.col("max_card_id").alias("card_id"),
        "user_id",
        F.lit(ALERT_TYPE).alias("alert_type"),
        expr.alert_score("risk_score").alias("risk_score"),
        _message(count, total, threshold, window_hours).alias("alert_message"),
        note.alias("note"),
    )


def structuring_audit(
    judged: DataFrame, alerts: DataFrame, as_of=None, actual_status: bool = False, hot: Hot = FIND
) -> DataFrame:
    """One audit row per judged payment: new alert, existing alert, or clean."""
    hit = F.col("violation")
    firsts = judged.filter(hit).groupBy("user_id").agg(F.min("transaction_id").alias("_first"))
    known = (
        alerts.filter((F.col("alert_status") == "open") & (F.col("alert_type") == ALERT_TYPE))
        .select("user_id").distinct().withColumn("_open", F.lit(True))
    )
    opens = firsts.join(known, "user_id", "left")
    rows = joins.lookup(judged, opens, "user_id", hot=hot)
    existing = F.col("_open").isNotNull() | (F.col("transaction_id") > F.col("_first"))
    outcome = expr.label(
        [(~hit, "No violation"), (existing, "Existing alert updated")], "New alert raised"
    )
    previous = F.col("transaction_status") if actual_status else F.lit("completed")
    return rows.select(
        "transaction_id",
        F.when(hit, previous).alias("previous_status"),
        F.lit("completed").alias("new_status"),
        F.lit(ACTOR).alias("changed_by"),
        expr.now_utc(as_of).alias("changed_at"),
        F.concat(
            outcome, F.lit(": $"), F.col("aggregate_total").cast("string"), F.lit(" in "),
            F.col("txn_count").cast("string"), F.lit(" payments"),
            F.when(hit, F.concat(F.lit(", risk "), expr.alert_score("risk_score").cast("string")))
            .otherwise(F.lit("")),
        ).alias("change_reason"),
    )
