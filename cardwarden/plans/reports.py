"""Investigator and compliance reports.

Every report takes the tables by name and returns a sorted DataFrame. Columns a
table lacks are left out. Sorts end with a key, so equal rows have one order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.functions import expr
from cardwarden.operators import joins

Tables = Mapping[str, DataFrame]

_TS = "transaction_timestamp"


def _names(tables: Tables) -> DataFrame:
    return tables["users"].select(
        "user_id", expr.full_name("first_name", "last_name").alias("user_name")
    )


def users_by_risk(tables: Tables, rank_risk: bool = False) -> DataFrame:
    """A1"""
    return joins.select_cols(
        joins.order_by_risk(tables["users"], "user_id", rank_risk=rank_risk),
        ["user_id", "first_name", "last_name", "email", "account_status", "risk_profile",
         "country_iso_code"],
    )


def cards_with_holder(tables: Tables) -> DataFrame:
    """A2"""
    held = tables["cards"].join(_names(tables), "user_id")
    return joins.select_cols(
        held.withColumnRenamed("user_name", "card_holder").orderBy("card_id"),
        ["card_id", "card_holder", "card_type", "last_four_digits", "card_status",
         "daily_limit", "monthly_limit", "expiry_date"],
    )


def merchants_by_risk(tables: Tables) -> DataFrame:
    """A3"""
    return joins.select_cols(
        tables["merchants"].orderBy(F.desc("is_blacklisted"), F.desc("risk_score"), "merchant_id"),
        ["merchant_id", "merchant_name", "merchant_category_code", "mcc_description",
         "country_iso_code", "risk_score", "is_blacklisted", "fraud_report_count"],
    )


def _with_parties(payments: DataFrame, tables: Tables) -> DataFrame:
    names = tables["merchants"].select("merchant_id", "merchant_name")
    return payments.join(_names(tables), "user_id").join(names, "merchant_id")


def transactions_with_parties(tables: Tables) -> DataFrame:
    """A4"""
    return joins.select_cols(
        _with_parties(tables["transactions"], tables).orderBy(F.desc(_TS), F.desc("transaction_id")),
        ["transaction_id", "user_name", "merchant_name", "transaction_amount", "currency_code",
         _TS, "ip_address", "latitude", "longitude", "transaction_status", "device_id"],
    )


def open_alerts(tables: Tables) -> DataFrame:
    """A5"""
    still_open = tables["alerts"].filter(F.col("alert_status") == "open")
    return joins.select_cols(
        still_open.join(_names(tables), "user_id").orderBy(F.desc("risk_score"), "alert_id"),
        ["alert_id", "user_name", "alert_type", "risk_score", "alert_status", "alert_message",
         "created_at"],
    )


def employees_by_role(tables: Tables) -> DataFrame:
    """A6"""
    return joins.select_cols(
        tables["authentication"].orderBy("role", "auth_id"),
        ["auth_id", "employee_id", "username", "role", "is_active", "last_login_at",
         "failed_attempts"],
    )


def known_locations(tables: Tables) -> DataFrame:
    """A7"""
    return joins.select_cols(
        tables["locations"].join(_names(tables), "user_id").orderBy("user_id", "location_id"),
        ["location_id", "user_name", "city", "country_iso_code", "latitude", "longitude",
         "frequency_count", "last_transaction_at"],
    )


def known_devices(tables: Tables) -> DataFrame:
    """A8"""
    return joins.select_cols(
        tables["devices"].join(_names(tables), "user_id").orderBy("user_id", "device_id"),
        ["device_id", "user_name", "device_type", "device_name", "os_type", "is_trusted",
         "last_seen"],
    )


def transaction_board(tables: Tables) -> DataFrame:
    """E1: all payments with their parties and alerts."""
    alerts = tables["alerts"].filter(F.col("transaction_id").isNotNull()).select(
        "transaction_id", "alert_id", "alert_type", "risk_score", "alert_status"
    )
    alerted = joins.left_many(tables["transactions"], alerts, "transaction_id")
    board = _with_parties(alerted, tables)
    return joins.select_cols(
        board.orderBy(F.desc(_TS), F.desc("transaction_id"), "alert_id"),
        ["transaction_id", "user_name", "merchant_name", "transaction_amount",
         "transaction_status", "ip_address", "latitude", "longitude", "alert_type",
         "risk_score", "alert_status"],
    )


def alerts_with_trail(tables: Tables) -> DataFrame:
    """E2: one row per alert and audit row of its payment."""
    trail = joins.select_cols(
        tables["audit"].filter(F.col("transaction_id").isNotNull()),
        ["transaction_id", "audit_id", "previous_status", "new_status", "changed_by", "change_reason"],
    )
    joined = joins.left_many(tables["alerts"], trail, "transaction_id")
    return joins.select_cols(
        joined.orderBy(F.desc("risk_score"), "alert_id", "audit_id"),
        ["alert_id", "alert_type", "risk_score", "alert_status", "alert_message", "created_at",
         "resolved_at", "previous_status", "new_status", "changed_by", "change_reason"],
    )


def customers_with_alerts(tables: Tables, rank_risk: bool = False) -> DataFrame:
    """E3: customers, cards and open alerts; a customer's alert repeats per card."""
    cards = joins.select_cols(
        tables["cards"], ["user_id", "card_id", "card_type", "last_four_digits", "card_status"]
    )
    alerts = tables["alerts"].filter(F.col("alert_status") == "open").select(
        "user_id", "alert_id", "alert_type", "alert_status", "risk_score"
    )
    customers = tables["users"].withColumn(
        "user_name", expr.full_name("first_name", "last_name")
    )
    joined = joins.left_many(customers.join(cards, "user_id"), alerts, "user_id")
    return joins.select_cols(
        joins.order_by_risk(joined, "user_id", "card_id", "alert_id", rank_risk=rank_risk),
        ["user_id", "user_name", "email", "phone", "account_status", "risk_profile", "card_id",
         "card_type", "last_four_digits", "card_status", "alert_type", "alert_status",
         "risk_score"],
    )


def alert_summary(tables: Tables) -> DataFrame:
    """F1"""
    return (
        tables["alerts"]
        .groupBy("alert_type")
        .agg(
            F.count(F.lit(1)).alias("total_alerts"),
            expr.count_if(F.col("alert_status") == "confirmed_fraud").alias("confirmed"),
            expr.count_if(F.col("alert_status") == "open").alias("open_count"),
            expr.avg_round("risk_score", 2).cast("decimal(10,2)").alias("avg_risk_score"),
        )
        .orderBy(F.desc("avg_risk_score"), "alert_type")
    )


def users_with_alerts(tables: Tables) -> DataFrame:
    """alerts are counted per user before the join."""
    counted = tables["alerts"].groupBy("user_id").agg(
        F.count("alert_id").alias("total_alerts"), F.max("risk_score").alias("max_risk_score")
    ).filter(F.col("total_alerts") > 0)
    named = tables["users"].select(
        "user_id", expr.full_name("first_name", "last_name").alias("user_name"), "risk_profile"
    )
    return (
        named.join(counted, "user_id")
        .select("user_id", "user_name", "risk_profile", "total_alerts", "max_risk_score")
        .orderBy(F.desc("max_risk_score"), "user_id")
    )


def merchant_volume(tables: Tables, as_of=None, days: int = 7) -> DataFrame:
    """payments are summed per merchant before the join."""
    recent = joins.since(tables["transactions"], _TS, days, "day", as_of)
    summed = recent.groupBy("merchant_id").agg(
        F.count("transaction_id").alias("_n"), F.sum("transaction_amount").alias("_volume")
    )
    described = ["merchant_name", "merchant_category_code", "is_blacklisted"]
    return (
        summed.join(tables["merchants"].select("merchant_id", *described), "merchant_id")
        .groupBy(*described)
        .agg(
            F.sum("_n").alias("total_transactions"),
            F.sum("_volume").cast("decimal(25,2)").alias("total_volume"),
        )
        .select("merchant_name", "merchant_category_code", "total_transactions", "total_volume",
                "is_blacklisted")
        .orderBy(F.desc("total_volume"), "merchant_name")
    )


def dump(tables: Tables, name: str) -> DataFrame:
    """G: a table as it is."""
    return tables[name]


def located_transactions(tables: Tables) -> DataFrame:
    """R1: payments with their coordinates as text."""
    shown = tables["transactions"].withColumn(
        "coordinates", expr.coords_text("latitude", "longitude")
    )
    return joins.select_cols(
        shown.orderBy("user_id", _TS, "transaction_id"),
        ["transaction_id", "user_id", "card_id", "merchant_id", "transaction_amount",
         "merchant_country", "ip_address", "coordinates", "transaction_status", _TS],
    )


def alerts_of_type(tables: Tables, alert_type: str) -> DataFrame:
    """R2"""
    chosen = tables["alerts"].filter(F.col("alert_type") == alert_type)
    return joins.select_cols(
        chosen.orderBy(F.desc("created_at"), F.desc("alert_id")),
        ["alert_id", "transaction_id", "card_id", "user_id", "alert_type", "risk_score",
         "alert_status", "alert_message", "investigation_notes", "created_at"],
    )


def audit_of_actors(tables: Tables, actors: Sequence[str]) -> DataFrame:
    """R3"""
    chosen = tables["audit"].filter(F.col("changed_by").isin(list(actors)))
    return joins.select_cols(
        chosen.orderBy(F.desc("changed_at"), F.desc("audit_id")),
        ["audit_id", "transaction_id", "previous_status", "new_status", "changed_by",
         "changed_at", "change_reason"],
    )


def declined_with_alert(tables: Tables, alert_type: str = "impossible_travel") -> DataFrame:
    """R4: declined payments with their alert of one type, if any."""
    alerts = tables["alerts"].filter(
        (F.col("alert_type") == alert_type) & F.col("transaction_id").isNotNull()
    ).select("transaction_id", "alert_id", "alert_type", "risk_score", "alert_status")
    declined = tables["transactions"].filter(F.col("transaction_status") == "declined")
    joined = joins.left_many(declined, alerts, "transaction_id")
    return joins.select_cols(
        joined.orderBy(F.desc(_TS), F.desc("transaction_id"), "alert_id"),
        ["transaction_id", "user_id", "transaction_amount", "merchant_country", "ip_address",
         "transaction_status", _TS, "alert_id", "alert_type", "risk_score", "alert_status"],
    )


def transactions_with_risk_flag(tables: Tables) -> DataFrame:
    """R5: payments with the merchant risk flag, by the payment's own category."""
    merchants = tables["merchants"].select("merchant_id", "merchant_name", "is_blacklisted", "risk_score")
    joined = tables["transactions"].join(_names(tables), "user_id").join(merchants, "merchant_id")
    flagged = joined.withColumn(
        "risk_flag", expr.merchant_risk_flag("is_blacklisted", "merchant_mcc", "risk_score")
    )
    return joins.select_cols(
        flagged.orderBy(F.desc(_TS), F.desc("transaction_id")),
        ["transaction_id", "user_name", "merchant_name", "is_blacklisted", "risk_flag",
         "transaction_amount", "transaction_status", _TS],
    )
