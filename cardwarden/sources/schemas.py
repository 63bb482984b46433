"""Table schemas with the rules declared on them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

INT, LONG, BOOL, TEXT = T.IntegerType(), T.LongType(), T.BooleanType(), T.StringType()
DATE, TIMESTAMP = T.DateType(), T.TimestampType()
MONEY, LIMIT = T.DecimalType(15, 2), T.DecimalType(10, 2)
SHARE, SCORE = T.DecimalType(3, 2), T.DecimalType(14, 2)
LATITUDE, LONGITUDE = T.DecimalType(10, 8), T.DecimalType(11, 8)

NOW = object()


@dataclass(frozen=True)
class Table:
    """Columns, keys, references, defaults and checks of one table."""

    schema: T.StructType
    key: str
    unique: tuple[tuple[str, ...], ...] = ()
    parents: dict[str, tuple[str, str]] = field(default_factory=dict)
    defaults: dict[str, object] = field(default_factory=dict)
    checks: dict[str, str] = field(default_factory=dict)
    lengths: dict[str, int] = field(default_factory=dict)

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]


def _field(name: str, kind: T.DataType, required: bool = False) -> T.StructField:
    return T.StructField(name, kind, not required)


def _table(*fields: T.StructField, key: str, **rules) -> Table:
    """A table whose length limits are read off its VARCHAR columns, stored as strings."""
    lengths = {f.name: f.dataType.length for f in fields if isinstance(f.dataType, T.VarcharType)}
    schema = T.StructType(
        [T.StructField(f.name, TEXT if f.name in lengths else f.dataType, f.nullable) for f in fields]
    )
    return Table(schema, key, lengths=lengths, **rules)


def _one_of(column: str, values: tuple[str, ...]) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


# What the status and type columns may hold.
ACCOUNT_STATUS = ("active", "suspended", "closed")
RISK_PROFILE = ("low", "medium", "high")
CARD_TYPE = ("debit", "credit", "prepaid")
CARD_STATUS = ("active", "blocked", "expired")
TRANSACTION_STATUS = ("completed", "pending", "declined", "reversed")
ALERT_STATUS = ("open", "acknowledged", "false_positive", "confirmed_fraud")
ALERT_TYPE = (
    "impossible_travel", "structuring_aml", "blacklisted_merchant", "high_risk_mcc",
    "velocity_breach", "unknown_device", "other",
)
DEVICE_TYPE = ("mobile", "laptop", "tablet", "desktop", "unknown")
ROLE = ("super_admin", "compliance_officer", "bank_employee")
LOGIN_EVENT = (
    "login_success", "login_failure", "account_locked", "account_unlocked", "logout",
    "session_expired", "password_changed", "mfa_success", "mfa_failure",
    "username_not_found", "inactive_account", "forced_logout",
)
LOGIN_STATUS = ("success", "failure")
MFA_OUTCOME = ("passed", "failed", "skipped")

TABLES: dict[str, Table] = {
    "users": _table(
        _field("user_id", INT, required=True),
        _field("first_name", T.VarcharType(100)),
        _field("last_name", T.VarcharType(100)),
        _field("email", T.VarcharType(150), required=True),
        _field("phone", T.VarcharType(20)),
        _field("account_created_at", TIMESTAMP, required=True),
        _field("account_status", T.VarcharType(20), required=True),
        _field("risk_profile", T.VarcharType(20), required=True),
        _field("country_iso_code", T.VarcharType(2)),
        _field("registration_ip_address", T.VarcharType(45)),
        key="user_id",
        unique=(("email",),),
        defaults={"account_created_at": NOW, "account_status": "active", "risk_profile": "low"},
        checks={
            "account_status": _one_of("account_status", ACCOUNT_STATUS),
            "risk_profile": _one_of("risk_profile", RISK_PROFILE),
        },
    ),
    "cards": _table(
        _field("card_id", INT, required=True),
        _field("user_id", INT, required=True),
        _field("card_type", T.VarcharType(20), required=True),
        _field("card_number_hash", T.VarcharType(256), required=True),
        _field("last_four_digits", T.VarcharType(4)),
        _field("expiry_date", DATE),
        _field("card_status", T.VarcharType(20), required=True),
        _field("issued_date", TIMESTAMP, required=True),
        _field("reported_lost_at", TIMESTAMP),
        _field("daily_limit", LIMIT),
        _field("monthly_limit", LIMIT),
        key="card_id",
        unique=(("card_number_hash",),),
        parents={"user_id": ("users", "cascade")},
        defaults={"card_status": "active", "issued_date": NOW},
        checks={
            "card_type": _one_of("card_type", CARD_TYPE),
            "card_status": _one_of("card_status", CARD_STATUS),
        },
    ),
    "merchants": _table(
        _field("merchant_id", INT, required=True),
        _field("merchant_name", T.VarcharType(255), required=True),
        _field("merchant_category_code", T.VarcharType(10)),
        _field("mcc_description", T.VarcharType(255)),
        _field("country_iso_code", T.VarcharType(2)),
        _field("risk_score", SHARE, required=True),
        _field("is_blacklisted", BOOL, required=True),
        _field("fraud_report_count", INT, required=True),
        _field("created_at", TIMESTAMP, required=True),
        key="merchant_id",
        defaults={
            "risk_score": 0, "is_blacklisted": False, "fraud_report_count": 0, "created_at": NOW,
        },
        checks={"merchant_risk": "risk_score BETWEEN 0 AND 1"},
    ),
    "transactions": _table(
        _field("transaction_id", LONG, required=True),
        _field("card_id", INT, required=True),
        _field("merchant_id", INT, required=True),
        _field("user_id", INT, required=True),
        _field("transaction_amount", MONEY, required=True),
        _field("currency_code", T.VarcharType(3), required=True),
        _field("transaction_timestamp", TIMESTAMP, required=True),
        _field("merchant_country", T.VarcharType(2)),
        _field("customer_country", T.VarcharType(2)),
        _field("merchant_mcc", T.VarcharType(10)),
        _field("transaction_status", T.VarcharType(20), required=True),
        _field("is_online", BOOL),
        _field("device_id", T.VarcharType(255)),
        _field("ip_address", T.VarcharType(45)),
        _field("latitude", LATITUDE),
        _field("longitude", LONGITUDE),
        key="transaction_id",
        parents={
            "card_id": ("cards", "restrict"),
            "merchant_id": ("merchants", "restrict"),
            "user_id": ("users", "restrict"),
        },
        defaults={
            "currency_code": "USD", "transaction_timestamp": NOW, "transaction_status": "completed",
        },
        checks={
            "transaction_status": _one_of("transaction_status", TRANSACTION_STATUS),
            "transaction_amount": "transaction_amount > 0",
        },
    ),
    "alerts": _table(
        _field("alert_id", LONG, required=True),
        _field("transaction_id", LONG),
        _field("card_id", INT, required=True),
        _field("user_id", INT, required=True),
        _field("alert_type", T.VarcharType(100), required=True),
        _field("risk_score", SCORE),
        _field("alert_message", TEXT),
        _field("alert_status", T.VarcharType(30), required=True),
        _field("investigation_notes", TEXT),
        _field("created_at", TIMESTAMP, required=True),
        _field("resolved_at", TIMESTAMP),
        key="alert_id",
        parents={
            "transaction_id": ("transactions", "restrict"),
            "card_id": ("cards", "restrict"),
            "user_id": ("users", "restrict"),
        },
        defaults={"alert_status": "open", "created_at": NOW},
        checks={
            "alert_status": _one_of("alert_status", ALERT_STATUS),
            "alert_type": _one_of("alert_type", ALERT_TYPE),
        },
    ),
    "transaction_audit_log": _table(
        _field("audit_id", LONG, required=True),
        _field("transaction_id", LONG),
        _field("previous_status", T.VarcharType(50)),
        _field("new_status", T.VarcharType(50)),
        _field("changed_by", T.VarcharType(255)),
        _field("changed_at", TIMESTAMP, required=True),
        _field("change_reason", TEXT),
        key="audit_id",
        parents={"transaction_id": ("transactions", "restrict")},
        defaults={"changed_at": NOW},
    ),
    "user_known_locations": _table(
        _field("location_id", INT, required=True),
        _field("user_id", INT, required=True),
        _field("city", T.VarcharType(100)),
        _field("country_iso_code", T.VarcharType(2)),
        _field("latitude", LATITUDE),
        _field("longitude", LONGITUDE),
        _field("last_transaction_at", TIMESTAMP),
        _field("frequency_count", INT, required=True),
        key="location_id",
        unique=(("user_id", "city", "country_iso_code"),),
        parents={"user_id": ("users", "cascade")},
        defaults={"frequency_count": 1},
    ),
    "user_devices": _table(
        _field("device_id", T.VarcharType(255), required=True),
        _field("user_id", INT, required=True),
        _field("device_type", T.VarcharType(50)),
        _field("device_name", T.VarcharType(255)),
        _field("os_type", T.VarcharType(50)),
        _field("first_seen", TIMESTAMP, required=True),
        _field("last_seen", TIMESTAMP),
        _field("is_trusted", BOOL, required=True),
        key="device_id",
        parents={"user_id": ("users", "cascade")},
        defaults={"first_seen": NOW, "is_trusted": False},
        checks={"device_type": _one_of("device_type", DEVICE_TYPE)},
    ),
    "authentication": _table(
        _field("auth_id", INT, required=True),
        _field("employee_id", T.VarcharType(50), required=True),
        _field("username", T.VarcharType(100), required=True),
        _field("role", T.VarcharType(50), required=True),
        _field("is_active", BOOL, required=True),
        _field("email", T.VarcharType(150)),
        _field("phone", T.VarcharType(20)),
        _field("mfa_enabled", BOOL, required=True),
        _field("last_login_at", TIMESTAMP),
        _field("last_login_ip", T.VarcharType(45)),
        _field("failed_attempts", INT, required=True),
        _field("locked_until", TIMESTAMP),
        _field("password_changed_at", TIMESTAMP),
        _field("must_change_password", BOOL, required=True),
        _field("created_at", TIMESTAMP, required=True),
        _field("updated_at", TIMESTAMP),
        _field("deactivated_at", TIMESTAMP),
        key="auth_id",
        unique=(("employee_id",), ("username",), ("email",)),
        defaults={
            "role": "bank_employee", "is_active": True, "mfa_enabled": False,
            "failed_attempts": 0, "must_change_password": False, "created_at": NOW,
        },
        checks={
            "role": _one_of("role", ROLE),
            "failed_attempts": "failed_attempts >= 0",
            "inactive_has_date": "is_active OR deactivated_at IS NOT NULL",
        },
    ),
    "authentication_audit_log": _table(
        _field("log_id", LONG, required=True),
        _field("auth_id", INT),
        _field("employee_id", T.VarcharType(50)),
        _field("username_attempted", T.VarcharType(100), required=True),
        _field("event_type", T.VarcharType(50), required=True),
        _field("login_status", T.VarcharType(20), required=True),
        _field("failure_reason", T.VarcharType(100)),
        _field("session_expires_at", TIMESTAMP),
        _field("ip_address", T.VarcharType(45)),
        _field("user_agent", T.VarcharType(500)),
        _field("device_fingerprint", T.VarcharType(256)),
        _field("geo_country", T.VarcharType(2)),
        _field("geo_city", T.VarcharType(100)),
        _field("mfa_used", BOOL, required=True),
        _field("mfa_outcome", T.VarcharType(20)),
        _field("event_timestamp", TIMESTAMP, required=True),
        _field("notes", TEXT),
        key="log_id",
        parents={"auth_id": ("authentication", "set_null")},
        defaults={"mfa_used": False, "event_timestamp": NOW},
        checks={
            "event_type": _one_of("event_type", LOGIN_EVENT),
            "login_status": _one_of("login_status", LOGIN_STATUS),
            "mfa_outcome": _one_of("mfa_outcome", MFA_OUTCOME),
        },
    ),
}
