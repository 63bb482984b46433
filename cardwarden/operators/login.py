"""Login security: lockout state from the login log, and reports over it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.functions import expr
from cardwarden.operators import joins, textlists, timeline
from cardwarden.operators.slices import DEFAULT_POLICY, FIND, Hot, SlicePolicy

MAX_FAILURES = 5
LOCK_MINUTES = 30

_TS = "event_timestamp"


def _failure():
    return (F.col("event_type") == "login_failure") & (F.col("login_status") == "failure")


def _success():
    return (F.col("event_type") == "login_success") & (F.col("login_status") == "success")


def _counted(log: DataFrame, policy: SlicePolicy, hot: Hot) -> DataFrame:
    """Counting events of known accounts with the failures since the last success."""
    events = log.filter(F.col("auth_id").isNotNull() & (_failure() | _success())).select(
        "log_id", "auth_id", "event_type", "login_status", "ip_address", _TS
    )
    return timeline.runs_since_reset(
        events, "auth_id", _TS, "log_id", _failure(), _success(),
        out="failed_attempts", policy=policy, hot=hot,
    )


def login_state(
    log: DataFrame,
    as_of=None,
    max_fail: int = MAX_FAILURES,
    lock_minutes: int = LOCK_MINUTES,
    policy: SlicePolicy = DEFAULT_POLICY,
    hot: Hot = FIND,
) -> DataFrame:
    """Per account: failures since the last success, lock, last login.

    Only a success clears the counter; the end of a lock does not.
    """
    place = F.struct(_TS, "log_id")
    states = _counted(log, policy, hot).groupBy("auth_id").agg(
        F.max_by("failed_attempts", place).cast("int").alias("failed_attempts"),
        F.max(F.when(_failure(), F.col(_TS))).alias("_last_failure"),
        F.max(F.when(_success(), F.col(_TS))).alias("last_login_at"),
        F.max_by("ip_address", F.when(_success(), place)).alias("last_login_ip"),
    )
    locked = F.when(
        F.col("failed_attempts") >= max_fail,
        expr.shift(F.col("_last_failure"), lock_minutes, "minute"),
    )
    kind = log.schema[_TS].dataType
    return states.withColumn("locked_until", locked.cast(kind)).select(
        "auth_id", "failed_attempts", "locked_until",
        F.coalesce(F.col("locked_until").cast("timestamp") > expr.instant(as_of), F.lit(False)).alias("is_locked"),
        "last_login_at", "last_login_ip",
    )


def lockout_events(
    log: DataFrame,
    max_fail: int = MAX_FAILURES,
    lock_minutes: int = LOCK_MINUTES,
    policy: SlicePolicy = DEFAULT_POLICY,
    hot: Hot = FIND,
) -> DataFrame:
    """Every failure that sets or extends a lock."""
    kind = log.schema[_TS].dataType
    return (
        _counted(log, policy, hot)
        .filter(_failure() & (F.col("failed_attempts") >= max_fail))
        .select(
            "log_id", "auth_id", _TS, F.col("failed_attempts").cast("int").alias("failed_attempts"),
            expr.shift(F.col(_TS), lock_minutes, "minute").cast(kind).alias("locked_until"),
        )
    )


def apply_login_state(auth: DataFrame, state: DataFrame, as_of=None) -> DataFrame:
    """Accounts with the state the log gives; accounts without events keep theirs."""
    new = state.select(
        "auth_id",
        F.struct("failed_attempts", "locked_until", "last_login_at", "last_login_ip").alias("_new"),
    )
    joined = auth.join(new, "auth_id", "left")
    seen = F.col("_new").isNotNull()
    values = {
        "failed_attempts": F.col("_new.failed_attempts"),
        "locked_until": F.col("_new.locked_until"),
        "last_login_at": F.coalesce("_new.last_login_at", "last_login_at"),
        "last_login_ip": F.coalesce("_new.last_login_ip", "last_login_ip"),
        "updated_at": expr.now_utc(as_of),
    }
    return joined.select(
        *[
            F.when(seen, values[c].cast(auth.schema[c].dataType)).otherwise(F.col(c)).alias(c)
            if c in values
            else F.col(c)
            for c in auth.columns
        ]
    )


# --- reports --------------------------------------------------------------

_LOG_COLUMNS = [
    "log_id", "employee_id", "username_attempted", "event_type", "login_status",
    "failure_reason", "ip_address", "geo_country", "geo_city", "user_agent", "mfa_used",
    "mfa_outcome", _TS, "notes",
]


def _newest_first(df: DataFrame, without: Sequence[str] = ()) -> DataFrame:
    shown = [c for c in _LOG_COLUMNS if c not in without]
    return joins.select_cols(df.orderBy(F.desc(_TS), F.desc("log_id")), shown)


def login_history(log: DataFrame) -> DataFrame:
    return _newest_first(log, ["user_agent"])


def failed_logins(log: DataFrame) -> DataFrame:
    failed = log.filter(F.col("login_status") == "failure")
    return _newest_first(failed, ["login_status", "mfa_used", "mfa_outcome", "notes"])


def suspicious_logins(log: DataFrame, home: Sequence[str] = ("US",)) -> DataFrame:
    """Logins from abroad, for unknown users, or on a locked account."""
    odd = log.filter(
        ~F.col("geo_country").isin(list(home))
        | F.col("event_type").isin("username_not_found", "account_locked")
    )
    shown = _newest_first(odd, ["employee_id", "login_status", "geo_city", "mfa_used", "mfa_outcome", "notes"])
    return shown.withColumn("flag", expr.flag(expr.FLAG_SUSPICIOUS))


def employee_history(log: DataFrame, employee_id: str) -> DataFrame:
    own = joins.by_id(log, "employee_id", employee_id)
    return _newest_first(own, ["employee_id", "username_attempted", "geo_city", "user_agent", "notes"])


def ip_counts(log: DataFrame) -> DataFrame:
    """Events, last event and the rows per address of every employee, address by address."""
    return log.groupBy("employee_id", "ip_address").agg(
        F.count(F.lit(1)).alias("n"), F.max(_TS).alias("last_event")
    )


def _by_employee(log: DataFrame, count_as: str, last_as: str, ips_as: str) -> DataFrame:
    """Summary per employee with the text of all addresses, in order, repeats kept."""
    totals = {
        count_as: (F.count(F.lit(1)), F.sum(count_as)),
        last_as: (F.max(_TS), F.max(last_as)),
    }
    listed = textlists.text_lists(log, ["employee_id"], "ip_address", ips_as, totals)
    return listed.orderBy(F.desc(count_as), "employee_id")


def lockout_summary(log: DataFrame) -> DataFrame:
    locked = log.filter(F.col("event_type") == "account_locked")
    return _by_employee(locked, "lockout_events", "last_lockout", "ips_involved")


def failure_summary(log: DataFrame) -> DataFrame:
    """Failures per employee; those without an employee form one group."""
    failed = log.filter(F.col("login_status") == "failure")
    return _by_employee(failed, "total_failures", "last_failure", "ips_used")


_ACCOUNT = [
    "auth_id", "employee_id", "username", "role", "email", "phone", "is_active", "mfa_enabled",
    "must_change_password", "failed_attempts", "locked_until", "last_login_at", "last_login_ip",
    "password_changed_at", "deactivated_at", "created_at", "account_health",
]


def _with_health(auth: DataFrame, as_of, with_must_change: bool) -> DataFrame:
    return auth.withColumn(
        "account_health",
        expr.account_health(
            "is_active", "locked_until", "must_change_password", "failed_attempts", as_of,
            with_must_change,
        ),
    )


def account_status(auth: DataFrame, as_of=None) -> DataFrame:
    """Accounts by role name with the short form of their health."""
    left_out = {"email", "phone", "password_changed_at", "deactivated_at", "created_at"}
    return joins.select_cols(
        _with_health(auth, as_of, with_must_change=False).orderBy("role", "auth_id"),
        [c for c in _ACCOUNT if c not in left_out],
    )


def account_directory(auth: DataFrame, as_of=None) -> DataFrame:
    """Accounts by role rank with the full form of their health."""
    checked = _with_health(auth, as_of, with_must_change=True)
    return joins.select_cols(
        joins.order_by_rank(checked, "role", expr.ROLE_RANK, "auth_id"), _ACCOUNT
    )
