"""Merchant rule: blacklisted merchants block, high-risk categories flag."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.functions import expr
from cardwarden.operators import changes as change_ops
from cardwarden.operators import joins
from cardwarden.operators.slices import FIND, Hot
from cardwarden.operators.versions import in_force

BLOCK_TYPE = "blacklisted_merchant"
MCC_TYPE = "high_risk_mcc"
ACTOR = "merchant"


def _blacklisted():
    return F.col("is_blacklisted").cast("boolean")


def merchant_screen(
    txns: DataFrame,
    users: DataFrame,
    merchants: DataFrame,
    codes: Sequence[str] = expr.SCREEN_MCC,
    sort: bool = True,
) -> DataFrame:
    """Payments at a blacklisted merchant or one of the listed categories, labelled; worst and largest first."""
    watched = merchants.filter(
        _blacklisted() | F.col("merchant_category_code").isin(list(codes))
    )
    risk_flag = expr.label(
        [
            (_blacklisted(), expr.FLAG_BLACKLISTED),
            (expr.is_high_risk_mcc("merchant_category_code", codes), expr.FLAG_MCC),
        ],
        "MONITOR",
    )
    named = txns.join(watched, "merchant_id").join(
        users.select("user_id", "first_name", "last_name"), "user_id"
    )
    if sort:
        named = named.orderBy(F.desc("is_blacklisted"), F.desc("transaction_amount"), "transaction_id")
    return joins.select_cols(
        named.withColumns(
            {"user_name": expr.full_name("first_name", "last_name"), "risk_flag": risk_flag}
        ),
        [
            "transaction_id", "user_name", "merchant_name", "merchant_category_code",
            "mcc_description", "transaction_amount", "transaction_timestamp", "ip_address",
            "device_id", "risk_score", "is_blacklisted", "fraud_report_count", "risk_flag",
        ],
    )


def _offenders(batch: DataFrame, merchants: DataFrame) -> DataFrame:
    bad = merchants.filter(_blacklisted()).select("merchant_id")
    return batch.join(bad, "merchant_id", "left_semi").select(*batch.columns)


def gate_by_versions(
    batch: DataFrame, versions: DataFrame, batch_id: str | None = "batch_id", mode: str = "batch",
    valid_from: str = "valid_from", hot: Hot = FIND,
) -> DataFrame:
    """`gate` against merchants whose rows change: each payment meets the version in force at its time."""
    ts = "transaction_timestamp"
    met = in_force(batch, versions, "merchant_id", ts, valid_from, ["is_blacklisted"], out="_version", hot=hot)
    marked = met.withColumn("_bad", F.coalesce(F.col("_version.is_blacklisted").cast("boolean"), F.lit(False)))
    if mode == "row":
        return marked.select(*batch.columns, F.col("_bad").alias("rejected"))
    if mode != "batch":
        raise ValueError(f"unknown mode {mode!r}")
    return _rejected_with(batch, marked.filter("_bad"), batch_id, hot)


def gate(
    batch: DataFrame, merchants: DataFrame, batch_id: str | None = "batch_id", mode: str = "batch",
    hot: Hot = FIND,
) -> DataFrame:
    """Mark the rows to reject.

    mode 'batch' rejects every row of a batch holding a blacklisted merchant,
    mode 'row' only the offending rows. Batches are marked through the distinct
    ids of offending ones, so a batch is never gathered. Rows whose batch id is
    missing form one batch; without a batch id column all rows do.
    """
    if mode == "row":
        bad = merchants.filter(_blacklisted()).select("merchant_id", F.lit(True).alias("_bad"))
        return (
            batch.join(bad, "merchant_id", "left")
            .select(*batch.columns, F.col("_bad").isNotNull().alias("rejected"))
        )
    if mode != "batch":
        raise ValueError(f"unknown mode {mode!r}")
    return _rejected_with(batch, _offenders(batch, merchants), batch_id, hot)


def _rejected_with(batch: DataFrame, found: DataFrame, batch_id: str | None, hot: Hot) -> DataFrame:
    """Mark the rows whose batch holds one of the offending rows."""
    if batch_id is None:
        return batch.withColumn("rejected", found.agg(F.count(F.lit(1)) > 0).scalar())
    blocked = found.select(batch_id).distinct().withColumn("_bad", F.lit(True))
    return joins.lookup(batch, blocked, batch_id, hot=hot).select(
        *batch.columns, F.col("_bad").isNotNull().alias("rejected")
    )


def block_batch(
    batch: DataFrame, merchants: DataFrame, batch_id: str | None = "batch_id", mode: str = "batch",
    hot: Hot = FIND,
) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows."""
    marked = gate(batch, merchants, batch_id, mode, hot)
    return marked.filter(~F.col("rejected")).drop("rejected"), marked.filter("rejected").drop("rejected")


# Facts of a blocked payment that alert and audit rows carry as columns, as far as the tables have them.
BLOCK_FACTS = (
    "merchant_id", "merchant_name", "merchant_category_code", "mcc_description", "fraud_report_count",
    "transaction_amount", "currency_code", "merchant_mcc", "merchant_country", "customer_country",
    "is_online", "device_id", "ip_address", "latitude", "longitude",
)


def _rejected_offences(rejected: DataFrame, merchants: DataFrame) -> DataFrame:
    about = [
        "merchant_id", "merchant_name", "risk_score", "merchant_category_code", "mcc_description",
        "fraud_report_count",
    ]
    bad = joins.select_cols(merchants.filter(_blacklisted()), about)
    return rejected.join(bad, "merchant_id")


def _facts(offences: DataFrame) -> list[str]:
    return [c for c in BLOCK_FACTS if c in offences.columns]


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("N/A"))


def blocked_alerts(rejected: DataFrame, merchants: DataFrame, as_of=None) -> DataFrame:
    """One open alert per offending row, never merged; the payment does not exist.

    Its facts are columns next to those of an alert.
    """
    offences = _rejected_offences(rejected, merchants)
    return offences.select(
        F.lit(None).cast("bigint").alias("transaction_id"),
        "card_id", "user_id",
        F.lit(BLOCK_TYPE).alias("alert_type"),
        expr.alert_score(F.coalesce("risk_score", F.lit(1))).alias("risk_score"),
        F.concat(
            F.lit("Blocked payment of "), F.col("transaction_amount").cast("string"), F.lit(" "),
            F.col("currency_code"), F.lit(" at "), F.col("merchant_name"),
        ).alias("alert_message"),
        F.lit("open").alias("alert_status"),
        expr.lines(
            F.concat(F.lit("Merchant "), _text("merchant_id"), F.lit(" "), _text("merchant_name")),
            F.concat(F.lit("IP address "), _text("ip_address")),
            F.concat(F.lit("At ("), _text("latitude"), F.lit(", "), _text("longitude"), F.lit(")")),
        ).alias("investigation_notes"),
        expr.now_utc(as_of).alias("created_at"),
        *_facts(offences),
    )


def blocked_audit(rejected: DataFrame, merchants: DataFrame, as_of=None) -> DataFrame:
    """One audit row per offending row, without a payment id."""
    offences = _rejected_offences(rejected, merchants)
    return offences.select(
        F.lit(None).cast("bigint").alias("transaction_id"),
        F.lit(None).cast("string").alias("previous_status"),
        F.lit("blocked").alias("new_status"),
        F.lit(ACTOR).alias("changed_by"),
        expr.now_utc(as_of).alias("changed_at"),
        F.concat(
            F.lit("User "), F.col("user_id").cast("string"), F.lit(", card "),
            F.col("card_id").cast("string"), F.lit(", merchant "),
            F.col("merchant_id").cast("string"), F.lit(" "), _text("merchant_name"), F.lit(" of risk "),
            _text("risk_score"), F.lit(", $"), F.col("transaction_amount").cast("string"), F.lit(", IP "),
            _text("ip_address"),
        ).alias("change_reason"),
    )


def block_updates(
    changed: DataFrame, txns: DataFrame, merchants: DataFrame, batch_id: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Apply changed payments unless their batch holds a blacklisted merchant.

    Returns the payments afterwards and the rejected changes.
    """
    accepted, rejected = block_batch(changed, merchants, batch_id)
    cols = [c for c in txns.columns if c != "transaction_id" and c in changed.columns]
    return change_ops.update_from(txns, accepted, "transaction_id", cols), rejected


def flag_high_risk_mcc(
    batch: DataFrame, merchants: DataFrame, codes: Sequence[str] = expr.HIGH_RISK_MCC
) -> DataFrame:
    """Judge every payment that is not reversed by its own category code.

    A payment with an unknown merchant keeps a null merchant risk.
    """
    known = joins.select_cols(
        merchants, ["merchant_id", "merchant_name", "mcc_description", "risk_score", "fraud_report_count"]
    )
    rows = batch.filter(F.col("transaction_status") != "reversed").join(known, "merchant_id", "left")
    return rows.withColumns(
        {
            "flagged": expr.is_high_risk_mcc("merchant_mcc", codes),
            "risk_flag": expr.merchant_risk_flag(F.lit(False), "merchant_mcc", "risk_score", codes),
        }
    )


def mcc_hits(judged: DataFrame) -> DataFrame:
    payment = F.concat(
        F.lit("Payment "), F.col("transaction_id").cast("string"), F.lit(" of $"),
        F.col("transaction_amount").cast("string"), F.lit(" with category "), _text("merchant_mcc"),
    )

    def known(column: str) -> Column:
        return _text(column) if column in judged.columns else F.lit("N/A")

    facts = expr.lines(
        payment,
        F.concat(F.lit("Merchant "), known("merchant_name"), F.lit(", "), known("mcc_description"),
                 F.lit(", fraud reports "), known("fraud_report_count"), F.lit(", "), F.col("risk_flag")),
        F.concat(F.lit("IP address "), known("ip_address"), F.lit(", device "), known("device_id")),
    )
    return judged.filter("flagged").select(
        "transaction_id", "card_id", "user_id",
        F.lit(MCC_TYPE).alias("alert_type"),
        expr.alert_score("risk_score").alias("risk_score"),
        F.concat(payment, F.lit(" at "), F.coalesce("merchant_name", F.lit("N/A"))).alias("alert_message"),
        facts.alias("note"),
    )


def mcc_audit(judged: DataFrame, as_of=None, actual_status: bool = False) -> DataFrame:
    """One audit row per judged payment, flagged or clear."""
    hit = F.col("flagged")
    previous = F.col("transaction_status") if actual_status else F.lit("completed")
    return judged.select(
        "transaction_id",
        F.when(hit, previous).alias("previous_status"),
        F.lit("completed").alias("new_status"),
        F.lit(ACTOR).alias("changed_by"),
        expr.now_utc(as_of).alias("changed_at"),
        F.concat(
            F.when(hit, "Flagged").otherwise("Clear"), F.lit(": "), F.col("risk_flag"),
            F.lit(", category "), _text("merchant_mcc"), F.lit(", $"),
            F.col("transaction_amount").cast("string"), F.lit(" at "), _text("merchant_name"),
            F.lit(" of risk "), _text("risk_score"),
        ).alias("change_reason"),
    )


def merchant_risk_profile(
    merchants: DataFrame,
    txns: DataFrame,
    alerts: DataFrame,
    merchant_id=None,
    fanout_safe: bool = False,
) -> DataFrame:
    """Every merchant with its payments, alerts and risk flag.

    A payment with several alerts counts once per alert, as a plain join of
    the three tables gives; fanout_safe=True counts it once. All payments are
    totalled straight by merchant; only those with alerts meet their alerts,
    counted per payment before, and what these add is totalled apart. So payments
    without an alert need not be shuffled one by one, and neither a busy payment
    nor a busy merchant is gathered.
    """
    per_payment = (
        alerts.filter(F.col("transaction_id").isNotNull())
        .groupBy("transaction_id")
        .agg(F.count("alert_id").alias("_alerts"))
    )
    paid = joins.optional_eq(txns, "merchant_id", merchant_id).select(
        "transaction_id", "merchant_id", "transaction_amount"
    )
    once = paid.groupBy("merchant_id").agg(
        F.count(F.lit(1)).alias("_once"),
        F.sum("transaction_amount").alias("_sum"),
        F.max("transaction_amount").alias("_largest"),
    )
    # Beyond the one time that `once` has counted; an alert whose id is null raises nothing.
    again = F.lit(0) if fanout_safe else F.greatest(F.col("_alerts") - 1, F.lit(0))
    # bigint times decimal(15,2) keeps two digits; the cast keeps the sum exact.
    volume = F.col("transaction_amount") * again.cast("decimal(10,0)")
    more = paid.join(per_payment, "transaction_id").groupBy("merchant_id").agg(
        F.sum(again.cast("bigint")).alias("_again"),
        F.sum(volume).alias("_added"),
        F.sum("_alerts").alias("_raised"),
    )
    none = F.lit(0)
    per_merchant = once.join(more, "merchant_id", "left").select(
        "merchant_id",
        (F.col("_once") + F.coalesce("_again", none)).alias("_n"),
        (F.col("_sum") + F.coalesce("_added", none.cast("decimal(25,2)"))).cast("decimal(25,2)").alias("_volume"),
        "_largest",
        F.coalesce("_raised", none).alias("_raised"),
    )
    return profile_of(joins.optional_eq(merchants, "merchant_id", merchant_id), per_merchant)


def profile_of(merchants: DataFrame, per_merchant: DataFrame) -> DataFrame:
    """Merchants with their totals (_n, _volume, _largest, _raised), zeros where they have none."""
    profile = merchants.join(per_merchant, "merchant_id", "left")
    average = (F.col("_volume") / F.col("_n")).cast("decimal(19,6)")
    zero = F.lit(0)
    shown = profile.withColumns(
        {
            "mcc": F.col("merchant_category_code"),
            "is_high_risk_mcc": expr.is_high_risk_mcc("merchant_category_code"),
            "risk_flag": expr.merchant_risk_flag("is_blacklisted", "merchant_category_code", "risk_score"),
            "total_transactions": F.coalesce("_n", zero).cast("bigint"),
            "total_volume": F.coalesce("_volume", zero).cast("decimal(25,2)"),
            "largest_transaction": F.coalesce("_largest", zero).cast("decimal(15,2)"),
            "avg_transaction": F.coalesce(average, zero).cast("decimal(19,6)"),
            "alerts_raised": F.coalesce("_raised", zero).cast("bigint"),
        }
    )
    return joins.select_cols(
        shown.orderBy(F.desc("is_blacklisted"), F.desc("risk_score"), "merchant_id"),
        [
            "merchant_id", "merchant_name", "mcc", "mcc_description", "country_iso_code",
            "risk_score", "is_blacklisted", "fraud_report_count", "is_high_risk_mcc", "risk_flag",
            "total_transactions", "total_volume", "largest_transaction", "avg_transaction",
            "alerts_raised",
        ],
    )
