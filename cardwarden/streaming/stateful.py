"""Keyed state over arriving rows: last accepted point, login failures."""

from __future__ import annotations


from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


from cardwarden.functions import expr
from cardwarden.operators import geo, login, merchant, structuring
from cardwarden.session import configure_streams, new_folder, running_stream
from cardwarden.streaming import packed, processors

cloudpickle.register_pickle_by_value(processors)
cloudpickle.register_pickle_by_value(packed)


def _marked(payments: DataFrame, delay: str | None) -> DataFrame:
    """Let the payments' time drive the watermark.

    The marked column goes no further: rows before the watermark reach the handlers,
    which tell them apart, instead of being dropped in front of them.
    """
    if delay is None:
        return payments
    marked = payments.withColumn("_clock", F.col("transaction_timestamp").cast("timestamp"))
    return marked.withWatermark("_clock", delay).drop("_clock")


def _named(rows: DataFrame) -> DataFrame:
    """Names without a leading underscore: the processor gets rows as named tuples."""
    return rows.toDF(*[c.lstrip("_") for c in rows.columns])


# Customers share the calls and the state of their shard; far more of them than tasks, and more with more customers.
SHARDS = 256
# Every bucket touched costs a call to the state store; a shard's bucket is a day.
DAY_S = 86_400


def _sharded(rows: DataFrame, owner: str, shards: int, block: int = 1) -> DataFrame:
    """Rows with their owner as a number and the shard it falls into; a missing owner is one of its own.

    Owners of one block, so many neighbouring numbers, fall into one shard.
    """
    whose = F.coalesce(F.col(owner).cast("bigint"), F.lit(-(2**63)))
    dealt = whose if block == 1 else F.floor(whose / block)
    return rows.withColumns({"owner": whose, "shard": F.pmod(F.xxhash64(dealt), F.lit(shards)).cast("int")})


def geo_velocity_stream(
    payments: DataFrame,
    max_kmh: float = 900,
    ignored: tuple[str, ...] = ("declined", "reversed"),
    look_back_hours: int = 48,
    ttl_ms: int | None = None,
    watermark: str | None = None,
    bucket_s: int = DAY_S,
    frame_rows: int = processors.FRAME_ROWS,
    shards: int = SHARDS,
) -> DataFrame:
    """Judge payments as they arrive against the customer's accepted points.

    The points of the last look_back_hours before the customer's latest one are
    kept, so a payment may come that late and is still judged as if in time. With
    `watermark`, a delay like "2 days", the stream's clock decides instead: points
    go when no payment in time can ask for them, and payments behind the watermark
    are not judged but marked in a further column, `too_late`. The customers of one
    of `shards` shards are judged together; with `ttl_ms` each is a key of their own.
    """
    points = _named(geo._points(_marked(payments, watermark), ignored))
    together = ttl_ms is None
    if together:
        points = _sharded(points, "user_id", shards)
    kept = ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in payments.select(*geo.KEPT).schema
    )
    timed = watermark is not None
    processor = processors.TravelProcessor(
        geo._speed_limit(max_kmh), list(geo.KEPT), None if timed else look_back_hours * 3600, ttl_ms,
        watermark=timed, bucket_s=bucket_s, frame_rows=frame_rows, owner="owner" if together else None, packed=together,
    )
    judged = f"{kept}, {geo.VERDICT_SCHEMA}" + (", too_late boolean" if timed else "")
    if together:
        folded = packed.through_state(points, processor, judged, "EventTime" if timed else "None")
    else:
        folded = points.groupBy("user_id").transformWithStateInPandas(
            statefulProcessor=processor, outputStructType=judged, outputMode="Append",
            timeMode="EventTime" if timed else "ProcessingTime",
        )
    return geo.folded_metrics(folded, max_kmh, ["too_late"] if timed else [])


def structuring_window_stream(
    payments: DataFrame,
    watermark: str,
    threshold: float = 10000,
    min_count: int = 2,
    window_hours: int = 48,
    bucket_s: int = 600,
    frame_rows: int = processors.FRAME_ROWS,
    shards: int = SHARDS,
) -> DataFrame:
    """The structuring test on every arriving payment, from totals that are kept up per customer.

    The window ends at the customer's latest payment, after all of the customer's
    rows of the micro-batch landed. A micro-batch reads the state of its own
    customers only, which lie in cells of one of `shards` shards. Payments behind the watermark are not judged and do not count;
    they come out marked `too_late`.
    """
    marked = _marked(payments, watermark)
    count = F.coalesce(structuring.counts_below(threshold), F.lit(False))
    rows = marked.select(
        *structuring.JUDGED,
        F.col("transaction_id").cast("bigint").alias("id"),
        expr.micros("transaction_timestamp").alias("at"),
        F.col("transaction_amount").cast("decimal(38,2)").alias("amount"),
        F.col("card_id").cast("bigint").alias("card"),
        count.alias("eligible"),
    )
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in payments.select(*structuring.JUDGED).schema)
    totalled = packed.through_state(
        _sharded(rows, "user_id", shards),
        processors.PackedWindows(structuring.JUDGED, window_hours * 3600, bucket_s, frame_rows),
        f"{kept}, txn_count bigint, aggregate_total decimal(38,2), max_card_id bigint, too_late boolean", "EventTime",
    )
    return structuring.judged_by_totals(totalled, threshold, min_count)


def login_state_stream(
    log: DataFrame,
    max_fail: int = login.MAX_FAILURES,
    lock_minutes: int = login.LOCK_MINUTES,
    ttl_ms: int | None = None,
    bucket_s: int = 3600,
    frame_rows: int = processors.FRAME_ROWS,
    shards: int = SHARDS,
) -> DataFrame:
    """The account's failure count and lock after every counting event.

    The accounts of one of `shards` shards are counted together; with `ttl_ms` each is a key of its own.
    """
    ts = "event_timestamp"
    events = log.filter(
        F.col("auth_id").isNotNull() & (login._failure() | login._success())
    ).select(
        F.col("auth_id").cast("bigint").alias("auth_id"),
        F.col("log_id").cast("bigint").alias("log_id"),
        expr.micros(ts).alias("at"),
        login._failure().alias("failed"),
        "ip_address",
    )
    together = ttl_ms is None
    if together:
        events = _sharded(events, "auth_id", shards)
    counted = events.groupBy("shard" if together else "auth_id").transformWithStateInPandas(
        statefulProcessor=processors.LoginProcessor(
            max_fail, lock_minutes, ttl_ms, bucket_s, frame_rows, "owner" if together else None
        ),
        outputStructType=(
            "auth_id bigint, log_id bigint, at bigint, failed_attempts int, locked_until bigint, "
            "last_login_at bigint, last_login_ip string"
        ),
        outputMode="Append",
        timeMode="None" if ttl_ms is None else "ProcessingTime",
    )
    kind = log.schema[ts].dataType

    def moment(name):
        return F.timestamp_micros(name).cast(kind)

    return counted.select(
        "auth_id", "log_id", moment("at").alias(ts), "failed_attempts",
        moment("locked_until").alias("locked_until"),
        moment("last_login_at").alias("last_login_at"), "last_login_ip",
    )


CHANGE = "seq bigint, kind string, transaction_id bigint, merchant_id bigint, day int, amount decimal(38,2)"


def merchant_totals_stream(changes: DataFrame, fanout_safe: bool = False, shards: int = SHARDS) -> DataFrame:
    """Totals per merchant and day, kept up from changes of payments and alerts.

    `changes` has the columns of CHANGE: kind `put` sets a payment's merchant, day
    and amount, `delete` removes it, `alert` and `alert_gone` add an alert of the
    payment and take one away, in the order of seq. Payments, and days of
    merchants, lie in cells of one of `shards` shards; a batch reads the cells of
    the payments it names and of the days they touch, nothing else. Every row that
    comes out replaces those of the same merchant and day with a lower version.
    """
    named = _sharded(changes, "transaction_id", shards, processors.BLOCK)
    moved = packed.through_state(
        named.select("seq", "kind", "merchant_id", "day", "amount", "owner", "shard"),
        processors.PaymentChanges(fanout_safe, "owner", packed=True),
        "merchant_id bigint, day int, n bigint, volume decimal(38,2), raised bigint, amount decimal(38,2), sign int", "None",
    )
    days = moved.withColumn("shard", F.pmod(F.xxhash64("merchant_id", "day"), F.lit(shards)).cast("int"))
    return packed.through_state(
        days, processors.DayTotals(shared=True, packed=True),
        "merchant_id bigint, day int, n bigint, volume decimal(38,2), raised bigint, largest decimal(38,2), version bigint", "None",
    )


def profile_from_totals(totals: DataFrame, merchants: DataFrame) -> DataFrame:
    """merchant_risk_profile from the totals written so far: the newest of each day, then all days of a merchant."""
    newest = totals.groupBy("merchant_id", "day").agg(
        F.max_by(F.struct("n", "volume", "raised", "largest"), "version").alias("t")
    )
    per_merchant = newest.groupBy("merchant_id").agg(
        F.sum("t.n").alias("_n"), F.sum("t.volume").cast("decimal(25,2)").alias("_volume"),
        F.max("t.largest").cast("decimal(15,2)").alias("_largest"), F.sum("t.raised").alias("_raised"),
    )
    return merchant.profile_of(merchants, per_merchant)


def run_available(stream: DataFrame, split_by: str | None = None) -> DataFrame:
    """Run a stream over what its source holds now and return the rows it wrote.

    Rows of different values of `split_by` go to outputs, folders, of their own.
    """
    spark = configure_streams(stream.sparkSession)
    folder = new_folder(spark, "stream")
    writer = stream.writeStream.format("parquet").option("path", f"{folder}/rows")
    if split_by is not None:
        writer = writer.partitionBy(split_by)
    writer = writer.option("checkpointLocation", f"{folder}/state").trigger(availableNow=True)
    with running_stream(spark):
        writer.start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")
