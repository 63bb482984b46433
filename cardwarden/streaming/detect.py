"""All rules over one arriving batch, and the stream that runs them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import timedelta
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cardwarden.functions import expr
from cardwarden.operators import alerts as alert_ops
from cardwarden.operators import geo, merchant, structuring
from cardwarden.operators.slices import DEFAULT_POLICY, FIND, Hot, SlicePolicy
from cardwarden.session import on_store
from cardwarden.sources import tables

POLICIES = {
    geo.ALERT_TYPE: alert_ops.GEO_DECLINING,
    structuring.ALERT_TYPE: alert_ops.STRUCTURING,
    merchant.MCC_TYPE: alert_ops.HIGH_RISK_MCC,
}

_TS = "transaction_timestamp"
_PARTITIONS = (T.StructField("day", T.DateType()), T.StructField("batch", T.IntegerType()))


@dataclass
class Detection:
    """What one batch leads to; alerts, notes and audit rows are planned when asked for."""

    judged: DataFrame  # accepted payments, final status and verdict of every rule
    rejected: DataFrame  # payments of blocked batches
    geo_judged: DataFrame
    arrived: DataFrame  # accepted payments with the status they came with
    merchants: DataFrame
    open_alerts: DataFrame
    as_of: object
    history: DataFrame | None = None
    hot: Hot = FIND  # of the batch's payments

    @cached_property
    def mcc_judged(self) -> DataFrame:
        return merchant.flag_high_risk_mcc(self.arrived, self.merchants)

    @cached_property
    def hits(self) -> DataFrame:
        seen = self.arrived.select("transaction_id", "ip_address")
        if self.history is not None:
            seen = seen.unionByName(self.history.select("transaction_id", "ip_address"))
        return (
            geo.geo_hits(geo.with_prev_address(self.geo_judged.filter("violation"), seen))
            .unionByName(structuring.structuring_hits(self.judged))
            .unionByName(merchant.mcc_hits(self.mcc_judged))
        )

    @cached_property
    def alerts(self) -> alert_ops.Upsert:
        return alert_ops.upsert_open_alerts(self.open_alerts, self.hits, POLICIES, self.as_of)

    @cached_property
    def blocked_alerts(self) -> DataFrame:
        return merchant.blocked_alerts(self.rejected, self.merchants, self.as_of)

    @cached_property
    def notes(self) -> DataFrame:
        return alert_ops.note_rows(self.hits, self.as_of)

    @cached_property
    def audit(self) -> DataFrame:
        return (
            geo.geo_audit(self.geo_judged, self.as_of)
            .unionByName(structuring.structuring_audit(self.judged, self.open_alerts, self.as_of, hot=self.hot))
            .unionByName(merchant.mcc_audit(self.mcc_judged, self.as_of))
            .unionByName(merchant.blocked_audit(self.rejected, self.merchants, self.as_of))
        )


Stage = Callable[[DataFrame, str], DataFrame]


def _unstaged(df: DataFrame, name: str) -> DataFrame:
    return df


def detect_batch(
    batch: DataFrame,
    merchants: DataFrame,
    alerts: DataFrame,
    history: DataFrame | None = None,
    last_accepted: DataFrame | None = None,
    known: DataFrame | None = None,
    as_of=None,
    batch_id: str | None = None,
    policy: SlicePolicy = DEFAULT_POLICY,
    stage: Stage = _unstaged,
) -> Detection:
    """Gate, travel rule, structuring rule, category rule, in this order.

    Payments the travel rule declines no longer count as completed in the
    structuring rule. Results with several consumers go through stage, which
    may store them and return the stored table.
    """
    # A batch within the limit has no frequent keys in any step that goes by its rows.
    hot = None if batch.count() <= policy.rows_per_slice else FIND
    accepted, rejected = merchant.block_batch(batch, merchants, batch_id, hot=hot)
    accepted, rejected = stage(accepted, "accepted"), stage(rejected, "rejected")
    # All columns go through the fold, so no join has to bring them back.
    others = [c for c in accepted.columns if c not in geo.KEPT]
    geo_judged = stage(
        geo.judge_velocity_declining(
            accepted, last_accepted=last_accepted, known=known, policy=policy, more=others,
            hot=hot if known is None else FIND,
        ),
        "geo_judged",
    )
    judged = geo_judged.select(*accepted.columns, F.col("violation").alias("geo_violation"))
    without_place = accepted.filter(~geo.has_place()).withColumn("geo_violation", F.lit(False))
    # The category rule goes by the status a payment arrived with.
    counts = (F.col("transaction_status") != "reversed") & expr.is_high_risk_mcc("merchant_mcc")
    rows = judged.unionByName(without_place).withColumns(
        {
            "arrived_status": F.col("transaction_status"),
            "mcc_flagged": counts,
            "transaction_status": F.when(F.col("geo_violation"), F.lit("declined")).otherwise(
                F.col("transaction_status")
            ),
        }
    )
    past = rows.limit(0) if history is None else history
    structured = stage(structuring.structuring_on_insert(past, rows, as_of, hot=hot), "transactions")
    arrived = structured.withColumn("transaction_status", F.col("arrived_status")).select(
        *batch.columns
    )
    return Detection(structured, rejected, geo_judged, arrived, merchants, alerts, as_of, history, hot)


class DetectionStore:
    """Result tables of the stream, one folder per batch; payments by day, then batch.

    A replayed batch overwrites its own folders and reads the state its
    predecessor left, so every batch counts once. What a batch reads of earlier
    ones does not grow with their number: payments of the days its look-back
    touches, open alerts and last points as changes since a full table, which is
    written every full_every batches. Alerts of types that are never merged are
    written once and not carried.
    """

    def __init__(self, spark: SparkSession, path: str, full_every: int = 20):
        self.spark, self.path, self.full_every = spark, path, full_every

    def _folder(self, table: str, batch: int) -> str:
        return f"{self.path}/{table}/batch={batch}"

    def _present(self, pattern: str) -> list[str]:
        path, files = on_store(self.spark, pattern)
        return [str(f.getPath()) for f in files.globStatus(path) or []]

    def write(self, df: DataFrame, table: str, batch: int) -> None:
        if table == "transactions":
            tables.write_by_day(df, f"{self.path}/{table}", batch=batch)
        else:
            df.write.mode("overwrite").parquet(self._folder(table, batch))

    def _payments(self, folders: list[str], schema: T.StructType) -> DataFrame:
        reader = self.spark.read.schema(T.StructType([*schema, *_PARTITIONS]))
        return reader.option("basePath", f"{self.path}/transactions").parquet(*folders)

    def stage(self, df: DataFrame, table: str, batch: int) -> DataFrame:
        """Store a result and go on from the stored table; an empty one keeps its columns."""
        self.write(df, table, batch)
        if table != "transactions":
            return self.spark.read.schema(df.schema).parquet(self._folder(table, batch)).select(*df.columns)
        folders = self._present(f"{self.path}/transactions/day=*/batch={batch}")
        if not folders:
            return self.spark.createDataFrame([], df.schema)
        return self._payments(folders, df.schema).select(*df.columns)

    def read(self, table: str, batch: int) -> DataFrame:
        if table == "transactions":
            rows = self.spark.read.parquet(f"{self.path}/transactions")
            return rows.filter(F.col("batch") == batch)
        return self.spark.read.parquet(self._folder(table, batch))

    def read_all(self, table: str, schema: T.StructType | None = None) -> DataFrame:
        """All batches of a table; a schema is needed where no batch may have left rows."""
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        if schema is not None and not self._present(f"{self.path}/{table}/*"):
            return self.spark.createDataFrame([], schema)
        return reader.parquet(f"{self.path}/{table}")

    def _since_full(self, table: str, batch: int) -> list[str]:
        """Folders with the full table and the changes that the state before a batch is made of."""
        full = (batch - 1) // self.full_every * self.full_every
        return [self._folder(f"{table}_full", full), *(self._folder(table, b) for b in range(full + 1, batch))]

    def open_alerts(self, batch: int, initial: DataFrame) -> DataFrame:
        """Open alerts of the types that later hits refresh."""
        if batch == 0:
            return _carried(initial)
        full, *changes = self._since_full("alerts", batch)
        reader = self.spark.read.schema(initial.schema)
        parts = reader.parquet(full).withColumn("_no", F.lit(-1))
        for b, folder in enumerate(changes):
            parts = parts.unionByName(reader.parquet(folder).withColumn("_no", F.lit(b)))
        return _carried(_newest(parts))

    def snapshot(self, batch: int, initial: DataFrame) -> DataFrame:
        """Every alert as it stands after a batch."""
        reader = self.spark.read.schema(T.StructType([*initial.schema, _PARTITIONS[1]]))
        changes = reader.parquet(f"{self.path}/alerts").filter(F.col("batch") <= batch)
        parts = initial.withColumn("_no", F.lit(-1)).unionByName(changes.withColumnRenamed("batch", "_no"))
        return _newest(parts)

    def write_alerts(self, found: Detection, before: DataFrame, initial: DataFrame, batch: int) -> None:
        """Changed and new alerts, the highest id, and now and then all that are carried."""
        columns = before.columns
        opened = found.alerts.opened.drop("alert_id").unionByName(
            found.blocked_alerts, allowMissingColumns=True
        )
        highest = initial.agg(F.max("alert_id").alias("top")) if batch == 0 else self.read("ids", batch - 1)
        top = highest.first()["top"] or 0
        numbered = tables.number_rows(
            opened, "user_id", ["alert_type", "transaction_id", "card_id", "alert_message"], offset=top, out="alert_id"
        )
        changed = found.alerts.kept.filter("hits IS NOT NULL")
        self.write(changed.select(*columns).unionByName(numbered.select(*columns)), "alerts", batch)
        written = self.spark.read.schema(before.schema).parquet(self._folder("alerts", batch))
        last = F.greatest(F.max("alert_id"), F.lit(top)).cast("bigint")
        self.write(written.agg(last.alias("top")), "ids", batch)
        if batch % self.full_every == 0:
            parts = before.withColumn("_no", F.lit(0)).unionByName(written.withColumn("_no", F.lit(1)))
            self.write(_carried(_newest(parts)), "alerts_full", batch)

    def history(self, batch: int, payments: T.StructType, as_of, hours: int = 48) -> DataFrame | None:
        """Earlier accepted payments of the days the look-back touches; only their folders are listed."""
        if batch == 0 or as_of is None:
            return None
        days = [(as_of - timedelta(hours=h)).date() for h in range(0, hours + 24, 24)]
        days = sorted({*days, (as_of - timedelta(hours=hours)).date()})
        folders = [f for day in days for f in self._present(f"{self.path}/transactions/day={day}")]
        if not folders:
            return None
        return self._payments(folders, payments).filter(F.col("batch") < batch).drop("batch")

    def known_points(self, batch: int, history: DataFrame | None, customers: DataFrame) -> DataFrame | None:
        """Accepted points of the batch's customers: those of their look-back, and everyone's last one."""
        if batch == 0:
            return None
        kinds = {"_at": T.LongType(), "_id": T.LongType(), "_lat": T.DoubleType(), "_lon": T.DoubleType()}
        self.point_schema = T.StructType(
            [customers.schema["user_id"], *(T.StructField(n, k) for n, k in kinds.items())]
        )
        full, *changes = self._since_full("last_points", batch)
        points = self._points(full, *changes).join(customers, "user_id", "left_semi")
        points = _latest(points)
        if history is not None:
            recent = geo.accepted_points(history)
            points = points.select(recent.columns).unionByName(recent)
        return points.dropDuplicates(["user_id", "_id"])

    def write_points(self, judged: DataFrame, batch: int) -> None:
        """The last accepted point of every customer of the batch; now and then of all customers."""
        points = _latest(geo.accepted_points(judged.filter(~F.col("violation"))))
        self.point_schema = points.schema
        self.write(points, "last_points", batch)
        if batch % self.full_every == 0:
            folders = [self._folder("last_points", batch)]
            if batch:
                folders += self._since_full("last_points", batch)
            self.write(_latest(self._points(*folders)), "last_points_full", batch)

    def _points(self, *folders: str) -> DataFrame:
        """Stored points; the type of user_id is that of the stored table."""
        return self.spark.read.schema(self.point_schema).parquet(*folders)


def _carried(alerts: DataFrame) -> DataFrame:
    return alerts.filter((F.col("alert_status") == "open") & F.col("alert_type").isin(list(POLICIES)))


def _newest(parts: DataFrame) -> DataFrame:
    """Of every alert the row with the highest _no."""
    columns = [c for c in parts.columns if c not in ("alert_id", "_no")]
    newest = F.max_by(F.struct(*columns), "_no").alias("_row")
    return parts.groupBy("alert_id").agg(newest).select("alert_id", "_row.*")


def _latest(points: DataFrame) -> DataFrame:
    fields = ["_at", "_id", "_lat", "_lon"]
    return points.groupBy("user_id").agg(F.max(F.struct(*fields)).alias("_p")).select(
        "user_id", *[F.col(f"_p.{c}").alias(c) for c in fields]
    )


def run_batch(
    store: DetectionStore,
    batch: DataFrame,
    batch_no: int,
    merchants: DataFrame,
    initial_alerts: DataFrame,
    statement_id: str | None = None,
) -> None:
    """Judge one micro-batch and store what follows from it.

    The clock is the batch's latest payment, so a replay gives the same result.
    """
    batch = store.stage(batch, "arrived", batch_no)
    as_of = batch.agg(F.max(_TS).cast("timestamp")).first()[0]
    open_before = store.open_alerts(batch_no, initial_alerts)
    history = store.history(batch_no, batch.schema, as_of)
    customers = batch.select("user_id").distinct()
    if history is not None:  # the rules ask about the batch's customers only
        history = history.join(customers, "user_id", "left_semi").select(history.columns)
    found = detect_batch(
        batch, merchants, open_before, history=history,
        known=store.known_points(batch_no, history, customers),
        as_of=as_of, batch_id=statement_id,
        stage=lambda df, name: store.stage(df, name, batch_no),
    )
    store.write(found.notes, "notes", batch_no)
    store.write(found.audit, "audit", batch_no)
    store.write_alerts(found, open_before, initial_alerts, batch_no)
    store.write_points(found.geo_judged, batch_no)


def start_detection(
    payments: DataFrame,
    store: DetectionStore,
    merchants: DataFrame,
    initial_alerts: DataFrame,
    checkpoint: str,
    statement_id: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Run every rule on each micro-batch of a payment stream."""

    def handle(batch: DataFrame, batch_no: int) -> None:
        run_batch(store, batch, batch_no, merchants, initial_alerts, statement_id)

    writer = payments.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
