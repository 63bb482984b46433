"""Alert upsert.

A hit is (transaction_id, card_id, user_id, alert_type, risk_score,
alert_message, note). One alert stays open per user and type: the first hit
opens it, later hits refresh the columns the rule's policy names. The text each
hit adds is stored as its own note row, so no alert grows without bound;
render_notes joins the notes of chosen alerts into one text.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.functions import expr
from cardwarden.operators import joins
from cardwarden.session import stored

KEY = ["user_id", "alert_type"]


@dataclass(frozen=True)
class UpsertPolicy:
    """Columns a later hit replaces on an open alert."""

    refresh: tuple[str, ...]


GEO_DECLINING = UpsertPolicy(("transaction_id", "risk_score", "alert_message"))
GEO_EVIDENCE = UpsertPolicy(("risk_score", "alert_message"))
STRUCTURING = UpsertPolicy(("risk_score",))
HIGH_RISK_MCC = UpsertPolicy(("risk_score",))

_HIT = ["transaction_id", "card_id", "risk_score", "alert_message"]


class Upsert(NamedTuple):
    """kept: every earlier alert, refreshed where hit; opened: new alerts, without id."""

    kept: DataFrame
    opened: DataFrame

    def snapshot(self) -> DataFrame:
        return self.kept.unionByName(self.opened, allowMissingColumns=True)


def _is_open():
    return F.col("alert_status") == "open"


def group_hits(hits: DataFrame) -> DataFrame:
    """First and last hit and their number per user and type; combines before the shuffle."""
    values = F.struct(*_HIT)
    return hits.groupBy(*KEY).agg(
        F.min_by(values, "transaction_id").alias("_first"),
        F.max_by(values, "transaction_id").alias("_last"),
        F.count(F.lit(1)).alias("hits"),
    )


def open_keys(alerts: DataFrame) -> DataFrame:
    return alerts.filter(_is_open()).select(*KEY).distinct()


def upsert_open_alerts(
    alerts: DataFrame,
    hits: DataFrame,
    policy: UpsertPolicy | Mapping[str, UpsertPolicy],
    as_of=None,
    checkpoint: bool = False,
) -> Upsert:
    """Refresh every open alert of a hit user and type, open one where there is none.

    Hits count in transaction_id order; a refreshed alert takes the last hit's
    values, not the highest. A mapping gives each alert type its own policy.
    The grouped hits feed both results; checkpoint=True stores them, one row
    per user and type, so that costly hits are found only once.
    """
    grouped = group_hits(hits)
    if checkpoint:
        grouped = stored(grouped)
    columns = {f.name: f.dataType for f in alerts.schema}

    def refreshes(name):
        if isinstance(policy, UpsertPolicy):
            return F.lit(name in policy.refresh)
        return F.col("alert_type").isin([t for t, p in policy.items() if name in p.refresh])

    closed = alerts.filter(~F.coalesce(_is_open(), F.lit(False))).withColumn(
        "hits", F.lit(None).cast("bigint")
    )
    matched = joins.lookup(alerts.filter(_is_open()), grouped, KEY)
    hit = F.col("hits").isNotNull()
    refreshed = matched.select(
        *[
            F.when(hit & refreshes(c), F.col(f"_last.{c}").cast(columns[c])).otherwise(F.col(c)).alias(c)
            if c in _HIT
            else F.col(c)
            for c in alerts.columns
        ],
        "hits",
    )
    fresh = grouped.join(open_keys(alerts), KEY, "left_anti")

    def opened_value(name):
        return F.when(refreshes(name), F.col(f"_last.{name}")).otherwise(F.col(f"_first.{name}"))

    values = {
        **{name: opened_value(name) for name in _HIT},
        "user_id": F.col("user_id"),
        "alert_type": F.col("alert_type"),
        "alert_status": F.lit("open"),
        "created_at": expr.now_utc(as_of),
    }
    opened = fresh.select(
        *[
            values.get(name, F.lit(None)).cast(kind).alias(name)
            for name, kind in columns.items()
        ],
        "hits",
    )
    return Upsert(closed.unionByName(refreshed), opened)


def new_alerts(alerts: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates whose user has no open alert of that type."""
    return candidates.join(open_keys(alerts), KEY, "left_anti")


def note_rows(hits: DataFrame, as_of=None) -> DataFrame:
    """The text every hit adds, one row each, to be appended to the notes table."""
    return hits.select(
        *KEY, "transaction_id", expr.now_utc(as_of).alias("noted_at"), "note"
    )


def render_notes(chosen: DataFrame, notes: DataFrame, ids_per_part: int = 10_000) -> DataFrame:
    """Chosen alerts with their notes joined into texts, in payment order.

    One rule at every size: a text holds the notes of a range of ids_per_part
    payment ids, and its row is numbered by that range (part). An alert without
    notes has part 0 and an empty text.
    """
    wanted = notes.join(chosen.select(*KEY).distinct(), KEY, "left_semi")
    part = F.floor(F.col("transaction_id") / ids_per_part).cast("bigint")
    entry = F.struct(
        "transaction_id",
        F.concat(F.lit("--- "), expr.fmt_ts("noted_at"), F.lit(" ---\r\n"),
                 F.coalesce("note", F.lit(""))).alias("text"),
    )
    texts = (
        wanted.withColumn("part", part)
        .groupBy(*KEY, "part")
        .agg(F.array_sort(F.collect_list(entry)).alias("_entries"))
    )
    joined = F.array_join(F.col("_entries.text"), "\r\n")
    return joins.left_many(chosen, texts, KEY).withColumns(
        {
            "part": F.coalesce("part", F.lit(0)),
            "investigation_notes": F.coalesce(joined, F.lit("")),
        }
    ).drop("_entries")
