"""Looking back along a key's time line: earlier rows, running and trailing totals.

Every operator takes `hot`: the stored table of frequent keys of its input
(slices.hot_keys), None if it is known to have none, or FIND. Without frequent
keys the plan is one window; with them, windows run per slice and a small
summary of the earlier slices is attached.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.functions import expr
from cardwarden.operators import slices
from cardwarden.operators.slices import DEFAULT_POLICY, FIND, SLICE, Hot, SlicePolicy

_AT = "_at"


def _latest_before(
    df: DataFrame, part: str, ts: str, local, latest: Column, out: str, policy: SlicePolicy, hot: Hot
) -> DataFrame:
    """The row's own look-back inside its slice, else the largest of the earlier slices."""
    timed = df.withColumn(_AT, expr.micros(ts))
    hot = slices.find(hot, timed, [part], _AT, policy)
    if hot is None:
        return timed.withColumn(out, local([part])).drop(_AT)
    marked = slices.mark_slices(timed, hot, [part], _AT)
    summary = slices.hot_only(marked).groupBy(part, SLICE).agg(latest.alias("_latest"))
    carried = slices.carry(summary, [part], {"_carried": F.max("_latest")})
    seen = marked.withColumn("_local", local([part, SLICE]))
    found = slices.attach_carry(seen, carried, [part])
    return slices.drop_marks(
        found.withColumn(out, F.coalesce("_local", "_carried")).drop("_local", "_carried", _AT)
    )


def prev_eligible(
    df: DataFrame,
    part: str,
    ts: str,
    row_id: str,
    cols: Sequence[str],
    eligible: Column,
    out: str = "prev",
    policy: SlicePolicy = DEFAULT_POLICY,
    hot: Hot = FIND,
) -> DataFrame:
    """Add the latest strictly earlier eligible row of the same key as a struct.

    Equal latest times are settled by the larger id.
    """
    point = F.when(eligible, F.struct(_AT, row_id, ts, *cols))

    def before(keys):
        return F.max(point).over(
            Window.partitionBy(*keys).orderBy(_AT).rangeBetween(Window.unboundedPreceding, -1)
        )

    return _latest_before(df, part, ts, before, F.max(point), out, policy, hot)


def previous_row(
    df: DataFrame,
    part: str,
    ts: str,
    row_id: str,
    cols: Sequence[str],
    out: str = "prev",
    policy: SlicePolicy = DEFAULT_POLICY,
    hot: Hot = FIND,
) -> DataFrame:
    """Add the row directly before, in time then id order, as a struct."""
    row = F.struct(_AT, row_id, ts, *cols)

    def before(keys):
        return F.lag(row).over(Window.partitionBy(*keys).orderBy(_AT, row_id))

    return _latest_before(df, part, ts, before, F.max(row), out, policy, hot)


def trailing_totals(
    df: DataFrame,
    part: str,
    ts: str,
    minutes: int,
    amount: str | None = None,
    count_as: str = "trailing_count",
    sum_as: str = "trailing_sum",
    policy: SlicePolicy = DEFAULT_POLICY,
    hot: Hot = FIND,
) -> DataFrame:
    """Count (and total) of the key's rows in the closed span of minutes up to each row.

    Every row enters the running total at its own time and leaves it just after
    the span, so one running sum per slice replaces a moving frame, whose cost
    grows with the square of the rows inside the span.
    """
    span = minutes * 60_000_000
    payload = df.columns
    timed = df.withColumn(_AT, expr.micros(ts))
    hot = slices.find(hot, timed, [part], _AT, policy)
    value = F.col(amount) if amount else F.lit(0)
    enter = F.struct(
        F.col(_AT).alias(_AT), F.lit(1).alias("_one"), value.alias("_value"),
        F.struct(*payload).alias("_row"),
    )
    leave = F.struct(
        (F.col(_AT) + F.lit(span + 1)).alias(_AT), F.lit(-1).alias("_one"),
        (-value).alias("_value"), F.lit(None).alias("_row"),
    )
    steps = timed.select(part, F.explode(F.array(enter, leave)).alias("_step")).select(
        part, "_step.*"
    )
    marked = steps if hot is None else slices.mark_slices(steps, hot, [part], _AT)
    keys = [part] if hot is None else [part, SLICE]
    so_far = (
        Window.partitionBy(*keys)
        .orderBy(_AT)
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    sums = {"_one": "_ones", "_value": "_values"} if amount else {"_one": "_ones"}
    running = marked
    for source, name in sums.items():
        running = running.withColumn(name, F.sum(source).over(so_far))
    if hot is not None:
        totals = (
            slices.hot_only(marked)
            .groupBy(part, SLICE)
            .agg(*[F.sum(source).alias(name) for source, name in sums.items()])
        )
        carried = slices.carry(totals, [part], {f"{name}_in": F.sum(name) for name in sums.values()})
        running = slices.attach_carry(running, carried, [part])
    rows = running.filter(F.col("_one") == 1)

    def total(name):
        return F.col(name) if hot is None else F.col(name) + F.coalesce(F.col(f"{name}_in"), F.lit(0))

    out = [total("_ones").alias(count_as)]
    if amount:
        out.append(total("_values").alias(sum_as))
    return rows.select("_row.*", *out)


def trailing_count(
    df: DataFrame,
    part: str,
    ts: str,
    minutes: int,
    out: str = "trailing_count",
    policy: SlicePolicy = DEFAULT_POLICY,
    hot: Hot = FIND,
) -> DataFrame:
    """Number of the key's rows in the closed span of minutes up to each row."""
    return trailing_totals(df, part, ts, minutes, count_as=out, policy=policy, hot=hot)


def runs_since_reset(
    df: DataFrame,
    part: str,
    ts: str,
    row_id: str,
    hit: Column,
    reset: Column,
    out: str = "hits_since_reset",
    policy: SlicePolicy = DEFAULT_POLICY,
    hot: Hot = FIND,
) -> DataFrame:
    """Number of hits since the key's last reset row, in time then id order.

    One pass: running hits, and running hits at the last reset, which never
    fall, so a maximum keeps the last. A slice adds the hits of the slices before
    it to both.
    """
    timed = df.withColumn(_AT, expr.micros(ts)).withColumn("_hit", F.when(hit, 1).otherwise(0))
    hot = slices.find(hot, timed, [part], _AT, policy)
    marked = timed if hot is None else slices.mark_slices(timed, hot, [part], _AT)
    keys = [part] if hot is None else [part, SLICE]
    so_far = (
        Window.partitionBy(*keys)
        .orderBy(_AT, row_id)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    counted = marked.withColumn("_hits", F.sum("_hit").over(so_far)).withColumn(
        "_at_reset", F.max(F.when(reset, F.col("_hits"))).over(so_far)
    )
    if hot is None:
        total = F.col("_hits") - F.coalesce("_at_reset", F.lit(0))
        return counted.withColumn(out, total).drop(_AT, "_hit", "_hits", "_at_reset")
    summary = slices.hot_only(counted).groupBy(part, SLICE).agg(
        F.max("_hits").alias("_n"), F.max("_at_reset").alias("_r")
    )
    earlier = Window.partitionBy(part).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        summary.withColumn("_hits_in", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .withColumn("_reset_in", F.max(F.col("_hits_in") + F.col("_r")).over(earlier))
        .select(part, SLICE, "_hits_in", "_reset_in")
    )
    based = slices.attach_carry(counted, carried, [part])
    hits_in = F.coalesce("_hits_in", F.lit(0))
    base = F.coalesce(hits_in + F.col("_at_reset"), F.col("_reset_in"), F.lit(0))
    return slices.drop_marks(
        based.withColumn(out, hits_in + F.col("_hits") - base).drop(
            _AT, "_hit", "_hits", "_at_reset", "_hits_in", "_reset_in"
        )
    )
