"""Ordered work per key that holds when one key owns a large share of the rows.

A window partitioned by user puts every row of a user into one task. Keys above
a row limit are therefore cut into time slices: windows run inside a slice, and
what a slice needs from the slices before it (a latest row, a running total) is
a small per-slice aggregate carried forward. Without such keys, and for all
other keys, the plan is the ordinary window plan.

Slices begin at quantiles of the key's own order values, so bursts and stray
values do not fill one slice; only rows with the same order value stay together.
The table of frequent keys is stored before it is used, so every evaluation of
the plan agrees on the slices.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.session import stored

SLICE = "_slice"
_STARTS = "_starts"

# A key has at most so many slices; beyond FRACTIONS / oversample times the limit they grow with it.
FRACTIONS = 4000
FIND = "find"


@dataclass(frozen=True)
class SlicePolicy:
    """Keys with more than rows_per_slice rows are cut.

    N rows hold at most N / rows_per_slice such keys, which bounds the table of
    frequent keys that is broadcast. oversample makes slices smaller than the
    limit by that factor.
    """

    rows_per_slice: int = 5_000_000
    oversample: int = 4


DEFAULT_POLICY = SlicePolicy()

# What operators take: a stored table of frequent keys, None for none, or FIND.
Hot = DataFrame | str | None


def frequent_keys(df: DataFrame, keys: Sequence[str], policy: SlicePolicy) -> DataFrame | None:
    """Keys above the limit with their number of parts (_parts), stored; None if there are none.

    A table that is itself within the limit needs no look at its keys.
    """
    if df.count() <= policy.rows_per_slice:
        return None
    parts = F.ceil(F.col("_n") * policy.oversample / policy.rows_per_slice)
    found = stored(
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > policy.rows_per_slice)
        .select(*keys, F.greatest(parts, F.lit(2)).cast("bigint").alias("_parts"))
    )
    return None if found.isEmpty() else found


def quantiles(order: str, fractions: int = FRACTIONS) -> Column:
    """The order values at 1/fractions, 2/fractions, ... of the rows, nearly."""
    places = ", ".join(f"{i / fractions}D" for i in range(1, fractions))
    return F.expr(f"percentile_approx(`{order}`, array({places}), {10 * fractions})")


def starts_among(values: Column, parts: Column, fractions: int = FRACTIONS) -> Column:
    """Distinct values at which parts 1, 2, ... of about equal size begin."""
    cuts = F.least(parts, F.lit(fractions))
    places = F.sequence(F.lit(1).cast("bigint"), cuts - 1)
    picked = F.transform(places, lambda i: F.get(values, (F.ceil(i * fractions / cuts) - 1).cast("int")))
    return F.array_distinct(picked)


def hot_keys(df: DataFrame, keys: Sequence[str], order: str, policy: SlicePolicy) -> DataFrame | None:
    """Keys above the limit with the order values at which their slices begin; None if there are none."""
    frequent = frequent_keys(df, keys, policy)
    if frequent is None:
        return None
    rows = df.select(*keys, order).join(F.broadcast(frequent), list(keys))
    sketched = rows.groupBy(*keys, "_parts").agg(quantiles(order).alias("_values"))
    return stored(sketched.select(*keys, starts_among(F.col("_values"), F.col("_parts")).alias(_STARTS)))


def find(hot: Hot, df: DataFrame, keys: Sequence[str], order: str, policy: SlicePolicy) -> DataFrame | None:
    return hot_keys(df, keys, order, policy) if isinstance(hot, str) else hot


def place_among(starts: str, order: Column | str) -> Column:
    """How many of the sorted starts are not above the order value, by halving."""
    order = F.col(order) if isinstance(order, str) else order

    def halve(acc: Column, _: Column) -> Column:
        middle = F.floor((acc["low"] + acc["high"]) / 2).cast("int")
        here = acc["low"] < acc["high"]
        after = here & (F.get(F.col(starts), middle) <= acc["value"])
        return F.struct(
            F.when(after, middle + 1).otherwise(acc["low"]).alias("low"),
            F.when(here & ~after, middle).otherwise(acc["high"]).alias("high"),
            acc["value"].alias("value"),
        )

    begin = F.struct(F.lit(0).alias("low"), F.size(starts).alias("high"), order.alias("value"))
    # As many halvings as this many starts need.
    steps = F.greatest(F.length(F.bin(F.size(starts))), F.lit(1))
    return F.aggregate(F.sequence(F.lit(1), steps), begin, halve, lambda acc: acc["low"])


def mark_slices(df: DataFrame, hot: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Add the slice number to every row: non-decreasing in the order value, 0 for other keys."""
    place = F.when(F.col(_STARTS).isNull(), F.lit(0)).otherwise(place_among(_STARTS, order))
    return (
        df.join(F.broadcast(hot), list(keys), "left")
        .withColumn(SLICE, place.cast("bigint"))
        .withColumn("_hot", F.col(_STARTS).isNotNull())
        .drop(_STARTS)
    )


def hot_only(marked: DataFrame) -> DataFrame:
    return marked.filter("_hot")


def carry(
    summary: DataFrame, keys: Sequence[str], combined: dict[str, Column]
) -> DataFrame:
    """Combine each key's earlier slices; one row per slice, slice count is bounded."""
    earlier = (
        Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    )
    return summary.select(
        *keys, SLICE, *[value.over(earlier).alias(name) for name, value in combined.items()]
    )


def attach_carry(marked: DataFrame, carried: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bring the carried values to the rows; they already sit partitioned by key and slice."""
    return marked.join(carried, [*keys, SLICE], "left")


def drop_marks(df: DataFrame) -> DataFrame:
    return df.drop(SLICE, "_hot")
