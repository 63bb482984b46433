"""Join forms that stay balanced when one key is very frequent."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.functions import expr
from cardwarden.operators import slices
from cardwarden.operators.slices import DEFAULT_POLICY, FIND, Hot, SlicePolicy


def select_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The wanted columns, in order, as far as the table has them."""
    present = set(df.columns)
    return df.select(*[c for c in cols if c in present])


def left_many(
    left: DataFrame,
    right: DataFrame,
    keys: str | Sequence[str],
    policy: SlicePolicy = DEFAULT_POLICY,
    hot: Hot = FIND,
) -> DataFrame:
    """Left join to a side that may repeat a key very often.

    An outer join cannot split a frequent key of its right side. So only rows of
    keys that the right side repeats beyond the limit take another way: the right
    rows are spread over salts, the left rows repeated for each salt, and both
    meet in an inner join, as every such key has a match. All other rows meet in
    one ordinary left join, and without frequent keys there is nothing else.
    N right rows hold at most N / rows_per_slice frequent keys, the only rows
    that are broadcast. Right rows should differ in some column, as equal rows
    share a salt.
    """
    on = [keys] if isinstance(keys, str) else list(keys)
    frequent = slices.frequent_keys(right, on, policy) if isinstance(hot, str) else hot
    if frequent is None:
        return left.join(right, on, "left")
    few = F.broadcast(frequent)
    ordinary = left.join(few, on, "left_anti").join(right.join(few, on, "left_anti"), on, "left")
    repeated = left.join(few, on).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1))
    ).drop("_parts")
    spread = right.join(few, on).withColumn(
        "_salt", F.pmod(F.xxhash64(*right.columns), F.col("_parts"))
    ).drop("_parts")
    return ordinary.unionByName(repeated.join(spread, [*on, "_salt"]).drop("_salt"))


def _same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    """The right side with renamed keys, and the condition under which keys agree, nulls included."""
    renamed = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    return renamed, reduce(and_, [left[k].eqNullSafe(renamed[f"_{k}"]) for k in keys])


def _join_same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    renamed, condition = _same_keys(left, right, keys)
    return left.join(renamed, condition, "left").drop(*[f"_{k}" for k in keys])


def lookup(
    rows: DataFrame,
    table: DataFrame,
    keys: str | Sequence[str],
    policy: SlicePolicy = DEFAULT_POLICY,
    hot: Hot = FIND,
) -> DataFrame:
    """Left join to a computed table with one row per key; missing keys agree.

    Skew handling at run time needs plain shuffles below the join, which an
    aggregated side lacks. So where the rows have frequent keys, their rows are
    spread over salts here, and the key's one row is repeated for each; the table
    of frequent keys has the bound given for left_many. Otherwise this is a join.
    """
    on = [keys] if isinstance(keys, str) else list(keys)
    frequent = slices.frequent_keys(rows, on, policy) if isinstance(hot, str) else hot
    if frequent is None:
        return _join_same(rows, table, on)
    few = F.broadcast(frequent)
    used = F.coalesce("_parts", F.lit(1))
    spread = _join_same(rows, few, on).withColumn(
        "_salt", F.pmod(F.xxhash64(*rows.columns), used)
    ).drop("_parts")
    repeated = _join_same(table, few, on).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), used - 1))
    ).drop("_parts")
    return _join_same(spread, repeated, [*on, "_salt"]).drop("_salt")


def optional_eq(df: DataFrame, column: str, value=None) -> DataFrame:
    """Filter by a value, or keep all rows when none is given."""
    return df if value is None else df.filter(F.col(column) == value)


def by_id(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) == value)


def bound(df: DataFrame, column: str, moment: Column) -> Column:
    """A moment in the column's own type, so that the comparison reaches the scan."""
    return moment.cast(df.schema[column].dataType)


def since(df: DataFrame, column: str, n: int, unit: str, as_of=None) -> DataFrame:
    """Rows of the last n hours or days."""
    start = expr.shift(expr.instant(as_of), -n, unit)
    return df.filter(F.col(column) >= bound(df, column, start))


def latest_before(df: DataFrame, key: str, ts: str, row_id: str, moment) -> DataFrame:
    """The latest row of every key before a moment."""
    rest = [c for c in df.columns if c != key]
    earlier = df.filter(F.col(ts) < bound(df, ts, expr.instant(moment)))
    newest = F.max_by(F.struct(*rest), F.struct(ts, row_id))
    return earlier.groupBy(key).agg(newest.alias("_row")).select(key, "_row.*")


def order_by_rank(df: DataFrame, column: str, ranks: dict, *more) -> DataFrame:
    """Sort by a rank given per value; values without one come first."""
    return df.orderBy(expr.map_case(column, ranks), *more)


def order_by_risk(df: DataFrame, *more, rank_risk: bool = False) -> DataFrame:
    """Sort by risk profile, as text descending or by severity."""
    first = expr.risk_rank("risk_profile").asc() if rank_risk else F.desc("risk_profile")
    return df.orderBy(first, *more)
