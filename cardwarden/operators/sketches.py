"""Distinct counts of any period from stored sketches, one per key and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_REGISTERS = 14


def relative_error(log_registers: int = LOG_REGISTERS, deviations: float = 3) -> float:
    """Bound on the error of an estimate that holds but for the given number of standard deviations."""
    return deviations * 1.04 / 2 ** (log_registers / 2)


def daily_sketches(
    rows: DataFrame, keys: list[str], at: str, value: str, log_registers: int = LOG_REGISTERS
) -> DataFrame:
    """Rows (day, keys, n, sketch): values seen, and a sketch of the different ones. Nulls are not counted.

    Sketches are begun on the map side, so a frequent key reaches the shuffle as one
    sketch per task; a sketch has a fixed size, however many rows it saw.
    """
    return rows.groupBy(F.to_date(at).alias("day"), *keys).agg(
        F.count(value).alias("n"), F.hll_sketch_agg(F.col(value), log_registers).alias("sketch")
    )


def write_days(sketches: DataFrame, path: str) -> None:
    """Store sketches by day; the days present replace themselves, so a replay changes nothing."""
    writer = sketches.repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("day").parquet(path)


def add_to_days(stored: DataFrame, more: DataFrame, keys: list[str]) -> DataFrame:
    """The sketches of days that later rows belong to, merged; only those days are read."""
    days = more.select("day").distinct()
    held = stored.join(days, "day", "left_semi").select("day", *keys, "n", "sketch")
    return _merged(held.unionByName(more.select(held.columns)), ["day", *keys])


def _merged(parts: DataFrame, keys: list[str]) -> DataFrame:
    return parts.groupBy(*keys).agg(F.sum("n").alias("n"), F.hll_union_agg("sketch").alias("sketch"))


def distinct_over(sketches: DataFrame, keys: list[str], period: Column | None = None) -> DataFrame:
    """Rows (keys, n, estimate): values and different values of the days for which `period`, a condition on day, holds.

    With no keys the period has one row; a period without days has none.
    """
    chosen = sketches if period is None else sketches.filter(period)
    merged = _merged(chosen, keys) if keys else _merged(chosen.withColumn("_all", F.lit(1)), ["_all"]).drop("_all")
    return merged.select(*keys, "n", F.hll_sketch_estimate("sketch").alias("estimate"))
