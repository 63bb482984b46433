"""Reading, typing, completing and storing table rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardwarden.functions import expr
from cardwarden.operators import slices
from cardwarden.session import stored
from cardwarden.sources.schemas import NOW, TABLES


def scan(spark: SparkSession, folder: str, table: str, fmt: str = "parquet") -> DataFrame:
    """Open one table of a folder; csv and json take the declared schema if there is one."""
    reader = spark.read.format(fmt)
    if fmt != "parquet" and table in TABLES:
        reader = reader.schema(TABLES[table].schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(f"{folder}/{table}.{fmt}")


def scan_stream(spark: SparkSession, folder: str, table: str, files_per_batch: int | None = None) -> DataFrame:
    """The parquet files of one table of a folder as a stream."""
    schema = spark.read.parquet(f"{folder}/{table}.parquet").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{table}*.parquet")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def ingest(df: DataFrame, table: str) -> DataFrame:
    """Bring rows to the table's columns and types; absent columns become null."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in TABLES[table].schema
        ]
    )


# More ranges than this are made only to keep each one within the default limit: every range is a task and a file.
MOST_RANGES = 200
ROWS_PER_SLICE = 2_000_000


def number_rows(
    df: DataFrame,
    order: str | Column,
    ties: Sequence[str] = (),
    offset: int | Column = 0,
    out: str = "row_id",
    rows_per_slice: int = ROWS_PER_SLICE,
    checkpoint: bool = True,
) -> DataFrame:
    """Consecutive ids offset+1.. in the order of a column and the ties, without one global sort task.

    Beyond the limit rows are dealt to ranges of (order, ties, place in the input),
    so equal order values, and rows equal in all of these, are split too; ids are
    places within a range, shifted by the row counts of the ranges before. Only
    those counts meet in one task. A small limit makes at most MOST_RANGES ranges
    of the size this takes, as long as ROWS_PER_SLICE holds. Nulls come first. Rows that differ should
    differ in `order` or `ties`, then a replay gives every row the same id. The
    rows are read several times, so they are stored first unless checkpoint=False
    says that they come from a table anyway.
    """
    rows = df.withColumn("_order", expr.col(order))
    if checkpoint:
        rows = stored(rows)
    start = expr.operand(offset).cast("bigint")
    count = rows.count()
    if count <= rows_per_slice:
        place = F.row_number().over(Window.orderBy("_order", *ties))
        return rows.withColumn(out, start + place).drop("_order")
    keys = ["_order", *ties, "_seat"]
    most = max(MOST_RANGES, -(-2 * count // ROWS_PER_SLICE))
    ranges = (
        rows.withColumn("_seat", F.monotonically_increasing_id())
        .repartitionByRange(min(-(-2 * count // rows_per_slice), most), *keys)
        .withColumn("_part", F.spark_partition_id())
    )
    # Stored, so that counts and places speak of the same ranges.
    ranged = stored(ranges)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        ranged.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*keys))
    return (
        ranged.withColumn("_place", place)
        .join(shifts, "_part")
        .withColumn(out, start + F.col("_before") + F.col("_place"))
        .drop("_part", "_place", "_before", "_order", "_seat")
    )


def fill_defaults(
    df: DataFrame,
    table: str,
    as_of=None,
    id_offset: int | Column | None = None,
    id_order: str | Column | None = None,
    id_ties: Sequence[str] = (),
) -> DataFrame:
    """Declared defaults for missing values, then ids for rows without one."""
    declared = TABLES[table]
    typed = ingest(df, table)
    values = {
        name: expr.now_utc(as_of) if value is NOW else F.lit(value)
        for name, value in declared.defaults.items()
    }
    kinds = {f.name: f.dataType for f in declared.schema}
    filled = typed.withColumns(
        {name: F.coalesce(F.col(name), value.cast(kinds[name])) for name, value in values.items()}
    )
    if id_offset is None:
        return filled
    numbered = number_rows(filled, id_order, id_ties, offset=id_offset, out="_id")
    key = declared.key
    return numbered.withColumn(
        key, F.coalesce(F.col(key), F.col("_id").cast(kinds[key]))
    ).drop("_id")


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Add rows to a stored table."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def write_by_day(txns: DataFrame, path: str, mode: str = "append", batch: int | None = None) -> None:
    """Store payments by day, so look-back filters read only the days they need.

    Rows are rebalanced by day before the write: few files per day, and a large
    day still goes to several tasks. With a batch number its rows go into their
    own folders below the days, and a replay of the batch replaces just those.
    """
    dated = txns.withColumn("day", F.to_date("transaction_timestamp"))
    if batch is None:
        dated.hint("rebalance", "day").write.mode(mode).partitionBy("day").parquet(path)
        return
    numbered = dated.withColumn("batch", F.lit(batch)).hint("rebalance", "day")
    writer = numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("day", "batch").parquet(path)


def since_days(stored: DataFrame, as_of, hours: int) -> DataFrame:
    """Prune a table stored by day to the days a look-back of hours can touch."""
    start = F.to_date(expr.shift(expr.instant(as_of), -hours, "hour"))
    return stored.filter(F.col("day") >= start)
