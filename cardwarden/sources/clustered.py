"""A table laid out so that lookups by any of several columns read few of its files.

Every column's values get a place among its quantiles; the bits of the places are
interleaved, and rows go into files by ranges of that number. Rows that are near
in all columns then lie in one file, whose smallest and largest values are narrow
in every column, not only in the one sorted first. The ranges of each file are a
small table of their own: a lookup asks it which files can hold the value and
opens no other. Below `path`, `rows/<batch>` has the files and `ranges/<batch>`
their ranges; a batch that is written again is replaced.

Defined results: nulls take the first place, and a lookup does not find them;
rows with equal values in all columns are split by the ties; an empty table has
one file without rows, and lookups on it return none; other columns pass through.
Readers must not run while a batch is written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 8
_PLACE = "__place"


def _number(df: DataFrame, column: str) -> Column:
    """A column that can be ordered as a number: whole numbers and times as long, others as double."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(F.col(column).cast("timestamp"))
    if isinstance(kind, T.IntegralType):
        return F.col(column).cast("long")
    if isinstance(kind, T.NumericType):
        return F.col(column).cast("double")
    raise ValueError(f"cannot cluster by {column}: {kind.simpleString()} is neither a number nor a time")


def quantile_cuts(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> list[list]:
    """For each column the values between its 2 ** bits places; one aggregate, of that size."""
    places = ", ".join(f"{i / 2**bits}D" for i in range(1, 2**bits))
    numbers = df.select(*[_number(df, c).alias(f"c{i}") for i, c in enumerate(columns)])
    found = numbers.agg(
        *[F.expr(f"percentile_approx(c{i}, array({places}), {10 * 2**bits})") for i in range(len(columns))]
    ).first()
    return [cuts or [] for cuts in found]


def place(number: Column, cuts: Sequence, bits: int = BITS) -> Column:
    """How many cuts are not above the number, by halving; null counts as the first place."""
    if not cuts:
        return F.lit(0).cast("long")
    listed = F.expr("array({})".format(", ".join(f"{c}L" if isinstance(c, int) else f"CAST('{c!r}' AS double)" for c in cuts)))
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])

    def halve(at: Column, step: Column) -> Column:
        return F.when(F.get(listed, at + step - 1) <= number, at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), halve).cast("long")


def interleaved(places: Sequence[Column], bits: int = BITS) -> Column:
    """The bits of all places in turn, highest first, as one long."""
    if len(places) * bits > 63:
        raise ValueError("too many bits for a long")
    total = F.lit(0).cast("long")
    for b in range(bits):
        for k, p in enumerate(reversed(places)):
            bit = F.shiftright(p, b).bitwiseAND(F.lit(1).cast("long"))
            total = total.bitwiseOR(F.shiftleft(bit, b * len(places) + k))
    return total


def write_clustered(
    df: DataFrame,
    path: str,
    columns: Sequence[str],
    ties: Sequence[str] = (),
    batch: int = 0,
    rows_per_file: int = 2_000_000,
    least_files: int = 1,
    bits: int = BITS,
) -> None:
    """Lay a batch of rows out by the columns and write the range of every file."""
    spark = df.sparkSession
    numbered = df
    for i, (column, cuts) in enumerate(zip(columns, quantile_cuts(df, columns, bits))):
        numbered = numbered.withColumn(f"{_PLACE}{i}", place(_number(df, column), cuts, bits))
    at = interleaved([F.col(f"{_PLACE}{i}") for i in range(len(columns))], bits)
    placed = numbered.withColumn(_PLACE, at).drop(*[f"{_PLACE}{i}" for i in range(len(columns))])
    files = max(least_files, -(-df.count() // rows_per_file))
    order = [_PLACE, *columns, *ties]
    dealt = placed.repartitionByRange(files, *order).sortWithinPartitions(*order).drop(_PLACE)
    dealt.write.mode("overwrite").parquet(f"{path}/rows/{batch}")
    written = spark.read.schema(df.schema).parquet(f"{path}/rows/{batch}")
    ranges = written.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.lit(batch).cast("long").alias("batch"),
        F.count(F.lit(1)).alias("n_rows"),
        *[F.struct(F.min(c).alias("least"), F.max(c).alias("most")).alias(c) for c in columns],
    )
    ranges.coalesce(1 + files // 10_000).write.mode("overwrite").parquet(f"{path}/ranges/{batch}")


def file_ranges(spark: SparkSession, path: str) -> DataFrame:
    """One row per file with rows: file, batch, n_rows, and (least, most) of every clustered column."""
    return spark.read.parquet(f"{path}/ranges/*")


def files_between(spark: SparkSession, path: str, column: str, low, high) -> list[str]:
    """The files that can hold values from low to high; their number is the driver's only share."""
    ranges = file_ranges(spark, path)
    kind = ranges.schema[column].dataType["least"].dataType
    touched = ranges.filter(
        (F.col(f"{column}.most") >= F.lit(low).cast(kind)) & (F.col(f"{column}.least") <= F.lit(high).cast(kind))
    )
    return [f"{path}/rows/{r['batch']}/{r['file']}" for r in touched.select("batch", "file").toLocalIterator()]


def between(spark: SparkSession, path: str, column: str, low, high) -> DataFrame:
    """Rows whose value lies from low to high, both included."""
    files = files_between(spark, path, column, low, high)
    table = spark.read.parquet(*files) if files else spark.read.parquet(f"{path}/rows/*").filter(F.lit(False))
    kind = table.schema[column].dataType
    return table.filter(F.col(column).between(F.lit(low).cast(kind), F.lit(high).cast(kind)))


def by_value(spark: SparkSession, path: str, column: str, value) -> DataFrame:
    """Rows with a value in a clustered column."""
    return between(spark, path, column, value, value)
