"""Rows of a table that changes over time, as they stood at another row's time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.operators import timeline
from cardwarden.operators.slices import DEFAULT_POLICY, FIND, Hot, SlicePolicy


def in_force(
    rows: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    valid_from: str,
    cols: Sequence[str],
    out: str = "version",
    policy: SlicePolicy = DEFAULT_POLICY,
    hot: Hot = FIND,
) -> DataFrame:
    """Add the version of the row's key that holds at the row's time, as a struct; null before the first one.

    A version holds from its valid_from, that moment included, until the next one
    of its key; of versions with one valid_from the largest in `cols` order wins.
    Rows and versions stand on one time line per key, in one shuffle: a key with many
    versions is not joined with itself, and a frequent key is cut into slices.
    """
    kind = rows.schema[at].dataType
    once = versions.groupBy(key, valid_from).agg(F.max(F.struct(*cols)).alias("_values"))
    marks = once.select(
        F.col(key).cast(rows.schema[key].dataType).alias(key),
        (F.col(valid_from) - F.expr("INTERVAL 1 MICROSECOND")).cast(kind).alias(at),
        "_values",
        F.lit(0).cast("bigint").alias("_no"),
        F.lit(None).cast(rows.select(F.struct(*rows.columns)).schema[0].dataType).alias("_row"),
    )
    own = rows.select(
        key, at, F.lit(None).cast(marks.schema["_values"].dataType).alias("_values"),
        F.lit(1).cast("bigint").alias("_no"), F.struct(*rows.columns).alias("_row"),
    )
    both = timeline.prev_eligible(
        own.unionByName(marks), key, at, "_no", ["_values"], F.col("_row").isNull(), out="_prev", policy=policy, hot=hot
    )
    return both.filter(F.col("_row").isNotNull()).select("_row.*", F.col("_prev._values").alias(out))
