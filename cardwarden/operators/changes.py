"""Set-based changes of table rows; every function returns the new snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.functions import expr
from cardwarden.operators import joins


def update_from(target: DataFrame, changes: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Take the given columns from the change row of the same key, nulls included."""
    new = changes.select(
        key, F.struct(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in cols]).alias("_new")
    )
    joined = target.join(new, key, "left")
    changed = F.col("_new").isNotNull()
    return joined.select(
        *[
            F.when(changed, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
            for c in target.columns
        ]
    )


def touch(target: DataFrame, changed_ids: DataFrame, key: str, as_of=None) -> DataFrame:
    """Stamp updated_at on the changed rows."""
    stamp = expr.now_utc(as_of)
    if "updated_at" not in target.columns:
        target = target.withColumn("updated_at", F.lit(None).cast("timestamp"))
    stamped = changed_ids.select(key).distinct().withColumn("updated_at", stamp)
    return update_from(target, stamped, key, ["updated_at"])


def delete_keys(target: DataFrame, keys: DataFrame) -> DataFrame:
    return target.join(keys, keys.columns, "left_anti")


def cascade(child: DataFrame, deleted: DataFrame, key: str, mode: str = "cascade") -> DataFrame:
    """Carry a parent's deletion to its children: drop them, or clear their key."""
    gone = deleted.select(key).distinct()
    if mode == "cascade":
        return child.join(gone, key, "left_anti")
    if mode == "set_null":
        marked = joins.lookup(child, gone.withColumn("_gone", F.lit(True)), key)
        kept = F.when(F.col("_gone").isNull(), F.col(key)).alias(key)
        return marked.select(*[kept if c == key else F.col(c) for c in child.columns])
    raise ValueError(f"unknown mode {mode!r}")
