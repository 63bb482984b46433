"""Declared constraints as checks that list the rows breaking them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.sources.schemas import TABLES
from cardwarden.sources.tables import ingest


def _broken(df: DataFrame, key: str, tests: Sequence[tuple[str, Column]], out: str) -> DataFrame:
    """One row per broken test, from a single pass over the table."""
    found = F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in tests]))
    return df.select(key, F.explode(found).alias(out))


def check_violations(df: DataFrame, rules: Mapping[str, str], key: str) -> DataFrame:
    """Rows failing a rule; a rule that comes out unknown passes."""
    return _broken(df, key, [(name, ~F.expr(rule)) for name, rule in rules.items()], "rule")


def table_check_violations(df: DataFrame, table: str) -> DataFrame:
    declared = TABLES[table]
    return check_violations(df, declared.checks, declared.key)


def duplicate_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with the number of rows."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key has no parent; rows without a key pass."""
    known = parent.select(F.col(parent_key or key).alias(key))
    return child.filter(F.col(key).isNotNull()).join(known, key, "left_anti")


def null_violations(df: DataFrame, cols: Sequence[str], key: str) -> DataFrame:
    """Rows missing a required value, one row per missing column."""
    return _broken(df, key, [(c, F.col(c).isNull()) for c in cols], "column_name")


def length_violations(df: DataFrame, limits: Mapping[str, int], key: str) -> DataFrame:
    """Rows with a text over its limit, one row per column."""
    tests = [(c, F.length(c) > n) for c, n in limits.items()]
    return _broken(df, key, tests, "column_name")


def _all_tables(tables: Mapping[str, DataFrame], find) -> DataFrame:
    """Rows (table_name, row_key, ...) of what is found in each declared table."""
    parts = []
    for name in TABLES:
        found = find(name, ingest(tables[name], name))
        if found is not None:
            key = F.col(TABLES[name].key).cast("string").alias("row_key")
            parts.append(found.select(F.lit(name).alias("table_name"), key, found.columns[-1]))
    return reduce(DataFrame.unionByName, parts)


def declared_check_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every row of every table that breaks a declared check."""
    return _all_tables(
        tables, lambda name, df: table_check_violations(df, name) if TABLES[name].checks else None
    )


def declared_null_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every required value that is missing, in all tables."""
    return _all_tables(
        tables, lambda name, df: null_violations(df, TABLES[name].required, TABLES[name].key)
    )


def declared_length_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every text over its declared length, in all tables."""
    return _all_tables(
        tables,
        lambda name, df: length_violations(df, TABLES[name].lengths, TABLES[name].key) if TABLES[name].lengths else None,
    )


def declared_orphans(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every row whose declared parent does not exist, over all references."""
    parts = []
    for name, declared in TABLES.items():
        child = ingest(tables[name], name)
        for column, (parent, _) in declared.parents.items():
            known = ingest(tables[parent], parent).select(F.col(TABLES[parent].key).alias(column))
            found = child.filter(F.col(column).isNotNull()).join(known, column, "left_anti")
            parts.append(
                found.select(
                    F.lit(name).alias("table_name"),
                    F.col(declared.key).cast("string").alias("row_key"),
                    F.lit(column).alias("column_name"),
                )
            )
    return reduce(DataFrame.unionByName, parts)
