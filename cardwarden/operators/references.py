"""Deletions carried through the declared references between tables.

Every requested row is a root. What hangs on it by `cascade` references goes with
it, however deep; `set_null` references to a row that goes are cleared; a
`restrict` reference from a row that does not go with the same root blocks the
root, and then nothing goes for its sake. Tables are visited parents first, each
once; tables that refer to each other in a circle are visited until no row is
added.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.operators import joins
from cardwarden.session import stored
from cardwarden.sources.schemas import TABLES, Table

CASCADE, SET_NULL, RESTRICT = "cascade", "set_null", "restrict"
ROOT = ["root_table", "root_key"]


@dataclass(frozen=True)
class Reference:
    """A column of one table that holds keys of another, and what a deletion there does."""

    child: str
    column: str
    parent: str
    mode: str


def declared_references(
    declared: Mapping[str, Table] = TABLES, modes: Mapping[tuple[str, str], str] | None = None
) -> list[Reference]:
    """All declared references; `modes` replaces the mode of single (table, column)."""
    changed = dict(modes or {})
    found = [
        Reference(child, column, parent, changed.pop((child, column), mode))
        for child, table in declared.items()
        for column, (parent, mode) in table.parents.items()
    ]
    if changed:
        raise ValueError(f"no such references: {sorted(changed)}")
    if unknown := {r.mode for r in found} - {CASCADE, SET_NULL, RESTRICT}:
        raise ValueError(f"unknown modes {sorted(unknown)}")
    return found


def visiting_order(names: list[str], references: list[Reference]) -> list[list[str]]:
    """Groups of tables, parents first; tables of one group reach each other by cascades."""
    below = {n: {r.child for r in references if r.parent == n and r.mode == CASCADE} for n in names}
    reach = {n: set(below[n]) for n in names}
    for middle in names:
        for n in names:
            if middle in reach[n]:
                reach[n] |= reach[middle]
    groups: list[list[str]] = []
    for n in names:
        if not any(n in g for g in groups):
            groups.append([m for m in names if m == n or (m in reach[n] and n in reach[m])])
    # A group stands behind all groups that reach it.
    return sorted(groups, key=lambda g: sum(g[0] in reach[n] for n in names if n not in g))


@dataclass
class Deletion:
    """What goes, what is cleared and what stands in the way."""

    tables: Mapping[str, DataFrame]
    keys: Mapping[str, str]
    references: list[Reference]
    gone: dict[str, DataFrame]  # (key, root_table, root_key) of roots that are not blocked
    blocking: DataFrame  # (root_table, root_key, table_name, row_key, column_name)

    def _cleared(self, reference: Reference) -> DataFrame:
        """Rows of the child that stay and lose their key."""
        parents = self.gone[reference.parent].select(F.col(self.keys[reference.parent]).alias(reference.column))
        key = self.keys[reference.child]
        stays = self.tables[reference.child].join(self.gone[reference.child].select(key), key, "left_anti")
        return stays.join(parents, reference.column, "left_semi")

    def actions(self) -> DataFrame:
        """Rows (table_name, row_key, action, column_name): `delete` with no column, `set_null` with one."""
        parts = []
        for name, rows in self.gone.items():
            keys = rows.select(F.col(self.keys[name]).cast("string").alias("row_key")).distinct()
            parts.append(_labelled(keys, name, "delete", None))
        for r in self.references:
            if r.mode == SET_NULL:
                keys = self._cleared(r).select(F.col(self.keys[r.child]).cast("string").alias("row_key"))
                parts.append(_labelled(keys, r.child, SET_NULL, r.column))
        return reduce(DataFrame.unionByName, parts)

    def after(self, name: str) -> DataFrame:
        """A table without the rows that go, with cleared keys; columns as before."""
        table, key = self.tables[name], self.keys[name]
        rows = table.join(self.gone[name].select(key), key, "left_anti")
        for r in self.references:
            if r.child == name and r.mode == SET_NULL:
                parents = self.gone[r.parent].select(F.col(self.keys[r.parent]).alias(r.column)).distinct()
                rows = joins.lookup(rows, parents.withColumn("_gone", F.lit(True)), r.column)
                rows = rows.withColumn(r.column, F.when(F.col("_gone").isNull(), F.col(r.column))).drop("_gone")
        return rows.select(table.columns)


def _labelled(keys: DataFrame, table: str, action: str, column: str | None) -> DataFrame:
    return keys.select(
        F.lit(table).alias("table_name"), "row_key", F.lit(action).alias("action"),
        F.lit(column).cast("string").alias("column_name"),
    )


def delete_through(
    tables: Mapping[str, DataFrame],
    requested: Mapping[str, DataFrame],
    declared: Mapping[str, Table] = TABLES,
    modes: Mapping[tuple[str, str], str] | None = None,
) -> Deletion:
    """Delete the requested rows (per table, a table with its key) and what the references demand.

    Keys are kept next to their roots, never rows. Requests without a row in their
    table ask for nothing; null keys and null references point nowhere.
    """
    references = declared_references(declared, modes)
    names, keys = list(declared), {n: t.key for n, t in declared.items()}
    present = {n: tables[n].select(keys[n], *[r.column for r in references if r.child == n and r.column != keys[n]]) for n in names}
    found: dict[str, DataFrame] = {}
    for group in visiting_order(names, references):
        inner = [r for r in references if r.mode == CASCADE and r.parent in group and r.child in group]
        outer = [r for r in references if r.mode == CASCADE and r.child in group and r.parent not in group]
        new = {n: [_roots(present[n], requested.get(n), n, keys[n])] for n in group}
        for r in outer:
            new[r.child].append(_followed(present[r.child], found[r.parent], r, keys))
        for n in group:
            found[n] = stored(reduce(DataFrame.unionByName, new[n]).distinct())
        front = {n: found[n] for n in group}
        while inner:
            step = {}
            for n in {r.child for r in inner}:
                parts = [_followed(present[n], front[r.parent], r, keys) for r in inner if r.child == n and r.parent in front]
                if parts:
                    fresh = reduce(DataFrame.unionByName, parts).distinct().join(found[n], [keys[n], *ROOT], "left_anti")
                    step[n] = stored(fresh)
            front = {n: rows for n, rows in step.items() if not rows.isEmpty()}
            if not front:
                break
            for n, rows in front.items():
                found[n] = stored(found[n].unionByName(rows))
    blocking = stored(_blocking(present, found, references, keys))
    blocked = blocking.select(*ROOT).distinct()
    gone = {n: stored(rows.join(blocked, ROOT, "left_anti")) for n, rows in found.items()}
    return Deletion(tables, keys, references, gone, blocking)


def _roots(table: DataFrame, wanted: DataFrame | None, name: str, key: str) -> DataFrame:
    rows = table.select(key).limit(0) if wanted is None else table.select(key).join(wanted.select(key), key, "left_semi")
    return rows.select(key, F.lit(name).alias("root_table"), F.col(key).cast("string").alias("root_key"))


def _followed(child: DataFrame, parents: DataFrame, reference: Reference, keys: Mapping[str, str]) -> DataFrame:
    """The child's rows that hold a key of the parents, with the parents' roots."""
    held = parents.select(F.col(keys[reference.parent]).alias("_held"), *ROOT)
    own = child.select(F.col(keys[reference.child]), F.col(reference.column).alias("_held"))
    return own.join(held, "_held").select(keys[reference.child], *ROOT)


def _blocking(
    present: Mapping[str, DataFrame], found: Mapping[str, DataFrame], references: list[Reference], keys: Mapping[str, str]
) -> DataFrame:
    """Rows that refer by `restrict` to a row that would go, and would not go with the same root."""
    parts = []
    for r in references:
        if r.mode == RESTRICT:
            key = keys[r.child]
            stays = _followed(present[r.child], found[r.parent], r, keys).join(found[r.child], [key, *ROOT], "left_anti")
            parts.append(
                stays.select(
                    *ROOT, F.lit(r.child).alias("table_name"), F.col(key).cast("string").alias("row_key"),
                    F.lit(r.column).alias("column_name"),
                )
            )
    if not parts:
        return next(iter(found.values())).limit(0).select(
            *ROOT, *[F.lit(None).cast("string").alias(c) for c in ("table_name", "row_key", "column_name")]
        )
    return reduce(DataFrame.unionByName, parts)
