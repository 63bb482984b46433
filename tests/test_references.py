"""Deletions through references, on small graphs with circles, and numbering with ties."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwarden.operators import references
from cardwarden.sources import tables
from cardwarden.sources.schemas import TABLES, Table


def _table(key, parents):
    fields = [T.StructField(c, T.LongType()) for c in dict.fromkeys([key, *parents])]
    return Table(T.StructType(fields), key, parents=parents)


def test_declared_graph_is_visited_parents_first():
    groups = references.visiting_order(list(TABLES), references.declared_references())
    place = {n: i for i, g in enumerate(groups) for n in g}
    assert place["users"] < min(place[n] for n in ("cards", "user_devices", "user_known_locations"))
    assert all(len(g) == 1 for g in groups)
    with pytest.raises(ValueError):
        references.declared_references(modes={("cards", "nothing"): "cascade"})
    with pytest.raises(ValueError):
        references.declared_references(modes={("cards", "user_id"): "drop"})


# Staff have a head and a team; a team has a lead: two circles. Notes restrict, logs are cleared.
CIRCLE = {
    "staff": _table("staff_id", {"head": ("staff", "cascade"), "team": ("teams", "cascade")}),
    "teams": _table("team_id", {"lead": ("staff", "cascade")}),
    "notes": _table("note_id", {"about": ("staff", "restrict"), "by": ("staff", "cascade")}),
    "logs": _table("log_id", {"who": ("staff", "set_null")}),
}


def _plain(rows, roots):
    """(deleted per table, cleared logs, blocking rows), a root at a time."""
    gone, blocking = {n: set() for n in CIRCLE}, set()
    for table, key in roots:
        if key not in rows[table]:
            continue
        own = {n: set() for n in CIRCLE}
        todo = [(table, key)]
        while todo:
            name, at = todo.pop()
            if at in own[name]:
                continue
            own[name].add(at)
            for child, declared in CIRCLE.items():
                for column, (parent, mode) in declared.parents.items():
                    if parent == name and mode == "cascade":
                        todo += [(child, k) for k, r in rows[child].items() if r[column] == at]
        stops = {(k, "about") for k, r in rows["notes"].items() if r["about"] in own["staff"] and k not in own["notes"]}
        blocking |= {(table, str(key), "notes", str(k), column) for k, column in stops}
        if not stops:
            for n in CIRCLE:
                gone[n] |= own[n]
    cleared = {k for k, r in rows["logs"].items() if r["who"] in gone["staff"] and k not in gone["logs"]}
    return gone, cleared, blocking


@pytest.mark.parametrize("seed", range(3))
def test_circles_blocks_and_clearing(spark, seed):
    dice = random.Random(seed)
    rows = {n: {} for n in CIRCLE}
    sizes = {"staff": 40, "teams": 8, "notes": 12, "logs": 30}
    for name, declared in CIRCLE.items():
        for key in range(sizes[name]):
            picks = {c: dice.choice([None, None, dice.randrange(sizes[p] + 1)]) for c, (p, _) in declared.parents.items()}
            rows[name][key] = {declared.key: key, **picks}
    frames = {
        n: spark.createDataFrame([tuple(r[f.name] for f in CIRCLE[n].schema) for r in rows[n].values()], CIRCLE[n].schema)
        for n in CIRCLE
    }
    roots = [("staff", k) for k in dice.sample(range(45), 6)] + [("teams", 1)]
    asked = {
        n: spark.createDataFrame([(k,) for t, k in roots if t == n] or [(None,)], f"{CIRCLE[n].key} long") for n in ("staff", "teams")
    }
    done = references.delete_through(frames, asked, declared=CIRCLE)
    gone, cleared, blocking = _plain(rows, roots)
    assert {tuple(r) for r in done.blocking.collect()} == blocking
    want = {(n, str(k), "delete", None) for n in CIRCLE for k in gone[n]} | {("logs", str(k), "set_null", "who") for k in cleared}
    got = [tuple(r) for r in done.actions().collect()]
    assert set(got) == want and len(got) == len(want)
    after = {r["log_id"]: r["who"] for r in done.after("logs").collect()}
    assert after == {k: None if k in cleared else r["who"] for k, r in rows["logs"].items() if k not in gone["logs"]}
    assert {r["staff_id"] for r in done.after("staff").collect()} == set(rows["staff"]) - gone["staff"]
    assert done.after("staff").columns == ["staff_id", "head", "team"]


def test_nothing_requested(spark):
    frames = {n: spark.createDataFrame([], CIRCLE[n].schema) for n in CIRCLE}
    done = references.delete_through(frames, {}, declared=CIRCLE)
    assert done.actions().collect() == [] and done.blocking.collect() == []


def test_ids_split_equal_values(spark):
    """One value in half of all rows, rows equal in everything, nulls: places are whole, in order, the same again."""
    rows = [(7 if i % 2 else i % 50, i % 400) for i in range(4000)] + [(None, 1)] * 30
    frame = spark.createDataFrame(rows, "k int, id int").repartition(6)

    def numbered():
        out = tables.number_rows(frame, "k", ["id"], out="place", rows_per_slice=300)
        return sorted((r["place"], r["k"], r["id"]) for r in out.collect())

    got = numbered()
    assert [g[0] for g in got] == list(range(1, len(rows) + 1))
    assert [g[1:] for g in got] == sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert got == numbered()


def test_hot_value_goes_to_many_ranges(spark):
    frame = spark.range(5000).select(F.lit(3).alias("k"), F.col("id"))
    ranges = frame.repartitionByRange(20, "k", "id").groupBy(F.spark_partition_id()).count()
    assert ranges.agg(F.max("count")).first()[0] < 1000
