"""Merkle manifest of a table: a tree of hashes per group, proofs per row, and their check.

Bitmap ranks: the keys of a group are the bits of 64-bit words, merged from all
tasks by `bit_or`; only words with a bit exist. A directory of counts adds up the
words below each container of 2^16 keys, the containers below 2^32, and so on
(four levels, each window at most 65,536 rows), so a row's place among its
group's rows is the directory's count before its word plus the bits below its
own: no sort of the rows, and no group in one task. Rows with one key are placed
by their leaf in the same way, 64 bits of it at a time; equal leaves are
interchangeable and counted.

Slot arrays: a block is `fanout` ** `block_levels` neighbouring nodes, keyed by
place divided by that. Each block's nodes meet as an array by slot, and several
levels of the tree are made of it at once. Block tops are the nodes of the next
round until every group has one, its subroot. The subroots, in order of the
group, are reduced alike to the root. Going back down, a block hands its nodes
the siblings above them once, so no row carries more than its own path.

Only DataFrame functions are used. What is shuffled per row are a few keys and
two 32-byte digests, never a text. Hot groups are spread by words and blocks, a
hot key by the words of its leaves, equal rows by combining them.

Defined results: null values are encoded `-`; a null key comes first in its
group, a null group is a group of its own, before all others; rows with one key
are ordered by leaf; equal rows stay rows of their own, whose proofs differ by
place; an empty table has no rows. Input columns other than those named are not
read, so their names cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.llm.common import settled
from cardwarden.sources.tables import number_rows

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PATH = "array<struct<before:string,after:string>>"


@dataclass
class Manifest:
    """The stored tables of a manifest.

    rounds: blocks (g, block, items, level0, ..., top) of the groups' trees, leaves first;
    tops: the same for the tree over the groups, whose last round is one block.
    """

    rounds: list[DataFrame]
    tops: list[DataFrame]
    fanout: int
    block_levels: int


def encoded(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon, and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def leaves(docs: DataFrame, key: str, group: str, fields: tuple[str, ...], tamper: dict[str, Column], when: Column) -> DataFrame:
    """Rows (g, key, leaf, changed, n): equal rows once, with their number.

    `changed` is the leaf after `tamper` (column: new value) where `when` holds. The
    name g of a group is `-` for null and `=` with the group behind it otherwise.
    """
    g = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))
    own = digest(*[encoded(F.col(c)) for c in fields])
    other = digest(*[encoded(tamper.get(c, F.col(c))) for c in fields])
    rows = docs.select(
        g.alias("g"),
        F.col(key).cast("long").alias("key"),
        F.unhex(own).alias("leaf"),
        F.when(when, F.unhex(other)).alias("changed"),
    )
    return rows.groupBy("g", "key", "leaf", "changed").agg(F.count(F.lit(1)).alias("n"))


def _directory(words: DataFrame, by: list[str]) -> DataFrame:
    """The words with `base`, the rows of the group before each word.

    p3 > p2 > p1 are the word's key without its last 16, 32 and 48 bits; every
    window holds the children of one prefix.
    """
    levels = ["p1", "p2", "p3", "word"]
    total = "rows"
    counts = [words]
    for level in (2, 1, 0):
        keys = [*by, *levels[: level + 1]]
        counts.append(counts[-1].groupBy(*keys).agg(F.sum(total).alias(total)))
    known = None
    for level, table in enumerate(reversed(counts)):
        parent = [*by, *levels[:level]]
        order = Window.partitionBy(*parent).orderBy(levels[level]).rowsBetween(Window.unboundedPreceding, -1)
        table = table.withColumn("within", F.coalesce(F.sum(total).over(order), F.lit(0)))
        if known is None:
            known = table.withColumnRenamed("within", "base")
        else:
            above = known.select(*parent, F.col("base").alias("above"))
            known = table.join(above, parent).withColumn("base", F.col("above") + F.col("within")).drop("above", "within")
    return known


def ranked(rows: DataFrame, by: list[str], key: str, weight: str) -> DataFrame:
    """Add `rank`, the weight of the group's rows with smaller keys, and `alike`, the rows with this key.

    Keys are longs, null below all others; weights are positive. `by` columns are not null.
    """
    zero, null = F.lit(0).cast("long"), F.lit(-(1 << 15) - 1).cast("long")
    prefix = {"p1": F.coalesce(F.shiftright(key, 48), null)}
    prefix |= {n: F.coalesce(F.shiftright(key, b), zero) for n, b in (("p2", 32), ("p3", 16), ("word", 6))}
    bit = F.coalesce(F.col(key).bitwiseAND(63), zero).cast("int")
    placed = rows.withColumns(prefix).withColumn("bit", bit)
    at = [*by, *prefix]
    keys = placed.groupBy(*at, "bit").agg(F.sum(weight).alias("all"), F.count(F.lit(1)).alias("alike"))
    more = F.when((F.col("all") > 1) | (F.col("alike") > 1), F.struct("bit", "all", "alike"))
    one = F.lit(1).cast("long")
    words = keys.groupBy(*at).agg(
        F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"),
        F.sum("all").alias("rows"),
        F.collect_list(more).alias("more"),
    )
    index = settled(_directory(words, by).select(*by, "p1", "word", "bits", "more", "base"))
    met = placed.drop("p2", "p3").join(index, [*by, "p1", "word"])
    below = F.bit_count(F.col("bits").bitwiseAND(F.expr("~shiftleft(-1L, bit)"))).cast("long")
    extra = F.aggregate(
        "more", F.lit(0).cast("long"), lambda s, m: s + F.when(m["bit"] < F.col("bit"), m["all"] - 1).otherwise(F.lit(0))
    )
    alike = F.aggregate("more", one, lambda s, m: F.when(m["bit"] == F.col("bit"), m["alike"]).otherwise(s))
    return met.withColumn("rank", F.col("base") + below + extra).withColumn("alike", alike).drop(
        "p1", "word", "bit", "bits", "more", "base"
    )


def _placed(found: DataFrame) -> DataFrame:
    """The leaves with `at`, the first place of each among the rows of its group."""
    first = settled(ranked(found, ["g"], "key", "n"))
    done = [first.filter("alike = 1").withColumn("at", F.col("rank")).drop("rank", "alike")]
    open_ = first.filter("alike > 1").withColumn("at", F.col("rank")).drop("rank", "alike")
    by = ["g", "at"]
    for part in range(4):
        if open_.isEmpty():
            break
        piece = F.conv(F.hex(F.substring("leaf", 8 * part + 1, 8)), 16, 10).cast("decimal(20,0)")
        signed = (piece + F.lit(-(2**63)).cast("decimal(20,0)")).cast("long")
        # rows still alike share all of their earlier digits, and so their place so far
        step = settled(ranked(open_.withColumn("piece", signed), by, "piece", "n"))
        step = step.withColumn("at", F.col("at") + F.col("rank")).drop("rank", "piece")
        done.append(step.filter("alike = 1").drop("alike"))
        open_ = step.filter("alike > 1").drop("alike")
    # after 256 bits rows are alike in leaf and differ in `changed` only: equal leaves are interchangeable
    else:
        again = Window.partitionBy("g", "at").orderBy("changed").rowsBetween(Window.unboundedPreceding, -1)
        done.append(open_.withColumn("at", F.col("at") + F.coalesce(F.sum("n").over(again), F.lit(0))))
    return reduce(DataFrame.unionByName, done)


def _one_row_each(placed: DataFrame, chunk: int = 1 << 20) -> DataFrame:
    """Equal rows as rows of their own, at neighbouring places; long stretches in two steps."""
    starts = F.sequence(F.col("at"), F.col("at") + F.col("n") - 1, F.lit(chunk).cast("long"))
    low = placed.withColumn("low", F.explode(starts))
    high = F.least(F.col("low") + chunk, F.col("at") + F.col("n")) - 1
    return low.withColumn("place", F.explode(F.sequence("low", high))).drop("low", "at", "n")


def _reduce(nodes: DataFrame, counts: DataFrame, fanout: int, levels: int) -> list[DataFrame]:
    """Rounds of blocks over nodes (g, place, node, payload...) until every group has one node.

    `counts` is (g, count). Each round is stored; a block's row has `items` (nodes by
    slot), `level0`.. (digests; null where the group needs no more) and `top`.
    """
    size = fanout**levels
    rounds: list[DataFrame] = []
    while True:
        payload = [c for c in nodes.columns if c not in ("g", "place", "node")]
        slot = F.struct((F.col("place") % size).alias("slot"), "node", *payload)
        row = (
            nodes.groupBy("g", F.expr(f"place div {size}").alias("block"))
            .agg(F.array_sort(F.collect_list(slot)).alias("items"))
            .join(counts, "g")
            .withColumn("level0", F.transform("items", lambda i: F.lower(F.hex(i["node"]))))
        )
        for level in range(levels):
            row = row.withColumn(f"level{level + 1}", _above(f"level{level}", fanout, F.col("count") > fanout**level))
        tops = [F.col(f"level{level}") for level in range(levels, -1, -1)]
        rounds.append(settled(row.withColumn("top", F.element_at(F.coalesce(*tops), 1)).drop("count")))
        most = counts.agg(F.max("count")).first()[0]
        if most is None or most <= size:
            return rounds
        counts = counts.select("g", F.ceil(F.col("count") / size).cast("long").alias("count"))
        nodes = rounds[-1].select("g", F.col("block").alias("place"), F.unhex("top").alias("node"))


def _above(nodes: str, fanout: int, needed: Column) -> Column:
    """The next level of a block; null if the group had one node already."""
    runs = F.sequence(F.lit(0), F.ceil(F.size(nodes) / fanout).cast("int") - 1)
    joined = F.transform(runs, lambda run: digest(F.array_join(F.slice(nodes, run * fanout + 1, fanout), "")))
    return F.when(needed, joined)


def _own_path(fanout: int, levels: int, slot: Column) -> Column:
    """The siblings of one of a block's nodes, level by level, as an array of (before, after)."""
    steps = []
    for level in range(levels):
        nodes = F.col(f"level{level}")
        at = F.floor(slot / fanout**level).cast("int")
        before = F.array_join(F.slice(nodes, at - at % fanout + 1, at % fanout), "")
        after = F.array_join(F.slice(nodes, at + 2, fanout - 1 - at % fanout), "")
        step = F.struct(before.alias("before"), after.alias("after"))
        steps.append(F.when(F.col(f"level{level + 1}").isNotNull(), step))
    return F.filter(F.array(*steps), lambda s: s.isNotNull())


def _descend(rounds: list[DataFrame], above: DataFrame, fanout: int, levels: int) -> DataFrame:
    """Every node of the first round with `path`, its siblings up to the root.

    `above` is (g, path, more...) for the groups' tops; its columns go on to the nodes.
    """
    carried = [c for c in above.columns if c not in ("g", "path")]
    found = above.withColumn("block", F.lit(0).cast("long"))
    for table in reversed(rounds):
        blocks = table.join(found, ["g", "block"])
        digests = [f"level{n}" for n in range(levels + 1)]
        nodes = blocks.select("g", "block", "path", *carried, *digests, F.explode("items").alias("item"))
        path = F.concat(_own_path(fanout, levels, F.col("item.slot")), F.col("path"))
        place = F.col("block") * fanout**levels + F.col("item.slot")
        payload = [c for c in table.schema["items"].dataType.elementType.names if c != "slot"]
        found = nodes.select(
            "g", place.alias("block"), path.alias("path"), *carried, *[F.col(f"item.{c}").alias(c) for c in payload]
        )
        if table is not rounds[0]:
            found = found.drop("node")
    return found


def build(
    docs: DataFrame,
    key: str = "doc_id",
    group: str = "lang",
    fields: tuple[str, ...] = FIELDS,
    tamper: dict[str, Column] | None = None,
    when: Column | None = None,
    fanout: int = 8,
    block_levels: int = 3,
) -> Manifest:
    """Hash all rows and store the trees. `tamper` and `when` add a second leaf for rows to be checked."""
    never = F.lit(False) if when is None else F.coalesce(when, F.lit(False))
    found = settled(leaves(docs, key, group, fields, tamper or {}, never))
    counts = settled(found.groupBy("g").agg(F.sum("n").alias("count")))
    nodes = _one_row_each(_placed(found)).withColumnRenamed("leaf", "node")
    rounds = _reduce(nodes, counts, fanout, block_levels)
    tops = number_rows(rounds[-1].select("g", "top"), "g", out="place", checkpoint=False)
    over = tops.select(
        F.lit("").alias("g"), (F.col("place") - 1).alias("place"), F.unhex("top").alias("node"), F.col("g").alias("of")
    )
    total = counts.groupBy(F.lit("").alias("g")).agg(F.count(F.lit(1)).alias("count"))
    return Manifest(rounds, _reduce(over, total, fanout, block_levels), fanout, block_levels)


def proofs(made: Manifest) -> DataFrame:
    """Rows (g, key, node, changed, subroot, root, path) for every row of the table; node is its leaf."""
    start = made.tops[-1].select("g", F.array().cast(PATH).alias("path"), F.col("top").alias("root"))
    groups = _descend(made.tops, start, made.fanout, made.block_levels)
    above = groups.select(F.col("of").alias("g"), "path", "root", F.lower(F.hex("node")).alias("subroot"))
    return _descend(made.rounds, above, made.fanout, made.block_levels).drop("block")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda node, step: digest(step["before"], node, step["after"]))


def siblings_digest(path: Column) -> Column:
    return digest(F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), ""))


def op11_merkle_manifest(docs: DataFrame) -> DataFrame:
    """Leaf, roots and proof of every document, and whether the tampered copy still gives the root."""
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    made = build(docs.select(*FIELDS), tamper={"text": ascii_lower(F.col("text"))}, when=picked)
    rows = proofs(made).select(
        F.col("key").alias("doc_id"),
        F.lower(F.hex("node")).alias("leaf"),
        "subroot",
        "root",
        siblings_digest(F.col("path")).alias("proof_sha256"),
        fold(F.lower(F.hex(F.coalesce("changed", "node"))), F.col("path")).alias("folded_root"),
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


_CRC = """xor(list_reduce(
    list_concat([4294967295::UBIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
    lambda crc, byte: list_reduce(
        list_concat([xor(crc, byte)], [0::UBIGINT for z in range(8)]),
        lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)), 4294967295::UBIGINT)"""


def _sql_leaf(text: str) -> str:
    values = [text if f == "text" else f"{f}::VARCHAR" for f in FIELDS]
    return "sha256(" + " || ".join(f"coalesce(strlen({v})::VARCHAR || ':' || {v}, '-')" for v in values) + ")"


def _sql_tree(name: str, levels: int) -> list[str]:
    """Tables name_0 (g, i, h) and up to `levels` more; name_k_run holds the runs of eight of a level."""
    parts = []
    for k in range(levels):
        parts.append(
            f"{name}_{k}_run AS (SELECT g, i // 8 AS i, list(h ORDER BY i) AS hs, max(n) AS n FROM "
            f"(SELECT g, i, h, count(*) OVER (PARTITION BY g) AS n FROM {name}_{k}) GROUP BY g, i // 8)"
        )
        parts.append(
            f"{name}_{k + 1} AS (SELECT g, i, CASE WHEN n > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h "
            f"FROM {name}_{k}_run)"
        )
    return parts


def _sql_walk(name: str, start: str, levels: int, g: str) -> list[str]:
    """Tables walk (doc_id, ..., pos, x, proof) level by level up a tree."""
    parts, last = [], start
    for k in range(levels):
        before, after = "array_to_string(hs[1:(w.pos % 8)], '')", "array_to_string(hs[(w.pos % 8) + 2:], '')"
        parts.append(
            f"{name}_walk_{k} AS (SELECT w.* EXCLUDE (pos, x, proof), w.pos // 8 AS pos, "
            f"CASE WHEN r.n > 1 THEN sha256({before} || w.x || {after}) ELSE w.x END AS x, "
            f"CASE WHEN r.n > 1 THEN w.proof || {before} || {after} ELSE w.proof END AS proof "
            f"FROM {last} w JOIN {name}_{k}_run r ON r.g = w.{g} AND r.i = w.pos // 8)"
        )
        last = f"{name}_walk_{k}"
    return parts


def oracle(levels: int = 8, group_levels: int = 4) -> str:
    """The query's rows in SQL, for groups of at most 8 ** levels rows and 8 ** group_levels groups."""
    upper = f"translate(text, '{UPPER}', '{LOWER}')"
    parts = [
        f"hashed AS (SELECT *, coalesce('=' || lang, '-') AS g, {_sql_leaf('text')} AS leaf, "
        f"CASE WHEN {_CRC} % 3 = 0 THEN {_sql_leaf(upper)} ELSE {_sql_leaf('text')} END AS x FROM documents)",
        "placed AS (SELECT doc_id, g, leaf, x, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos "
        "FROM hashed)",
        "leaf_0 AS (SELECT g, pos AS i, leaf AS h FROM placed)",
        *_sql_tree("leaf", levels),
        "top_0 AS (SELECT 0 AS g, row_number() OVER (ORDER BY encode(g)) - 1 AS i, h, g AS own "
        f"FROM leaf_{levels})",
        *_sql_tree("top", group_levels),
        "start AS (SELECT doc_id, g, leaf, pos, x, '' AS proof FROM placed)",
        *_sql_walk("leaf", "start", levels, "g"),
        "middle AS (SELECT w.doc_id, w.leaf, w.x, w.proof, 0 AS g, t.i AS pos, t.h AS subroot "
        f"FROM leaf_walk_{levels - 1} w JOIN top_0 t ON t.own = w.g)",
        *_sql_walk("top", "middle", group_levels, "g"),
    ]
    return (
        "WITH " + ",\n".join(parts) + "\nSELECT doc_id, leaf, subroot, r.h AS root, sha256(proof) AS proof_sha256, "
        f"x AS folded_root, x = r.h AS verified FROM top_walk_{group_levels - 1}, top_{group_levels} r"
    )


OP11_SQL = oracle()
