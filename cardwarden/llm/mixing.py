"""Mixing sources to target weights by Sainte-Lague apportionment, in DataFrame functions only.

Words are the tokens. Sources get target amounts (weights, with a ceiling of a
number of passes over a source). The targets are cut into blocks of equal size
and the blocks are given out by highest quotients t / (2 k + 1): first to the
sources, then within each source to its shards. A shard lays its documents out
in a seeded order, cuts them into blocks of equal size (that size up to rounding, so that
no part of a block is left over) and takes its quota: whole passes first, then a
run of blocks from a seeded block on, around the end. What a document gives is
the overlap of its words with the taken blocks.

Bounds: the table of sources has a row per source and one window over it; a
source has at most `most_shards` shards, and its shards meet in one window. A
document is never exploded and a shard is only sorted, so a source that holds a
third of all rows is spread over its shards.

Defined results: a null text has no words; a null source is a source of its
own, ordered last; a source without words has target 0; repeated rows count as
rows, and since equal rows are interchangeable, reruns give the same rows; a
null doc_id is an id like any other; extra columns pass through, but for those
with the name of a result, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.session import stored

ADDED = ("size", "source_size", "target", "taken")
WORD = r"[^\x20\x09-\x0D]+"


def sainte_lague(parties: DataFrame, group: list[str], share: str, seats: Column, tie: list) -> DataFrame:
    """Add `seats`: integer seats of each party within its group, by highest quotients.

    A party with the ideal q = seats * share / total gets round-about q; only the
    quotients near that place are compared. With n parties the seats differ from
    rounded ideals by at most 1.5 n q / seats + 1 in sum, so the first
    floor(q - that) seats are certain, and rows compared are about 5 n in all.
    `tie` orders parties with equal quotients.
    """
    whole = Window.partitionBy(*group)
    base = (
        parties.withColumn("__all", seats)
        .withColumn("__n", F.count(F.lit(1)).over(whole))
        .withColumn("__sum", F.sum(share).over(whole))
    )
    ideal = F.when(F.col("__sum") > 0, F.col("__all") * F.col(share) / F.col("__sum")).otherwise(0.0)
    spread = F.ceil(2 + F.when(F.col("__sum") > 0, 1.5 * F.col("__n") * F.col(share) / F.col("__sum")).otherwise(0.0))
    base = (
        base.withColumn("__low", F.greatest(F.lit(0).cast("long"), F.floor(ideal) - spread))
        .withColumn("__high", F.when(F.col(share) > 0, F.floor(ideal) + spread).otherwise(F.lit(-1).cast("long")))
        .withColumn("__open", F.col("__all") - F.sum("__low").over(whole))
    )
    tried = base.withColumn(
        "__k", F.explode_outer(F.when(F.col("__high") >= F.col("__low"), F.sequence("__low", "__high")))
    ).withColumn("__quotient", F.col(share) / (2 * F.col("__k") + 1))
    by_quotient = whole.orderBy(F.col("__quotient").desc_nulls_last(), *tie, F.col("__k"))
    won = tried.withColumn("__place", F.row_number().over(by_quotient)).withColumn(
        "__won", ((F.col("__place") <= F.col("__open")) & F.col("__k").isNotNull()).cast("long")
    )
    keys = parties.columns
    return won.groupBy(*keys, "__low").agg(F.sum("__won").alias("__more")).select(
        *keys, (F.col("__low") + F.col("__more")).alias("seats")
    )


def source_targets(
    sources: DataFrame, weights: tuple[float, ...], amount: float, most_passes: float
) -> DataFrame:
    """Rows (source, source_size) with `target` words.

    Weights go round over the sources in order of code points, null last. They
    share `amount` times all words; a source stops at `most_passes` times its
    size and the excess is shared again by weight until none is above. The same
    in closed form: with sources in order of ceiling / weight, those before the
    first that can hold the common level are full, the others get level * weight.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"),
    )
    everything = Window.partitionBy()
    ratio = F.col("__ceiling") / F.col("__weight")
    rising = Window.orderBy("__ratio", F.col("source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    onward = rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ranked = (
        sources.withColumn("__weight", weight)
        .withColumn("__ceiling", most_passes * F.col("source_size"))
        .withColumn("__ratio", ratio)
        .withColumn("__wanted", amount * F.sum("source_size").over(everything))
        .withColumn("__full", F.coalesce(F.sum("__ceiling").over(before), F.lit(0.0)))
        .withColumn("__level", (F.col("__wanted") - F.col("__full")) / F.sum("__weight").over(onward))
        .withColumn("__fits", F.when(F.col("__level") <= F.col("__ratio"), F.col("__level")))
    )
    level = F.max("__fits").over(everything)
    return ranked.withColumn("__common", level).select(
        "source",
        "source_size",
        F.when(
            F.col("__common").isNotNull() & (F.col("__common") <= F.col("__ratio")),
            F.col("__common") * F.col("__weight"),
        )
        .otherwise(F.col("__ceiling"))
        .alias("target"),
    )


def mix(
    docs: DataFrame,
    text: str = "text",
    weights: tuple[float, ...] = (5, 2, 1),
    amount: float = 1.5,
    most_passes: int = 2,
    seed: int = 20,
    shard_words: int = 200_000,
    most_shards: int = 1024,
    most_block: int = 1024,
    blocks_per_source: int = 256,
    keep_text: bool = True,
) -> DataFrame:
    """The documents with size, source_size, target and taken.

    A block is 1 / `blocks_per_source` of the smallest source that has words, at
    least one word and at most `most_block`, so that every source has enough
    blocks to come near its target.
    """
    own = [c for c in docs.columns if (keep_text or c != text) and c not in ADDED]
    id_hash = F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce(text, F.lit("")))
    # The document's own columns travel in one struct, so that no name of theirs meets one used here.
    sized = stored(
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in own]).alias("__doc"),
            "source",
            "doc_id",
            F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("__size"),
            id_hash.alias("__hash"),
        )
    )
    sizes = sized.groupBy("source").agg(F.sum("__size").alias("source_size"))
    targets = source_targets(sizes, weights, amount, most_passes)
    everything = Window.partitionBy()
    smallest = F.min(F.when(F.col("source_size") > 0, F.col("source_size"))).over(everything)
    block = F.greatest(F.lit(1), F.least(F.lit(most_block), F.floor(smallest / blocks_per_source))).cast("long")
    blocks = targets.withColumn("block", F.coalesce(block, F.lit(1).cast("long")))
    total = F.round(F.sum("target").over(everything) / F.col("block")).cast("long")
    seated = sainte_lague(
        blocks.withColumn("__one", F.lit(1)).withColumn("__seats", total),
        ["__one"],
        "target",
        F.col("__seats"),
        [F.col("source").asc_nulls_last()],
    )
    shards_of = F.least(F.lit(most_shards), F.ceil(F.col("source_size") / shard_words) + 1).cast("long")
    plan = stored(
        seated.select(
            F.col("source").alias("__source"), "source_size", "target", "block", F.col("seats").alias("__quota"),
            shards_of.alias("__shards"),
        )
    )
    dealt = sized.join(plan, F.col("source").eqNullSafe(F.col("__source")), "left").withColumn(
        "__shard", F.pmod(F.xxhash64("__hash", F.lit(seed + 1)), F.col("__shards"))
    )
    shards = dealt.groupBy("__source", "__shard", "__quota", "block").agg(F.sum("__size").alias("__words"))
    quotas = sainte_lague(
        shards, ["__source"], "__words", F.col("__quota"), [F.col("__shard")]
    ).select(
        F.col("__source").alias("__of"), F.col("__shard").alias("__no"), "seats", F.col("__words"),
    )
    split = dealt.join(
        quotas, F.col("__source").eqNullSafe(F.col("__of")) & (F.col("__shard") == F.col("__no")), "left"
    )
    laid = Window.partitionBy("__source", "__shard").orderBy("__hash", "__size", "doc_id")
    there = split.withColumn("__stop", F.sum("__size").over(laid.rowsBetween(Window.unboundedPreceding, 0)))
    n_blocks = F.greatest(F.lit(1).cast("long"), F.round(F.col("__words") / F.col("block")).cast("long"))
    seats = F.least(F.col("seats"), most_passes * n_blocks)
    first = F.pmod(F.xxhash64(F.lit(seed + 2), F.col("__source"), F.col("__shard")), n_blocks)
    there = (
        there.withColumn("__start", F.col("__stop") - F.col("__size"))
        .withColumn("__blocks", n_blocks)
        .withColumn("__first", first)
        .withColumn("__passes", F.floor(seats / n_blocks))
        .withColumn("__rest", seats % n_blocks)
    )

    def edge(number: Column) -> Column:
        """The word at which a block of the shard begins."""
        return F.floor(number.cast("decimal(19,0)") * F.col("__words") / F.col("__blocks")).cast("long")

    def overlap(low: Column, high: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.col("__stop"), high) - F.greatest(F.col("__start"), low))

    last = F.col("__first") + F.col("__rest")
    ahead = overlap(edge(F.col("__first")), edge(F.least(last, F.col("__blocks"))))
    around = overlap(F.lit(0), edge(F.greatest(F.lit(0), last - F.col("__blocks"))))
    taken = F.col("__passes") * F.col("__size") + ahead + around
    return there.select(
        *[F.col(f"__doc.`{c}`").alias(c) for c in own],
        F.col("__size").alias("size"),
        "source_size",
        "target",
        F.when(F.col("__size") > 0, taken).otherwise(0).cast("long").alias("taken"),
    )


def op10_mixing(docs: DataFrame) -> DataFrame:
    """How many words of every document the mix takes."""
    mixed = mix(docs.select("doc_id", "source", "text"), keep_text=False)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")
