"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.common import settled


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component) of all linked nodes; a component is named by its smallest node.

    `links` has columns a, b. Each round points the larger neighbours of every
    node to its smallest one, then a node and its smaller neighbours to the
    smallest of these; the rows end as stars. Minima are combined before the
    shuffle and each round is written to the shared folder, so a node with very
    many links is never gathered and the plan does not grow.
    """
    pairs = settled(
        links.filter("a != b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    mark = None
    while True:
        count = pairs.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if (count["n"], count["x"]) == mark or count["n"] == 0:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        mark = (count["n"], count["x"])
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = settled(large.distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = settled(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
