"""The texts of a group: as counted rows, or joined into one text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.operators import joins

# One text of more bytes than this is refused, at any group.
MOST_BYTES = 256 << 20


def text_counts(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Rows (keys, text, n): a group's different texts and how often each occurs.

    The form for groups of any size; it is combined before the shuffle.
    """
    return df.groupBy(*keys, text).agg(F.count(F.lit(1)).alias("n"))


def text_lists(
    df: DataFrame,
    keys: list[str],
    text: str,
    out: str,
    totals: dict[str, tuple[Column, Column]] | None = None,
    sep: str = ", ",
    most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """Per group, in one row, the texts in order, repeats kept, missing ones left out.

    Equal texts are counted before the shuffle, so a group brings one row per
    different text. The length of every group's text is known before it is put
    together; a text that would exceed most_bytes ends the query with a message
    that names the group, instead of becoming several rows or a shorter text.
    totals names further results of the group, each as (aggregate over rows,
    aggregate over those partial values).
    """
    totals = totals or {}
    per_text = df.groupBy(*keys, text).agg(
        F.count(F.lit(1)).alias("_n"), *[first.alias(name) for name, (first, _) in totals.items()]
    )
    size = (F.octet_length(text) + len(sep)) * F.col("_n").cast("decimal(38,0)")
    groups = per_text.groupBy(*keys).agg(
        F.sum(size).alias("_bytes"), *[last.alias(name) for name, (_, last) in totals.items()]
    )
    rows = per_text.drop(*totals).withColumnRenamed(text, "_text")
    named = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
    refused = F.raise_error(
        F.concat(F.lit(f"texts of more than {most_bytes} bytes in one group, use text_counts: "), named)
    )
    repeated = F.array_join(F.array_repeat("_text", F.col("_n").cast("int")), sep)
    entry = F.when(F.col("_bytes") > most_bytes, refused.cast("struct<_text:string,_repeated:string>")).when(
        F.col("_text").isNotNull(), F.struct(F.col("_text"), repeated.alias("_repeated"))
    )
    joined = (
        joins.lookup(rows, groups, keys)
        .withColumn("_entry", entry)
        .groupBy(*keys, *totals)
        .agg(F.array_sort(F.collect_list("_entry")).alias("_entries"))
    )
    texts = F.when(F.size("_entries") > 0, F.array_join("_entries._repeated", sep))
    return joined.select(*keys, *totals, texts.alias(out))
