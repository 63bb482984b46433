"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.session import stored

DOC_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder_of_id(key: Column, divisor: int) -> Column:
    """crc32 of the id written as text, modulo the divisor; null for a null id."""
    return F.crc32(key.cast("string").cast("binary")) % divisor


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, learn: Column, most_rows: int
) -> DataFrame:
    """Rows (doc_id, text, n_chars, y, turn): at most `most_rows` labelled documents to learn from.

    Those with the smallest hash of the id, over the ids for which `learn`, a
    condition on doc_id, holds. Labels of repeated ids count as 1 if any is; of
    documents with the same id the smallest row is taken. The ids have the
    stated bound, so they may be broadcast.
    """
    told = labels.filter(learn & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    ids = (
        told.groupBy("doc_id")
        .agg(F.max(label).alias("y"))
        .select("doc_id", "y", F.xxhash64("doc_id").alias("turn"))
        .orderBy("turn", "doc_id")
        .limit(most_rows)
    )
    met = docs.select("doc_id", "text", "n_chars").join(F.broadcast(ids), "doc_id")
    return (
        met.groupBy("doc_id", "y", "turn")
        .agg(F.min(F.struct("text", "n_chars")).alias("d"))
        .select("doc_id", F.col("d.text").alias("text"), F.col("d.n_chars").alias("n_chars"), "y", "turn")
    )


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settled(df: DataFrame) -> DataFrame:
    """`stored`, and the shuffle files of the job that wrote the table are given back at once."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP)
    conf.set(CLEANUP, "true")
    try:
        return stored(df)
    finally:
        conf.set(CLEANUP, before)
