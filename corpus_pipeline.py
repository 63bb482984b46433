"""From raw documents to a training mix, in stages.

Each stage takes (spark, docs, sf_dir), where docs is all that the stage before
kept, and returns a DataFrame, which is written as Parquet and read again as the
next stage's docs. All but the last return the columns of documents; the last
adds size, source_size, target and taken. SQL cannot express the learnt first
stage, so ORACLE_SQL is None; the tests follow the stages with plain code.

Null ids: quality, decontamination and secrets treat such documents like any
other; the near-duplicate stage keeps them, as they cannot be named.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.llm import decontaminate, minhash, mixing, quality, secrets
from cardwarden.llm.common import DOC_COLUMNS, table
from cardwarden.session import new_folder

DEDUP_POLICY = minhash.MinHashPolicy(shingle=5, percent=80, bands=40, rows=6)


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*DOC_COLUMNS)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labelled ones, does not reject."""
    docs = _documents(docs)
    model = quality.train(docs, table(spark, sf_dir, "labels"), "quality", ~quality.held_out())
    scored = quality.score(docs, model, "__score")
    return _documents(scored.filter(F.col("__score") >= 0.5))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near-duplicates; other texts of its id stay, too."""
    docs = _documents(docs)
    found = minhash.near_duplicates(docs, policy=DEDUP_POLICY)
    kept = found.filter("id = component_id").select(F.col("id").alias("__id")).distinct()
    named = docs.join(kept, docs["doc_id"] == kept["__id"], "left_semi").dropDuplicates(["doc_id", "text"])
    return _documents(named.unionByName(docs.filter("doc_id IS NULL")))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of a benchmark item."""
    found = decontaminate.find_contamination(_documents(docs), table(spark, sf_dir, "benchmark"), out="__found")
    return _documents(found.filter(F.size("__found.hit_words") == 0))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark and n_chars counted again where there were any."""
    found = secrets.find_secrets(_documents(docs), out="__spans")
    hit = found.withColumn("__hit", F.size("__spans") > 0)
    clean = secrets.redact(hit, "text", "__spans")
    chars = F.when(F.col("__hit"), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return _documents(clean.withColumn("n_chars", chars))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix: those of which at least one word is taken."""
    return mixing.mix(_documents(docs)).filter("taken > 0")


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
