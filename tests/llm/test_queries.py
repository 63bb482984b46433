"""The registered corpus queries: SQL oracles, and the pipeline by plain code."""

import compare
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from cardwarden.llm import decontaminate, mixing, registry, secrets
from cardwarden.llm.common import DOC_COLUMNS

FOLDER = "/root/testdata/sf0.001"


def test_all_operators_are_registered():
    numbers = {name.split("_")[0] for name in registry.QUERIES}
    assert numbers == {f"op{i}" for i in range(1, 14)}
    assert set(registry.ORACLE) <= set(registry.QUERIES)
    assert set(registry.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(registry.ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(registry.ORACLE))
def test_against_sql(spark, name):
    con = compare.connect(FOLDER)
    assert compare.differences(registry.QUERIES[name](spark, FOLDER), con, registry.ORACLE[name]) is None


@pytest.mark.parametrize("name", [n for n in registry.QUERIES if n not in registry.ORACLE])
def test_one_row_per_document(spark, name):
    table = "pages" if "html" in name else "documents"
    rows = registry.QUERIES[name](spark, FOLDER).count()
    assert rows == spark.read.parquet(f"{FOLDER}/{table}.parquet").count()


def test_pipeline_stages(spark, tmp_path):
    """Every stage against plain code on its own input."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        path = str(tmp_path / name)
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
        after = {r["doc_id"]: r for r in docs.collect()}
        assert set(after) <= set(before)
        if name != "mixing":
            assert tuple(docs.columns) == DOC_COLUMNS
        if name == "quality":
            bad = {r["doc_id"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").filter("quality = 0").collect()}
            kept = len(bad & set(after))
            assert kept <= 0.1 * len(bad) and len(after) >= 0.95 * (len(before) - len(bad) * len(before) / 90)
        elif name == "near_duplicates":
            assert set(after) == _kept_by_brute_force({k: r["text"] for k, r in before.items()})
        elif name == "decontamination":
            assert set(after) == {k for k, r in before.items() if not decontaminate.brute_force(r["text"], items)[1]}
        elif name == "secrets":
            for k, r in before.items():
                assert after[k]["text"] == _masked(r["text"])
                assert after[k]["n_chars"] == (len(after[k]["text"]) if after[k]["text"] != r["text"] else r["n_chars"])
        elif name == "mixing":
            sizes = {k: len(r["text"].split()) for k, r in before.items()}
            assert all(0 < r["taken"] <= 2 * sizes[k] == 2 * r["size"] for k, r in after.items())
            for source in {r["source"] for r in after.values()}:
                own = [r for r in after.values() if r["source"] == source]
                assert sum(r["taken"] for r in own) == pytest.approx(own[0]["target"], rel=0.05)
        seen[name] = len(after)
    assert corpus_pipeline.run(spark, FOLDER).count() == seen["mixing"]


def _kept_by_brute_force(texts):
    sets = {}
    for k, t in texts.items():
        words = "".join(c.lower() if c.isascii() else c for c in t).encode().split()
        width = min(5, len(words))
        sets[k] = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()
    name = {k: k for k in sets}

    def find(k):
        while name[k] != k:
            k = name[k]
        return k

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                name[max(x, y)] = min(x, y)
    return {k for k in ids if find(k) == k}


def _masked(text):
    out, at = [], 0
    for start, _, stop in secrets.brute_force(text):
        if start >= at:
            out.append(text[at:start] + "[SECRET]")
        at = max(at, stop)
    return "".join(out) + text[at:] if out else text


def test_mixing_reruns_agree(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    first = mixing.op10_mixing(docs).orderBy("doc_id").collect()
    assert first == mixing.op10_mixing(docs.repartition(7, F.col("lang"))).orderBy("doc_id").collect()
