"""Large components in top-k; repeated ids with other texts in near-duplicates and the pipeline; large clusters."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cardwarden.llm import minhash, topk


@pytest.mark.parametrize("reach", [3.0, 9e6, 3e9, 1e14])
def test_top_k_of_large_components(spark, reach):
    """Exact scores far beyond what doubles and 64-bit products hold; scores stand at the limit of 64 bits."""
    dice = random.Random(int(reach))
    rows = [(i, [dice.uniform(-reach, reach) for _ in range(3)]) for i in range(300)]
    rows += [(400, [9e6, 1.0, 0.0]), (401, [float("inf"), 0.0, 0.0]), (402, [1e300, 0.0, 0.0]), (403, None), (50, rows[50][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    whole = {}
    for i, v in rows:
        if v is not None and all(abs(x) * 256 < 2.0**63 for x in v):
            whole.setdefault(i, []).append([int(np.floor(x * 256)) for x in v])
    limit = 2**63 - 1
    want = []
    for q in sorted(k for k in whole if k % 50 == 0):
        asked = min(whole[q])
        scored = [
            (max(-limit, min(limit, sum(a * b for a, b in zip(asked, v)))), i) for i, vs in whole.items() if i != q for v in vs
        ]
        want += [(q, r + 1, i, s) for r, (s, i) in enumerate(sorted(scored, key=lambda x: (-x[0], x[1]))[:5])]
    got = topk.top_k(frame, F.col("vec_id") % 50 == 0, shard_rows=64, block_rows=4, leaf=8)
    assert sorted(map(tuple, got.collect())) == want


def _text(dice, n=60):
    return " ".join("".join(dice.choice("abcdefgh") for _ in range(5)) for _ in range(n))


def test_repeated_ids_keep_all_links(spark):
    dice = random.Random(2)
    a, b, c, d = (_text(dice) for _ in range(4))
    rows = [(5, a), (5, b), (9, a + " x"), (10, b + " y"), (12, c), (20, c), (20, d), (31, d + " z"), (40, _text(dice))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {(r["doc_id"], r["component_id"]) for r in minhash.op7_near_duplicates(docs).collect()}
    assert got == {(5, 5), (9, 5), (10, 5), (12, 12), (20, 12), (31, 12), (40, 40)}


def test_pipeline_keeps_other_texts_of_an_id(spark):
    dice = random.Random(3)
    a, b = _text(dice), _text(dice)
    rows = [(5, a, "en", "s", 1), (5, b, "en", "s", 2), (5, a, "en", "s", 1), (7, a, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == sorted([(5, a), (5, b)])


def test_many_short_copies_in_one_cluster():
    """Thousands of near-copies are linked without comparing all of them with all."""
    dice = random.Random(4)
    base = _text(dice, 120).split()
    policy, sets = minhash.MinHashPolicy(), []
    for i in range(12_000):
        words = list(base)
        words[i % 120] = f"w{i}"
        sets.append(minhash.shingle_set(" ".join(words), policy.shingle))
    packed = np.stack([np.frombuffer(minhash.pack(minhash.minima(s, policy)), np.uint64) for s in sets])
    start = time.process_time()
    found = minhash.linked(list(range(len(sets))), sets, packed, policy)
    assert time.process_time() - start < 30
    assert len(found) == len(sets) - 1
