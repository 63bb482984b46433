"""Manifest, periodic runs and SentencePiece against plain code and the library."""

import hashlib
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardwarden.llm import manifest, periodic, pieces

FOLDER = "/root/testdata/sf0.01"


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _tree(nodes, fanout=8):
    levels = [nodes]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([_sha("".join(low[i : i + fanout])) for i in range(0, len(low), fanout)])
    return levels


def _path(levels, i, fanout=8):
    steps = []
    for level in levels[:-1]:
        first = i // fanout * fanout
        steps.append((level[first:i], level[i + 1 : first + fanout]))
        i //= fanout
    return steps


def _manifest(rows):
    """All rows of op11, by sorting."""

    def leaf(row):
        return _sha("".join("-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in manifest.FIELDS))

    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append((row["doc_id"], leaf(row), row))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for group in groups.values():
        group.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = {g: _tree([x[1] for x in groups[g]]) for g in names}
    top = _tree([trees[g][-1][0] for g in names])
    out = Counter()
    for k, g in enumerate(names):
        for i, (key, own, row) in enumerate(groups[g]):
            steps = _path(trees[g], i) + _path(top, k)
            folded = own
            if key is not None and zlib.crc32(str(key).encode()) % 3 == 0 and row["text"] is not None:
                lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in row["text"])
                folded = leaf(row | {"text": lower})
            for before, after in steps:
                folded = _sha("".join([*before, folded, *after]))
            proof = _sha("".join(h for before, after in steps for h in before + after))
            root = top[-1][0]
            out[(key, own, trees[g][-1][0], root, proof, folded, folded == root)] += 1
    return out


def _manifest_rows(docs):
    return Counter(tuple(r) for r in manifest.op11_merkle_manifest(docs).collect())


def test_manifest_of_odd_documents(odd_docs, odd_rows, no_docs):
    rows = [dict(zip(odd_docs.columns, r)) for r in odd_rows]
    assert _manifest_rows(odd_docs) == _manifest(rows)
    assert _manifest_rows(no_docs) == Counter()
    assert _manifest_rows(odd_docs.limit(1)) == _manifest([r.asDict() for r in odd_docs.limit(1).collect()])


def test_manifest_places(spark):
    """Far and extreme ids, hot ids with other texts, thousands of equal rows, groups by the thousand."""
    dice = random.Random(3)
    rows = []
    for i in range(600):
        key = dice.choice([None, 5, 5, i, -i, i * 10**12, -(2**63), 2**63 - 1, 2**62 + i, -i * 10**15])
        rows.append((key, dice.choice([None, "", "Aé", str(i), "same"]), dice.choice(["en", "en", None, "", "é", "-", "="]), None, 1))
    rows += [(i, f"t{i}", f"l{i:05d}", None, None) for i in range(700)]
    rows += [(7, "Same", "en", None, 3)] * 1100
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    assert _manifest_rows(docs) == _manifest([r.asDict() for r in docs.collect()])


def test_manifest_ranks_without_sorting(spark):
    keys = [None, None, -(2**63), -5, -5, 0, 63, 64, 65535, 65536, 2**32, 2**48, 2**63 - 1]
    frame = spark.createDataFrame([("a", k, 3 if k == 64 else 1) for k in keys], "g string, k long, n long")
    got = sorted((r["k"] is not None, r["k"] or 0, r["rank"], r["alike"]) for r in manifest.ranked(frame, ["g"], "k", "n").collect())
    weights = [(k is not None, k or 0, 3 if k == 64 else 1) for k in keys]
    want = sorted(
        (a, b, sum(w for c, d, w in weights if (c, d) < (a, b)), sum((c, d) == (a, b) for c, d, _ in weights)) for a, b, _ in weights
    )
    assert got == want


def test_manifest_other_shapes(spark):
    """Another fan-out, key, group and fields; folding a leaf by its path gives the root."""
    docs = spark.range(300).select(F.col("id").alias("n"), (F.col("id") % 3).alias("part"), F.lit("x").alias("g"))
    made = manifest.build(docs, key="n", group="part", fields=("n", "g"), fanout=3, block_levels=2)
    rows = manifest.proofs(made)
    folded = rows.select("root", manifest.fold(F.lower(F.hex("node")), F.col("path")).alias("again"), "changed")
    assert folded.filter("root <> again or changed is not null").count() == 0 and folded.count() == 300
    assert folded.select("root").distinct().count() == 1


def test_no_python_in_manifest(spark):
    plan = manifest.op11_merkle_manifest(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    text = plan._jdf.queryExecution().toString()
    assert "Python" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def _runs(words, shortest=6, exponent=4):
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(shortest, exponent * q):
                found.setdefault((start, i + q), q)
            i += 1
    return sorted((a, b - a, q) for (a, b), q in found.items())


def test_runs_against_brute_force():
    dice = random.Random(5)
    for _ in range(400):
        texts = []
        for _ in range(dice.randrange(1, 8)):
            letters = dice.choice([1, 2, 2, 3, 20])
            text = [dice.randrange(letters) for _ in range(dice.randrange(120))]
            if dice.random() < 0.5:
                unit = [dice.randrange(letters) for _ in range(dice.randrange(1, 12))]
                text = text[: dice.randrange(30)] + unit * dice.randrange(1, 9) + text[-20:]
            texts.append(text)
        exponent = dice.choice([4, 4, 2, 3])
        got = periodic.runs_of([np.array(t, np.int64) for t in texts], 20, 6, exponent)
        for k, text in enumerate(texts):
            assert [tuple(r) for r in got.get(k, np.zeros((0, 3), int)).tolist()] == _runs(text, 6, exponent)


def test_grammar_extensions():
    """Common extensions in both directions, at all pairs of places of periodic and random texts."""
    dice = np.random.default_rng(8)
    for letters, size in ((1, 40), (2, 60), (3, 50), (2, 9)):
        inner = dice.integers(0, letters, size)
        if letters == 3:
            inner = np.tile(inner[:7], 8)[:size]
        text = np.concatenate([[letters], inner, [letters + 1]])
        grammar = periodic.Grammar(text, 2)
        i, j = (x.ravel() for x in np.meshgrid(np.arange(len(text)), np.arange(len(text))))
        i, j = i[i < j], j[i < j]
        again = text[::-1]

        def plain(t, a, b):
            n = 0
            while b + n < len(t) and t[a + n] == t[b + n]:
                n += 1
            return n

        assert grammar.extend(i, j).tolist() == [plain(text, a, b) for a, b in zip(i, j)]
        assert grammar.mirrored().extend(i, j).tolist() == [plain(again, a, b) for a, b in zip(i, j)]


def _periodic_row(key, text):
    words = (text or "").encode().split()
    n = len(words)
    if key is not None and n and (h := zlib.crc32(str(key).encode())) % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = _runs(words)
    kept = [True] * n
    for s, length, q in runs:
        kept[s + q : s + length] = [False] * (length - q)
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    milli = None if top[0] is None else 1000 * top[1] // top[2]
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    return (key, len(runs), *top, milli, _sha(lines), _sha(b" ".join(w for w, k in zip(words, kept) if k).decode()))


def test_periodic_odd_documents(spark, odd_docs, odd_rows, no_docs):
    short = [r for r in odd_rows if len(r[1] or "") < 5000]
    got = Counter(tuple(r) for r in periodic.op12_periodic_runs(odd_docs.filter("text is null or length(text) < 5000")).collect())
    assert got == Counter(_periodic_row(r[0], r[1]) for r in short)
    assert periodic.op12_periodic_runs(no_docs).collect() == []


def test_periodic_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").filter("length(text) < 3000")
    more = docs.selectExpr("doc_id + 100000 AS doc_id", "concat(text, repeat(' x y', 9), repeat(' \\n z', 7), text) AS text")
    both = docs.select("doc_id", "text").unionByName(more.limit(150))
    want = Counter(_periodic_row(r["doc_id"], r["text"]) for r in both.collect())
    assert Counter(tuple(r) for r in periodic.op12_periodic_runs(both).collect()) == want
    assert sum(1 for r in want if r[1]) > 150


def test_periodic_keeps_columns_and_long_texts(spark):
    docs = spark.createDataFrame([(1, "a b " * 200_000, "own", [1, 2]), (2, None, None, None)], "id long, text string, runs string, more array<int>")
    out = periodic.find_runs(docs)
    assert out.columns == ["id", "text", "more", "n_words", "runs", "collapsed"]
    long, none = out.orderBy("id").collect()
    assert [tuple(r) for r in long["runs"]] == [(0, 400_000, 2)] and long["collapsed"] == "a b" and long["more"] == [1, 2]
    assert (none["n_words"], none["runs"], none["collapsed"]) == (0, [], "")


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Pieces(pieces.default_model(), 500)


def test_pieces_against_the_library(vocabulary):
    dice = random.Random(1)
    bits = ["a", "b", " ", "  ", "▁", "\n", "é", "😀", "\0", "1", "23", "the ", "日本", "ал", "取获", ".*", "�", "x" * 9, '"', "])^-"]
    for _ in range(3000):
        text = "".join(dice.choice([*bits, chr(dice.randrange(1, 0xD800))]) for _ in range(dice.randrange(60)))
        ids = vocabulary.encode(text)
        assert ids == vocabulary.library.encode(text) and vocabulary.decode(ids) == vocabulary.library.decode(ids)
    assert not vocabulary.wrong


def test_decoding_any_ids(vocabulary):
    dice = random.Random(2)
    for _ in range(3000):
        ids = [dice.choice([0, 1, 2, 35, 259, 28705, dice.randrange(120, 260), dice.randrange(32000)]) for _ in range(dice.randrange(12))]
        assert vocabulary.decode(ids) == vocabulary.library.decode(ids)


def test_long_parts(vocabulary):
    dice = random.Random(3)
    for text in ("a" * 50_000, "".join(dice.choice("abcdeXYZ") for _ in range(50_000)), "▁" * 5_000, "é日" * 5_000):
        assert vocabulary.encode(text) == vocabulary.library.encode(text)


def test_disagreement_is_told():
    own = pieces.Pieces(pieces.default_model(), 100)
    own._compare({"▁the": (1, 2, 3), "ab": tuple(own.library.encode("\nab")[2:])})
    assert own.wrong == {"▁the"}
    assert own.encode_all(["not the", "nothing"])[1] == [False, True]


def test_sentencepiece_documents(spark, odd_docs, odd_rows, no_docs):
    """Every whole text against the library; digests; odd rows and columns."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert pieces.encode(docs, check="texts").filter("not agrees").count() == 0
    library = pieces.load(pieces.default_model()).library
    want = Counter()
    for row in odd_rows:
        ids = library.encode(row[1] or "")
        want[(row[0], len(ids), _sha(",".join(map(str, ids))), _sha(library.decode(ids)), True)] += 1
    assert Counter(tuple(r) for r in pieces.op13_sentencepiece(odd_docs).collect()) == want
    assert pieces.op13_sentencepiece(no_docs).collect() == []
    out = pieces.encode(odd_docs.withColumn("ids", F.lit("own")), decoded=False, check=None)
    assert out.columns == [*odd_docs.columns, "ids"]
    again = pieces.decode(out.select("text", "ids").filter("text = 'one two'"))
    assert [r["decoded"] for r in again.collect()] == ["one two"]
