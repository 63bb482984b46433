"""Texts with very many matches, columns whose names clash with results, and links as stars."""

import random
import time

from pyspark.sql import functions as F

from cardwarden.llm import minhash, mixing, secrets


def _redacted(text, spans, mark="[SECRET]"):
    out, done = [], 0
    for start, _, stop in spans:
        if start >= done:
            out += [text[done:start], mark]
        done = max(done, stop)
    return "".join(out) + text[done:]


def _texts():
    dice = random.Random(4)
    many = " ".join("%016x" % dice.getrandbits(64) for _ in range(60_000))
    mixed = " ".join(
        dice.choice(["😀é", "password=aaaaaaaaaaaaaaaa", "token: abcdefabcdefabcdef", "AKIA" + "Z9" * 9, "face bad", "x"])
        for _ in range(5_000)
    )
    edges = "".join("ü" * dice.randint(500, 530) + "0123456789abcdef" for _ in range(300))
    return [many, mixed, edges, "0123456789abcdef", "ab " * 64, "ab " * 65, "", None, "\n" * 600 + "deadbeef" * 200]


def test_many_spans_and_redaction(spark):
    texts = _texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    began = time.time()
    found = secrets.find_secrets(docs)
    got = {r["doc_id"]: [(s["start"], s["kind"], s["stop"]) for s in r["secret_spans"]] for r in found.collect()}
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(found, "text", "secret_spans").collect()}
    assert time.time() - began < 60
    for i, text in enumerate(texts):
        want = secrets.brute_force(text)
        assert got[i] == want
        assert clean[i] == (None if text is None else _redacted(text, want))


def test_running_totals(spark):
    rows = [(i, list(range(1, n + 1))) for i, n in enumerate((0, 1, 63, 64, 65, 128, 129, 1000))]
    table = spark.createDataFrame(rows, "id long, v array<bigint>")
    sums = secrets.running(F.col("v"), lambda a, b: a + b)
    most = secrets.running(F.reverse("v"), lambda a, b: F.greatest(a, b))
    for r in table.select("v", sums.alias("s"), most.alias("m")).collect():
        assert list(r["s"]) == [sum(r["v"][:i]) for i in range(len(r["v"]))]
        assert list(r["m"]) == [max(r["v"][::-1][:i], default=0) for i in range(len(r["v"]))]


def test_result_column_is_replaced(spark):
    docs = spark.createDataFrame([(1, "AKIA" + "A" * 20, "old", 3)], "doc_id long, text string, secret_spans string, __r0 int")
    found = secrets.find_secrets(docs)
    assert found.columns == ["doc_id", "text", "__r0", "secret_spans"]
    assert len(found.first()["secret_spans"]) == 1


def test_mixing_with_names_used_inside(odd_docs):
    names = ["size", "source_size", "target", "taken", "block", "seats", "__size", "__hash", "__doc", "__shard"]
    wide = odd_docs.select("doc_id", "source", "text", *[F.lit(n).alias(n) for n in names])
    plain = mixing.mix(odd_docs.select("doc_id", "source", "text"))
    mixed = mixing.mix(wide)
    assert mixed.columns == ["doc_id", "source", "text", *names[4:], "size", "source_size", "target", "taken"]
    assert mixed.filter("block != 'block' OR __hash != '__hash'").count() == 0
    assert sorted(map(str, mixed.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))


def test_stars_keep_components():
    dice = random.Random(2)
    links = [(i, i + 1) for i in range(50, 90)] + [(dice.randrange(200, 300), dice.randrange(200, 300)) for _ in range(60)]
    links = [(a, b) for a, b in links if a != b]
    label = {x: x for pair in links for x in pair}
    for _ in label:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    got = minhash.stars(links)
    assert {b: a for a, b in got} == {x: y for x, y in label.items() if x != y}
    assert minhash.stars([]) == []
