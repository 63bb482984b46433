"""Secrets, decontamination, near-duplicates, long repeats and mixing on odd documents."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardwarden.llm import decontaminate, minhash, mixing, secrets, suffix
from cardwarden.llm.components import components


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_trigram_queries():
    assign, access, hexa = (secrets.trigram_query(r.pattern) for r in secrets.RULES)
    assert frozenset({"tok", "oke", "ken"}) in assign[0] and len(assign) == 1
    assert access == [[frozenset({"aki", "kia"})]]
    assert hexa == []
    assert secrets.trigram_query("ab|abcd") == []
    assert secrets.trigram_query("abc[0-9]+defg") == [[frozenset({"abc"})], [frozenset({"def", "efg"})]]


def test_secrets(odd_docs, odd_rows):
    want = Counter()
    for row in odd_rows:
        spans = secrets.brute_force(row[1])
        text = ",".join(f"{secrets.RULES[k].kind}:{a}:{b}" for a, k, b in spans)
        kinds = Counter(k for _, k, _ in spans)
        want[(row[0], kinds[0], kinds[1], kinds[2], _sha(text), text)] += 1
    got = Counter(tuple(r) for r in secrets.op1_secret_scan(odd_docs).collect())
    assert got == want


def test_secrets_keep_columns_and_empty_table(odd_docs, no_docs):
    assert secrets.find_secrets(odd_docs).columns == [*odd_docs.columns, "secret_spans"]
    assert secrets.op1_secret_scan(no_docs).count() == 0


def test_redacted(odd_docs):
    found = secrets.find_secrets(odd_docs)
    clean = secrets.redact(found, "text", "secret_spans")
    row = clean.filter("doc_id = 306").first()["text"]
    assert "deadbeef" not in row and "AKIA" not in row and "token: secret: abcdefghijklmnop" in row
    assert secrets.op1_secret_scan(clean).filter("n_hex > 0").count() == 0
    assert clean.filter("text IS NULL").count() == odd_docs.filter("text IS NULL").count()


ITEMS = [
    (1, "One two"),
    (2, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12"),
    (3, "W2-W3-W4 w5 w6 w7 w8 w9 w10 w11"),
    (3, "same id, other text"),
    (None, "no name"),
    (4, None),
    (5, "... !"),
    (6, "é😀x"),
]


@pytest.mark.parametrize("most", [1 << 20, 300])
def test_decontamination(spark, odd_docs, most):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    texts = [
        "a w1 W2 w3 w4 w5 w6 w7 w8 w9 w10 w11 b",
        "w1 w2 w3 w4 w5 w6 w7 w8 w9 ww10",
        "one two one two",
        "No name; é😀x! same id other text",
        "",
        None,
        "x " * 5000 + "one two",
    ]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, item_id int")
    plain = [(None if i is None else str(i), t) for i, t in ITEMS]
    got = decontaminate.find_contamination(docs, items, most_window_bytes=most).collect()
    for r in got:
        c = r["contamination"]
        assert (c["n_words"], c["hit_words"], c["item_ids"]) == decontaminate.brute_force(r["text"], plain)
    spans = {r["doc_id"]: r["contamination"]["hit_spans"] for r in got}
    assert texts[0][slice(*spans[0][0])] == texts[0][2:-2]
    assert decontaminate.op4_decontaminate(odd_docs, items).count() == odd_docs.count()
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.op4_decontaminate(docs, none).filter("contaminated").count() == 0
    assert decontaminate.op4_decontaminate(docs.limit(0), items).count() == 0


def _components(rows, shingle=3, percent=85):
    sets = defaultdict(set)
    name = {}

    def find(k):
        while name[k] != k:
            k = name[k]
        return k

    nodes = []
    for key, text in rows:
        words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
        width = min(shingle, len(words))
        own = frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1)) if words else frozenset()
        nodes.append((key, own))
        if key is not None:
            name[key] = key
    real = sorted({n for n in nodes if n[0] is not None and n[1]}, key=lambda n: n[0])
    for i, (a, x) in enumerate(real):
        for b, y in real[i + 1 :]:
            both = len(x & y)
            if 100 * both >= percent * (len(x) + len(y) - both):
                p, q = find(a), find(b)
                name[max(p, q)] = min(p, q)
    named = {own: min(find(k) for k, o in real if o == own) for own in {o for _, o in real}}
    return Counter((k, len(o), find(k) if k is not None else named.get(o)) for k, o in nodes)


@pytest.mark.parametrize("chunk", [2_000_000, 500])
def test_near_duplicates(odd_docs, odd_rows, chunk):
    policy = minhash.MinHashPolicy(chunk_shingles=chunk)
    got = Counter(tuple(r) for r in minhash.near_duplicates(odd_docs, policy=policy).collect())
    assert got == _components([(r[0], r[1]) for r in odd_rows])


def test_near_duplicates_query(odd_docs, no_docs):
    rows = minhash.op7_near_duplicates(odd_docs).collect()
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)
    assert {r["component_id"] for r in rows if r["doc_id"] is not None and 100 <= r["doc_id"] < 225} == {100}
    assert minhash.op7_near_duplicates(no_docs).count() == 0


def test_estimate_of_low_bits():
    policy = minhash.MinHashPolicy()
    dice = np.random.default_rng(1)
    pool = dice.integers(0, 1 << 63, 3000, np.uint64)
    for share in (0.0, 0.5, 0.85, 1.0):
        both = int(1000 * 2 * share / (1 + share))
        a, b = pool[:1000], np.concatenate((pool[:both], pool[1000 : 2000 - both]))
        packed = [np.frombuffer(minhash.pack(minhash.minima(x, policy)), np.uint64) for x in (a, b)]
        assert abs(minhash.estimated(packed[0][None], packed[1], policy.hashes)[0] - share) < 0.15


def test_components(spark):
    dice = random.Random(2)
    links = [(dice.randrange(300), dice.randrange(300)) for _ in range(180)] + [(1000, 1000 + i) for i in range(50)]
    links += [(2000 + i, 2001 + i) for i in range(40)]
    name = {}

    def find(k):
        while name.setdefault(k, k) != k:
            k = name[k]
        return k

    for a, b in links:
        x, y = find(a), find(b)
        name[max(x, y)] = min(x, y)
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {tuple(r) for r in got} == {(k, find(k)) for a, b in links if a != b for k in (a, b)}
    assert len(got) == len({r["node"] for r in got})


def test_merged_transforms():
    dice = random.Random(1)
    for _ in range(100):
        length, count = dice.choice([3, 5, 8]), dice.randint(1, 9)
        strings = ["".join(dice.choice("ab\x00é") for _ in range(dice.randint(length, 25))).encode() for _ in range(count)]
        docs = np.array([dice.randint(0, 5) for _ in strings])
        least = {}
        for s, d in zip(strings, docs):
            for i in range(len(s) - length + 1):
                least[s[i : i + length]] = min(least.get(s[i : i + length], 99), d)
        got = suffix.least_documents(strings, docs, length, dice.randint(1, 4))
        for s, own in zip(strings, got):
            assert own.tolist() == [least[s[i : i + length]] for i in range(len(s) - length + 1)]


def test_long_repeats(odd_docs, odd_rows):
    rows = [(r[0], r[1]) for r in odd_rows]
    want = Counter(
        (k, n, sum(b - a for a, b in runs), len(runs), hashlib.sha256(kept).hexdigest())
        for (k, _), (n, runs, kept) in zip(rows, suffix.brute_force(rows))
    )
    assert Counter(tuple(r) for r in suffix.op6_suffix_dedup(odd_docs).collect()) == want
    small = suffix.without_repeats(odd_docs, part_bytes=3000, chunk=500, shards=3)
    assert {(r["doc_id"], len(r["removed"])) for r in small.collect()} == {(w[0], w[3]) for w in want}


def test_long_repeats_empty(no_docs):
    assert suffix.op6_suffix_dedup(no_docs).count() == 0


def test_long_repeats_of_hot_anchors(spark, odd_docs, monkeypatch):
    dice = random.Random(23)
    line = "Permission is hereby granted, free of charge, to any person obtaining a copy"
    words = ["".join(dice.choice("abcdef") for _ in range(6)) for _ in range(400)]

    def around():
        return " ".join(dice.choices(words, k=12))

    rows = [(i, f"{around()}\n{line}\n{around()}\n{'=' * dice.randint(40, 90)}\n{around()}") for i in range(150)]
    rows += [(i, f"{'=' * 300}{around()}é{line}") for i in range(150, 160)] + [(3, line), (None, line)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    dealt = []
    real = suffix._decisions

    def watched(segments, *rest):
        sizes = segments.groupBy("anchor").agg(F.sum(F.octet_length("segment")).alias("n"))
        dealt.append(sizes.agg(F.max("n")).first()[0] or 0)
        return real(segments, *rest)

    monkeypatch.setattr(suffix, "_decisions", watched)
    for table, most in ((docs, 2000), (docs, 0), (odd_docs, 0)):
        plain = [tuple(r) for r in table.select("doc_id", "text").collect()]
        want = Counter((k, n, tuple(runs), kept) for (k, _), (n, runs, kept) in zip(plain, suffix.brute_force(plain)))
        found = suffix.without_repeats(table, hot_bytes=most)
        got = Counter(
            (r["doc_id"], r["n_bytes"], tuple((s["start"], s["stop"]) for s in r["removed"]), bytes(r["kept"]))
            for r in found.collect()
        )
        assert got == want
        assert dealt.pop() <= most  # no task is given more of an anchor


def _targets(sizes, weights=(5, 2, 1), amount=1.5, passes=2):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    rest, free, out = amount * sum(sizes.values()), set(order), {}
    while free:
        total = sum(weight[s] for s in free)
        above = {s for s in free if rest * weight[s] / total > passes * sizes[s]}
        if not above:
            return out | {s: rest * weight[s] / total for s in free}
        for s in above:
            out[s] = passes * sizes[s]
            rest -= out[s]
        free -= above
    return out


def test_mixing(odd_docs, odd_rows):
    rows = mixing.op10_mixing(odd_docs).collect()
    assert len(rows) == len(odd_rows)
    sizes = defaultdict(int)
    for r in odd_rows:
        sizes[r[3]] += len((r[1] or "").split())
    want = _targets(sizes)
    of_size = {s: n for n, s in sizes.items()}
    taken = defaultdict(int)
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        source = of_size[r["source_size"]]
        assert r["target"] == pytest.approx(want[source])
        taken[source] += r["taken"]
    for source, target in want.items():
        assert taken[source] == pytest.approx(target, rel=0.02, abs=2)
    again = mixing.op10_mixing(odd_docs.repartition(5)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows))


def test_mixing_empty(no_docs, odd_docs):
    assert mixing.op10_mixing(no_docs).count() == 0
    blank = mixing.op10_mixing(odd_docs.filter("doc_id IN (300, 301, 302)")).collect()
    assert [r["taken"] for r in blank] == [0, 0, 0]


@pytest.mark.parametrize("seed", range(4))
def test_highest_quotients(spark, seed):
    dice = random.Random(seed)
    parties = [(g, p, float(dice.choice([1, 1, 2, 5, 49, 900]))) for g in "ab" for p in range(dice.randint(1, 30))]
    seats = {"a": dice.randint(0, 400), "b": dice.randint(0, 20)}
    df = spark.createDataFrame(parties, "g string, p int, w double")
    got = mixing.sainte_lague(df, ["g"], "w", F.when(F.col("g") == "a", seats["a"]).otherwise(seats["b"]), [F.col("p")])
    want = {}
    for g, n in seats.items():
        own = {p: w for h, p, w in parties if h == g}
        given = dict.fromkeys(own, 0)
        for _ in range(n):
            best = max(own, key=lambda p: (own[p] / (2 * given[p] + 1), -p))
            given[best] += 1
        want |= {(g, p): k for p, k in given.items()}
    assert {(r["g"], r["p"]): r["seats"] for r in got.collect()} == want
