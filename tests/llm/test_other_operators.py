"""Pages, archives, vectors and classifiers on odd rows."""

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardwarden.llm import html_extract, quality, topk, toxicity, warc

FOLDER = "/root/testdata/sf0.1"


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("just text &amp; more", "just text & more"),
        ("<html><body><nav><a href=x>Menu</a></nav></body></html>", ""),
        (
            "<body><header><h1>Site</h1></header><article><h1>Title</h1><p>One  two,\n three.<p>Four <b>five</b>; six<br>seven."
            "</article><aside>Side</aside><footer>&copy; x</footer>",
            "Title\n\nOne two, three.\n\nFour five; six seven.",
        ),
        (
            "<body><div class='cookie-notice'>We use cookies, a lot, really.</div><div id=content><h2>Head</h2>"
            "<p>A long sentence, with commas, and more.</p><script>var a='<p>x</p>';</script><ul><li>First<li>Second</ul>"
            "<div class='ad'>Buy, buy, buy now!</div><p>Another sentence, again, with text.</p>"
            "<section class=comments><p>I disagree, strongly, with this.</p></section></div>"
            "<form><p>Enter, please, your name.</p></form></body>",
            "Head\n\nA long sentence, with commas, and more.\n\nFirst\n\nSecond\n\nAnother sentence, again, with text.",
        ),
        ("<article><p>a &lt;b&gt; &#233;&#x1F600;</p><!-- <p>no</p> --><p hidden>no</p><p>c<</p></article>", "a <b> é😀\n\nc<"),
        ("<article><p title='a > b'>x</p><p class=\"un>quoted</p></article>", "x\n\nquoted"),
    ],
)
def test_main_text(page, text):
    assert html_extract.main_text(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        ("<body><p>Stray.</p><article><h1>T</h1><div class=body><p>A text, long, and more.</p></div></article></body>", "T\n\nA text, long, and more."),
        (
            f"<article><section><p>First, short.</p></section><section><p>{'Long, and longer. ' * 9}</p></section></article>",
            f"First, short.\n\n{('Long, and longer. ' * 9).strip()}",
        ),
        (
            f"<body><article><p>One, small.</p></article><h2>Between</h2><article><div><p>{'Two, large. ' * 20}</p></div></article></body>",
            f"One, small.\n\nBetween\n\n{('Two, large. ' * 20).strip()}",
        ),
        (
            f"<body><h1>T</h1><table><tr><td><p>Left, one.</p><td><p>{'Right, two. ' * 20}</p></table></body>",
            f"T\n\nLeft, one.\n\n{('Right, two. ' * 20).strip()}",
        ),
        ("<body><h1>T</h1><div class=text><p>A text, long, and more.</p><p>Short</p></div></body>", "T\n\nA text, long, and more.\n\nShort"),
    ],
)
def test_main_text_is_whole(page, text):
    assert html_extract.main_text(page) == text


@pytest.mark.parametrize(
    "start, end",
    [
        ("<article class='post comments-open'>", "</article>"),
        ("<div class='content has-sidebar'>", "</div>"),
        ("<div id='page-with-menu'>", "</div>"),
        ("<div class='no-ads share-enabled'>", "</div>"),
        ("<form action=x><div class=widget>", "</div></form>"),
        ("<form><article>", "</article></form><article class=teaser><nav>See</nav></article>"),
        ("<article class=widget>", "</article>"),
        ("<article><div class=share>", "</div></article>"),
    ],
)
def test_names_do_not_drop_the_article(start, end):
    body = "<h1>T</h1><p>A text, long, and more.</p><p>Another, longer, text.</p>"
    page = f"<body><nav>Menu</nav>{start}{body}<div class='cookie-notice'>Yes, yes.</div>{end}<div class=site-footer>Bye, bye.</div></body>"
    assert html_extract.main_text(page) == "T\n\nA text, long, and more.\n\nAnother, longer, text."


def test_long_comments_beside_an_article():
    talk = "<article class=comment-item><p>I disagree, strongly, with this.</p></article>" * 9
    page = f"<article><p>A text, long, and more.</p></article><section class=comments>{talk}</section>"
    assert html_extract.main_text(page) == "A text, long, and more."


def test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").withColumn("text", F.lit("clash"))
    rows = html_extract.op3_html_extract(pages).collect()
    assert len(rows) == pages.count() and all(len(r["text"]) == r["n_chars"] > 0 for r in rows)
    assert html_extract.op3_html_extract(pages.limit(0)).count() == 0
    deep = "<div>" * 3000 + "<p>deep, indeed.</p>"
    assert html_extract.main_text(deep) == "deep, indeed."


@pytest.fixture(scope="module")
def odd_pages():
    dice = random.Random(3)
    bits = ["\r", "\n", "\r\n", "\r\n\r\n", "a", "é", "😀", "WARC/1.1\r\n", "Content-Length: 5\r\n\r\n", " ", "\x00"]
    rows = []
    for i in range(300):
        body = "".join(dice.choice(bits) for _ in range(dice.randint(0, 12)))
        rows.append((i, dice.choice([f"http://x/{i}", None, "http://y\r\nz"]), None if i % 17 == 0 else body))
    long = "x" * 2_000_000
    return rows + [(1000, "u", long), (1001, "u", long), (1001, "u", long), (None, "q", "only"), (None, "q", long)]


@pytest.mark.parametrize("least", [0, 10])
def test_archives_round_trip(spark, tmp_path, odd_pages, least):
    pages = spark.createDataFrame(odd_pages, "page_id long, url string, html string").withColumn("size", F.lit(1))
    warc.write_warc(pages.repartition(5), str(tmp_path / "w"), min_bytes=least)
    got = warc.read_warc(spark, str(tmp_path / "w")).collect()
    best = defaultdict(list)
    for key, _, body in odd_pages:
        best[body or ""].append(key)
    want = Counter()
    for key, _, body in odd_pages:
        raw = (body or "").encode()
        first = max((k for k in best[body or ""] if k is not None), default=None)
        whole = key == first or len(raw) < least
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        want[
            (key, "response" if whole else "revisit", len(raw), digest, None if whole else first, (body or "") if whole else None)
        ] += 1
    columns = ("page_id", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload")
    assert Counter(tuple(r[c] for c in columns) for r in got) == want


def test_archives_empty(spark):
    assert warc.op9_warc(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def _best(rows, k=5, modulus=50):
    good = [
        (i, np.floor(256 * np.array(v, float)).astype(np.int64))
        for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    asked = {}
    for i, v in good:
        if i % modulus == 0 and (i not in asked or (len(v), v.tolist()) < (len(asked[i]), asked[i].tolist())):
            asked[i] = v
    out = Counter()
    for q, v in asked.items():
        found = sorted((-int(v @ w), i) for i, w in good if i != q and len(w) == len(v))[:k]
        out.update((q, rank, i, -s) for rank, (s, i) in enumerate(found, 1))
    return out


def test_top_k(spark):
    dice = np.random.default_rng(4)
    centres = dice.normal(0, 1, (6, 8))
    rows = [(i, [float(x) for x in centres[i % 6] + dice.normal(0, 0.05, 8)]) for i in range(700)]
    rows += [(800 + i, rows[3][1]) for i in range(20)] + [(850, rows[3][1]), (850, rows[4][1]), (3, rows[3][1])]
    rows += [(900, None), (950, []), (951, []), (None, rows[0][1]), (1000, [1.0, None] + [0.0] * 6)]
    rows += [(1050, [float("nan")] * 8), (1100, [float("inf")] * 8), (1150, [1.0, 2.0]), (1151, [3.0, 4.0]), (1200, [0.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got = topk.top_k(df, F.coalesce(F.col("vec_id") % 50 == 0, F.lit(False)), shard_rows=100, block_rows=7, leaf=8)
    assert Counter(tuple(r) for r in got.collect()) == _best(rows)
    assert topk.op2_topk_search(df.limit(0)).count() == 0
    assert topk.op2_topk_search(df.filter("vec_id = 50")).count() == 0


def test_ball_tree_bounds():
    dice = np.random.default_rng(5)
    points = dice.integers(-100, 100, (500, 6))
    order, nodes, centres, radii = topk.build_tree(points.astype(float), 16)
    assert sorted(order.tolist()) == list(range(500))
    for (start, stop, left, right), centre, radius in zip(nodes, centres, radii):
        away = np.sqrt(((points[order[start:stop]] - centre) ** 2).sum(1))
        assert away.max() <= radius + 1e-9 and ((left < 0) == (right < 0))


def _split(spark, name, make):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    scored = make(docs, labels)
    return scored.join(labels.select("doc_id", F.col(name).alias("y")), "doc_id").filter("held_out").toPandas()


def _area(frame):
    ranks = frame["score"].rank().to_numpy()
    y = frame["y"].to_numpy()
    ones = y.sum()
    return (ranks[y == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(y) - ones))


def test_quality_held_out(spark):
    frame = _split(spark, "quality", quality.op5_quality)
    assert _area(frame) > 0.99
    assert ((frame["score"] >= 0.5) == (frame["y"] == 1)).mean() > 0.97
    assert (frame["predicted"] == (frame["score"] >= 0.5)).all()


def test_toxicity_held_out(spark):
    frame = _split(spark, "toxic", toxicity.op8_toxicity)
    assert _area(frame) > 0.97
    assert (frame[frame["y"] == 0]["score"] < 0.5).mean() > 0.98
    assert (frame[frame["y"] == 1]["score"] >= 0.5).mean() > 0.8


@pytest.mark.parametrize("make, name", [(quality.op5_quality, "quality"), (toxicity.op8_toxicity, "toxic")])
def test_classifiers_on_odd_rows(spark, odd_docs, no_docs, make, name):
    labels = spark.createDataFrame(
        [(i, int(i % 3 == 0), int(i % 3 == 0)) for i in range(60)] + [(1, 1, 1), (2, None, None), (None, 1, 1), (999, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    rows = make(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count()
    fold = (3, 1) if name == "quality" else (5, 0)
    for r in rows:
        assert 0 <= r["score"] <= 1
        key = r["doc_id"]
        assert r["held_out"] == (key is not None and zlib.crc32(str(key).encode()) % fold[0] == fold[1])
    assert make(no_docs, labels).count() == 0
    assert {r["score"] for r in make(odd_docs, labels.limit(0)).collect()} == {0.5}


def test_scores_ignore_other_columns(spark, odd_docs):
    """Labels, lang, source and ids are no inputs of a score."""
    labels = spark.createDataFrame([(i, int(i % 2), int(i % 2)) for i in range(60)], "doc_id long, quality int, toxic int")
    model = quality.train(odd_docs, labels, "quality", F.lit(True))
    changed = odd_docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("zz")).withColumn("doc_id", F.lit(1))
    one, two = (sorted(r["quality_score"] for r in quality.score(d, model).collect()) for d in (odd_docs, changed))
    assert one == two


def test_factorisation_identity():
    dice = np.random.default_rng(6)
    machine = quality.FactorisationMachine(0.3, dice.normal(0, 1, quality.WIDTH), dice.normal(0, 1, (quality.WIDTH, 4)))
    index, value = dice.choice(quality.WIDTH, 12, replace=False), dice.normal(0, 1, 12)
    pairs = sum(
        machine.factors[index[i]] @ machine.factors[index[j]] * value[i] * value[j] for i in range(12) for j in range(i)
    )
    assert machine.raw(index, value) == pytest.approx(0.3 + machine.linear[index] @ value + pairs)
