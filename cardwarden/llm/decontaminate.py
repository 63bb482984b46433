"""Benchmark decontamination with one Aho-Corasick automaton over the test items.

Items are normalised to words joined by single spaces; their windows of
consecutive words are the patterns. Each text is normalised the same way, in one
pass of byte translation, and scanned once; a match ends at a word boundary by
construction, and the word numbers are mapped back to offsets in the original.

The automaton travels to the tasks as a broadcast. Its size is checked first:
items are dealt into blocks whose windows stay under `most_window_bytes`, so a
benchmark of any size is scanned in as many passes as it needs blocks and no
broadcast grows with it.

Defined results: null and empty texts have no words; items without words match
nothing; several items with the same window are all found; rows with the same
item_id are one item; an item with a null id marks words, but is neither counted
nor listed; extra columns pass through untouched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 10
MOST_WINDOW_BYTES = 32 << 20

# Bytes of words are digits, a-z and everything beyond ASCII; A-Z are folded.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


@dataclass
class Scanner:
    """Patterns with the numbers of their items, and the automaton, built where it is used."""

    window: int
    patterns: dict[str, list[int]]
    ids: list[str | None]
    _automaton: object = field(default=None, repr=False)

    def __getstate__(self):
        return self.window, self.patterns, self.ids

    def __setstate__(self, state):
        self.window, self.patterns, self.ids = state
        self._automaton = None

    @property
    def automaton(self):
        if self._automaton is None:
            self._automaton = ahocorasick.Automaton()
            for pattern, items in self.patterns.items():
                self._automaton.add_word(pattern, (pattern.count(" ") - 1, items))
            if self.patterns:
                self._automaton.make_automaton()
        return self._automaton

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int, list[int]]]]:
        """Number of words, and matches (first word, words, items)."""
        words = normal_words(text)
        if not words or not self.patterns:
            return len(words), []
        line = (b" " + b" ".join(words) + b" ").decode("latin-1")
        hits = list(self.automaton.iter(line))
        if not hits:
            return len(words), []
        spaces = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 0x20)
        ends = np.searchsorted(spaces, [end for end, _ in hits])
        return len(words), [(int(e) - n, n, items) for e, (_, (n, items)) in zip(ends, hits)]


def build_scanner(items: list[tuple[str | None, str | None]], window: int = WINDOW) -> Scanner:
    numbers: dict[str | None, int] = {}
    patterns: dict[str, set[int]] = {}
    for item_id, text in items:
        words = [w.decode("latin-1") for w in normal_words(text)]
        if words:
            number = numbers.setdefault(item_id, len(numbers))
            for i in range(max(1, len(words) - window + 1)):
                patterns.setdefault(f" {' '.join(words[i : i + window])} ", set()).add(number)
    return Scanner(window, {p: sorted(n) for p, n in patterns.items()}, list(numbers))


def byte_spans(text: str, words: np.ndarray) -> list[tuple[int, int]]:
    """Offsets (code points) in the original of the runs of hit words."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass").translate(_FOLD), np.uint8)
    inside = np.concatenate(([False], raw != 0x20, [False])).astype(np.int8)
    edges = np.diff(inside)
    starts, stops = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    cut = np.flatnonzero(np.diff(words) > 1)
    first = words[np.concatenate(([0], cut + 1))]
    last = words[np.concatenate((cut, [len(words) - 1]))]
    points = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    point = np.concatenate(([0], np.cumsum((points & 0xC0) != 0x80)))
    return [(int(point[starts[a]]), int(point[stops[b]])) for a, b in zip(first, last)]


_FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("hit_words", T.ArrayType(T.LongType())),
        T.StructField("item_ids", T.ArrayType(T.StringType())),
        T.StructField("hit_spans", T.ArrayType(T.ArrayType(T.LongType()))),
    ]
)
_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("hit_words", pa.list_(pa.int64())),
        ("item_ids", pa.list_(pa.string())),
        ("hit_spans", pa.list_(pa.list_(pa.int64()))),
    ]
)


def _scan_text(scanner: Scanner, text: str | None) -> dict:
    n, hits = scanner.scan(text)
    words = np.unique(np.concatenate([np.arange(a, a + k) for a, k, _ in hits])) if hits else np.empty(0, int)
    named = {scanner.ids[i] for _, _, items in hits for i in items} - {None}
    spans = byte_spans(text, words) if len(words) else []
    return {"n_words": n, "hit_words": words.tolist(), "item_ids": sorted(named), "hit_spans": spans}


def _blocks(items: DataFrame, key: str, text: str, window: int, most_bytes: int) -> int:
    """How many blocks keep each broadcast under the bound, from one aggregate."""
    size = items.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    return 1 + size * (window + 1) // most_bytes


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    most_window_bytes: int = MOST_WINDOW_BYTES,
    out: str = "contamination",
) -> DataFrame:
    """The documents with `out`: n_words, hit_words (numbers), item_ids (sorted), hit_spans.

    hit_spans are (start, stop) in code points of the original text.
    """
    spark = docs.sparkSession
    count = _blocks(items, item_key, item_text, window, most_window_bytes)
    named = items.select(F.col(item_key).cast("string").alias("id"), F.col(item_text).alias("text"))
    found = docs
    for block in range(count):
        part = named.filter(F.pmod(F.xxhash64("id", "text"), F.lit(count)) == block)
        shared = spark.sparkContext.broadcast(build_scanner([(r["id"], r["text"]) for r in part.collect()], window))
        found = _scan_pass(found, shared, text, f"__pass{block}")
    passes = [f"__pass{block}" for block in range(count)]
    if count == 1:
        return found.withColumnRenamed(passes[0], out)
    merged = F.struct(
        F.col(passes[0])["n_words"].alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.array(*[F.col(p)["hit_words"] for p in passes])))).alias("hit_words"),
        F.array_sort(F.array_distinct(F.flatten(F.array(*[F.col(p)["item_ids"] for p in passes])))).alias("item_ids"),
        F.array_sort(F.flatten(F.array(*[F.col(p)["hit_spans"] for p in passes]))).alias("hit_spans"),
    )
    return found.withColumn(out, merged).drop(*passes)


def _scan_pass(docs: DataFrame, shared, text: str, out: str) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = shared.value
        for batch in batches:
            at = batch.schema.get_field_index(text)
            rows = [_scan_text(scanner, x.as_py()) for x in batch.column(at)]
            columns = [*batch.columns, pa.array(rows, _ARROW)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, out])

    return docs.mapInArrow(scan, T.StructType([*docs.schema.fields, T.StructField(out, _FOUND)]))


def brute_force(text: str | None, items: list[tuple[str | None, str | None]], window: int = WINDOW):
    """n_words, hit words and items of one text by comparing word lists, for tests."""
    words = normal_words(text)
    hit, named = set(), set()
    for item_id, item in items:
        told = normal_words(item)
        for i in range(max(1, len(told) - window + 1)) if told else ():
            want = told[i : i + window]
            for j in range(len(words) - len(want) + 1):
                if words[j : j + len(want)] == want:
                    hit.update(range(j, j + len(want)))
                    named.add(item_id)
    return len(words), sorted(hit), sorted(named - {None})


def item_digest(ids: list[str]) -> str:
    return hashlib.sha256(",".join(ids).encode()).hexdigest()


def op4_decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Hit words and found items of every document."""
    found = find_contamination(docs.select("doc_id", "text"), items)
    c = F.col("contamination")
    n_hit = F.size(c["hit_words"]).cast("long")
    return found.select(
        "doc_id",
        c["n_words"].alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(c["item_ids"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(c["item_ids"], ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


_WORDS_SQL = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)
OP4_SQL = (
    f"WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS_SQL} AS w FROM documents), "
    f"b AS (SELECT item_id::VARCHAR AS item, {_WORDS_SQL} AS w FROM benchmark), "
    "bw AS (SELECT DISTINCT item, array_to_string(w[i:i + 9], ' ') AS win, least(len(w), 10) AS k FROM "
    "(SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)), "
    "ks AS (SELECT DISTINCT k FROM bw), "
    "p AS (SELECT rid, w, unnest(range(1, len(w) + 1)) AS i FROM d), "
    "dw AS (SELECT rid, i, k, array_to_string(w[i:i + k - 1], ' ') AS win FROM p, ks WHERE i + k - 1 <= len(w)), "
    "m AS (SELECT rid, i, bw.k, item FROM dw JOIN bw ON dw.k = bw.k AND dw.win = bw.win), "
    "h AS (SELECT rid, count(DISTINCT x) AS n FROM (SELECT rid, unnest(range(i, i + k)) AS x FROM m) GROUP BY rid), "
    "t AS (SELECT rid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM "
    "(SELECT DISTINCT rid, item FROM m WHERE item IS NOT NULL) GROUP BY rid) "
    "SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(t.n, 0)::BIGINT AS n_items, "
    "sha256(coalesce(ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated "
    "FROM d LEFT JOIN h USING (rid) LEFT JOIN t USING (rid)"
)
