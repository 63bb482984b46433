"""Secret scans over a trigram inverted index, in DataFrame functions only.

Each rule is a regular expression. Its Boolean trigram query is derived from the
expression's parse tree: the strings that every match must contain give, per
place, alternatives of trigrams that have to occur together. The index holds a
posting row (trigram, document key) for each trigram some rule asks about; other
trigrams would never be looked up and are not written. Postings stay rows, so a
frequent trigram is never gathered; they meet per document, where the queries
are decided. Only documents that satisfy a rule's query are verified with that
rule's expression; rules without a mandatory trigram scan every text.

Defined results: a null or empty text has no spans; documents with the same key
share their postings, and each row is verified on its own text; a null key is a
key like any other; other columns pass through untouched, but for one with the
name of the result, which is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from itertools import product
from operator import and_, or_
from re import _constants as sre
from re import _parser as sre_parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPANS_TYPE = "array<struct<start:bigint,kind:int,stop:bigint>>"
_WORD_BITS = 62
_MOST_ALTERNATIVES = 64
_MOST_CLASS = 4
_BLOCK = 512


@dataclass(frozen=True)
class Rule:
    """A kind of secret; matches whose `group` is shorter than `min_chars` are dropped.

    `likely` is an optional cheap expression that every kept match contains.
    """

    kind: str
    pattern: str
    group: int = 0
    min_chars: int = 1
    any_case: bool = False
    likely: str | None = None

    @property
    def java(self) -> str:
        return ("(?i)" if self.any_case else "") + self.pattern


# The kinds, in the order in which equal starts are listed.
RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        min_chars=12,
        any_case=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", min_chars=18),
    Rule("hex", r"[0-9a-f]+", min_chars=16, likely=r"[0-9a-f]{16}"),
)


def _trigrams(text: str) -> frozenset[str]:
    text = text.lower()
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _alternatives(item) -> set[str] | None:
    """All strings an element can match, or None if they are too many to list."""
    op, value = item
    if op is sre.LITERAL:
        return {chr(value)}
    if op is sre.IN and all(x[0] is sre.LITERAL for x in value) and len(value) <= _MOST_CLASS:
        return {chr(x[1]) for x in value}
    if op is sre.SUBPATTERN:
        return _sequence(value[3])
    if op is sre.BRANCH:
        parts = [_sequence(branch) for branch in value[1]]
        return None if None in parts else set().union(*parts)
    if op is sre.MAX_REPEAT and value[:2] == (0, 1):
        inner = _sequence(value[2])
        return None if inner is None else inner | {""}
    return None


def _sequence(items) -> set[str] | None:
    whole = {""}
    for item in items:
        part = _alternatives(item)
        if part is None or len(whole) * len(part) > _MOST_ALTERNATIVES:
            return None
        whole = {a + b for a, b in product(whole, part)}
    return whole


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """AND of places, each an OR of trigram sets; empty if nothing is mandatory.

    Trigrams are in lower case, as the index folds case.
    """
    places, current = [], {""}

    def close() -> None:
        sets = {_trigrams(x) for x in current}
        least = [s for s in sets if not any(o < s for o in sets)]
        if frozenset() not in sets:
            places.append(sorted(least, key=sorted))

    for item in sre_parser.parse(pattern):
        part = _alternatives(item)
        if part is not None and len(current) * len(part) <= _MOST_ALTERNATIVES:
            current = {a + b for a, b in product(current, part)}
            continue
        close()
        current = {""}
    close()
    return places


def postings(docs: DataFrame, key: str, text: str, vocabulary: list[str]) -> DataFrame:
    """Rows (gram, key): the texts with that entry of the vocabulary, in any case."""
    folded = docs.select(F.col(key).alias("key"), F.lower(F.col(text)).alias("folded"))
    entries = [F.when(F.contains("folded", F.lit(g)), F.lit(i)) for i, g in enumerate(vocabulary)]
    return folded.select("key", F.explode(F.array_compact(F.array(*entries))).alias("gram"))


def candidates(docs: DataFrame, key: str, text: str, rules: tuple[Rule, ...]) -> DataFrame | None:
    """Rows (key, r<i> ...): documents whose postings satisfy rule i; None without such rules."""
    asked = {i: q for i, rule in enumerate(rules) if (q := trigram_query(rule.pattern))}
    if not asked:
        return None
    vocabulary = sorted({g for q in asked.values() for place in q for s in place for g in s})
    number = {g: i for i, g in enumerate(vocabulary)}
    words = -(-len(vocabulary) // _WORD_BITS)
    listed = postings(docs, key, text, vocabulary)
    bit = F.expr(f"shiftleft(1L, gram % {_WORD_BITS})")
    word = F.floor(F.col("gram") / _WORD_BITS)
    met = listed.groupBy("key").agg(
        *[F.bit_or(F.when(word == w, bit).otherwise(F.lit(0).cast("long"))).alias(f"w{w}") for w in range(words)]
    )

    def has(grams: frozenset[str]) -> Column:
        masks = [0] * words
        for g in grams:
            masks[number[g] // _WORD_BITS] |= 1 << number[g] % _WORD_BITS
        tests = [F.col(f"w{w}").bitwiseAND(F.lit(m)) == F.lit(m) for w, m in enumerate(masks) if m]
        return reduce(and_, tests)

    decided = [
        reduce(and_, [reduce(or_, [has(s) for s in place]) for place in q]).alias(f"r{i}")
        for i, q in asked.items()
    ]
    found = met.select("key", *decided)
    return found.filter(reduce(or_, [F.col(f"r{i}") for i in asked]))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often `use` names it."""
    return F.transform(F.array(value), use)[0]


def running(values: Column, plus: Callable[[Column, Column], Column], part: int = 64) -> Column:
    """For every value the total of those before it, from 0 on, by any associative `plus`.

    Totals run within parts of the array and over the parts, so a value is copied
    about `part` times and not once for every value after it.
    """

    def totals(array: Column) -> Column:
        zero = F.array(F.lit(0).cast("long"))
        return F.aggregate(array, zero, lambda acc, x: F.concat(acc, F.array(plus(F.element_at(acc, -1), x))))

    def cut(array: Column) -> Column:
        last = F.floor(F.greatest(F.size(array) - 1, F.lit(0)) / part).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: totals(F.slice(array, i * part + 1, F.lit(part))))

    def joined(parts: Column) -> Column:
        carried = totals(F.transform(parts, lambda a: F.element_at(a, -1)))
        own = F.zip_with(
            parts,
            F.slice(carried, F.lit(1), F.size(parts)),
            lambda a, c: F.transform(F.slice(a, F.lit(1), F.size(a) - 1), lambda x: plus(c, x)),
        )
        return F.flatten(own)

    return _bound(values, lambda array: _bound(cut(array), joined))


def _spans(text: Column, number: int, rule: Rule) -> Column:
    """Kept matches of one rule: leftmost, not overlapping, in code points."""
    pieces = F.arrays_zip(
        F.split(text, rule.java, -1),
        F.regexp_extract_all(text, F.lit(rule.java), F.lit(0)),
        F.regexp_extract_all(text, F.lit(rule.java), F.lit(rule.group)),
    )

    def spans(piece: Column) -> Column:
        wide = F.transform(piece, lambda p: (F.length(p["0"]) + F.coalesce(F.length(p["1"]), F.lit(0))).cast("long"))
        placed = F.arrays_zip(piece.alias("piece"), running(wide, lambda a, b: a + b).alias("before"))
        kept = F.filter(placed, lambda p: F.length(p["piece"]["2"]) >= rule.min_chars)

        def span(p: Column) -> Column:
            start = p["before"] + F.length(p["piece"]["0"])
            stop = start + F.length(p["piece"]["1"])
            return F.struct(start.alias("start"), F.lit(number).alias("kind"), stop.alias("stop"))

        return F.transform(kept, span)

    return _bound(pieces, spans).cast(SPANS_TYPE)


def find_secrets(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    rules: tuple[Rule, ...] = RULES,
    out: str = "secret_spans",
) -> DataFrame:
    """The documents with `out`: spans (start, number of the rule, stop), sorted."""
    empty = F.array().cast(SPANS_TYPE)
    told = candidates(docs, key, text, rules)
    joined = docs
    if told is not None:
        flags = [c for c in told.columns if c != "key"]
        told = told.select(F.col("key").alias("__key"), *[F.col(c).alias(f"__{c}") for c in flags])
        joined = docs.join(told, docs[key].eqNullSafe(told["__key"]), "left")
    parts = []
    for i, rule in enumerate(rules):
        test = told[f"__r{i}"] if told is not None and f"__r{i}" in told.columns else F.lit(True)
        if rule.likely:
            test = test & docs[text].rlike(rule.likely)
        parts.append(F.when(test, _spans(docs[text], i, rule)).otherwise(empty))
    found = F.array_sort(F.coalesce(F.concat(*parts), empty))
    return joined.select(*[docs[c] for c in docs.columns if c != out], found.alias(out))


def spans_text(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """kind:start:stop, comma-joined."""
    kinds = F.array(*[F.lit(rule.kind) for rule in rules])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"], s["stop"])), ","
    )


def redact(docs: DataFrame, text: str, spans: str, mark: str = "[SECRET]") -> DataFrame:
    """Replace every span (overlapping ones as one) by a mark; the spans column goes.

    The text is cut into blocks once and what stays is joined from the blocks it
    lies in, so the work grows with the text and the spans, not with their product.
    """
    body = F.col(text)

    def masked(blocks: Column) -> Column:
        def cut(low: Column, high: Column) -> Column:
            first, last = (F.floor(x / _BLOCK).cast("int") for x in (low, high - 1))
            within = F.array_join(F.slice(blocks, first + 1, last - first + 1), "")
            there = F.substr(within, (low % _BLOCK + 1).cast("int"), (high - low).cast("int"))
            return F.when(high > low, there).otherwise("")

        ends = F.transform(F.col(spans), lambda s: s["stop"])
        pieces = F.zip_with(
            F.col(spans),
            running(ends, lambda a, b: F.greatest(a, b)),
            lambda s, done: F.when(s["start"] >= done, F.concat(cut(done, s["start"]), F.lit(mark))).otherwise(""),
        )
        return F.concat(F.array_join(pieces, ""), cut(F.array_max(ends), F.length(body).cast("long")))

    blocks = F.regexp_extract_all(body, F.lit(f"(?s).{{1,{_BLOCK}}}"), F.lit(0))
    return docs.withColumn(text, F.when(F.size(spans) > 0, _bound(blocks, masked)).otherwise(body)).drop(spans)


def brute_force(text: str | None, rules: tuple[Rule, ...] = RULES) -> list[tuple[int, int, int]]:
    """The same spans by a plain scan of one text, for tests."""
    found = []
    for i, rule in enumerate(rules):
        flags = re.ASCII | (re.IGNORECASE if rule.any_case else 0)
        for m in re.finditer(rule.pattern, text or "", flags):
            if len(m[rule.group]) >= rule.min_chars:
                found.append((m.start(), i, m.end()))
    return sorted(found)


def op1_secret_scan(docs: DataFrame) -> DataFrame:
    """Counts, digest and text of the spans of every document."""
    found = find_secrets(docs.select("doc_id", "text"))
    shown = found.withColumn("spans", spans_text(F.col("secret_spans")))

    def count(i: int) -> Column:
        return F.size(F.filter("secret_spans", lambda s: s["kind"] == i)).cast("long")

    return shown.select(
        "doc_id",
        *[count(i).alias(f"n_{rule.kind}") for i, rule in enumerate(RULES)],
        F.sha2(F.col("spans"), 256).alias("base_sha256"),
        "spans",
    )


_KEYWORDS = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    "|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
)
OP1_SQL = (
    "WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents), "
    "c AS (SELECT rid, t FROM d), "
    "m AS ("
    + " UNION ALL ".join(
        f"SELECT rid, {no} AS no, '{kind}' AS kind, {least} AS least, "
        f"regexp_extract_all(t, '{pat}', 0) AS w, regexp_extract_all(t, '{pat}', {grp}) AS v, "
        f"string_split_regex(t, '{pat}') AS g FROM c"
        for no, kind, pat, grp, least in (
            (0, "assign", _KEYWORDS + "[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)", 2, 12),
            (1, "access", "AKIA[A-Z0-9]+", 0, 18),
            (2, "hex", "[0-9a-f]+", 0, 16),
        )
    )
    + "), u AS (SELECT rid, no, kind, least, unnest(range(1, len(w) + 1)) AS i, w, v, g FROM m WHERE len(w) > 0), "
    "l AS (SELECT rid, no, kind, least, i, length(g[i]) AS gl, length(w[i]) AS wl, length(v[i]) AS vl FROM u), "
    "p AS (SELECT *, sum(gl + wl) OVER (PARTITION BY rid, no ORDER BY i) AS e FROM l), "
    "s AS (SELECT rid, no, kind, e - wl AS b, e FROM p WHERE vl >= least), "
    "a AS (SELECT rid, count(*) FILTER (no = 0) AS n0, count(*) FILTER (no = 1) AS n1, "
    "count(*) FILTER (no = 2) AS n2, "
    "string_agg(kind || ':' || b::BIGINT || ':' || e::BIGINT, ',' ORDER BY b, no) AS x FROM s GROUP BY rid) "
    "SELECT doc_id, coalesce(n0, 0)::BIGINT AS n_assign, coalesce(n1, 0)::BIGINT AS n_access, "
    "coalesce(n2, 0)::BIGINT AS n_hex, sha256(coalesce(x, '')) AS base_sha256, coalesce(x, '') AS spans "
    "FROM d LEFT JOIN a USING (rid)"
)
