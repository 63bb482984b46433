"""Runs of words that repeat with a period, found by recompression.

A run is a stretch with smallest period q and at least max(shortest, exponent * q)
words that no neighbouring word extends. Documents of a batch are written one
after the other, with a mark of its own between any two.

Candidates: a run of four periods covers four neighbouring points of the grid
0, q, 2q, ..., so words at three neighbouring grid steps are equal there. All
grid steps of all periods are n / 1 + n / 2 + ... = n ln n comparisons, made a
period at a time over every document long enough for it. Of three neighbouring
equal steps one is kept, and steps inside a stretch of one word at q = 1 only: a stretch with
period q that holds q words alike is that word throughout.

Extension: the batch becomes a run-length grammar. Rounds alternate between
blocks (a maximal repetition of a symbol becomes one symbol) and pairs (symbols
are split into left and right ones at random; a left one followed by a right one
becomes one symbol). Equal symbols of a level expand to equal texts, and where a
level begins a symbol depends on the neighbouring symbols only. The longest
common extension of two places therefore goes up the levels while the symbols
agree, a constant number of steps each, and down again into the first that do
not: exact, without hashes and without a suffix array. Both directions read the
same grammar. Documents without candidates have no run and need no grammar.

Memory: a batch holds about `batch_words` words or one document; arrays are about
100 bytes a word. Nothing is shuffled.

Defined results: a null or empty text has no words and no runs; a null id leaves
the text unchanged by the alteration; repeated rows are rows of their own; an
empty table gives no rows. Of runs with equal exponent the smallest start, then
the smallest period, is the greatest. Input columns other than id and text are
not read; `find_runs` keeps them unless they are named like its outputs.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHORTEST, EXPONENT = 6, 4
WORD = r"[^\x20\x09-\x0D]+"
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class Grammar:
    """A run-length grammar by recompression; `extend` gives longest common extensions.

    `text` must begin and end with a symbol that occurs once. `levels` holds, per
    level, the symbols, the place of each one's parent in the next level, and the
    place of every parent's first symbol; `blocks` tells if parents are blocks.
    """

    def __init__(self, text: np.ndarray, enough: int, seed: int = 12):
        self.symbols: list[np.ndarray] = []
        self.parent: list[np.ndarray] = []
        self.first: list[np.ndarray] = []
        self.blocks: list[bool] = []
        dice = np.random.default_rng(seed)
        now, alphabet = text.astype(np.int64), int(text.max(initial=0)) + 1
        blocks, idle = True, 0
        while len(now) > enough and idle < 8:
            starts = np.ones(len(now), bool)
            if blocks:
                starts[1:] = now[1:] != now[:-1]
            else:
                left = dice.integers(0, 2, alphabet, dtype=np.int8).astype(bool)[now]
                starts[1:] = ~(left[:-1] & ~left[1:])
            first = np.flatnonzero(starts)
            length = np.diff(np.append(first, len(now)))
            long = length > 1
            after = now[first]
            if long.any():
                at = first[long]
                second = length[long] if blocks else now[at + 1]
                _, name = np.unique(now[at] * np.int64(max(alphabet, len(now)) + 1) + second, return_inverse=True)
                after[long] = alphabet + name
                self.symbols.append(now)
                self.parent.append(np.cumsum(starts) - 1)
                self.first.append(np.append(first, len(now)))
                self.blocks.append(blocks)
                used, after = np.unique(after, return_inverse=True)
                now, alphabet, idle = after.astype(np.int64), len(used), 0
            else:
                idle += 1
            blocks = not blocks
        self.symbols.append(now)

    def mirrored(self) -> Grammar:
        """The same grammar read from right to left."""
        other = object.__new__(Grammar)
        other.blocks = self.blocks
        other.symbols = [s[::-1] for s in self.symbols]
        other.parent = [p[-1] - p[::-1] for p in self.parent]
        other.first = [f[-1] - f[::-1] for f in self.first]
        return other

    def _step(self, level: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How far both places may go on one level at once: 0 where the symbols differ."""
        own = self.symbols[level]
        step = (own[i] == own[j]).astype(np.int64)
        if level < len(self.blocks) and self.blocks[level]:
            parent, first = self.parent[level], self.first[level]
            step *= np.minimum(first[parent[i] + 1] - i, first[parent[j] + 1] - j)
        return step

    def extend(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal symbols from text places i and j on, for i != j."""
        at_i, at_j = i.astype(np.int64), j.astype(np.int64)
        top = len(self.blocks)
        stopped = np.full(len(at_i), -1, np.int64)
        live = np.arange(len(at_i))
        for level in range(top):
            parent, first = self.parent[level], self.first[level]
            going = live
            while len(going):
                a, b = at_i[going], at_j[going]
                on_edge = (first[parent[a]] == a) & (first[parent[b]] == b)
                going, a, b = going[~on_edge], a[~on_edge], b[~on_edge]
                step = self._step(level, a, b)
                at_i[going], at_j[going] = a + step, b + step
                stopped[going[step == 0]] = level
                going = going[step > 0]
            live = live[stopped[live] < 0]
            at_i[live], at_j[live] = parent[at_i[live]], parent[at_j[live]]
        own = self.symbols[top]
        going = live
        while len(going):
            same = own[at_i[going]] == own[at_j[going]]
            stopped[going[~same]] = top
            going = going[same]
            at_i[going] += 1
            at_j[going] += 1
        for level in range(top - 1, -1, -1):
            down = np.flatnonzero(stopped > level)
            a, b = self.first[level][at_i[down]], self.first[level][at_j[down]]
            step = self._step(level, a, b)
            at_i[down], at_j[down] = a + step, b + step
        return at_i - i


def _grid_candidates(words: np.ndarray, begin: np.ndarray, size: np.ndarray, exponent: int) -> tuple:
    """Places i and periods q with equal words at i and i + q, at least one for every run.

    Documents stand in ascending order of their sizes, so those long enough for a
    period are the last ones, and the grid is laid over the array from there on.
    """
    change = np.flatnonzero(np.append(words[1:] != words[:-1], True))
    steps = exponent - 1
    longest = int(size[-1]) // exponent if len(size) else 0
    firsts = begin[np.searchsorted(size, exponent * np.arange(longest + 1))]
    places, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for q in range(1, longest + 1):
        low = -(-int(firsts[q]) // q) * q
        grid = words[low::q]
        equal = grid[1:] == grid[:-1]
        group = equal[steps - 1 :]
        for back in range(1, steps):
            group = group & equal[steps - 1 - back : len(equal) - back]
        start = np.flatnonzero(group)
        if not len(start):
            continue
        place = low + q * np.unique(start + -start % steps)
        if q > 1:
            place = place[change[np.searchsorted(change, place)] < place + q]
        places.append(place)
        periods.append(np.full(len(place), q, np.int64))
    return np.concatenate(places), np.concatenate(periods)


def _joined(parts: list[np.ndarray], fresh: int) -> tuple[np.ndarray, np.ndarray]:
    """The parts one after the other with a mark of its own before, between and after; and their begins."""
    size = np.array([len(p) for p in parts], np.int64)
    begin = np.cumsum(np.append(0, size[:-1] + 1)) + 1
    whole = np.empty(int(size.sum()) + len(parts) + 1, np.int64)
    marks = np.append(begin - 1, len(whole) - 1)
    real = np.ones(len(whole), bool)
    real[marks] = False
    whole[marks] = fresh + np.arange(len(marks))
    if parts:
        whole[real] = np.concatenate(parts)
    return whole, begin


def runs_of(
    texts: list[np.ndarray], alphabet: int, shortest: int = SHORTEST, exponent: int = EXPONENT
) -> dict[int, np.ndarray]:
    """Per text (word numbers below `alphabet`) with runs: rows (start, length, period) by start, then period."""
    order = sorted((k for k, t in enumerate(texts) if len(t) >= shortest), key=lambda k: len(texts[k]))
    if not order:
        return {}
    parts = [texts[k] for k in order]
    whole, begin = _joined(parts, alphabet)
    place, period = _grid_candidates(whole, begin, np.array([len(p) for p in parts]), exponent)
    owner = np.searchsorted(begin, place, side="right") - 1
    inside = place + period < np.append(begin[1:], len(whole))[owner] - 1
    place, period, owner = place[inside], period[inside], owner[inside]
    asked, owner = np.unique(owner, return_inverse=True)
    if not len(asked):
        return {}
    shift = begin[asked]
    whole, begin = _joined([parts[k] for k in asked], alphabet)
    place = place + (begin - shift)[owner]
    grammar = Grammar(whole, enough=4 * len(asked) + 16)
    ahead = grammar.extend(place, place + period)
    last = len(whole) - 1
    behind = grammar.mirrored().extend(last - place + 1, last - place - period + 1)
    start, stop = place - behind, place + period + ahead
    kept = (stop - start >= np.maximum(shortest, exponent * period))
    start, stop, period, owner = start[kept], stop[kept], period[kept], owner[kept]
    least = np.lexsort((period, stop, start))
    start, stop, period, owner = start[least], stop[least], period[least], owner[least]
    own = np.ones(len(start), bool)
    own[1:] = (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    found = np.stack([start - begin[owner], stop - start, period], axis=1)[own]
    owner = owner[own]
    result = {}
    for k in np.unique(owner):
        rows = found[np.searchsorted(owner, k) : np.searchsorted(owner, k, side="right")]
        result[order[asked[k]]] = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    return result


def _collapsed(words: list[bytes], runs: np.ndarray | None) -> str:
    """The words outside of all repetitions after a run's first period, with one space between."""
    if runs is None:
        return b" ".join(words).decode()
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, runs[:, 0] + runs[:, 2], 1)
    np.add.at(covered, runs[:, 0] + runs[:, 1], -1)
    return b" ".join(words[k] for k in np.flatnonzero(np.cumsum(covered[:-1]) == 0)).decode()


def find_runs(
    docs: DataFrame,
    text: str = "text",
    shortest: int = SHORTEST,
    exponent: int = EXPONENT,
    batch_words: int = 400_000,
) -> DataFrame:
    """The rows with `n_words`, `runs` (start, length, period; by start, then period) and `collapsed`.

    `exponent` is the least number of periods, at least 2; words are split at ASCII
    white space. `collapsed` drops what a run repeats after its first period.
    """
    if exponent < 2 or shortest < 1:
        raise ValueError("a run has at least two periods")
    added = {"n_words": "bigint", "runs": RUNS, "collapsed": "string"}
    kept = [c for c in docs.columns if c not in added]
    own = [f"__own_{i}" for i in range(len(kept))]
    packed = docs.select(F.col(f"`{text}`").alias("__text"), *[F.col(f"`{k}`").alias(o) for k, o in zip(kept, own)])
    types = {f.name: f.dataType.simpleString() for f in packed.schema.fields}
    schema = ", ".join([f"`{o}` {types[o]}" for o in own] + [f"{n} {t}" for n, t in added.items()])
    run_type = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def judged(split: list[list[bytes]]) -> Iterator[pa.Array]:
        number: dict[bytes, int] = defaultdict(count().__next__)
        texts = [np.fromiter(map(number.__getitem__, words), np.int64, len(words)) for words in split]
        found = runs_of(texts, len(number), shortest, exponent)
        yield pa.array([len(w) for w in split], pa.int64())
        yield pa.array(
            [
                [{"start": a, "length": b, "period": c} for a, b, c in found[k].tolist()] if k in found else []
                for k in range(len(split))
            ],
            run_type,
        )
        yield pa.array([_collapsed(words, found.get(k)) for k, words in enumerate(split)], pa.string())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, split, start, size = batch.column("__text"), [], 0, 0
            for at in range(batch.num_rows):
                split.append((source[at].as_py() or "").encode().split())
                size += len(split[-1])
                if size >= batch_words or at == batch.num_rows - 1:
                    passed = [batch.column(o).slice(start, len(split)) for o in own]
                    yield pa.RecordBatch.from_arrays([*passed, *judged(split)], names=[*own, *added])
                    split, start, size = [], at + 1, 0

    found = packed.mapInArrow(rows, schema)
    return found.select(*[F.col(o).alias(k) for k, o in zip(kept, own)], *added)


def greatest(runs: Column) -> Column:
    """The run with the greatest exact length / period, the first of equal ones; null for none."""

    def better(best: Column, run: Column) -> Column:
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), better)


def altered(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth document, by the hash of its id, repeats a part of itself to its end."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    part = F.expr("crc div 10")
    marked = docs.select("doc_id", "text", crc.alias("crc")).select(
        "doc_id", "text", part.alias("g"),
        F.when(F.col("crc") % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))).alias("words"),
    )
    n = F.size("words").cast("long")
    a = F.col("g") % n
    p = 1 + F.floor((n - a) / (3 + F.col("g") % 8))
    at = marked.select("*", F.when(F.size("words") > 0, F.struct(n.alias("n"), a.alias("a"), p.alias("p"))).alias("at"))
    copy = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("at.n") - 1),
        lambda i: F.get(
            "words",
            F.when(i < F.col("at.a"), i).otherwise(F.col("at.a") + (i - F.col("at.a")) % F.col("at.p")).cast("int"),
        ),
    )
    return at.select("doc_id", F.when(F.col("at").isNotNull(), F.array_join(copy, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(docs: DataFrame) -> DataFrame:
    """Runs of the altered documents, the greatest one, and digests of all runs and of the words kept."""
    found = find_runs(altered(docs.select("doc_id", "text")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    top = found.withColumn("top", greatest(F.col("runs")))
    return top.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("top.start").alias("start"),
        F.col("top.length").alias("length"),
        F.col("top.period").alias("period"),
        F.floor(1000 * F.col("top.length") / F.col("top.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
