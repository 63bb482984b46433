"""SentencePiece encoding and decoding for vocabularies of merges.

Encoding keeps an agenda of adjacent symbol pairs whose union is a piece, best
score first and leftmost among equals; the best pair is merged, the pairs it
stood in are dropped and those of the new symbol enter, until no pair is left.
A symbol outside the vocabulary becomes its UTF-8 bytes. Decoding joins the
pieces again. In every Arrow batch the sentencepiece library encodes the parts met
there for the first time and decodes the ids of all texts; `agrees` tells per row
whether both gave the same. On request it encodes every whole text as well.

A text is cut, before the agenda, where no piece can reach across: before white
space that follows something else, and between characters that no chain of
pieces connects (letters and punctuation, say). Short parts repeat, so each task
remembers the ids of up to `most_parts` of them and of as many older ones.

The vocabulary's path is a parameter; every worker loads the file once. Models
other than merges with byte fallback, an identity normaliser and a white space
put in front are refused with ValueError.

Defined results: a null text is encoded like an empty one, to no ids and ''; very
long texts and parts are encoded whole, in time n log n; literal '▁' counts as
white space, as in the library; repeated rows and ids are rows of their own; an
empty table gives no rows. Columns of the input named like an output (`ids`,
`decoded`, `agrees`) are replaced, all other columns pass through.
"""

from __future__ import annotations

import heapq
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

SPACE = "▁"
UNKNOWN = " ⁇ "
SHORT_PART = 48
OUTSIDE = 1 << 20  # symbols outside the vocabulary are this plus their code point
WIDE = 1 << 22
NEVER = 1 << 40
END = -1
PAD = "\0"
GUARD = "\n"


class Pieces:
    """A vocabulary of merges with its own encoder and decoder."""

    def __init__(self, model: str, most_parts: int):
        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        lib, size = self.library, self.library.vocab_size()
        names = [lib.id_to_piece(i) for i in range(size)]
        plain = [
            i for i in range(size) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i))
        ]
        self.id_of = {names[i]: i for i in plain}
        self.cost = {names[i]: -lib.get_score(i) for i in plain}
        self.byte_ids = {int(names[i], 16): i for i in self._bytes(names)}
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        if len(self.byte_ids) != 256:
            raise ValueError("a vocabulary with byte fallback is wanted")
        self.controls = {i for i in range(size) if lib.is_control(i)}
        self.surface = [n.replace(SPACE, " ") for n in names]
        self.surface[lib.unk_id()] = UNKNOWN
        for i in self.controls:
            self.surface[i] = ""
        for byte, i in self.byte_ids.items():
            self.surface[i] = chr(byte) if byte < 128 else "�"
        self.high = {i for byte, i in self.byte_ids.items() if byte >= 128}
        self._check_cuts()
        self.pairs = self._pairs()
        self.letter_ids = np.arange(0x110000, dtype=np.int64) + OUTSIDE
        for name, i in self.id_of.items():
            if len(name) == 1:
                self.letter_ids[ord(name)] = i
        self.parts_of = self._cutter()
        self.known: dict[str, tuple[int, ...]] = {}
        self.wrong: set[str] = set()
        self.earlier: dict[str, tuple[int, ...]] = {}
        self.most_parts = most_parts
        for probe in ("", " ", "  a  b ", "\tx\n", "éﬁ①　 \U0001f600", "a▁b<s><0x41>"):
            if self.encode(probe) != lib.encode(probe):
                raise ValueError("the model is none of merges with an identity normaliser and a space in front")

    def _bytes(self, names: list[str]) -> Iterator[int]:
        for i, name in enumerate(names):
            if self.library.is_byte(i):
                names[i] = name.strip("<>")
                yield i

    def _check_cuts(self) -> None:
        if any(SPACE in name.lstrip(SPACE) for name in self.id_of):
            raise ValueError("pieces reach over white space")

    def _cutter(self):
        """Finds parts no piece reaches out of: white space and characters that stand together in pieces."""
        leader: dict[str, str] = {}

        def lead(c: str) -> str:
            while leader.setdefault(c, c) != c:
                c = leader[c]
            return c

        for name in self.id_of:
            own = name.lstrip(SPACE)
            for a, b in zip(own, own[1:]):
                leader[lead(a)] = lead(b)
        sets: dict[str, list[str]] = {}
        for c in leader:
            sets.setdefault(lead(c), []).append(c)
        classes = ["".join(re.escape(c) for c in sorted(some)) for some in sorted(sets.values(), key=len, reverse=True)]
        runs = "".join(f"[{c}]+|" for c in classes)
        return re.compile(f"{SPACE}*(?:{runs}[^{SPACE}])|{SPACE}+", re.DOTALL).findall

    def _pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pairs of pieces whose union is a piece: their sorted keys, the cost's rank and the piece."""
        names = list(self.id_of)
        rank = dict(zip(names, np.unique([self.cost[n] for n in names], return_inverse=True)[1].tolist()))
        found = sorted(
            (self.id_of[name[:k]] * WIDE + self.id_of[name[k:]], rank[name], i)
            for name, i in self.id_of.items()
            for k in range(1, len(name))
            if name[:k] in self.id_of and name[k:] in self.id_of
        )
        keys, ranks, merged = np.array(found, np.int64).reshape(-1, 3).T
        return np.append(keys, np.iinfo(np.int64).max), np.append(ranks, NEVER), np.append(merged, 0)

    def _price(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the cost of merging two symbols (NEVER if their union is no piece), and the union."""
        keys, ranks, merged = self.pairs
        wanted = left * WIDE + right
        at = np.searchsorted(keys, wanted)
        return np.where((keys[at] == wanted) & (right != END), ranks[at], NEVER), merged[at]

    def _few(self, parts: list[str]) -> list[tuple[int, ...]]:
        """The ids of short parts, all at once: each has an agenda of its own, a row of costs by place.

        A step merges in every part its least cost, the leftmost of equals, and prices
        the two pairs of the new symbol; parts without a pair left drop out.
        """
        width = max(map(len, parts))
        letters = np.frombuffer("".join(p.ljust(width + 1, PAD) for p in parts).encode("utf-32-le"), "<u4")
        symbols = self.letter_ids[letters].reshape(len(parts), width + 1)
        whole = np.array([len(p) for p in parts])
        symbols[np.arange(width + 1) >= whole[:, None]] = END
        cost, union = self._price(symbols[:, :-1], symbols[:, 1:])
        right = np.tile(np.arange(1, width + 2, dtype=np.int16), (len(parts), 1))
        left = right - np.int16(2)
        done, order, rows = [], [], np.arange(len(parts))
        while len(rows):
            at = np.arange(len(rows))
            best = cost.argmin(axis=1)
            live = cost[at, best] < NEVER
            if 2 * np.count_nonzero(live) < len(rows):
                done.append(symbols[~live])
                order.append(rows[~live])
                rows, symbols, cost, union = rows[live], symbols[live], cost[live], union[live]
                left, right, best = left[live], right[live], best[live]
                at = np.arange(len(rows))
            else:
                at, best = at[live], best[live]
            merged, gone = union[at, best], right[at, best]
            after = right[at, gone]
            symbols[at, best], symbols[at, gone] = merged, END
            cost[at, np.minimum(gone, width - 1)] = NEVER
            right[at, best], left[at, after] = after, best
            cost[at, best], union[at, best] = self._price(merged, symbols[at, after])
            before = left[at, best]
            some = before >= 0
            at, before, merged = at[some], before[some], merged[some]
            cost[at, before], union[at, before] = self._price(symbols[at, before], merged)
        ids = [self._written([i for i in row if i != END]) for some in done for row in some.tolist()]
        return [ids[k] for k in np.argsort(np.concatenate(order)).tolist()]

    def _written(self, symbols: list[int]) -> tuple[int, ...]:
        """Symbols outside the vocabulary as the ids of their bytes."""
        if max(symbols) < OUTSIDE:
            return tuple(symbols)
        bytes_of = ([i] if i < OUTSIDE else [self.byte_ids[b] for b in chr(i - OUTSIDE).encode()] for i in symbols)
        return tuple(chain.from_iterable(bytes_of))

    def _many(self, part: str) -> tuple[int, ...]:
        """The ids of a long part; its agenda is a heap, entries whose symbols have changed are passed over."""
        symbols: list[str] = list(part)
        end = len(symbols)
        before, after = list(range(-1, end - 1)), list(range(1, end + 1))
        cost = self.cost
        agenda = [(cost[a + b], k, k + 1, 2) for k, (a, b) in enumerate(zip(part, part[1:])) if a + b in cost]
        heapq.heapify(agenda)
        while agenda:
            _, left, right, length = heapq.heappop(agenda)
            if not symbols[left] or not symbols[right] or len(symbols[left]) + len(symbols[right]) != length:
                continue
            symbols[left] += symbols[right]
            symbols[right] = ""
            after[left] = after[right]
            if after[left] < end:
                before[after[left]] = left
            for a, b in ((before[left], left), (left, after[left])):
                if a >= 0 and b < end:
                    joined = symbols[a] + symbols[b]
                    if joined in cost:
                        heapq.heappush(agenda, (cost[joined], a, b, len(joined)))
        return self._written([self.id_of[s] if s in self.id_of else OUTSIDE + ord(s) for s in symbols if s])

    def _compare(self, fresh: dict[str, tuple[int, ...]]) -> None:
        """Note the parts to which the library gives other ids; a guard stands before those without white space."""
        probes = [p[1:] if p.startswith(SPACE) else GUARD + p for p in fresh]
        guard = self.library.encode(GUARD)
        for (part, ids), told in zip(fresh.items(), self.library.encode(probes, num_threads=1)):
            if told != (list(ids) if part.startswith(SPACE) else [*guard, *ids]):
                self.wrong.add(part)

    def encode_all(self, texts: list[str], check: bool = False) -> tuple[list[list[int]], list[bool]]:
        """The ids of every text, and if the library agrees on all its parts; new short parts are merged together."""
        split = [self.parts_of(SPACE + text.replace(" ", SPACE)) if text else [] for text in texts]
        known = self.known
        found = [list(map(known.get, parts)) for parts in split]
        unknown = {p for parts, ids in zip(split, found) if None in ids for p, i in zip(parts, ids) if i is None}
        learnt = {p: self.earlier[p] for p in unknown if p in self.earlier}
        long = {p: self._many(p) for p in unknown if len(p) > SHORT_PART}
        short = sorted((p for p in unknown if p not in learnt and p not in long), key=len)
        for width in (6, 9, 12, 18, 27, SHORT_PART):
            stop = bisect_right(short, width, key=len)
            if stop:
                learnt |= zip(short[:stop], self._few(short[:stop]))
                short = short[stop:]
        if check:
            self._compare({p: learnt[p] for p in learnt if p not in self.earlier} | long)
        known |= learnt
        for parts, ids in zip(split, found):
            if None in ids:
                ids[:] = [known.get(p) or long[p] if i is None else i for p, i in zip(parts, ids)]
        if len(known) > self.most_parts:
            self.known, self.earlier = {}, known
        agree = [not self.wrong or self.wrong.isdisjoint(parts) for parts in split]
        return [list(chain.from_iterable(ids)) for ids in found], agree

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0][0]

    def decode(self, ids: list[int]) -> str:
        """Pieces joined; one white space in front goes; bytes that are no UTF-8 become U+FFFD each."""
        first = next((i for i in ids if i not in self.controls), None)
        if self.high.isdisjoint(ids):
            text = "".join(map(self.surface.__getitem__, ids))
        else:
            found: list[str] = []
            run = bytearray()
            for i in ids:
                if i in self.high:
                    run.append(self.byte_of[i])
                    continue
                if run:
                    found.append(_utf8(bytes(run)))
                    run.clear()
                found.append(self.surface[i])
            text = "".join(found) + _utf8(bytes(run))
        drop = first is not None and first not in self.byte_of and text.startswith(" ") and first != self.library.unk_id()
        return text[1:] if drop else text


def _utf8(raw: bytes) -> str:
    found, at = [], 0
    while at < len(raw):
        for width in (2, 3, 4):
            try:
                found.append(raw[at : at + width].decode())
                at += width
                break
            except UnicodeDecodeError:
                continue
        else:
            found.append("�")
            at += 1
    return "".join(found)


@lru_cache(maxsize=4)
def load(model: str, most_parts: int = 150_000) -> Pieces:
    return Pieces(model, most_parts)


def default_model() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


def encode(
    docs: DataFrame,
    text: str = "text",
    model: str | None = None,
    decoded: bool = True,
    check: str | None = "parts",
    most_parts: int = 150_000,
    batch_chars: int = 4_000_000,
) -> DataFrame:
    """The rows with `ids`, and on request `decoded` and `agrees`; all columns but those pass through.

    `agrees` compares with the library: the ids of every part when a task first meets
    it (check="parts") or the ids of every whole text anew ("texts"), and the text that
    the library decodes from the ids. Batches hold about `batch_chars` characters, at
    least a text.
    """
    if check not in (None, "parts", "texts"):
        raise ValueError("check is 'parts', 'texts' or None")
    model = model or default_model()
    added = {"ids": ArrayType(IntegerType())} | ({"decoded": StringType()} if decoded else {})
    added |= {"agrees": BooleanType()} if check else {}
    fields = [f for f in docs.schema.fields if f.name not in added]
    kept = [f.name for f in fields]
    own = [f"__own_{i}" for i in range(len(kept))]
    packed = docs.select(F.col(f"`{text}`").alias("__text"), *[F.col(f"`{k}`").alias(o) for k, o in zip(kept, own)])
    schema = StructType(
        [StructField(o, f.dataType) for o, f in zip(own, fields)] + [StructField(n, t) for n, t in added.items()]
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model, most_parts)
        for batch in batches:
            texts = [t or "" for t in batch.column("__text").to_pylist()]
            for start, stop in _spans(texts, batch_chars):
                some = texts[start:stop]
                ids, agree = pieces.encode_all(some, check == "parts")
                columns = [batch.column(o).slice(start, stop - start) for o in own]
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                if decoded or check:
                    back = [pieces.decode(i) for i in ids]
                if decoded:
                    columns.append(pa.array(back, pa.string()))
                if check:
                    told = pieces.library.encode(some, num_threads=1) if check == "texts" else ids
                    again = pieces.library.decode(told, num_threads=1)
                    columns.append(pa.array([a and b == c and d == e for a, b, c, d, e in zip(agree, ids, told, back, again)]))
                yield pa.RecordBatch.from_arrays(columns, names=[*own, *added])

    found = packed.mapInArrow(rows, schema)
    return found.select(*[F.col(o).alias(k) for k, o in zip(kept, own)], *added)


def _spans(texts: list[str], most: int) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def decode(table: DataFrame, ids: str = "ids", model: str | None = None) -> DataFrame:
    """The rows with `decoded`, the text of their ids; null ids give ''. A column of that name is replaced."""
    model = model or default_model()

    @F.pandas_udf("string")
    def joined(column: pd.Series) -> pd.Series:
        return column.map(lambda i: "" if i is None else load(model).decode([int(x) for x in i]))

    return table.withColumn("decoded", joined(F.col(ids)))


def op13_sentencepiece(docs: DataFrame) -> DataFrame:
    """Digests of every text's ids and of the text decoded from them."""
    found = encode(docs.select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
        "agrees",
    )
