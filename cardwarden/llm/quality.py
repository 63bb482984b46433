"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

A document is a sparse vector: its words, hashed, with damped counts of unit
length; and one entry per structure statistic or piece of metadata, for the bin
it falls into. The score is the logistic of w0 + sum w_i x_i + sum over pairs of
<v_i, v_j> x_i x_j, where the pairs are summed in linear time as
(|sum v_i x_i|^2 - sum |v_i x_i|^2) / 2 per factor.

Learning uses a bounded sample of labelled rows (`most_rows`, by hash of the id):
features are made where the rows are, the sample meets in one task, and only the
model, of fixed size, comes to the driver and is broadcast for scoring. Scoring
is one pass without a shuffle.

Defined results: null and empty texts are scored by their statistics; a null id
is not held out and never learnt from; without any labels every score is 0.5;
extra columns pass through untouched.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwarden.llm.common import labelled_sample, remainder_of_id

WORD_BUCKETS = 1 << 15
BINS = 24
MOST_ROWS = 8000

_KIND = np.zeros(256, np.int64)  # 0 other bytes, 1 lower, 2 upper, 3 digit, 4 blank, 5 mark, 6 symbol, 7 line end
_KIND[0x61:0x7B] = 1
_KIND[0x41:0x5B] = 2
_KIND[0x30:0x3A] = 3
_KIND[[0x20, 0x09, 0x0D]] = 4
_KIND[[ord(c) for c in ".,;:?!'\"-()"]] = 5
_KIND[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = 6
_KIND[0x0A] = 7


def _log_bin(x: float) -> int:
    return int(min(BINS - 1, 2 * np.log2(1 + x)))


def _share_bin(x: float) -> int:
    return int(min(BINS - 1, x * BINS))


def structure_bins(text: str, counts: Counter, n_words: int, n_chars: int | None) -> list[int]:
    """The bin of every statistic; shares are of bytes, words or lines."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    kinds = np.bincount(_KIND[raw], minlength=8)
    letters = max(1, kinds[0] + kinds[1] + kinds[2])
    size = max(1, len(raw))
    lines = [x for x in text.split("\n") if x]
    some = max(1, n_words)
    return [
        _log_bin(len(raw)),
        _log_bin(n_words),
        _share_bin(kinds[2] / letters),
        _share_bin(3 * kinds[3] / size),
        _share_bin(3 * kinds[5] / size),
        _share_bin(3 * kinds[6] / size),
        _share_bin(kinds[4] / size),
        _share_bin(len(counts) / some),
        _log_bin(len(raw) / some),
        _share_bin(1 - len(set(lines)) / max(1, len(lines))),
        _share_bin(max(counts.values(), default=0) / some),
        _log_bin(len(lines)),
        0 if n_chars is None else 1 + min(BINS - 2, _log_bin(max(0, n_chars))),
    ]


N_STATISTICS = 13
WIDTH = WORD_BUCKETS + N_STATISTICS * BINS


class _Buckets(dict):
    """Bucket of a word; forgets all when it has become large."""

    def __missing__(self, word: str) -> int:
        if len(self) > 1 << 18:
            self.clear()
        bucket = self[word] = zlib.crc32(word.encode("utf-8", "surrogatepass")) % WORD_BUCKETS
        return bucket


_BUCKETS = _Buckets()


def features(text: str | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Indices (distinct) and values of one document."""
    text = text or ""
    words = text.lower().split()
    counts = Counter(words)
    raw = np.fromiter(map(_BUCKETS.__getitem__, counts), np.int64, len(counts))
    summed = np.bincount(raw, weights=np.fromiter(counts.values(), float, len(counts))) if len(raw) else np.empty(0)
    index = np.flatnonzero(summed)
    value = np.log1p(summed[index])
    if len(value):
        value /= np.sqrt(value @ value)
    bins = structure_bins(text, counts, len(words), n_chars)
    own = np.array([WORD_BUCKETS + i * BINS + b for i, b in enumerate(bins)])
    return np.concatenate((index, own)).astype(np.int32), np.concatenate((value, np.full(len(own), 0.5))).astype(np.float32)


@dataclass
class FactorisationMachine:
    """Weights of the bias, of the features and of their factors; None stands for no labels."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def raw(self, index: np.ndarray, value: np.ndarray) -> float:
        scaled = self.factors[index] * value[:, None]
        total = scaled.sum(0)
        pairs = 0.5 * float(total @ total - (scaled * scaled).sum())
        return self.bias + float(self.linear[index] @ value) + pairs

    def score(self, index: np.ndarray, value: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.raw(index, value), -30, 30))))


def fit(
    rows: list[tuple[np.ndarray, np.ndarray, int]],
    rank: int = 8,
    epochs: int = 6,
    batch: int = 64,
    rate: float = 0.1,
    ridge: float = 1e-5,
    seed: int = 5,
) -> FactorisationMachine:
    """Logistic loss, batches in a seeded order, a step size per coordinate."""
    dice = np.random.default_rng(seed)
    w0, g0 = 0.0, 1e-8
    w, gw = np.zeros(WIDTH), np.full(WIDTH, 1e-8)
    v, gv = dice.normal(0, 0.05, (WIDTH, rank)), np.full((WIDTH, rank), 1e-8)
    for _ in range(epochs):
        order = dice.permutation(len(rows))
        for at in range(0, len(order), batch):
            part = [rows[i] for i in order[at : at + batch]]
            index = np.concatenate([r[0] for r in part])
            x = np.concatenate([r[1] for r in part]).astype(float)
            lengths = np.array([len(r[0]) for r in part])
            row = np.repeat(np.arange(len(part)), lengths)
            starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            scaled = v[index] * x[:, None]
            total = np.add.reduceat(scaled, starts)
            squares = np.add.reduceat((scaled * scaled).sum(1), starts)
            raw = w0 + np.add.reduceat(w[index] * x, starts) + 0.5 * ((total * total).sum(1) - squares)
            error = 1 / (1 + np.exp(-np.clip(raw, -30, 30))) - np.array([r[2] for r in part])
            error /= len(part)
            hit, place = np.unique(index, return_inverse=True)
            ex = error[row] * x
            dw = np.bincount(place, ex) + ridge * w[hit]
            dv = np.stack(
                [np.bincount(place, ex * (total[row, f] - scaled[:, f])) for f in range(rank)], axis=1
            ) + ridge * v[hit]
            d0 = error.sum()
            g0 += d0 * d0
            w0 -= rate * d0 / np.sqrt(g0)
            gw[hit] += dw * dw
            w[hit] -= rate * dw / np.sqrt(gw[hit])
            gv[hit] += dv * dv
            v[hit] -= rate * dv / np.sqrt(gv[hit])
    return FactorisationMachine(w0, w.astype(np.float32), v.astype(np.float32))


def _featured(sample: DataFrame) -> DataFrame:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            made = [features(t, n) for t, n in zip(rows["text"], rows["n_chars"])]
            yield pa.RecordBatch.from_pydict(
                {
                    "turn": rows["turn"],
                    "doc_id": pa.array([str(i) for i in rows["doc_id"]]),
                    "y": pa.array(rows["y"], pa.int32()),
                    "index": pa.array([m[0] for m in made], pa.list_(pa.int32())),
                    "value": pa.array([m[1] for m in made], pa.list_(pa.float32())),
                }
            )

    return sample.mapInArrow(make, "turn long, doc_id string, y int, index array<int>, value array<float>")


def train(docs: DataFrame, labels: DataFrame, label: str, learn, most_rows: int = MOST_ROWS) -> FactorisationMachine | None:
    """Fit in one task on the bounded sample; only the model comes back."""

    def fit_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for turn, key, y, index, value in zip(*(batch.column(i) for i in range(5))):
                rows.append((turn.as_py(), key.as_py(), index.values.to_numpy(), value.values.to_numpy(), y.as_py()))
        rows.sort(key=lambda r: r[:2])
        if rows:
            model = fit([r[2:] for r in rows])
            yield pa.RecordBatch.from_pydict(
                {"bias": [model.bias], "linear": [model.linear.tobytes()], "factors": [model.factors.tobytes()]}
            )

    sample = labelled_sample(docs, labels, label, learn, most_rows)
    made = _featured(sample).repartition(1).mapInArrow(fit_all, "bias double, linear binary, factors binary").collect()
    if not made:
        return None
    linear = np.frombuffer(bytes(made[0]["linear"]), np.float32)
    factors = np.frombuffer(bytes(made[0]["factors"]), np.float32).reshape(WIDTH, -1)
    return FactorisationMachine(made[0]["bias"], linear, factors)


def score(docs: DataFrame, model: FactorisationMachine | None, out: str = "quality_score") -> DataFrame:
    """The documents with a score from 0 to 1; reads text and n_chars only."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            sizes = batch.column(batch.schema.get_field_index("n_chars"))
            scores = [
                0.5 if machine is None else machine.score(*features(t.as_py(), n.as_py())) for t, n in zip(texts, sizes)
            ]
            columns = [*batch.columns, pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, out])

    return docs.mapInArrow(add, T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())]))


def held_out():
    return F.coalesce(remainder_of_id(F.col("doc_id"), 3) == 1, F.lit(False))


def op5_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Quality scores of all documents, learnt outside the held-out fold."""
    model = train(docs, labels, "quality", ~held_out())
    scored = score(docs.select("doc_id", "text", "n_chars"), model, "score")
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
