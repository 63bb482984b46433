"""Toxicity by logistic regression over hashed word n-grams and skip-grams, learnt with FTRL-proximal.

Features of a text are the distinct hashes of its words, of neighbouring pairs,
of pairs with one word between, and of the openings (four and five letters) that
longer words share with their inflected forms. Learning keeps, per coordinate, a sum of
adjusted gradients and of squared gradients, which gives each its own rate; the
L1 term keeps weights at exactly zero until their evidence is strong, so that
the model that is broadcast is a short list of weights.

Learning uses a bounded sample of labelled rows (`most_rows`, by hash of the id);
features are made where the rows are, the sample meets in one task, and only the
non-zero weights come to the driver. Scoring is one pass without a shuffle.

Defined results: null and empty texts get the score of the bias alone; a null id
is not held out and never learnt from; without any labels every score is 0.5;
extra columns pass through untouched.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwarden.llm.common import labelled_sample, remainder_of_id

WIDTH = 1 << 20
MOST_ROWS = 8000

# Letters, digits and everything beyond ASCII make words; A-Z are folded.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
STEMS = (4, 5)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


class _Hashes(dict):
    """64-bit hash of a word; forgets all when it has become large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1 << 18:
            self.clear()
        value = self[word] = (zlib.crc32(word) << 32 | zlib.crc32(word, 0x5EED)) & 0xFFFFFFFFFFFFFFFF
        return value


_HASHES = _Hashes()


def grams(text: str | None) -> np.ndarray:
    """Hashes of words, pairs, skip pairs and openings, below WIDTH; repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    parts = [h * _ODD[0]]
    if len(h) > 1:
        parts.append((h[:-1] * _ODD[1] + h[1:]) * _ODD[0])
    if len(h) > 2:
        parts.append((h[:-2] * _ODD[2] + h[2:]) * _ODD[3])
    for size in STEMS:
        stems = [_HASHES[word[:size]] for word in words if len(word) > size]
        parts.append(np.array(stems, np.uint64) * _ODD[0] + np.uint64(size << 44))
    return (np.concatenate(parts) >> np.uint64(44)).astype(np.int32)


def ftrl(
    rows: list[tuple[np.ndarray, int]],
    alpha: float = 1.0,
    beta: float = 1.0,
    l1: float = 4.0,
    l2: float = 1.0,
    epochs: int = 2,
) -> tuple[float, np.ndarray, np.ndarray]:
    """Bias, indices and values of the non-zero weights."""
    z, n = np.zeros(WIDTH), np.zeros(WIDTH)
    zb = nb = 0.0

    def weights(zi, ni):
        shrunk = np.sign(zi) * np.maximum(np.abs(zi) - l1, 0)
        return -shrunk / ((beta + np.sqrt(ni)) / alpha + l2)

    for _ in range(epochs):
        for index, y in rows:
            zi, ni = z[index], n[index]
            w = weights(zi, ni)
            wb = -zb / ((beta + np.sqrt(nb)) / alpha)
            error = 1 / (1 + np.exp(-np.clip(wb + w.sum(), -30, 30))) - y
            square = error * error
            rate = (np.sqrt(ni + square) - np.sqrt(ni)) / alpha
            z[index] = zi + error - rate * w
            n[index] = ni + square
            zb += error - (np.sqrt(nb + square) - np.sqrt(nb)) / alpha * wb
            nb += square
    all_weights = weights(z, n)
    index = np.flatnonzero(all_weights)
    return float(-zb / ((beta + np.sqrt(nb)) / alpha)), index.astype(np.int32), all_weights[index].astype(np.float32)


def _gathered(sample: DataFrame) -> DataFrame:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            yield pa.RecordBatch.from_pydict(
                {
                    "turn": rows["turn"],
                    "doc_id": pa.array([str(i) for i in rows["doc_id"]]),
                    "y": pa.array(rows["y"], pa.int32()),
                    "index": pa.array([np.unique(grams(t)) for t in rows["text"]], pa.list_(pa.int32())),
                }
            )

    return sample.mapInArrow(make, "turn long, doc_id string, y int, index array<int>")


def train(docs: DataFrame, labels: DataFrame, label: str, learn, most_rows: int = MOST_ROWS):
    """(bias, indices, values) of the model, or None without labels."""

    def fit_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for turn, key, y, index in zip(*(batch.column(i) for i in range(4))):
                rows.append((turn.as_py(), key.as_py(), index.values.to_numpy(), y.as_py()))
        rows.sort(key=lambda r: r[:2])
        if rows:
            bias, index, value = ftrl([r[2:] for r in rows])
            yield pa.RecordBatch.from_pydict(
                {"bias": [bias], "index": [index.tobytes()], "value": [value.tobytes()]}
            )

    sample = labelled_sample(docs, labels, label, learn, most_rows)
    made = _gathered(sample).repartition(1).mapInArrow(fit_all, "bias double, index binary, value binary").collect()
    if not made:
        return None
    return (
        made[0]["bias"],
        np.frombuffer(bytes(made[0]["index"]), np.int32),
        np.frombuffer(bytes(made[0]["value"]), np.float32),
    )


def score(docs: DataFrame, model, out: str = "toxic_score") -> DataFrame:
    """The documents with a score from 0 to 1; reads text only."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros(WIDTH, np.float32)
        if shared.value is not None:
            bias, index, value = shared.value
            dense[index] = value

        def one(text: str | None) -> float:
            if shared.value is None:
                return 0.5
            found = grams(text)
            found = np.unique(found[dense[found] != 0])
            return float(1 / (1 + np.exp(-np.clip(bias + float(dense[found].sum()), -30, 30))))

        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            columns = [*batch.columns, pa.array([one(t.as_py()) for t in texts], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, out])

    return docs.mapInArrow(add, T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())]))


def held_out():
    return F.coalesce(remainder_of_id(F.col("doc_id"), 5) == 0, F.lit(False))


def op8_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Toxicity scores of all documents, learnt outside the held-out fold."""
    model = train(docs, labels, "toxic", ~held_out())
    scored = score(docs.select("doc_id", "text"), model, "score")
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
