"""Rows that travel to the state handlers and back as tables, not one by one.

Spark hands a handler every row as a named tuple and makes frames of them, which
costs far more than what most handlers do. So the rows of a task are cut by shard
into Arrow tables, one binary value each; a handler gets a few of those, and what
it returns is unpacked behind it.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

PACK_ROWS = 200_000


def to_bytes(table: pa.Table | pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write(table)
    return sink.getvalue().to_pybytes()


def from_bytes(rows: bytes) -> pa.Table:
    return pa.ipc.open_stream(rows).read_all()


def _by_shard(shard: str, pack_rows: int) -> Callable:
    """mapInArrow function: tables of one shard each, of at most pack_rows rows and one batch."""

    def cut(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        number = table.column(shard).to_numpy()
        order = np.argsort(number, kind="stable")
        number = number[order]
        table = table.drop_columns([shard]).take(pa.array(order)).combine_chunks()
        begins = np.flatnonzero(np.append(True, number[1:] != number[:-1]))
        sizes = np.diff(np.append(begins, len(number)))
        rows = [to_bytes(table.slice(b, n)) for b, n in zip(begins.tolist(), sizes.tolist())]
        return pa.RecordBatch.from_arrays([pa.array(number[begins], pa.int32()), pa.array(rows, pa.binary())], names=["shard", "rows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size >= pack_rows:
                yield cut(held)
                held, size = [], 0
        if held:
            yield cut(held)

    return run


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in batch.column(0):
            yield from pa.ipc.open_stream(rows.as_buffer())


def through_state(
    rows: DataFrame, processor, schema: str, time_mode: str, shard: str = "shard", pack_rows: int = PACK_ROWS
) -> DataFrame:
    """Rows of a stream through a processor that takes and gives packed tables, keyed by their shard."""
    packed = rows.mapInArrow(_by_shard(shard, pack_rows), "shard int, rows binary")
    done = packed.groupBy("shard").transformWithStateInPandas(
        statefulProcessor=processor, outputStructType="rows binary", outputMode="Append", timeMode=time_mode
    )
    return done.mapInArrow(_unpacked, schema)


def tables(frames: Iterator[pd.DataFrame]) -> Iterator[pa.Table]:
    """What a handler is given, as tables."""
    for frame in frames:
        for rows in frame["rows"]:
            yield from_bytes(bytes(rows))


def frame_of(table: pa.Table) -> pd.DataFrame:
    """What a handler returns."""
    return pd.DataFrame({"rows": [to_bytes(table)]})


# --- columns --------------------------------------------------------------


def whole(column: pa.ChunkedArray, missing: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers and which of them are there."""
    column = column.cast(pa.int64())
    return column.fill_null(missing).to_numpy(), column.is_valid().to_numpy()


def hundredths(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Amounts with two decimals as whole numbers, and which of them are there.

    Amounts that 64 bits do not hold make an array of Python's whole numbers.
    """
    column = column.cast(pa.decimal128(38, 2)).combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    there = np.asarray(column.is_valid())
    if not len(column):
        return np.zeros(0, np.int64), there
    pair = np.frombuffer(column.buffers()[1], np.int64)[2 * column.offset : 2 * (column.offset + len(column))].reshape(-1, 2)
    low, high = np.where(there, pair[:, 0], 0), np.where(there, pair[:, 1], 0)
    if (high == low >> 63).all():
        return low, there
    both = [(int(h) << 64) | (int(x) & (2**64 - 1)) for x, h in zip(low.tolist(), high.tolist())]
    return narrow(np.array(both, object)), there


def decimals(values: np.ndarray, there: np.ndarray | None = None) -> pa.Array:
    """Hundredths as amounts."""
    values = narrow(values)
    if values.dtype == object:
        low = np.array([v & (2**64 - 1) for v in values], np.uint64).view(np.int64)
        high = np.array([v >> 64 for v in values], np.int64)
    else:
        low, high = values, values >> 63
    data = pa.py_buffer(np.ascontiguousarray(np.stack([low, high], axis=1)))
    valid = None if there is None else pa.array(there).buffers()[1]
    return pa.Array.from_buffers(pa.decimal128(38, 2), len(values), [valid, data])


def narrow(values: np.ndarray) -> np.ndarray:
    """Python's whole numbers as 64 bits where these hold all of them."""
    if values.dtype == object and all(-(2**63) <= v < 2**63 for v in values):
        return values.astype(np.int64)
    return values


def room(values: np.ndarray, factor: int) -> np.ndarray:
    """The values in a form that can grow by the factor without loss."""
    if values.dtype != object and len(values):
        most = max(int(values.max()), -int(values.min()))
        if most * max(int(factor), 1) >= 2**62:
            return values.astype(object)
    return values


def nullable(values: np.ndarray, there: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.array(values, mask=~there).cast(kind)


class Cells:
    """Values by a cell's number in map state; a batch reads and writes the cells it touches."""

    def __init__(self, handle, name: str):
        self.state = handle.getMapState(name, "cell int", "rows binary")

    def read(self, number: int):
        if not self.state.containsKey((number,)):
            return None
        return pickle.loads(bytes(self.state.getValue((number,))[0]))

    def write(self, number: int, value, held: bool) -> None:
        """None empties the cell; held tells that it had a value."""
        if value is not None:
            self.state.updateValue((number,), (pickle.dumps(value, 5),))
        elif held:
            self.state.removeKey((number,))
