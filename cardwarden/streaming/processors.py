"""State handlers of the keyed streams.

What a key remembers lies in map state under buckets of time, so a handler reads
and writes the buckets its rows touch and no others. A key's rows of one
micro-batch are taken up to `frame_rows` at a time: more of them are laid into
buckets first and then read back bucket by bucket, in time order.

With a watermark, rows before it are told apart and change nothing, and timers
at the ends of buckets drop what no later row can ask for.
"""

from __future__ import annotations

import pickle
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from decimal import Decimal
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from cardwarden.operators.travel_fold import POINT_FIELDS, judge_one
from cardwarden.streaming.packed import (
    Cells, decimals, frame_of, from_bytes, hundredths, narrow, nullable, room, tables, to_bytes, whole,
)

FRAME_ROWS = 200_000
CHUNK_ROWS = 5_000


class _Spool:
    """A key's rows of a micro-batch in time order, at most frame_rows of them or one bucket at a time."""

    def __init__(self, handle: StatefulProcessorHandle, bucket_s: int, frame_rows: int):
        self.width, self.frame_rows = bucket_s * 1_000_000, frame_rows
        self.parts = handle.getMapState("arrived", "bucket bigint, part int", "rows binary")

    def in_order(self, rows: Iterator[pd.DataFrame], row_id: str) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for frame in rows:
            held.append(frame)
            size += len(frame)
            if size > self.frame_rows:
                yield from self._by_bucket(held, rows, row_id)
                return
        if held:
            yield _sorted(held, row_id)

    def _by_bucket(self, held: list[pd.DataFrame], rows: Iterator[pd.DataFrame], row_id: str) -> Iterator[pd.DataFrame]:
        parts, sizes = Counter(), Counter()

        def lay(frame: pd.DataFrame) -> None:
            for bucket, some in frame.groupby(frame["at"].to_numpy() // self.width, sort=False):
                for first in range(0, len(some), CHUNK_ROWS):
                    chunk = some.iloc[first : first + CHUNK_ROWS]
                    self.parts.updateValue((int(bucket), parts[bucket]), (pickle.dumps(chunk),))
                    parts[bucket] += 1
                    sizes[bucket] += len(chunk)

        while held:
            lay(held.pop())
        for frame in rows:
            lay(frame)
        group: list[int] = []
        for bucket in [*sorted(sizes), None]:
            if group and (bucket is None or sum(sizes[b] for b in group) + sizes[bucket] > self.frame_rows):
                keys = [(int(b), part) for b in group for part in range(parts[b])]
                yield _sorted([pickle.loads(bytes(self.parts.getValue(k)[0])) for k in keys], row_id)
                for key in keys:
                    self.parts.removeKey(key)
                group = []
            group.append(bucket)


def _sorted(frames: list[pd.DataFrame], row_id: str) -> pd.DataFrame:
    """Rows in time then id order."""
    return pd.concat(frames, ignore_index=True).sort_values(["at", row_id], kind="stable", ignore_index=True)


def _watermark(timer_values) -> int:
    """The watermark in microseconds; rows before it are too late."""
    return timer_values.getCurrentWatermarkInMs() * 1000


def _timed(table: pa.Table) -> pa.Table:
    """A table whose rows all have a time; a missing number is the smallest."""
    if table["at"].null_count:
        raise ValueError("a row without a time")
    place = table.column_names.index("id")
    return table.set_column(place, "id", table["id"].fill_null(np.iinfo(np.int64).min))


def _of_packed(
    rows: Iterator[pd.DataFrame], frame_rows: int, payload: list[str], work: list[str]
) -> tuple[Iterator, pa.Table | None, pa.Schema]:
    """Packed rows as frames for a handler, and the schema of the columns it carries along.

    Up to frame_rows rows come as one frame of what the handler works with and their place in the
    table, which is returned, too; more come as frames with all their columns, so that none is held.
    """
    given = map(_timed, tables(rows))
    held, size = [], 0
    for table in given:
        held.append(table)
        size += len(table)
        if size > frame_rows:
            break
    carried = held[0].select(payload).schema
    if size > frame_rows:
        return (t.to_pandas(integer_object_nulls=True) for t in chain(held, given)), None, carried
    table = pa.concat_tables(held)
    frame = {c: table[c].to_numpy() for c in work}
    return iter([pd.DataFrame({**frame, "row": np.arange(len(table))})]), table, carried


POINT = np.dtype([("owner", "<i8"), *[(f, k) for f, k in zip(POINT_FIELDS, ("<i8", "<i8", "<f8", "<f8"))]])
REACH = np.dtype([("owner", "<i8"), ("first", "<i8"), ("latest", "<i8")])


def _owners(frame: pd.DataFrame, owner: str | None) -> np.ndarray:
    """Whose the rows are; without that column all belong to the key."""
    return np.zeros(len(frame), np.int64) if owner is None else frame[owner].to_numpy(np.int64)


def _all_timed(frame: pd.DataFrame) -> None:
    """A row without a time has no place among the others; rows come sorted, such ones last."""
    if pd.isna(frame["at"].iloc[-1]):
        raise ValueError("a row without a time")


def _ends(owner: np.ndarray) -> np.ndarray:
    """Places of the last row of each owner in rows sorted by owner."""
    return np.flatnonzero(np.append(owner[1:] != owner[:-1], True)) if len(owner) else np.zeros(0, np.int64)


def _latest_points(points: np.ndarray) -> np.ndarray:
    """The last point of each owner."""
    points = points[np.lexsort((points["id"], points["at"], points["owner"]))]
    return points[_ends(points["owner"])]


class _Reach:
    """Times of the first and the latest point of each owner of a key."""

    def __init__(self, rows: bytes = b""):
        self.rows = np.frombuffer(rows, REACH).copy()

    def of(self, owner: np.ndarray, field: str, absent: int) -> np.ndarray:
        if not len(self.rows):
            return np.full(len(owner), absent)
        place = np.minimum(np.searchsorted(self.rows["owner"], owner), len(self.rows) - 1)
        return np.where(self.rows["owner"][place] == owner, self.rows[field][place], absent)

    def take(self, points: np.ndarray) -> None:
        new = np.zeros(len(points), REACH)
        for field, source in zip(REACH.names, ("owner", "at", "at")):
            new[field] = points[source]
        rows = np.concatenate([self.rows, new])
        rows = rows[np.argsort(rows["owner"], kind="stable")]
        ends = _ends(rows["owner"])
        starts = np.append(0, ends[:-1] + 1)
        self.rows = rows[ends]
        self.rows["first"] = np.minimum.reduceat(rows["first"], starts)
        self.rows["latest"] = np.maximum.reduceat(rows["latest"], starts)


NEVER = np.iinfo(np.int64).min // 2


class TravelProcessor(StatefulProcessor):
    """Judges customers' payments against the accepted points before them.

    A key is one customer or, with `owner`, a shard of customers that this column
    tells apart: their rows are judged together, a bucket of the state holds the
    points of all of them. Without a watermark the state holds each customer's
    points of the look-back, counted from the customer's latest one, and always
    that one. With a watermark it holds what rows not before the watermark can ask
    for: the points of open buckets, and the last one before them. A payment that
    comes late is judged against the latest strictly earlier point; one from
    before the look-back becomes no point itself. `packed` rows come and go as tables.
    """

    def __init__(
        self, max_speed_4: int, payload: list[str], look_back_s: int | None, ttl_ms: int | None,
        watermark: bool = False, bucket_s: int = 3600, frame_rows: int = FRAME_ROWS, owner: str | None = None,
        packed: bool = False,
    ):
        self.packed = packed
        self.max_speed_4, self.payload, self.ttl_ms, self.watermark = max_speed_4, payload, ttl_ms, watermark
        self.look_back = None if look_back_s is None else look_back_s * 1_000_000
        self.bucket_s, self.width, self.frame_rows, self.owner = bucket_s, bucket_s * 1_000_000, frame_rows, owner

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.points = handle.getMapState("points", "bucket bigint", "points binary", self.ttl_ms)
        # With which buckets there are; asking the map for its keys reads all of its values, too.
        self.reach = handle.getValueState("reach", "rows binary, buckets binary", self.ttl_ms)
        self.spool = _Spool(handle, self.bucket_s, self.frame_rows)

    def _known(self) -> tuple[bytes, list[int]]:
        """The owners' first and latest times, and the buckets there are; with ttl_ms buckets go by themselves."""
        state = self.reach.get()
        rows, numbers = (b"", b"") if state is None else (bytes(x) for x in state)
        if self.ttl_ms is None:
            return rows, np.frombuffer(numbers, np.int64).tolist()
        buckets = sorted(k for (k,) in self.points.keys())
        return rows if buckets else b"", buckets

    def _remember(self, rows: bytes, buckets: list[int]) -> None:
        self.reach.update((rows, np.array(buckets, np.int64).tobytes()))

    def _bucket(self, number: int) -> np.ndarray:
        return np.frombuffer(bytes(self.points.getValue((number,))[0]), POINT)

    def _begin(self, reach: _Reach, owner: np.ndarray) -> np.ndarray:
        """Where the look-back of each owner begins."""
        if self.look_back is None:
            return np.full(len(owner), NEVER)
        latest = reach.of(owner, "latest", NEVER)
        return np.where(latest == NEVER, NEVER, latest - self.look_back)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if not self.packed:
            for found in self._verdicts(rows, timerValues):
                yield self._shaped(*found)
            return
        frames, table, carried = _of_packed(rows, self.frame_rows, self.payload, [*POINT_FIELDS, "eligible", self.owner])
        for frame, place, verdicts in self._verdicts(frames, timerValues):
            if table is None:
                out = pa.Table.from_pandas(frame[self.payload].iloc[place], carried, preserve_index=False)
            else:
                out = table.select(self.payload).take(pa.array(frame["row"].to_numpy()[place]))
            yield frame_of(self._with_verdicts(out, verdicts))

    def _verdicts(self, frames: Iterator[pd.DataFrame], timerValues) -> Iterator[tuple]:
        """Frames in time order, in which order their rows come out, and their verdicts; None for rows that come too late."""
        known, buckets = self._known()
        were, before, reach = list(buckets), _Reach(known), _Reach(known)
        low, seen = _watermark(timerValues) if self.watermark else None, []
        for frame in self.spool.in_order(frames, "id"):
            if low is not None:
                late = frame["at"].to_numpy() < low
                if late.any():
                    some = frame[late].reset_index(drop=True)
                    yield some, np.arange(len(some)), None
                    frame = frame[~late].reset_index(drop=True)
            if len(frame):
                seen.append(np.unique(_owners(frame, self.owner)))
                yield frame, *self._judge(frame, buckets, before, reach)
        if seen and len(reach.rows):
            if self.look_back is not None:
                self._forget(buckets, reach, np.unique(np.concatenate(seen)))
            if reach.rows.tobytes() != known or buckets != were:
                self._remember(reach.rows.tobytes(), buckets)

    def _forget(self, buckets: list[int], reach: _Reach, owners: np.ndarray) -> None:
        """Points of these owners from before their look-back go."""
        first, begin = reach.of(owners, "first", NEVER), self._begin(reach, owners)
        moved = (first // self.width < begin // self.width) & (begin > NEVER)
        if not moved.any():
            return
        low, high = (first[moved] // self.width).min(), (begin[moved] // self.width).max()
        for number in buckets[bisect_left(buckets, low) : bisect_left(buckets, high)]:
            points = self._bucket(number)
            kept = points[points["at"] >= self._begin(reach, points["owner"])]
            if not len(kept):
                self.points.removeKey((number,))
                buckets.remove(number)
            elif len(kept) < len(points):
                self.points.updateValue((number,), (kept.tobytes(),))
        place = np.searchsorted(reach.rows["owner"], owners[moved])
        reach.rows["first"][place] = begin[moved]

    def _before(self, buckets: list[int], owners: np.ndarray) -> list[np.ndarray]:
        """The owners' last points in these buckets, read from the newest as far as needed."""
        found = []
        for number in reversed(buckets):
            if not len(owners):
                break
            points = self._bucket(number)
            points = _latest_points(points[np.isin(points["owner"], owners)])
            found.append(points)
            owners = np.setdiff1d(owners, points["owner"], assume_unique=True)
        return found

    def _judge(self, new: pd.DataFrame, buckets: list[int], before: _Reach, reach: _Reach) -> tuple[np.ndarray, list[pa.Array]]:
        _all_timed(new)
        arrived = np.zeros(len(new), POINT)
        arrived["owner"] = _owners(new, self.owner)
        for f in POINT_FIELDS:
            arrived[f] = new[f].to_numpy(POINT[f])
        first, last = int(arrived["at"][0]) // self.width, int(arrived["at"][-1]) // self.width
        place = bisect_left(buckets, first)
        cells = {b: self._bucket(b) for b in buckets[place : bisect_left(buckets, last + 1)]}
        owners = np.unique(arrived["owner"])
        earlier = owners[reach.of(owners, "first", np.iinfo(np.int64).max) < first * self.width]
        held = np.concatenate([arrived[:0], *cells.values()])
        held = np.concatenate([held[np.isin(held["owner"], owners)], *self._before(buckets[:place], earlier)])
        held = held[held["at"] >= self._begin(before, held["owner"])]
        points = np.concatenate([held, arrived])
        given = np.arange(len(points)) < len(held)
        eligible = np.append(
            np.ones(len(held), bool),
            new["eligible"].to_numpy(bool) & (arrived["at"] >= self._begin(before, arrived["owner"])),
        )
        order = np.lexsort((points["id"], points["at"], points["owner"]))
        points, given, eligible = points[order], given[order], eligible[order]
        columns = [np.ascontiguousarray(points[f]) for f in POINT_FIELDS]
        verdicts, accepted = judge_one(
            *columns, eligible, given, self.max_speed_4, np.ascontiguousarray(points["owner"])
        )
        fresh = points[accepted & ~given]
        if len(fresh):
            reach.take(fresh)
            number = fresh["at"] // self.width
            by_bucket = np.argsort(number, kind="stable")
            fresh, number = fresh[by_bucket], number[by_bucket]
            ends = _ends(number) + 1
            for start, end in zip([0, *ends[:-1].tolist()], ends.tolist()):
                b = int(number[start])
                if b not in cells:
                    buckets.insert(bisect_left(buckets, b), b)
                    if self.watermark:
                        self.handle.registerTimer((b + 1) * self.width // 1000)
                both = np.concatenate([cells.get(b, fresh[:0]), fresh[start:end]])
                self.points.updateValue((b,), (both.tobytes(),))
        return order[~given] - len(held), verdicts

    VERDICTS = [*(f"_ref_{f}" for f in POINT_FIELDS), "violation", "late"]

    def _shaped(self, frame: pd.DataFrame, place: np.ndarray, verdicts: list[pa.Array] | None) -> pd.DataFrame:
        out = frame[self.payload].iloc[place].reset_index(drop=True)
        kinds = ["Int64", "Int64", "Float64", "Float64", "bool", "bool"]
        found = self._unjudged(len(place)) if verdicts is None else verdicts
        for name, values, kind in zip(self.VERDICTS, found, kinds):
            out[name] = pd.array(values.to_pylist(), dtype=kind)
        if self.watermark:
            out["too_late"] = verdicts is None
        return out

    def _with_verdicts(self, out: pa.Table, verdicts: list[pa.Array] | None) -> pa.Table:
        for name, values in zip(self.VERDICTS, self._unjudged(len(out)) if verdicts is None else verdicts):
            out = out.append_column(name, values)
        return out.append_column("too_late", pa.repeat(verdicts is None, len(out))) if self.watermark else out

    @staticmethod
    def _unjudged(n: int) -> list[pa.Array]:
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
        return [*(pa.nulls(n, kind) for kind in kinds), *[pa.repeat(False, n)] * 2]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Buckets have ended: of them the last point of each owner stays."""
        number = expiredTimerInfo.getExpiryTimeInMs() * 1000 // self.width - 1
        if self.points.containsKey((number,)):
            high = max(number, _watermark(timerValues) // self.width - 1)
            known, buckets = self._known()
            ended = [k for k in buckets if k <= high]
            points = _latest_points(np.concatenate([self._bucket(k) for k in ended]))
            self.points.updateValue((ended[-1],), (points.tobytes(),))
            for earlier in ended[:-1]:
                self.points.removeKey((earlier,))
            self._remember(known, buckets[len(ended) - 1 :])
        return iter(())

    def close(self) -> None:
        pass


class WindowProcessor(StatefulProcessor):
    """Totals of a customer's window that ends at the customer's latest payment.

    A ring of buckets holds count, sum and largest card of the eligible payments;
    the totals of the buckets wholly inside the window are kept up: arriving
    payments are added, buckets that leave are taken off again. The bucket in which
    the window begins is counted row by row, so the result is exact. All of a
    customer's rows of a micro-batch land before any is judged.
    """

    def __init__(self, payload: list[str], window_s: int, bucket_s: int = 600, frame_rows: int = FRAME_ROWS):
        self.payload, self.window = payload, window_s * 1_000_000
        self.bucket_s, self.width, self.frame_rows = bucket_s, bucket_s * 1_000_000, frame_rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        totals = "n bigint, total decimal(38,2), card bigint"
        self.cells = handle.getMapState("cells", "bucket bigint", totals)
        row = "array<struct<at:bigint,amount:decimal(38,2),card:bigint>>"
        self.rows = handle.getMapState("rows", "bucket bigint, part bigint", f"rows {row}")
        self.inside = handle.getValueState("inside", f"clock bigint, edge bigint, {totals}")
        self.judged = handle.getMapState("judged", "part bigint", "rows binary")
        self.spool = _Spool(handle, self.bucket_s, self.frame_rows)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        low = _watermark(timerValues)
        state = self.inside.get() if self.inside.exists() else None
        clock, edge, n, total, card = state or (None, None, 0, Decimal(0), None)
        waiting, frames = 0, []
        for frame in self.spool.in_order(rows, "id"):
            before = frame["at"].to_numpy() < low
            if before.any():
                yield self._shaped(frame[before], None)
                frame = frame[~before]
            if not len(frame):
                continue
            clock = max(clock or 0, int(frame["at"].iloc[-1]))
            if edge is None:
                edge = (int(frame["at"].iloc[0]) - self.window) // self.width
            some = frame[frame["eligible"].to_numpy(bool)]
            for number, own in some.groupby(some["at"].to_numpy() // self.width):
                added = self._add(int(number), own)
                if number > edge:
                    n, total, card = _plus((n, total, card), added)
            # The rows wait for the window's totals; all but the latest frame in the state.
            frames.append(frame)
            if len(frames) > 1:
                self.judged.updateValue((waiting,), (pickle.dumps(frames.pop(0)),))
                waiting += 1
        if not frames:
            return
        begin = clock - self.window
        n, total, card = self._slide(edge, begin // self.width, (n, total, card))
        self.inside.update((clock, begin // self.width, n, total, card))
        window = _plus((n, total, card), self._edge(begin))
        for part in range(waiting):
            yield self._shaped(pickle.loads(bytes(self.judged.getValue((part,))[0])), window)
            self.judged.removeKey((part,))
        yield self._shaped(frames[0], window)

    def _add(self, number: int, own: pd.DataFrame) -> tuple:
        """Payments enter their bucket; returns what they add."""
        cell = (0, Decimal(0), None)
        if self.cells.containsKey((number,)):
            cell = tuple(self.cells.getValue((number,)))
        else:
            end = (number + 1) * self.width + self.window
            self.handle.registerTimer(end // 1000 + 1)
        found = [
            (int(at), amount, None if pd.isna(c) else int(c)) for at, amount, c in zip(own["at"], own["amount"], own["card"])
        ]
        done, place = 0, cell[0]
        while done < len(found):
            part, used = divmod(place, CHUNK_ROWS)
            held = [tuple(r) for r in self.rows.getValue((number, part))[0]] if used else []
            some = found[done : done + CHUNK_ROWS - used]
            self.rows.updateValue((number, part), (held + some,))
            done, place = done + len(some), place + len(some)
        added = (len(found), sum((r[1] for r in found), Decimal(0)), _largest(r[2] for r in found))
        self.cells.updateValue((number,), _plus(cell, added))
        return added

    def _slide(self, edge: int, new_edge: int, inside: tuple) -> tuple:
        """Buckets from the old edge to before the new one go; those up to the new one leave the totals."""
        if new_edge <= edge:
            return inside
        numbers = sorted(k for (k,) in self.cells.keys())
        n, total, card = inside
        for number in numbers[: bisect_left(numbers, new_edge + 1)]:
            cell = self.cells.getValue((number,))
            if number > edge:
                n, total = n - cell[0], total - cell[1]
            if number < new_edge:
                self._drop(number, cell[0])
        left = [self.cells.getValue((k,))[2] for k in numbers[bisect_left(numbers, new_edge + 1) :]]
        return n, total, _largest(left)

    def _edge(self, begin: int) -> tuple:
        """The part of the window that lies in the bucket it begins in."""
        number = begin // self.width
        if not self.cells.containsKey((number,)):
            return (0, Decimal(0), None)
        n, total, cards = 0, Decimal(0), []
        for part in range(-(-self.cells.getValue((number,))[0] // CHUNK_ROWS)):
            for at, amount, card in self.rows.getValue((number, part))[0]:
                if at >= begin:
                    n, total = n + 1, total + amount
                    cards.append(card)
        return n, total, _largest(cards)

    def _drop(self, number: int, n: int) -> None:
        for part in range(-(-n // CHUNK_ROWS)):
            self.rows.removeKey((number, part))
        self.cells.removeKey((number,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """A bucket has left the window of every payment still to come."""
        number = (expiredTimerInfo.getExpiryTimeInMs() * 1000 - self.window) // self.width - 1
        if self.cells.containsKey((number,)):
            clock, edge, *inside = self.inside.get()
            if number >= edge:
                inside = self._slide(edge, number + 1, tuple(inside))
                self.inside.update((clock, number + 1, *inside))
            if self.cells.containsKey((number,)):
                self._drop(number, self.cells.getValue((number,))[0])
        return iter(())

    def _shaped(self, frame: pd.DataFrame, window: tuple | None) -> pd.DataFrame:
        out = frame[self.payload].reset_index(drop=True)
        n, total, card = window or (None, None, None)
        out["txn_count"] = pd.array([n] * len(out), dtype="Int64")
        out["aggregate_total"] = [total] * len(out)
        out["max_card_id"] = pd.array([card] * len(out), dtype="Int64")
        out["too_late"] = window is None
        return out

    def close(self) -> None:
        pass


SWEEP = 86_400_000_000


class SharedWindows(WindowProcessor):
    """The same totals for a shard of customers that the column `owner` tells apart.

    A customer's ring lies in a cell of the shard's state: clock, edge, the totals
    inside, and per bucket count, sum (in hundredths), largest card and the rows. A
    batch reads and writes the cells of its own customers; a sweep at the end of
    each day takes out what has left the window of every payment still to come.
    """

    def __init__(self, *args, owner: str = "owner", **options):
        super().__init__(*args, **options)
        self.owner = owner

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rings = _Cells(handle, "rings")
        self.judged = handle.getMapState("judged", "part bigint", "rows binary")
        self.spool = _Spool(handle, self.bucket_s, self.frame_rows)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        low, opened, touched, sweeps = _watermark(timerValues), {}, set(), set()
        waiting, frames = 0, []
        for frame in self.spool.in_order(rows, "id"):
            before = frame["at"].to_numpy() < low
            if before.any():
                yield self._shaped(frame[before], None)
                frame = frame[~before]
            if not len(frame):
                continue
            touched |= self._land(frame, opened, sweeps)
            # The rows wait for the window's totals; all but the latest frame in the state.
            frames.append(frame)
            if len(frames) > 1:
                self.judged.updateValue((waiting,), (pickle.dumps(frames.pop(0)),))
                waiting += 1
        if not frames:
            return
        windows = {}
        for own in touched:
            cell = self.rings.cell(opened, (own,))
            clock, edge, inside, ring = cell[own]
            begin = clock - self.window
            inside = self._leave(ring, edge, begin // self.width, inside)
            cell[own] = (clock, begin // self.width, inside, ring)
            inner = [r for r in ring.get(begin // self.width, (0, 0, None, []))[3] if r[0] >= begin]
            part = (len(inner), sum(r[1] for r in inner), _largest(r[2] for r in inner))
            n, total, card = _plus(inside, part)
            windows[own] = (n, Decimal(total).scaleb(-2), card)
        self.rings.save(opened)
        for at in sweeps:
            self.handle.registerTimer(at)
        for part in range(waiting):
            yield self._of_owners(pickle.loads(bytes(self.judged.getValue((part,))[0])), windows)
            self.judged.removeKey((part,))
        yield self._of_owners(frames[0], windows)

    def _land(self, frame: pd.DataFrame, opened: dict, sweeps: set[int]) -> set[int]:
        """Payments enter their buckets; returns whose they are."""
        _all_timed(frame)
        touched = set()
        values = zip(
            _owners(frame, self.owner).tolist(), frame["at"].tolist(), frame["eligible"].tolist(), frame["amount"], frame["card"]
        )
        for own, at, eligible, amount, card in values:
            touched.add(own)
            cell = self.rings.cell(opened, (own,))
            if own not in cell:
                cell[own] = (at, (at - self.window) // self.width, (0, 0, None), {})
            clock, edge, inside, ring = cell[own]
            if eligible:
                row = (at, int(amount.scaleb(2)), _whole(card))
                number, added = at // self.width, (1, *row[1:])
                if number not in ring:
                    ring[number] = (0, 0, None, [])
                    end = (number + 1) * self.width + self.window
                    sweeps.add(-(-end // SWEEP) * SWEEP // 1000 + 1)
                *totals, rows = ring[number]
                rows.append(row)
                ring[number] = (*_plus(totals, added), rows)
                if number > edge:
                    inside = _plus(inside, added)
            cell[own] = (max(clock, at), edge, inside, ring)
        return touched

    @staticmethod
    def _leave(ring: dict, edge: int, new_edge: int, inside: tuple) -> tuple:
        """_slide on a ring in memory."""
        if new_edge <= edge:
            return inside
        n, total, card = inside
        for number in [k for k in ring if k <= new_edge]:
            if number > edge:
                n, total = n - ring[number][0], total - ring[number][1]
            if number < new_edge:
                del ring[number]
        return n, total, _largest(b[2] for k, b in ring.items() if k > new_edge)

    def _of_owners(self, frame: pd.DataFrame, windows: dict) -> pd.DataFrame:
        own = [windows[o] for o in _owners(frame, self.owner).tolist()]
        out = self._shaped(frame, (0, Decimal(0), None))
        out["txn_count"] = pd.array([w[0] for w in own], dtype="Int64")
        out["aggregate_total"] = [w[1] for w in own]
        out["max_card_id"] = pd.array([w[2] for w in own], dtype="Int64")
        return out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = _watermark(timerValues)
        new_edge, opened = (now - self.window) // self.width, {}
        for (number,) in list(self.rings.state.keys()):
            cell = opened[number] = pickle.loads(bytes(self.rings.state.getValue((number,))[0]))
            for own, (clock, edge, inside, ring) in list(cell.items()):
                if new_edge > edge:
                    cell[own] = (clock, new_edge, self._leave(ring, edge, new_edge, inside), ring)
                if not ring and clock <= now:
                    del cell[own]
        self.rings.save(opened)
        return iter(())


CLOCK = np.dtype([("owner", "<i8"), ("clock", "<i8")])


class PackedWindows(StatefulProcessor):
    """The totals of SharedWindows on packed rows, as columns.

    A shard's state is each customer's clock and the eligible payments of the windows; payments leave
    with their bucket. All rows of a micro-batch land before any is judged; of more than frame_rows
    rows the tables wait in the state.
    """

    ROWS = ("owner", "at", "amount", "card", "known")

    def __init__(self, payload: list[str], window_s: int, bucket_s: int = 600, frame_rows: int = FRAME_ROWS, owner: str = "owner"):
        self.payload, self.window, self.width = payload, window_s * 1_000_000, bucket_s * 1_000_000
        self.frame_rows, self.owner = frame_rows, owner

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.windows = handle.getValueState("windows", "rows binary")
        self.judged = handle.getMapState("judged", "part bigint", "rows binary")

    def _held(self) -> tuple[np.ndarray, dict, int]:
        """Clocks by owner, payments, and the time of the last sweep that is due."""
        state = self.windows.get()
        empty = {c: np.zeros(0, np.int64) for c in self.ROWS}
        return (np.zeros(0, CLOCK), empty, 0) if state is None else pickle.loads(bytes(state[0]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        low, parts, size, held = _watermark(timerValues), [], 0, []
        for part, table in enumerate(map(_timed, tables(rows))):
            size += len(table)
            parts.append(self._work(table))
            held.append(table.select([*dict.fromkeys([*self.payload, "at", self.owner])]))
            if size > self.frame_rows:
                self.judged.updateValue((part,), (to_bytes(held[part].combine_chunks()),))
                held[part] = None
        work = _gathered(parts, {c: np.zeros(0, np.int64) for c in parts[0]})
        totals = self._land({c: v[work["at"] >= low] for c, v in work.items()}, low)
        for part, table in enumerate(held):
            if table is None:
                table = from_bytes(bytes(self.judged.getValue((part,))[0]))
                self.judged.removeKey((part,))
            yield frame_of(self._with_totals(table, totals, low))

    def _work(self, table: pa.Table) -> dict[str, np.ndarray]:
        card, known = whole(table["card"])
        return {
            "owner": table[self.owner].to_numpy(), "at": table["at"].to_numpy(), "amount": hundredths(table["amount"])[0],
            "card": card, "known": known.astype(np.int64), "eligible": table["eligible"].to_numpy().astype(np.int64),
        }

    def _land(self, new: dict, low: int) -> dict[str, np.ndarray]:
        """Payments enter the windows; returns the totals of their owners, in the owners' order."""
        if not len(new["at"]):
            return {}
        clocks, rows, sweep = self._held()
        owners, of = np.unique(new["owner"], return_inverse=True)
        latest = np.full(len(owners), np.iinfo(np.int64).min)
        np.maximum.at(latest, of, new["at"])
        at = np.minimum(np.searchsorted(clocks["owner"], owners), max(len(clocks) - 1, 0))
        if len(clocks):
            known = clocks["owner"][at] == owners
            latest[known] = np.maximum(latest[known], clocks["clock"][at[known]])
        own = np.zeros(len(owners), CLOCK)
        own["owner"], own["clock"] = owners, latest
        clocks = np.concatenate([clocks[~np.isin(clocks["owner"], owners)], own])
        clocks = clocks[np.argsort(clocks["owner"], kind="stable")]
        counts = new["eligible"] > 0
        rows = {c: np.concatenate([rows[c], new[c][counts]]) for c in self.ROWS}
        due = -(-(int(latest.max()) // self.width * self.width + self.width + self.window) // SWEEP) * SWEEP
        if due > sweep:
            self.handle.registerTimer(due // 1000 + 1)
        self._save(clocks, rows, max(due, sweep), low)

        place = np.minimum(np.searchsorted(owners, rows["owner"]), len(owners) - 1)
        inside = (owners[place] == rows["owner"]) & (rows["at"] >= latest[place] - self.window)
        place, rows = place[inside], {c: v[inside] for c, v in rows.items()}
        order = np.argsort(place, kind="stable")
        n = np.bincount(place, minlength=len(owners))
        there = n > 0
        starts = (np.cumsum(n) - n)[there]
        amount = room(rows["amount"], len(order))
        total, card = np.zeros(len(owners), amount.dtype), np.zeros(len(owners), np.int64)
        known = np.zeros(len(owners), bool)
        if len(order):
            total[there] = np.add.reduceat(amount[order], starts)
            cards = np.where(rows["known"] > 0, rows["card"], np.iinfo(np.int64).min)
            card[there] = np.maximum.reduceat(cards[order], starts)
            known[there] = np.maximum.reduceat(rows["known"][order], starts) > 0
        return {"owner": owners, "n": n, "total": total, "card": card, "known": known}

    def _save(self, clocks: np.ndarray, rows: dict, sweep: int, low: int) -> None:
        """Keep what a payment not before the watermark can ask for: what its owner's window holds now."""
        begin = np.maximum(clocks["clock"], low) - self.window
        place = np.searchsorted(clocks["owner"], rows["owner"])
        kept = rows["at"] >= begin[place] // self.width * self.width
        rows = {c: narrow(v[kept]) for c, v in rows.items()}
        clocks = clocks[(clocks["clock"] > low) | np.isin(clocks["owner"], rows["owner"])]
        if len(clocks):
            self.windows.update((pickle.dumps((clocks, rows, sweep), 5),))
        else:
            self.windows.clear()

    def _with_totals(self, table: pa.Table, totals: dict, low: int) -> pa.Table:
        late = table["at"].to_numpy() < low
        own = table[self.owner].to_numpy()
        out = table.select(self.payload)
        if not totals:
            found = (pa.nulls(len(out), pa.int64()), pa.nulls(len(out), pa.decimal128(38, 2)), pa.nulls(len(out), pa.int64()))
        else:
            place = np.minimum(np.searchsorted(totals["owner"], own), len(totals["owner"]) - 1)
            found = (
                nullable(totals["n"][place], ~late, pa.int64()), decimals(totals["total"][place], ~late),
                nullable(totals["card"][place], ~late & totals["known"][place], pa.int64()),
            )
        for name, values in zip(("txn_count", "aggregate_total", "max_card_id", "too_late"), (*found, pa.array(late))):
            out = out.append_column(name, values)
        return out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.windows.exists():
            self._save(*self._held(), _watermark(timerValues))
        return iter(())

    def close(self) -> None:
        pass


def _largest(cards) -> int | None:
    return max((c for c in cards if c is not None), default=None)


def _plus(a: tuple, b: tuple) -> tuple:
    return a[0] + b[0], a[1] + b[1], _largest((a[2], b[2]))


class LoginProcessor(StatefulProcessor):
    """Counts accounts' failures since their last success.

    A key is one account or, with `owner`, a shard of accounts that this column tells apart.
    """

    def __init__(
        self, max_fail: int, lock_minutes: int, ttl_ms: int | None, bucket_s: int = 3600, frame_rows: int = FRAME_ROWS,
        owner: str | None = None,
    ):
        self.max_fail, self.ttl_ms, self.bucket_s, self.frame_rows = max_fail, ttl_ms, bucket_s, frame_rows
        self.lock_micros, self.owner = lock_minutes * 60_000_000, owner

    def init(self, handle: StatefulProcessorHandle) -> None:
        # Per account: failures, locked until, last login at, its address.
        self.accounts = handle.getValueState("accounts", "rows binary", self.ttl_ms)
        self.spool = _Spool(handle, self.bucket_s, self.frame_rows)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = pickle.loads(bytes(self.accounts.get()[0])) if self.accounts.exists() else {}
        for frame in self.spool.in_order(rows, "log_id"):
            yield self._counted(key, frame, held)
        self.accounts.update((pickle.dumps(held),))

    def _counted(self, key, ordered: pd.DataFrame, held: dict) -> pd.DataFrame:
        owner = _owners(ordered, self.owner)
        order = np.argsort(owner, kind="stable")
        ordered, owner = ordered.iloc[order], owner[order]
        ends = _ends(owner)
        starts = np.append(0, ends[:-1] + 1)
        accounts, sizes = owner[ends].tolist(), ends - starts + 1
        states = [held.get(a, (0, None, None, None)) for a in accounts]
        start = np.repeat(starts, sizes)
        failures = np.repeat(np.array([x[0] for x in states], np.int64), sizes)
        (locked, was_locked), (login_at, was_in) = (
            (np.repeat(np.array([x[i] or 0 for x in states], np.int64), sizes), np.repeat([x[i] is not None for x in states], sizes))
            for i in (1, 2)
        )
        login_ip = np.repeat(np.array([x[3] for x in states], object), sizes)
        at, failed = ordered["at"].to_numpy(np.int64), ordered["failed"].to_numpy(bool)
        place = np.arange(len(at))
        # Failures so far less those at the last success; before the first one the state's count goes on.
        counted = np.cumsum(failed)
        success = np.maximum.accumulate(np.where(failed, -1, place))
        success = np.where(success >= start, success, -1)
        before = counted[start] - failed[start] - failures
        since = counted - np.where(success >= 0, counted[np.maximum(success, 0)], before)
        locking = failed & (since >= self.max_fail)
        lock = np.maximum.accumulate(np.where(locking, place, -1))
        lock = np.where(lock >= start, lock, -1)
        own_lock = (lock >= 0) & (lock > success)
        old_lock = (success < 0) & (lock < 0) & was_locked
        until = np.where(own_lock, at[np.maximum(lock, 0)] + self.lock_micros, locked)
        addresses = ordered["ip_address"].to_numpy(object)
        seen = np.maximum(success, 0)
        out = pd.DataFrame(
            {
                "auth_id": key[0] if self.owner is None else owner,
                "log_id": ordered["log_id"].to_numpy(np.int64),
                "at": at,
                "failed_attempts": since.astype(np.int32),
                "locked_until": pd.array(until, dtype="Int64"),
                "last_login_at": pd.array(np.where(success >= 0, at[seen], login_at), dtype="Int64"),
                "last_login_ip": np.where(success >= 0, addresses[seen], login_ip),
            }
        )
        out.loc[~(own_lock | old_lock), "locked_until"] = pd.NA
        out.loc[(success < 0) & ~was_in, "last_login_at"] = pd.NA
        last = out.iloc[ends]

        def whole(column):
            return [None if pd.isna(x) else int(x) for x in last[column]]

        values = zip(last["failed_attempts"].tolist(), whole("locked_until"), whole("last_login_at"), last["last_login_ip"].tolist())
        held.update(zip(accounts, values))
        return out

    def close(self) -> None:
        pass


CELLS = 16


class _Cells:
    """Values by whole-number keys, kept in cells of a map state; a batch reads and writes the cells it touches."""

    def __init__(self, handle: StatefulProcessorHandle, name: str):
        self.state = handle.getMapState(name, "cell int", "rows binary")

    def cell(self, opened: dict[int, dict], key: tuple) -> dict:
        number = hash(key) % CELLS
        if number not in opened:
            found = self.state.containsKey((number,))
            opened[number] = pickle.loads(bytes(self.state.getValue((number,))[0])) if found else {}
        return opened[number]

    def save(self, opened: dict[int, dict]) -> None:
        for number, rows in opened.items():
            if rows:
                self.state.updateValue((number,), (pickle.dumps(rows),))
            elif self.state.containsKey((number,)):
                self.state.removeKey((number,))


def _whole(value) -> int | None:
    return None if pd.isna(value) else int(value)


# Payments with neighbouring numbers lie in one cell: what arrives together is mostly numbered together.
BLOCK = 4096
PAYMENT_CELLS = 64
ALIVE, MERCHANT, DAY, AMOUNT = 1, 2, 4, 8
PUT = 3


def _columns(frame: pd.DataFrame, **kinds: pa.DataType) -> pa.Table:
    """Columns of a frame as a table; those that it lacks are not there."""

    def column(name, kind):
        convert = _whole if pa.types.is_integer(kind) else lambda x: None if pd.isna(x) else x
        return pa.array([convert(x) for x in frame[name]] if name in frame else [None] * len(frame), kind)

    return pa.table({name: column(name, kind) for name, kind in kinds.items()})


def _as_frame(table: pa.Table) -> pd.DataFrame:
    return table.to_pandas(integer_object_nulls=True)


def _gathered(blocks: list[dict], empty: dict) -> dict[str, np.ndarray]:
    return {c: np.concatenate([empty[c], *(b[c] for b in blocks)]) for c in empty}


class PaymentChanges(StatefulProcessor):
    """Payments as they stand, with their alerts; every change takes the old contribution back and gives the new one.

    A key is one payment or, with `owner`, a shard of payments that this column tells apart: all its
    changes of a micro-batch are taken at once, as columns. `packed` rows come and go as tables.
    """

    EMPTY = {c: np.zeros(0, np.int64) for c in ("owner", "merchant", "day", "amount", "alerts", "has")}
    OUT = ("merchant_id", "day", "n", "volume", "raised", "amount", "sign")

    def __init__(self, fanout_safe: bool, owner: str | None = None, packed: bool = False):
        self.fanout_safe, self.owner, self.packed = fanout_safe, owner, packed

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.payments = Cells(handle, "payments")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if self.packed:
            out = self._changed(pa.concat_tables(tables(rows)))
            if out is not None:
                yield frame_of(out)
            return
        whole_, money = pa.int64(), pa.decimal128(38, 2)
        events = _columns(
            pd.concat(list(rows), ignore_index=True), seq=whole_, kind=pa.string(), merchant_id=whole_, day=whole_,
            amount=money, owner=whole_,
        )
        out = self._changed(events)
        if out is not None:
            moved = _as_frame(out)
            yield moved.astype({"merchant_id": "Int64", "day": "Int64"}) if self.owner else moved

    @staticmethod
    def _cell(owner: np.ndarray) -> np.ndarray:
        return owner // BLOCK % PAYMENT_CELLS

    def _contribution(self, p: dict) -> tuple[np.ndarray, np.ndarray]:
        """Whether a payment counts, and how often."""
        counts = (p["has"] & (ALIVE | MERCHANT)) == ALIVE | MERCHANT
        return counts, np.ones(len(counts), np.int64) if self.fanout_safe else np.maximum(p["alerts"], 1)

    def _changed(self, events: pa.Table) -> pa.Table | None:
        seq = whole(events["seq"], np.iinfo(np.int64).max)[0]
        own = whole(events["owner"])[0]
        order = np.lexsort((seq, own))
        own, kind = own[order], pc.index_in(events["kind"], value_set=pa.array(["delete", "alert", "alert_gone"]))
        kind = kind.fill_null(PUT).to_numpy()[order]
        starts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        owners, place = own[starts], np.arange(len(own))
        put = np.maximum.reduceat(np.where(kind == PUT, place, -1), starts)
        live = np.maximum.reduceat(np.where((kind == PUT) | (kind == 0), place, -1), starts)
        alerts = np.add.reduceat((kind == 1).astype(np.int64) - (kind == 2), starts)

        touched = np.unique(self._cell(owners)).tolist()
        cells = {number: self.payments.read(number) for number in touched}
        held = _gathered([c for c in cells.values() if c], self.EMPTY)
        by_owner = np.argsort(held["owner"], kind="stable")
        at = np.searchsorted(held["owner"][by_owner], owners)
        found = at < len(by_owner)
        found[found] = held["owner"][by_owner[at[found]]] == owners[found]
        was = by_owner[at[found]]
        old = {c: np.zeros(len(owners), held[c].dtype) for c in self.EMPTY}
        for c in old:
            old[c][found] = held[c][was]

        new = dict(old, owner=owners, alerts=old["alerts"] + alerts)
        have = np.zeros(len(owners), np.int64)
        last = order[np.maximum(put, 0)]
        for c, bit, values in (
            ("merchant", MERCHANT, whole(events["merchant_id"])), ("day", DAY, whole(events["day"])),
            ("amount", AMOUNT, hundredths(events["amount"])),
        ):
            new[c] = np.where(put >= 0, values[0][last], old[c])
            have |= np.where(values[1][last], bit, 0)
        have = np.where(put >= 0, have, old["has"] & ~ALIVE)
        alive = np.where(live >= 0, kind[np.maximum(live, 0)] == PUT, (old["has"] & ALIVE) > 0)
        new["has"] = have | np.where(alive, ALIVE, 0)

        (counted, before), (counts, weight) = self._contribution(old), self._contribution(new)
        differs = np.any([old[c] != new[c] for c in ("merchant", "day", "amount", "alerts", "has")], axis=0)
        back, given = counted & (differs | ~counts), counts & (differs | ~counted)
        self._keep(held, was, new, cells)
        if not (back.any() or given.any()):
            return None

        def both(a, b):
            return np.concatenate([a[back], b[given]])

        n, has = both(-before, weight), both(old["has"], new["has"])
        amount, paid = both(old["amount"], new["amount"]), has & AMOUNT > 0
        volume = room(amount, max(abs(int(n.min())), int(n.max()))) * n
        sign = both(np.full(len(owners), -1), np.ones(len(owners), np.int64))
        columns = [
            pa.array(both(old["merchant"], new["merchant"])), nullable(both(old["day"], new["day"]), has & DAY > 0, pa.int32()),
            pa.array(n), decimals(volume, paid), pa.array(both(-old["alerts"], new["alerts"])), decimals(amount, paid),
            pa.array(sign, pa.int32()),
        ]
        return pa.table(dict(zip(self.OUT, columns)))

    def _keep(self, held: dict, was: np.ndarray, new: dict, cells: dict) -> None:
        """The touched cells without the old state of these payments and with the new one."""
        rest = np.ones(len(held["owner"]), bool)
        rest[was] = False
        kept = (new["has"] & ALIVE > 0) | (new["alerts"] != 0)
        both = {c: narrow(np.concatenate([held[c][rest], new[c][kept]])) for c in self.EMPTY}
        number = self._cell(both["owner"])
        order = np.argsort(number, kind="stable")
        bounds = np.searchsorted(number[order], [*cells, np.iinfo(np.int64).max])
        for (cell, before), start, stop in zip(cells.items(), bounds, bounds[1:]):
            some = order[start:stop]
            self.payments.write(cell, {c: both[c][some] for c in both} if len(some) else None, before is not None)

    def close(self) -> None:
        pass


# So many neighbouring days lie in one cell.
DAYS = 4
DAY_CELLS = 32
NO_DAY = np.iinfo(np.int64).min


def _pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Two whole numbers as one value that sorts and compares as they do."""
    both = np.stack([first, second], axis=1).view(np.uint64) ^ np.uint64(1 << 63)
    return np.ascontiguousarray(both.astype(">u8")).view("S16").reshape(-1)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... of each range, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


class DayTotals(StatefulProcessor):
    """Totals of merchants' days and how often each amount is there, from which the largest is taken.

    A key is one merchant's day or, with `shared`, a shard of them; their rows name merchant and day.
    `packed` rows come and go as tables. A cell holds the totals of its days, in order, and the
    amounts of each, one after the other.
    """

    KEYS = {c: np.zeros(0, np.int64) for c in ("merchant", "day", "n", "volume", "raised", "version", "size")}
    AMOUNTS = {c: np.zeros(0, np.int64) for c in ("amount", "count")}

    def __init__(self, shared: bool = False, packed: bool = False):
        self.shared, self.packed = shared, packed

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.days = Cells(handle, "days")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if self.packed:
            yield frame_of(self._totals(pa.concat_tables(tables(rows))))
            return
        whole_, money = pa.int64(), pa.decimal128(38, 2)
        frame = pd.concat(list(rows), ignore_index=True)
        if not self.shared:
            frame = frame.assign(merchant_id=key[0], day=key[1])
        moved = _columns(frame, merchant_id=whole_, day=whole_, n=whole_, raised=whole_, amount=money, sign=whole_)
        done = _as_frame(self._totals(moved))
        yield done.astype({"day": "Int64"}) if self.shared else done

    @staticmethod
    def _cell(day: np.ndarray) -> np.ndarray:
        return day // DAYS % DAY_CELLS

    def _totals(self, moved: pa.Table) -> pa.Table:
        merchant, day = whole(moved["merchant_id"])[0], whole(moved["day"], NO_DAY)[0]
        n, raised, sign = (whole(moved[c])[0] for c in ("n", "raised", "sign"))
        amount, paid = hundredths(moved["amount"])
        volume = room(amount, len(n) * max(1, int(np.abs(n).max()))) * np.where(paid, n, 0)
        key = _pairs(merchant, day)
        own, first, of = np.unique(key, return_index=True, return_inverse=True)
        order = np.argsort(of, kind="stable")
        starts = np.searchsorted(of[order], np.arange(len(own)))

        cells = {number: self.days.read(number) for number in np.unique(self._cell(day[first])).tolist()}
        known = [c for c in cells.values() if c]
        keys, amounts = _gathered([k for k, _ in known], self.KEYS), _gathered([a for _, a in known], self.AMOUNTS)
        begins = np.cumsum(keys["size"]) - keys["size"]
        by_key = np.argsort(held := _pairs(keys["merchant"], keys["day"]), kind="stable")
        at = np.searchsorted(held, own, sorter=by_key)
        found = at < len(by_key)
        found[found] = held[by_key[at[found]]] == own[found]
        was = by_key[at[found]]

        new = {c: np.zeros(len(own), keys[c].dtype) for c in keys}
        for c in new:
            new[c][found] = keys[c][was]
        new["merchant"], new["day"] = merchant[first], day[first]
        new["n"] += np.add.reduceat(n[order], starts)
        new["raised"] += np.add.reduceat(raised[order], starts)
        new["volume"] = room(new["volume"], 2) + room(np.add.reduceat(volume[order], starts), 2)
        new["version"] += 1
        # The amounts of these days, with what came and went.
        sizes = keys["size"][was]
        theirs = _ranges(begins[was], sizes)
        whose = np.concatenate([np.repeat(np.flatnonzero(found), sizes), of[paid]])
        value = np.concatenate([amounts["amount"][theirs], amount[paid]])
        count = np.concatenate([amounts["count"][theirs], sign[paid]])
        rank = value if value.dtype != object else np.unique(value, return_inverse=True)[1]
        order = np.lexsort((rank, whose))
        whose, value, count = whose[order], value[order], count[order]
        if len(whose):
            starts = np.flatnonzero(np.append(True, (whose[1:] != whose[:-1]) | (value[1:] != value[:-1])))
            whose, value, count = whose[starts], value[starts], np.add.reduceat(count, starts)
            whose, value, count = whose[count != 0], value[count != 0], count[count != 0]
        new["size"] = np.bincount(whose, minlength=len(own))
        ends = np.cumsum(new["size"])
        there = new["size"] > 0
        largest = np.zeros(len(own), value.dtype)
        largest[there] = value[ends[there] - 1]
        self._keep(keys, amounts, was, theirs, new, value, count, cells)
        columns = {
            "merchant_id": pa.array(new["merchant"]), "day": nullable(new["day"], new["day"] != NO_DAY, pa.int64()).cast(pa.int32()),
            "n": pa.array(new["n"]), "volume": decimals(new["volume"]), "raised": pa.array(new["raised"]),
            "largest": decimals(largest, there), "version": pa.array(new["version"]),
        }
        return pa.table(columns)

    def _keep(self, keys, amounts, was, theirs, new, value, count, cells: dict) -> None:
        """The touched cells with the new totals and amounts of these days instead of the old ones."""
        rest, others = np.ones(len(keys["size"]), bool), np.ones(len(amounts["count"]), bool)
        rest[was], others[theirs] = False, False
        both = {c: narrow(np.concatenate([keys[c][rest], new[c]])) for c in keys}
        value = narrow(np.concatenate([amounts["amount"][others], value]))
        count = np.concatenate([amounts["count"][others], count])
        begins = np.cumsum(both["size"]) - both["size"]
        number = self._cell(both["day"])
        order = np.argsort(number, kind="stable")
        bounds = np.searchsorted(number[order], [*cells, DAY_CELLS])
        for (cell, before), start, stop in zip(cells.items(), bounds, bounds[1:]):
            some = order[start:stop]
            spots = _ranges(begins[some], both["size"][some])
            self.days.write(cell, ({c: both[c][some] for c in both}, {"amount": value[spots], "count": count[spots]}), before is not None)

    def close(self) -> None:
        pass
