"""The accepted-point fold of the declining travel rule.

A row the rule declines must not become the reference point of later rows, so
each decision depends on the ones before it. The fold keeps only the last
accepted point per customer and is shared by the batch and the streaming form.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from cardwarden.functions.expr import EARTH_RADIUS_KM

# A point: (microseconds, row id, latitude, longitude)
Point = tuple[int, int, float, float]


def too_fast(a: Point, b: Point, max_speed_4: int) -> bool:
    """Whether going from a to b needs more than the limit, given in 1/10000 km/h.

    Uses the same rounding steps as the column form: kilometres to 4 digits,
    hours to 6, speed to 4, all half up.
    """
    if a[2] == b[2] and a[3] == b[3]:
        return False
    phi1, phi2 = math.radians(a[2]), math.radians(b[2])
    h = (
        math.sin((phi2 - phi1) / 2) ** 2
        + math.cos(phi1) * math.cos(phi2) * math.sin(math.radians(b[3] - a[3]) / 2) ** 2
    )
    km = 2 * EARTH_RADIUS_KM * math.atan2(math.sqrt(h), math.sqrt(max(0.0, 1 - h)))
    km_4 = math.floor(km * 10_000 + 0.5)
    seconds = max(1, b[0] // 1_000_000 - a[0] // 1_000_000)
    hours_6 = (2 * seconds * 1_000_000 + 3600) // 7200
    speed_4 = (2 * km_4 * 1_000_000 + hours_6) // (2 * hours_6)
    return speed_4 > max_speed_4


class Verdict(NamedTuple):
    reference: Point | None
    violation: bool
    late: bool


@dataclass
class Track:
    """Last accepted points of one customer: before, and at, the latest time."""

    reference: Point | None = None
    latest: Point | None = None

    def step(self, row: Point, eligible: bool, max_speed_4: int) -> Verdict:
        """Judge one row. A row not after the known points comes late and is not judged."""
        if self.latest is not None and row[0] > self.latest[0]:
            self.reference, self.latest = self.latest, None
        if self.latest is not None and row[0] < self.latest[0]:
            return Verdict(None, False, True)
        reference = self.reference
        if reference is not None and row[0] <= reference[0]:
            return Verdict(None, False, True)
        violation = reference is not None and too_fast(reference, row, max_speed_4)
        if eligible and not violation:
            self.latest = row
        return Verdict(reference, violation, False)

    def place(self, row: Point) -> None:
        """Take over a point that was accepted before."""
        if self.latest is not None and row[0] > self.latest[0]:
            self.reference = self.latest
        self.latest = row

    @property
    def last(self) -> Point | None:
        return self.latest or self.reference


POINT_FIELDS = ("at", "id", "lat", "lon")
_POINT_TYPES = (pa.int64(), pa.int64(), pa.float64(), pa.float64())


def _too_fast_all(a: list[np.ndarray], b: list[np.ndarray], max_speed_4: int) -> np.ndarray:
    """too_fast for whole columns."""
    phi1, phi2 = np.radians(a[2]), np.radians(b[2])
    h = (
        np.sin((phi2 - phi1) / 2) ** 2
        + np.cos(phi1) * np.cos(phi2) * np.sin(np.radians(b[3] - a[3]) / 2) ** 2
    )
    km = 2 * EARTH_RADIUS_KM * np.arctan2(np.sqrt(h), np.sqrt(np.maximum(0.0, 1 - h)))
    km_4 = np.floor(km * 10_000 + 0.5).astype(np.int64)
    seconds = np.maximum(1, b[0] // 1_000_000 - a[0] // 1_000_000)
    hours_6 = (2 * seconds * 1_000_000 + 3600) // 7200
    return (2 * km_4 * 1_000_000 + hours_6) // (2 * hours_6) > max_speed_4


class _Batch:
    """Rows of one Arrow batch, judged as if every eligible row were accepted.

    That guess holds up to an eligible row it finds violating, and again from
    the next accepted row on; settle() walks the rows in between one by one.
    """

    def __init__(self, batch: pa.RecordBatch, keys: list[str], max_speed_4: int):
        def column(name):
            return batch.column(batch.schema.get_field_index(name))

        self.limit = max_speed_4
        self.points = [column(f"_{f}").to_numpy(zero_copy_only=False) for f in POINT_FIELDS]
        self.eligible = column("_eligible").to_numpy(zero_copy_only=False).astype(bool)
        # Points accepted in earlier runs stand among the rows; they are not judged again.
        self.given = np.zeros(batch.num_rows, dtype=bool)
        if batch.schema.get_field_index("_given") >= 0:
            self.given = column("_given").to_numpy(zero_copy_only=False).astype(bool)
        self.keys = [column(k).to_numpy(zero_copy_only=False) for k in keys]
        self.entries = [column(f"_in_{f}") for f in POINT_FIELDS]
        at, index = self.points[0], np.arange(batch.num_rows)
        new_owner = np.ones(len(at), dtype=bool)
        new_owner[1:] = np.any([k[1:] != k[:-1] for k in self.keys], axis=0)
        self.new_time = new_owner.copy()
        self.new_time[1:] |= at[1:] != at[:-1]
        self.starts = np.flatnonzero(new_owner)
        owner_start = np.maximum.accumulate(np.where(new_owner, index, 0))
        self.time_start = np.maximum.accumulate(np.where(self.new_time, index, 0))
        last_eligible = np.maximum.accumulate(np.where(self.eligible, index, -1))
        # The latest eligible row of the owner at a strictly earlier time.
        before = np.where(self.time_start > 0, last_eligible[self.time_start - 1], -1)
        self.before = np.where(before >= owner_start, before, -1)
        known = self.before >= 0
        self.references = [np.where(known, c[self.before], 0) for c in self.points]
        # An owner's rows before its first accepted one go by the entry, if that lies before all of them.
        self.hard = np.zeros(0, dtype=np.int64)
        if self.entries[0].null_count < len(at):
            entry = [c.fill_null(0).to_numpy(zero_copy_only=False) for c in self.entries]
            given = np.asarray(self.entries[0].is_valid())
            self.hard = np.flatnonzero(given[self.starts] & (entry[0][self.starts] >= at[self.starts]))
            by_entry = ~known & given & (entry[0] < at)
            self.references = [np.where(by_entry, e, r) for e, r in zip(entry, self.references)]
            known = known | by_entry
        self.known = known
        self.violation = known & ~self.given & _too_fast_all(self.references, self.points, max_speed_4)
        self.late = np.zeros(len(at), dtype=bool)
        self.trouble = np.flatnonzero(self.violation & self.eligible)

    def owner(self, row: int) -> tuple:
        return tuple(k[row].item() for k in self.keys)

    def point(self, row: int) -> Point | None:
        return tuple(c[row].item() for c in self.points) if row >= 0 else None

    def entry(self, row: int) -> Point | None:
        values = tuple(c[row].as_py() for c in self.entries)
        return None if values[0] is None else values

    def _step(self, track: Track, row: int) -> None:
        if self.given[row]:
            track.place(self.point(row))
            return
        verdict = track.step(self.point(row), bool(self.eligible[row]), self.limit)
        self.known[row] = verdict.reference is not None
        for column, value in zip(self.references, verdict.reference or (0, 0, 0.0, 0.0)):
            column[row] = value
        self.violation[row], self.late[row] = verdict.violation, verdict.late

    def settle(self, start: int, stop: int, track: Track) -> Track:
        """Correct one owner's rows, given the track before them; returns the track after."""
        row, trusted = start, track.last is None
        while row < stop:
            if trusted:
                place = np.searchsorted(self.trouble, row)
                found = self.trouble[place] if place < len(self.trouble) else stop
                row = int(self.time_start[min(found, stop - 1)])
                track = Track(self.point(int(self.before[row])))
                trusted = False
            self._step(track, row)
            row += 1
            if row < stop and self.new_time[row]:
                before, last = int(self.before[row]), track.last
                trusted = before >= 0 and last is not None and last[1] == self.points[1][before]
        return track

    def to_walk(self) -> np.ndarray:
        """Which owners' rows the guess may not hold for; the others' eligible rows are all accepted."""
        timeless = np.flatnonzero(np.isnan(self.points[0]))
        rows = np.concatenate([self.trouble, timeless])
        return np.unique(np.append(np.searchsorted(self.starts, rows, "right") - 1, self.hard))

    def last_accepted(self, first: int, stop: int) -> list[tuple[tuple, Point | None]]:
        """The last points of these owners if all of their eligible rows are accepted."""
        starts, ends = self.starts[first:stop], np.append(self.starts[1:], len(self.eligible))[first:stop]
        last = np.maximum.accumulate(np.where(self.eligible, np.arange(len(self.eligible)), -1))[ends - 1]
        points = list(zip(*(c[np.maximum(last, 0)].tolist() for c in self.points)))
        for i in np.flatnonzero(last < starts).tolist():
            points[i] = self.entry(int(starts[i]))
        return list(zip(zip(*(k[starts].tolist() for k in self.keys)), points))

    def judged(self) -> list[pa.Array]:
        """Reference and verdict of the rows that are not given."""
        new = ~self.given
        references = [
            pa.array(c[new], type=kind, mask=~self.known[new])
            for c, kind in zip(self.references, _POINT_TYPES)
        ]
        return [*references, pa.array(self.violation[new]), pa.array(self.late[new])]


def _walk(batches: Iterator[pa.RecordBatch], keys: list[str], max_speed_4: int, ends: bool = False):
    """Yield (batch, its verdicts, the last points of owners that ended, if asked for); rows come sorted per key."""
    current, track = None, Track()
    for batch in batches:
        if batch.num_rows == 0:
            continue
        rows, finished = _Batch(batch, keys, max_speed_4), []
        last, stops = len(rows.starts) - 1, [*rows.starts[1:].tolist(), batch.num_rows]
        goes_on = current is not None and rows.owner(0) == current
        if current is not None and not goes_on:
            finished.append((current, track.last))
        if ends:
            guessed = rows.last_accepted(0, last)
        # An owner that comes from the batch before or may go on into the next is walked with its track.
        for place in np.unique(np.append(rows.to_walk(), [0] * goes_on + [last])).astype(int).tolist():
            start = int(rows.starts[place])
            track = rows.settle(start, stops[place], track if goes_on and place == 0 else Track(rows.entry(start)))
            if ends and place < last:
                guessed[place] = (guessed[place][0], track.last)
        current = rows.owner(int(rows.starts[last]))
        yield batch, rows, finished + guessed if ends else []
    if current is not None:
        yield None, None, [(current, track.last)]


def judge_batches(keys: list[str], max_speed_4: int, payload: list[str]):
    """mapInArrow function: every row with its reference point and verdict."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows, _ in _walk(batches, keys, max_speed_4):
            if batch is None:
                continue
            new = pa.array(~rows.given)
            kept = [batch.column(batch.schema.get_field_index(n)).filter(new) for n in payload]
            names = [*payload, *[f"_ref_{f}" for f in POINT_FIELDS], "violation", "late"]
            yield pa.RecordBatch.from_arrays([*kept, *rows.judged()], names=names)

    return run


def judge_one(at, ids, lat, lon, eligible, given, max_speed_4: int, owner=None) -> tuple[list[pa.Array], np.ndarray]:
    """One customer's rows in time then id order: verdicts of the new rows, and which rows are accepted now.

    With `owner` the rows are those of several customers, one after the other.
    """
    n = len(at)
    owner = np.zeros(n, np.int64) if owner is None else owner
    nothing = [pa.nulls(n, kind) for kind in _POINT_TYPES]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(owner), pa.array(at), pa.array(ids), pa.array(lat), pa.array(lon),
         pa.array(eligible), pa.array(given), *nothing],
        names=["_key", "_at", "_id", "_lat", "_lon", "_eligible", "_given", *[f"_in_{f}" for f in POINT_FIELDS]],
    )
    rows = _Batch(batch, ["_key"], max_speed_4)
    # Without a violation among the eligible rows the guess that all are accepted holds.
    stops = np.append(rows.starts[1:], n)
    for place in rows.to_walk().tolist():
        rows.settle(int(rows.starts[place]), int(stops[place]), Track())
    return rows.judged(), rows.given | (rows.eligible & ~rows.violation)


def last_points(keys: list[str], max_speed_4: int):
    """mapInArrow function: the last accepted point of every key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, finished in _walk(batches, keys, max_speed_4, ends=True):
            if not finished:
                continue
            owners, points = zip(*finished)
            key_arrays = [pa.array([o[i] for o in owners], type=pa.int64()) for i in range(len(keys))]
            point_arrays = [
                pa.array([None if p is None else p[i] for p in points], type=kind)
                for i, kind in enumerate(_POINT_TYPES)
            ]
            yield pa.RecordBatch.from_arrays(
                [*key_arrays, *point_arrays], names=[*keys, *[f"_out_{f}" for f in POINT_FIELDS]]
            )

    return run


def _follow(user: str, piece: str, rows: list[dict]) -> list[dict]:
    """One customer's slices from entry to exit."""
    rows = sorted(rows, key=lambda r: (r[piece], r["_round"]))
    exits, first_entry = {}, {}
    for row in rows:
        entry, out = (tuple(row[f"{p}_{f}"] for f in POINT_FIELDS) for p in ("_in", "_out"))
        exits[row[piece], entry[1]] = out
        first_entry.setdefault(row[piece], entry)
    pieces = sorted(first_entry)
    entry, result = first_entry[pieces[0]], []
    for place, number in enumerate(pieces):
        known = (number, entry[1]) in exits
        result.append(
            {user: rows[0][user], piece: number, "_missing": not known}
            | {f"_in_{f}": v for f, v in zip(POINT_FIELDS, entry)}
        )
        if known:
            entry = exits[number, entry[1]]
        elif place + 1 < len(pieces):
            entry = first_entry[pieces[place + 1]]
    return result


def chain(keys: tuple[str, str]):
    """mapInArrow function: follow each customer's slices from entry to exit.

    Input are the folds run so far, one row per slice and entry point, sorted by
    customer, slice and round. Output is one row per slice with its entry point,
    and whether that fold is still to be run. Behind a missing fold the walk goes
    on from the entry the next slice was first run with, so that all missing folds
    of a customer run together. A customer each of whose slices was run once, with
    the point the slice before it ends in, needs no walk.
    """
    user, piece = keys
    schema = pa.schema(
        [(user, pa.int64()), (piece, pa.int64()), ("_missing", pa.bool_())]
        + [(f"_in_{f}", kind) for f, kind in zip(POINT_FIELDS, _POINT_TYPES)]
    )

    def followed(folds: pa.Table) -> list[pa.Table]:
        owner, number = (folds[c].to_numpy() for c in keys)
        new = np.append(True, owner[1:] != owner[:-1])
        fits = number[:-1] != number[1:]
        for f in POINT_FIELDS:
            (there, end), (given, entry) = (
                (np.asarray(folds[c].is_valid()), folds[c].fill_null(0).to_numpy()) for c in (f"_out_{f}", f"_in_{f}")
            )
            fits &= (there[:-1] == given[1:]) & (end[:-1] == entry[1:])
        starts = np.flatnonzero(new)
        settled = np.minimum.reduceat(np.append(True, fits) | new, starts)
        whose = np.cumsum(new) - 1
        plain = folds.filter(pa.array(settled[whose]))
        out = [plain.append_column("_missing", pa.repeat(False, len(plain))).select(schema.names).cast(schema)]
        for place in np.flatnonzero(~settled).tolist():
            start = int(starts[place])
            stop = int(starts[place + 1]) if place + 1 < len(starts) else len(owner)
            out.append(pa.Table.from_pylist(_follow(user, piece, folds.slice(start, stop - start).to_pylist()), schema=schema))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            if not len(held):
                continue
            # The last customer may go on in the next batch.
            owner = held[user].to_numpy()
            stop = int(np.searchsorted(owner, owner[-1]))
            if stop:
                for part in followed(held.slice(0, stop)):
                    yield from part.to_batches()
                held = held.slice(stop)
        if held is not None and len(held):
            for part in followed(held):
                yield from part.to_batches()

    return run
