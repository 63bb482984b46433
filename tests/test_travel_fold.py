"""The batch-wise fold against one step per row, for any cut of the input into batches."""

import random

import pyarrow as pa
import pytest

from cardwarden.operators.travel_fold import POINT_FIELDS, Track, judge_batches, last_points

PLACES = [(32.5, -93.7), (40.7, -74.0), (55.7, 37.6), (-33.8, 151.2), (32.6, -93.8)]
LIMIT = 9_000_000


def make(seed, users=6, n=150):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        user = 1 if rng.random() < 0.5 else rng.randrange(2, 2 + users)
        at = rng.randrange(0, 40) * 3_600_000_000
        place = rng.choice(PLACES[:2] * 3 + PLACES)
        rows.append((user, at, i, *place, rng.random() < 0.8))
    rows.sort()
    entry = {u: (-1_000_000, -u, *rng.choice(PLACES)) if rng.random() < 0.4 else None for u in range(10)}
    late = {3: (10 * 3_600_000_000, -3, *PLACES[0])}
    return rows, {**entry, **late}


def batches(rows, entry, size):
    for start in range(0, len(rows), size):
        part = rows[start:start + size]
        columns = {
            "user": pa.array([r[0] for r in part], pa.int64()),
            "_at": pa.array([r[1] for r in part], pa.int64()),
            "_id": pa.array([r[2] for r in part], pa.int64()),
            "_lat": pa.array([r[3] for r in part]),
            "_lon": pa.array([r[4] for r in part]),
            "_eligible": pa.array([r[5] for r in part]),
        }
        for i, name in enumerate(POINT_FIELDS):
            kind = pa.int64() if i < 2 else pa.float64()
            columns[f"_in_{name}"] = pa.array([entry[r[0]] and entry[r[0]][i] for r in part], kind)
        yield pa.RecordBatch.from_pydict(columns)


def stepwise(rows, entry):
    tracks, out = {}, []
    for user, at, i, lat, lon, ok in rows:
        track = tracks.setdefault(user, Track(entry[user]))
        verdict = track.step((at, i, lat, lon), ok, LIMIT)
        out.append((i, verdict.reference and verdict.reference[1], verdict.violation, verdict.late))
    return out, {u: t.last and t.last[1] for u, t in tracks.items()}


@pytest.mark.parametrize("seed", range(40))
@pytest.mark.parametrize("size", [1, 7, 50, 1000])
def test_any_batch_size(seed, size):
    rows, entry = make(seed)
    want, ends = stepwise(rows, entry)
    got = []
    for batch in judge_batches(["user"], LIMIT, ["_id"])(batches(rows, entry, size)):
        got += [(r["_id"], r["_ref_id"], r["violation"], r["late"]) for r in batch.to_pylist()]
    assert got == want
    last = {}
    for batch in last_points(["user"], LIMIT)(batches(rows, entry, size)):
        last.update({r["user"]: r["_out_id"] for r in batch.to_pylist()})
    assert last == ends
