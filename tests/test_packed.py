"""Handlers that take rows as tables: how much state they read, large amounts, settings of a running stream."""

import random
from decimal import Decimal

import pandas as pd
import pyarrow as pa
import pytest

from cardwarden import session
from cardwarden.operators import travel_fold
from cardwarden.sources import adapters
from cardwarden.streaming import packed, processors
from test_keyed_state import HOUR, Handle, Map, _frames, _travel
from test_shards import OWNERS, _payments

MONEY = pa.decimal128(38, 2)
LOG = pa.schema(
    [("seq", pa.int64()), ("kind", pa.string()), ("merchant_id", pa.int64()), ("day", pa.int32()), ("amount", MONEY), ("owner", pa.int64())]
)


def _packed(rows, schema):
    table = pa.Table.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)
    return pd.DataFrame({"rows": [packed.to_bytes(table)]})


def _run(handle, *frames):
    found = [t.to_pylist() for t in packed.tables(iter(handle.run(frames)))]
    return [tuple(r.values()) for rows in found for r in rows]


def test_payments_that_come_together_share_cells(monkeypatch):
    """Twenty batches of payments numbered one after the other: each reads no more state than the first ones."""
    handle = Handle(processors.PaymentChanges(False, "owner", packed=True))
    read, original = [], Map.getValue
    monkeypatch.setattr(Map, "getValue", lambda self, key: read.append(len(original(self, key)[0])) or original(self, key))
    per_batch = []
    for batch in range(20):
        before = sum(read)
        ids = range(batch * 5000, batch * 5000 + 5000)
        _run(handle, _packed([(i, "put", i % 7, 3, Decimal(i), i) for i in ids], LOG))
        per_batch.append(sum(read) - before)
    assert max(per_batch) <= 100_000 * 6 * 8 / 8


def test_days_of_other_weeks_are_not_read(monkeypatch):
    handle = Handle(processors.DayTotals(shared=True, packed=True))
    kinds = [("merchant_id", pa.int64()), ("day", pa.int32()), ("n", pa.int64()), ("raised", pa.int64()), ("amount", MONEY), ("sign", pa.int32())]
    touched = []
    for name in ("getValue", "updateValue"):
        original = getattr(Map, name)
        monkeypatch.setattr(Map, name, lambda self, key, *rest, call=original: touched.append(key) or call(self, key, *rest))
    for day in (0, 10, 20, 30, 0):
        touched.clear()
        rows = _run(handle, _packed([(m, day, 1, 0, Decimal(m), 1) for m in range(50)], pa.schema(kinds)))
        assert len(rows) == 50 and len(set(touched)) == 1


@pytest.mark.parametrize("amount", [Decimal(10) ** 17 + Decimal("0.01"), Decimal("-99999999999999999.99"), Decimal(10) ** 25])
def test_amounts_beyond_64_bits(amount):
    payments = Handle(processors.PaymentChanges(False, "owner", packed=True))
    days = Handle(processors.DayTotals(shared=True, packed=True))
    log = [(i, "put", 1, 5, a, i) for i, a in enumerate([amount, amount, Decimal("1.50"), None])]
    moved = payments.run([_packed([*log, (9, "alert", None, None, None, 1), (10, "alert", None, None, None, 1)], LOG)])
    paid = [None, amount, Decimal("1.50")]
    ((merchant, day, n, volume, raised, largest, version),) = _run(days, *moved)
    assert (merchant, day, n, volume, raised, version) == (1, 5, 5, 3 * amount + Decimal("1.50"), 2, 1)
    assert largest == max(a for a in paid if a is not None)
    # Taken back again.
    moved = payments.run([_packed([(20 + i, "delete", None, None, None, i) for i in (0, 1)], LOG)])
    ((_, _, n, volume, _, largest, version),) = _run(days, *moved)
    assert (n, volume, largest, version) == (2, Decimal("1.50"), Decimal("1.50"), 2)


def test_ids_beyond_the_whole_numbers_of_a_double():
    """A missing merchant beside a large one: the large one keeps its last digit."""
    handle = Handle(processors.PaymentChanges(True, "owner", packed=True))
    big = 2**53 + 1
    out = _run(handle, _packed([(1, "put", big, None, None, 1), (2, "alert", None, None, None, 2)], LOG))
    assert out == [(big, None, 1, None, 0, None, 1)]


def test_a_stream_runs_with_as_many_partitions_as_tasks_at_once(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    try:
        for given, wanted in (("200", spark.sparkContext.defaultParallelism), ("3", 3)):
            spark.conf.set(key, given)
            with session.running_stream(spark):
                assert int(spark.conf.get(key)) == wanted
            assert spark.conf.get(key) == given
    finally:
        spark.conf.set(key, before)


POINTS = pa.schema(
    [("id", pa.int64()), ("at", pa.int64()), ("lat", pa.float64()), ("lon", pa.float64()), ("eligible", pa.bool_()), ("owner", pa.int64()), ("name", pa.string())]
)


@pytest.mark.parametrize("frame_rows", [7, 100_000])
@pytest.mark.parametrize("options", [{"watermark": True}, {"look_back_s": 20 * 3600}, {"look_back_s": 6 * 3600}])
def test_packed_travel_is_that_of_frames(options, frame_rows):
    plain, tables = (
        Handle(_travel(**options, frame_rows=frame_rows, owner="owner", packed=p)) for p in (False, True)
    )
    for rows in _payments(1):
        rows = [(*r, f"p{r[0]}") for r in rows]
        want = pd.concat(plain.run(_frames(rows, POINTS.names, 9)))
        got = pd.concat([t.to_pandas() for t in packed.tables(iter(tables.run([_packed(rows[:9], POINTS), _packed(rows[9:], POINTS)])))])
        want, got = (x.sort_values("id").reset_index(drop=True).drop(columns="name", errors="ignore").astype(float).fillna(-1) for x in (want, got))
        pd.testing.assert_frame_equal(want, got)
        if "watermark" in options:
            for handle in (plain, tables):
                handle.advance(max(r[1] for r in rows) // 1000 - 10 * 3600 * 1000)
    assert {k for m in plain.maps for k in m.rows} == {k for m in tables.maps for k in m.rows}


def test_a_packed_row_without_time_is_refused():
    with pytest.raises(ValueError):
        Handle(_travel(owner="owner", packed=True)).run([_packed([(1, None, 0.0, 0.0, True, 1, "p")], POINTS)])


def test_only_customers_with_a_violation_are_walked(monkeypatch):
    walked, settle = [], travel_fold._Batch.settle
    monkeypatch.setattr(travel_fold._Batch, "settle", lambda self, *rest: walked.append(rest[0]) or settle(self, *rest))
    rows = [(i, i * HOUR // 10, 60.0 if i == 70 else 0.0, 0.0, True, i % 40, "p") for i in range(400)]
    Handle(_travel(look_back_s=10**6, owner="owner", packed=True)).run([_packed(rows, POINTS)])
    assert len(walked) == 1


def test_arriving_files_fill_their_parts(spark, tmp_path):
    """No more files than the rows of each part need."""
    events = spark.range(10_000).selectExpr("id AS seq", "CAST(id % 7 = 0 AS int) + CAST(id % 3 = 0 AS int) AS __part")
    adapters.in_parts(events, str(tmp_path / "rows"), 3, ("seq",), rows_per_file=1000)
    sizes = [spark.read.parquet(str(f)).count() for part in range(3) for f in sorted((tmp_path / f"rows/__part={part}").glob("*.parquet"))]
    want = [r["count"] for r in events.groupBy("__part").count().orderBy("__part").collect()]
    assert sum(sizes) == 10_000 and max(sizes) <= 1000 and len(sizes) == sum(-(-n // 1000) for n in want)


WINDOW_ROWS = pa.schema(
    [("id", pa.int64()), ("at", pa.int64()), ("amount", MONEY), ("card", pa.int64()), ("eligible", pa.bool_()), ("owner", pa.int64())]
)


@pytest.mark.parametrize("frame_rows", [7, 100_000])
@pytest.mark.parametrize("seed", range(4))
def test_packed_windows_are_those_of_each_customer(seed, frame_rows):
    dice, latest = random.Random(seed), []
    one = Handle(processors.PackedWindows(["id"], 9 * 3600, 1800, frame_rows))
    alone = {o: Handle(processors.WindowProcessor(["id"], 9 * 3600, 1800)) for o in OWNERS}
    for rows in _payments(seed, 14, 9):
        rows = [(r[0], r[1], Decimal(dice.randrange(1, 9999)) / 100, dice.choice([None, 1, 2, 3]), r[4], r[5]) for r in rows]
        got = _run(one, _packed(rows[:5], WINDOW_ROWS), _packed(rows[5:], WINDOW_ROWS))
        want = []
        for owner, handle in alone.items():
            for frame in handle.run(_frames([r[:5] for r in rows if r[5] == owner], WINDOW_ROWS.names[:5], 9)):
                want += [tuple(None if pd.isna(x) else x for x in r) for r in frame.itertuples(index=False, name=None)]
        assert sorted(got) == sorted(want)
        latest.append(max(r[1] for r in rows))
        for handle in (one, *alone.values()):
            handle.advance(max(latest) // 1000 - 6 * 3600 * 1000)
    one.advance(max(latest) // 1000 + 100 * 3600 * 1000)
    assert one.processor.windows.row is None and one.size() == 0


def test_a_shard_of_windows_asks_its_state_as_often_for_any_number_of_customers():
    """Before, a shard read and wrote 16 cells."""
    calls = []
    for customers in (1, 300):
        handle = Handle(processors.PackedWindows(["id"], 48 * 3600))
        state = handle.processor.windows
        for name in ("get", "update", "exists"):
            setattr(state, name, lambda *a, call=getattr(state, name): calls.append(customers) or call(*a))
        _run(handle, _packed([(i, i % 40 * HOUR, Decimal(1), 1, True, i % customers) for i in range(3000)], WINDOW_ROWS))
    assert calls.count(300) == calls.count(1) <= 3


def test_customers_whose_slices_fit_are_not_followed(monkeypatch):
    """Slices that were run with the point before them stay; the other customer is followed; batches cut customers."""
    followed, follow = [], travel_fold._follow
    monkeypatch.setattr(travel_fold, "_follow", lambda user, piece, rows: followed.append(rows[0]["user_id"]) or follow(user, piece, rows))
    point, rows = (lambda i: {"at": i, "id": i, "lat": 0.0, "lon": 0.0}), []
    for user, wrong in ((1, None), (2, 3), (3, None)):
        for piece in range(6):
            entry, out = point(user * 100 + piece - (piece == wrong)), point(user * 100 + piece + 1)
            rows.append({"user_id": user, "piece": piece, "_round": 0} | {f"_in_{f}": v if piece else None for f, v in entry.items()} | {f"_out_{f}": v for f, v in out.items()})
    batches = [pa.RecordBatch.from_pylist(rows[i : i + 4], pa.Table.from_pylist(rows).schema) for i in range(0, 18, 4)]
    got = pa.Table.from_batches(travel_fold.chain(("user_id", "piece"))(iter(batches))).to_pylist()
    want = [r for user in (1, 2, 3) for r in follow("user_id", "piece", [x for x in rows if x["user_id"] == user])]
    key = lambda r: (r["user_id"], r["piece"])
    assert sorted(got, key=key) == sorted(want, key=key) and followed == [2]
    assert [key(r) for r in got if r["_missing"]] == [(2, 3)]


def test_slices_without_a_violation_are_not_walked(monkeypatch):
    walked, settle = [], travel_fold._Batch.settle
    monkeypatch.setattr(travel_fold._Batch, "settle", lambda self, *rest: walked.append(rest[0]) or settle(self, *rest))
    names = ["user", *(f"_{f}" for f in travel_fold.POINT_FIELDS), "_eligible", *(f"_in_{f}" for f in travel_fold.POINT_FIELDS)]
    rows = [(u, 100 * HOUR + u * HOUR, u, 0.0, 0.0, u % 2 == 0, HOUR, -u, 1.0, 0.0) for u in range(50)]
    batch = pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows])
    (out,) = travel_fold.judge_batches(["user"], 9_000_000, ["_id"])(iter([batch]))
    assert out.column("_ref_id").to_pylist() == [-u for u in range(50)] and len(walked) == 1
    ends = pa.Table.from_batches(travel_fold.last_points(["user"], 9_000_000)(iter([batch]))).to_pylist()
    assert [r["_out_id"] for r in ends] == [u if u % 2 == 0 else -u for u in range(50)]
