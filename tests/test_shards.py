"""Keys that share a call and a state, against each key alone."""

import random
from decimal import Decimal

import pandas as pd
import pytest

from cardwarden.streaming import processors
from test_keyed_state import HOUR, TRAVEL, WINDOW, Handle, _frames, _travel

OWNERS = [-(2**63), 3, 4, 11, 12]


class Calls:
    """Counts what a handler asks of its state."""

    def __init__(self, handle):
        self.made = 0
        for state in handle.maps:
            for name in ("containsKey", "getValue", "updateValue", "removeKey", "keys"):
                setattr(state, name, self._counted(getattr(state, name)))

    def _counted(self, call):
        def run(*args):
            self.made += 1
            return call(*args)

        return run


def _together(shared, alone, columns, batches, by, advance=None):
    """Every batch through one shared handle and through one handle per owner; both give the same rows."""
    for rows in batches:
        got = shared.run(_frames(rows, [*columns, "owner"], 9))
        want = []
        for owner in OWNERS:
            own = [r[:-1] for r in rows if r[-1] == owner]
            if own:
                want += alone[owner].run(_frames(own, columns, 9))
        got, want = (pd.concat(x).sort_values(by).reset_index(drop=True).astype(str) for x in (got, want))
        assert got.drop(columns="auth_id", errors="ignore").equals(want.drop(columns="auth_id", errors="ignore"))
        if advance:
            for handle in (shared, *alone.values()):
                handle.advance(advance(rows))


def _payments(seed, batches=10, spread=14):
    dice, key = random.Random(seed), 0
    for batch in range(batches):
        rows = []
        for _ in range(dice.randrange(1, 80)):
            key += 1
            at = max(0, batch * 5 * HOUR + dice.randrange(-spread * HOUR, 5 * HOUR))
            rows.append((key, at, dice.choice([0.0, 0.1, 40.0]), 0.0, dice.random() < 0.8, dice.choice(OWNERS[: 2 + batch % 4])))
        yield rows


@pytest.mark.parametrize("frame_rows", [7, 100_000])
@pytest.mark.parametrize("options", [{"watermark": True}, {"look_back_s": 20 * 3600}, {"look_back_s": 6 * 3600}])
@pytest.mark.parametrize("seed", range(3))
def test_travel_of_a_shard(seed, options, frame_rows):
    shared = Handle(_travel(**options, frame_rows=frame_rows, owner="owner"))
    alone = {o: Handle(_travel(**options, frame_rows=frame_rows)) for o in OWNERS}
    clock = (lambda rows: max(r[1] for r in rows) // 1000 - 10 * 3600 * 1000) if "watermark" in options else None
    _together(shared, alone, TRAVEL, _payments(seed), "id", clock)


def test_calls_to_the_state_do_not_grow_with_customers():
    """A batch of 300 customers asks no more of the state than its days."""
    rows = [(i, i % 48 * HOUR, 0.0, 0.0, True, i % 300) for i in range(3000)]
    handle = Handle(_travel(look_back_s=48 * 3600, bucket_s=86_400, owner="owner"))
    calls = Calls(handle)
    handle.run(_frames(rows, [*TRAVEL, "owner"], 1000))
    assert calls.made <= 10


@pytest.mark.parametrize("frame_rows", [7, 100_000])
def test_logins_of_a_shard(frame_rows):
    dice, columns = random.Random(2), ["log_id", "at", "failed", "ip_address"]
    batches = [
        [(b * 100 + i, (b * 9 + dice.randrange(9)) * HOUR, dice.random() < 0.8, str(i), dice.choice(OWNERS)) for i in range(60)]
        for b in range(8)
    ]
    shared = Handle(processors.LoginProcessor(3, 30, None, frame_rows=frame_rows, owner="owner"))
    alone = {o: Handle(processors.LoginProcessor(3, 30, None, frame_rows=frame_rows)) for o in OWNERS}
    _together(shared, alone, columns, batches, "log_id")


@pytest.mark.parametrize("fanout_safe", [False, True])
def test_payments_and_days_of_a_shard(fanout_safe, monkeypatch):
    monkeypatch.setattr(processors, "CELLS", 2)
    dice, seq = random.Random(5), 0
    shared = Handle(processors.PaymentChanges(fanout_safe, "owner"))
    alone = {o: Handle(processors.PaymentChanges(fanout_safe)) for o in OWNERS}
    shared_days, days = Handle(processors.DayTotals(shared=True)), {}
    log, moves = ["seq", "kind", "merchant_id", "day", "amount"], ["merchant_id", "day", "n", "volume", "raised", "amount", "sign"]
    for _ in range(15):
        rows = []
        for _ in range(25):
            seq += 1
            kind = dice.choice(["put", "put", "delete", "alert"])
            put = (dice.choice([None, 1, 2]), dice.choice([None, 1, 2]), dice.choice([None, Decimal(3), Decimal(4)]))
            rows.append((seq, kind, *(put if kind == "put" else (None,) * 3), dice.choice(OWNERS)))
        got = [tuple(map(str, r)) for f in shared.run(_frames(rows, [*log, "owner"], 9)) for r in f.itertuples(index=False)]
        want = [f for o in OWNERS if (own := [r[:-1] for r in rows if r[-1] == o]) for f in alone[o].run(_frames(own, log, 9))]
        text = [tuple("<NA>" if i < 2 and pd.isna(x) else str(int(x)) if i < 2 else str(x) for i, x in enumerate(r)) for f in want for r in f.itertuples(index=False)]
        assert sorted(got) == sorted(text)
        moved = [tuple(None if pd.isna(x) else x for x in r) for f in want for r in f.itertuples(index=False)]
        if not moved:
            continue
        (out,) = shared_days.run(_frames(moved, moves, 4))
        totals = {}
        for key in {r[:2] for r in moved}:
            handle = days.setdefault(key, Handle(processors.DayTotals()))
            (own,) = handle.processor.handleInputRows(key, iter(_frames([r for r in moved if r[:2] == key], moves, 4)), handle)
            totals[key] = list(map(str, own.iloc[0, 2:]))
        found = {tuple(None if pd.isna(x) else int(x) for x in r[:2]): list(map(str, r[2:])) for r in out.itertuples(index=False, name=None)}
        assert found == totals


@pytest.mark.parametrize("frame_rows", [6, 100_000])
@pytest.mark.parametrize("seed", range(4))
def test_windows_of_a_shard(seed, frame_rows, monkeypatch):
    monkeypatch.setattr(processors, "CELLS", 2)
    dice = random.Random(seed)

    def money():
        return Decimal(dice.randrange(1, 9999)) / 100

    batches = [
        [(r[0], r[1], money(), dice.choice([None, 1, 2, 3]), r[4], r[5]) for r in rows] for rows in _payments(seed, 14, 9)
    ]
    shared = Handle(processors.SharedWindows(["id"], 9 * 3600, 1800, frame_rows))
    alone = {o: Handle(processors.WindowProcessor(["id"], 9 * 3600, 1800, frame_rows)) for o in OWNERS}
    # The shard's clock drives all, as the stream's does.
    latest = []
    def clock(rows):
        latest.append(max(r[1] for r in rows))
        return max(latest) // 1000 - 6 * 3600 * 1000

    _together(shared, alone, WINDOW, batches, "id", clock)
    shared.advance(max(latest) // 1000 + 100 * 3600 * 1000)
    assert shared.size() == 0


@pytest.mark.parametrize("make", [lambda: _travel(owner="owner"), lambda: processors.SharedWindows(["id"], 9 * 3600)])
def test_a_payment_without_time_is_refused(make):
    columns = ["id", "at", "lat", "lon", "eligible", "amount", "card", "owner"]
    rows = [(i, HOUR if i else None, 0.0, 0.0, True, Decimal(1), 1, 3) for i in range(3)]
    with pytest.raises(ValueError):
        Handle(make()).run(_frames(rows, columns, 9))
