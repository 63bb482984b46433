"""Handlers of the keyed streams against plain code, on state held in dictionaries."""

import random
from decimal import Decimal

import pandas as pd
import pytest

from cardwarden.operators.travel_fold import Track
from cardwarden.streaming import processors

HOUR = 3600 * 1_000_000


class Map:
    def __init__(self):
        self.rows = {}

    def containsKey(self, key):
        return key in self.rows

    def getValue(self, key):
        return self.rows[key]

    def updateValue(self, key, value):
        self.rows[key] = value

    def removeKey(self, key):
        del self.rows[key]

    def keys(self):
        return iter(list(self.rows))


class Value:
    def __init__(self):
        self.row = None

    def exists(self):
        return self.row is not None

    def get(self):
        return self.row

    def update(self, row):
        self.row = row

    def clear(self):
        self.row = None


class Handle:
    """State of one key; `advance` moves the watermark and runs the timers it passes."""

    def __init__(self, processor):
        self.maps, self.timers, self.watermark, self.processor = [], set(), 0, processor
        processor.init(self)

    def getMapState(self, *_):
        self.maps.append(Map())
        return self.maps[-1]

    def getValueState(self, *_):
        return Value()

    def registerTimer(self, at):
        self.timers.add(at)

    def getCurrentWatermarkInMs(self):
        return self.watermark

    def run(self, frames):
        return list(self.processor.handleInputRows((1,), iter(frames), self))

    def advance(self, to):
        self.watermark = max(self.watermark, to)
        for at in sorted(t for t in self.timers if t <= self.watermark):
            self.timers.remove(at)
            assert list(self.processor.handleExpiredTimer((1,), self, Timer(at))) == []

    def size(self):
        return sum(len(m.rows) for m in self.maps)


class Timer:
    def __init__(self, at):
        self.at = at

    def getExpiryTimeInMs(self):
        return self.at


def _frames(rows, columns, size):
    return [pd.DataFrame(rows[i : i + size], columns=columns) for i in range(0, len(rows), size)]


def test_spool_bounds_frames_and_keeps_order():
    """A customer with a third of a million rows in one micro-batch: frames stay bounded, nothing stays behind."""
    dice = random.Random(1)
    rows = [(dice.randrange(72 * HOUR), i) for i in range(330_000)]
    spool = processors._Spool(Handle(processors.LoginProcessor(5, 30, None)), 3600, 10_000)
    seen, most = [], 0
    for frame in spool.in_order(iter(_frames(rows, ["at", "id"], 10_000)), "id"):
        most = max(most, len(frame))
        seen += list(zip(frame["at"].tolist(), frame["id"].tolist()))
    assert seen == sorted(rows) and most <= 10_000 and not spool.parts.rows


TRAVEL = ["id", "at", "lat", "lon", "eligible"]


def _travel(**options):
    return processors.TravelProcessor(9_000_000, ["id"], options.pop("look_back_s", None), None, **options)


def _walk(rows):
    """Every row against the latest strictly earlier accepted point, in order of arrival."""
    points, out = [], {}
    for key, at, lat, lon, eligible in rows:
        before = max((p for p in points if p[0] < at), default=None)
        track = Track(before)
        verdict = track.step((at, key, lat, lon), eligible, 9_000_000)
        out[key] = (before and before[1], verdict.violation)
        if eligible and not verdict.violation:
            points.append((at, key, lat, lon))
    return out


@pytest.mark.parametrize("frame_rows", [7, 100_000])
@pytest.mark.parametrize("seed", range(5))
def test_travel_with_watermark(seed, frame_rows):
    dice = random.Random(seed)
    handle = Handle(_travel(watermark=True, bucket_s=3600, frame_rows=frame_rows))
    judged, told, arrived, late, key, clock = {}, {}, [], set(), 0, 0
    for batch in range(12):
        rows = []
        for _ in range(dice.randrange(1, 60)):
            key += 1
            at = max(0, batch * 5 * HOUR + dice.randrange(-14 * HOUR, 5 * HOUR))
            rows.append((key, at, dice.choice([0.0, 0.1, 40.0]), 0.0, dice.random() < 0.8))
        low = handle.watermark * 1000
        late |= {r[0] for r in rows if r[1] < low}
        arrived += sorted((r for r in rows if r[1] >= low), key=lambda r: (r[1], r[0]))
        for frame in handle.run(_frames(rows, TRAVEL, 10)):
            for r in frame.to_dict("records"):
                (told if r["too_late"] else judged)[r["id"]] = (None if pd.isna(r["_ref_id"]) else r["_ref_id"], r["violation"])
        clock = max(clock, *(r[1] for r in rows))
        handle.advance(clock // 1000 - 10 * 3600 * 1000)
        # Buckets of ten hours and of the batch's own, and the last point before them.
        assert handle.size() <= 10 + 5 + 3
    assert set(told) == late and late
    assert judged == _walk(arrived)


@pytest.mark.parametrize("frame_rows", [5, 100_000])
def test_travel_look_back_by_buckets(frame_rows):
    dice = random.Random(3)
    small, large = (Handle(_travel(look_back_s=6 * 3600, bucket_s=b, frame_rows=frame_rows)) for b in (600, 10**6))
    for batch in range(10):
        rows = []
        for i in range(30):
            at = max(0, batch * 2 * HOUR + dice.randrange(-9 * HOUR, 2 * HOUR))
            rows.append((batch * 100 + i, at, dice.choice([0.0, 30.0]), 0.0, True))
        one, other = (pd.concat(h.run(_frames(rows, TRAVEL, 8))) for h in (small, large))
        assert one.sort_values("id").reset_index(drop=True).equals(other.sort_values("id").reset_index(drop=True))
    assert small.size() <= 6 * 6 + 2


WINDOW = ["id", "at", "amount", "card", "eligible"]


@pytest.mark.parametrize("frame_rows", [6, 100_000])
@pytest.mark.parametrize("seed", range(6))
def test_window_totals(seed, frame_rows, monkeypatch):
    monkeypatch.setattr(processors, "CHUNK_ROWS", 4)
    dice = random.Random(seed)
    window = 9 * HOUR
    handle = Handle(processors.WindowProcessor(["id"], 9 * 3600, 1800, frame_rows))
    landed, key, clock, latest = [], 0, None, 0
    for batch in range(15):
        rows = []
        for _ in range(dice.randrange(0, 40)):
            key += 1
            at = max(0, batch * 3 * HOUR + dice.randrange(-8 * HOUR, 3 * HOUR) // (HOUR // 4) * (HOUR // 4))
            card = dice.choice([None, 1, 2, 3, batch])
            rows.append((key, at, Decimal(dice.randrange(1, 9999)) / 100, card, dice.random() < 0.7))
        low = handle.watermark * 1000
        kept = [r for r in rows if r[1] >= low]
        landed += kept
        got = {}
        for frame in handle.run(_frames(rows, WINDOW, 9)):
            for r in frame.to_dict("records"):
                card = None if pd.isna(r["max_card_id"]) else r["max_card_id"]
                got[r["id"]] = None if r["too_late"] else (r["txn_count"], r["aggregate_total"], card)
        want = {r[0]: None for r in rows if r[1] < low}
        if kept:
            clock = max([clock or 0, *(r[1] for r in kept)])
            inside = [r for r in landed if r[4] and r[1] >= clock - window]
            cards = [r[3] for r in inside if r[3] is not None]
            total = (len(inside), sum((r[2] for r in inside), Decimal(0)), max(cards, default=None))
            want |= {r[0]: total for r in kept}
        assert got == want
        latest = max([latest, *(r[1] for r in rows)])
        handle.advance(latest // 1000 - 6 * 3600 * 1000)
    handle.advance(latest // 1000 + 100 * 3600 * 1000)
    assert handle.size() == 0


def test_window_reads_no_more_than_its_buckets(monkeypatch):
    """With ten times the history inside the look-back a batch touches as many buckets as before."""
    handle = Handle(processors.WindowProcessor(["id"], 48 * 3600, 600))
    reads = []
    original = Map.getValue
    monkeypatch.setattr(Map, "getValue", lambda self, key: reads.append(key) or original(self, key))
    for minute in range(0, 40 * 60, 10):
        handle.run(_frames([(minute, minute * 60_000_000, Decimal(1), 1, True)], WINDOW, 10))
        if minute == 4 * 60:
            few = len(reads)
    handle_reads = len(reads)
    handle.run(_frames([(9999, 40 * HOUR, Decimal(1), 1, True)], WINDOW, 10))
    assert len(reads) - handle_reads <= few


def test_login_counts_over_bounded_frames():
    dice = random.Random(4)
    rows = [(i, dice.randrange(50 * HOUR), dice.random() < 0.7, str(i)) for i in range(2000)]
    columns = ["log_id", "at", "failed", "ip_address"]
    whole, pieces = (
        pd.concat(Handle(processors.LoginProcessor(5, 30, None, frame_rows=n)).run(_frames(rows, columns, 300)))
        for n in (10**6, 150)
    )
    assert whole.astype(str).values.tolist() == pieces.astype(str).values.tolist()


@pytest.mark.parametrize("fanout_safe", [False, True])
@pytest.mark.parametrize("seed", range(3))
def test_merchant_days_kept_up(seed, fanout_safe):
    """Random changes of payments and alerts over many batches against totals made anew after each."""
    dice = random.Random(seed)
    payments = {i: Handle(processors.PaymentChanges(fanout_safe)) for i in range(25)}
    days, newest, truth, seq = {}, {}, {}, 0
    for _ in range(20):
        log = {}
        for _ in range(30):
            seq += 1
            key, state = dice.randrange(25), None
            alive, raised = truth.get(key, (None, 0))
            kind = dice.choice(["put", "put", "delete", "alert", "alert_gone"])
            if kind == "alert_gone" and not raised:
                continue
            row = (seq, kind, None, None, None)
            if kind == "put":
                amount = dice.choice([None, Decimal(dice.randrange(1, 9)), Decimal(dice.randrange(1, 9))])
                state = (dice.randrange(3), dice.randrange(3), amount)
                row = (seq, kind, *state)
            alive = state if kind == "put" else None if kind == "delete" else alive
            truth[key] = (alive, raised + {"alert": 1, "alert_gone": -1}.get(kind, 0))
            log.setdefault(key, []).append(row)
        moved = {}
        for key, rows in log.items():
            dice.shuffle(rows)
            for frame in payments[key].run(_frames(rows, ["seq", "kind", "merchant_id", "day", "amount"], 3)):
                for r in frame.itertuples(index=False):
                    moved.setdefault((r.merchant_id, r.day), []).append(tuple(r))
        for key, rows in moved.items():
            columns = ["merchant_id", "day", "n", "volume", "raised", "amount", "sign"]
            handle = days.setdefault(key, Handle(processors.DayTotals()))
            (out,) = handle.processor.handleInputRows(key, iter(_frames(rows, columns, 4)), handle)
            newest[key] = tuple(out.iloc[0])[2:6]
        want = {}
        for alive, raised in truth.values():
            if alive is not None:
                n, volume, alerts, largest = want.get(alive[:2], (0, Decimal(0), 0, None))
                weight, amount = 1 if fanout_safe else max(raised, 1), alive[2]
                paid = [a for a in (largest, amount) if a is not None]
                want[alive[:2]] = (n + weight, volume + weight * (amount or 0), alerts + raised, max(paid, default=None))
        empty = (0, Decimal(0), 0, None)
        assert {k: v for k, v in newest.items() if v != empty} == want
