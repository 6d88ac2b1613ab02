"""The relational replay against a sequential one, on random frames."""

import random

import pytest

from tidebook.operators import backtest, book

EVENTS = "sequence long, exchange_timestamp_ms long, asset_id string, market string, event_type string, side string, price double, size double, best_bid double, best_ask double, tick_size double, change_index int, change_count int"
LEVELS = "sequence long, asset_id string, side string, price double, size double, source_rank int"


def feed(seed, n=900):
    rnd = random.Random(seed)
    events, levels, now = [], [], 0
    while len(events) < n:
        asset, kind = rnd.choice("ABC"), rnd.choices(["book", "price_change", "best_bid_ask", "last_trade_price", "tick_size_change"], [1, 8, 3, 3, 1])[0]
        now += rnd.choice([0, 5, 100, 700, 2500])
        top = lambda: rnd.choice([None, None, round(rnd.uniform(0.3, 0.7), 2)])
        frame = rnd.randint(1, 3) if kind == "price_change" else 1
        for i in range(frame):
            seq = len(events) + 1
            place = (i, frame) if kind == "price_change" else (None, None)
            price = round(rnd.uniform(0.3, 0.7), 2)
            events.append((seq, None if rnd.random() < 0.03 else now, asset, "m", kind, rnd.choice(["BUY", "SELL", "SELL", "BUY", "x"]), price if rnd.random() < 0.95 else None, float(rnd.choice([0, 0, 5, 10, -1])), top(), top(), rnd.choice([None, 0.01, 0.0, 0.001]) if kind in ("book", "tick_size_change") else None, *place))
            if kind == "book":
                for rank in range(rnd.randint(0, 6)):
                    levels.append((seq, asset, rnd.choice(["BUY", "SELL"]), round(rnd.uniform(0.3, 0.7), 2), float(rnd.choice([0, 5, 7])), rank))
    return events, levels


def replay(events, levels, interval):
    """States after each emitting event, and the snapshots; one event after the other."""
    names = [x.split()[0] for x in EVENTS.split(", ")]
    by_seq = {}
    for s, _, side, price, size, rank in levels:
        by_seq.setdefault(s, []).append((rank, side, price, size))
    books, last, states, emitted, pruned = {}, {}, {}, [], 0
    for row in events:
        e = dict(zip(names, row, strict=True))
        b = books.setdefault(e["asset_id"], backtest.Levels())
        kind, reason = e["event_type"], None
        if kind == "book":
            b.load([{"side": s, "price": p, "size": n} for _, s, p, n in sorted(by_seq.get(e["sequence"], []))])
            b.tick = e["tick_size"] or b.tick
            reason = "book"
        elif kind == "price_change":
            if not b.ready or e["side"] not in ("BUY", "SELL") or e["price"] is None or e["size"] < 0:
                continue
            b.set(e["side"], e["price"], e["size"])
            if e["change_index"] + 1 < e["change_count"]:
                continue
        elif kind == "tick_size_change" and e["tick_size"] is not None:
            b.tick = e["tick_size"]
        if not b.ready:
            continue
        pruned += b.prune(e["best_bid"], e["best_ask"])
        if kind == "best_bid_ask":
            continue
        depth = lambda side, n: sum(b.side[side][p] for p in sorted(b.side[side], reverse=side == "BUY")[:n])
        states[e["sequence"]] = (*b.best, depth("BUY", 1), depth("SELL", 1), depth("BUY", 5), depth("SELL", 5))
        now = e["exchange_timestamp_ms"]
        if reason is None and now is not None and (last.get(e["asset_id"]) is None or now - last[e["asset_id"]] >= interval):
            reason = "interval"
        if reason:
            emitted.append((e["sequence"], reason))
            if now is not None:
                last[e["asset_id"]] = now
            elif reason == "book":
                last[e["asset_id"]] = None
    return states, emitted, pruned


@pytest.mark.parametrize("seed", [1, 2])
def test_states_and_snapshots(spark, monkeypatch, seed):
    monkeypatch.setattr(book, "RANGE", 100)  # states are carried over many ranges
    events, levels = feed(seed)
    e, lv = spark.createDataFrame(events, EVENTS), spark.createDataFrame(levels, LEVELS)
    states, emitted, pruned = replay(events, levels, 1000)
    rows = book.annotate(e)
    got = book.with_metrics(book.states(rows, lv).filter("point")).collect()
    assert {r["sequence"]: (r["book_bid"], r["book_ask"], r["bid_depth_1"], r["ask_depth_1"], r["bid_depth_5"], r["ask_depth_5"]) for r in got} == states
    assert sorted((r["sequence"], r["reason"]) for r in book.snapshots(e, lv, 1000).collect()) == emitted
    counters = book.replay_counters(e, lv, 1000).head()
    assert counters["events_seen"] == len(events) and counters["snapshots_written"] == len(emitted) and counters["levels_pruned_by_authoritative_top"] == pruned


def test_gaps_and_settings(spark):
    rows = [(1, 0, "A"), (2, 120_000, "A"), (3, 240_001, "A"), (4, 100, "A"), (5, 400_000, "A"), (6, None, "A"), (7, 10**9, "")]
    e = spark.createDataFrame(rows, "sequence long, exchange_timestamp_ms long, asset_id string")
    assert [tuple(r) for r in book.gap_stats(e).collect()] == [("A", 2, 159_999)]
    with pytest.raises(ValueError, match="interval"):
        book.snapshots(e, e, -1)


def test_markouts_follow_the_processing_order(spark):
    """Against each trade's search through the later events; times go back now and then."""
    rnd = random.Random(6)
    rows, now = [], 0
    for seq in range(1, 600):
        now += rnd.randint(0, 40)
        rows.append((seq, rnd.choice("AB"), None if rnd.random() < 0.05 else now - rnd.choice([0, 0, 0, 150]), rnd.choice(["BUY", "SELL"]), round(rnd.random(), 2), 2.0, rnd.choice([None, round(rnd.random(), 2)])))
    df = spark.createDataFrame(rows, "sequence long, asset_id string, exchange_timestamp_ms long, side string, price double, size double, mid double")
    trades = [r for r in rows if r[0] % 3 == 0]
    want = {}
    for seq, asset, at, side, price, size, _ in trades:
        mids = [m for s, a, t, *_, m in rows if a == asset and s > seq and m is not None and t is not None and at is not None and t >= at + 100]
        want[seq] = (mids[0], pytest.approx((1 if side == "BUY" else -1) * (mids[0] - price) * size)) if mids else (None, None)
    got = book.markouts(df.filter("sequence % 3 = 0"), df, 100).collect()
    assert len(got) == len(trades) and {r["sequence"]: (r["markout_mid"], r["markout_pnl"]) for r in got} == want
