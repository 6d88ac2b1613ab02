"""Small archives with results worked out by hand.

The scenario: market `rain` with tokens W and D. W's book is loaded, thinned by a frame of changes,
traded in twice on the ask and once on the bid, and loaded anew by a second book; D has one book only.
"""

import gzip
import json

LINK = {"connection_id": "feed-7", "subscription_revision": 3, "frame_index": 1, "frame_message_count": 2}


def market(stamp, payload, **more):
    """A feed record that is received 3 ms after the exchange's stamp (in ms)."""
    return {"record_type": "market_ws", "received_at_ns": (stamp + 3) * 1_000_000, "received_monotonic_ns": stamp, **LINK, "payload": payload | {"timestamp": str(stamp), "market": "rain"}, **more}


def book(asset, bids, asks, **more):
    side = lambda levels: [{"price": p, "size": s} for p, s in levels]
    return {"event_type": "book", "asset_id": asset, "bids": side(bids), "asks": side(asks), **more}


def trade(side, price, size):
    return {"event_type": "last_trade_price", "asset_id": "W", "side": side, "price": price, "size": size, "fee_rate_bps": "20", "transaction_hash": f"hash-{size}"}


DISCOVERY = {
    "record_type": "rewarded_market_discovery", "received_at_ns": 4_000_000, "market_count": 1, "asset_count": 2, "candidate_count": 9,
    "markets": [{"condition_id": "rain", "market_id": "31", "question": "Will it rain?", "collector_daily_reward": "48", "rewards_max_spread": 4.0, "rewards_min_size": 2, "collector_volume_24hr": 250.25,
                 "tokens": [{"token_id": "W", "outcome": "Wet", "price": "0.31"}, {"token_id": "D", "outcome": "Dry", "price": 0.69}]}],
}
CHANGES = {
    "event_type": "price_change",
    "price_changes": [
        {"asset_id": "W", "side": "BUY", "price": "0.29", "size": "0", "best_bid": "0.30", "best_ask": "0.34"},
        {"asset_id": "W", "side": "sell", "price": "0.33", "size": "12", "best_bid": "0.30", "best_ask": "0.33"},
        {"asset_id": "D", "side": "BUY", "price": "0.66", "size": "4", "best_bid": "0.66", "best_ask": "0.70"},
    ],
}

SCENARIO = [
    DISCOVERY,
    market(10_000, book("W", [("0.30", "40"), ("0.29", "10")], [("0.34", "8"), ("0.36", "5")], tick_size="0.01", hash="w1")),
    market(10_500, book("D", [("0.65", "9")], [("0.70", "9")], tick_size="0.01", hash="d1")),
    market(12_000, CHANGES),
    market(15_000, trade("BUY", "0.33", "7")),
    market(16_000, trade("BUY", "0.34", "1")),
    market(20_000, trade("SELL", "0.30", "46")),
    market(31_000, book("W", [("0.32", "3")], [("0.36", "3")], tick_size="0.01", hash="w2")),
]
#: Sequences and types that the scenario's records get: changes of a frame are numbered one by one.
TYPES = ["rewarded_market_discovery", "book", "book", "price_change", "price_change", "price_change", "last_trade_price", "last_trade_price", "last_trade_price", "book"]


def write(path, records, extra=("{not json",)):
    path.parent.mkdir(parents=True, exist_ok=True)
    text = "".join(json.dumps(r) + "\n" for r in records) + "".join(x + "\n" for x in extra)
    if path.name.endswith(".gz"):
        path.write_bytes(gzip.compress(text.encode()))
    else:
        path.write_text(text)
    return str(path)
