"""Order books replayed in one pass.

A full book starts a new epoch of its asset, and nothing of the book outlives an epoch. So events are
dealt out by (asset, epoch) and sorted by sequence, and each task runs through its rows once, batch by
batch: it holds one book, never a history, and an asset with a great many events is as many tasks as its
epochs allow. Epochs and the carried tick and trade prices are found first, within ranges of sequences
whose ends are aggregated and carried on, so that no asset is one task there either.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from heapq import heappop, heappush, nlargest, nsmallest

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.market_math import crossed, imbalance, mid, tolerance

DEPTHS = (1, 5, 10)
#: Sequences of a range that one task carries states over.
RANGE = 1_000_000


def locf(value: Column, over: Window) -> Column:
    """The last value that isn't null, up to and with this row."""
    return F.last(value, ignorenulls=True).over(over)


def is_change() -> Column:
    return F.col("event_type") == "price_change"


def annotate(events: DataFrame) -> DataFrame:
    """Adds epoch, tick_state, trade_state, tol, valid and final; rows without an asset are left out."""
    book = F.col("event_type") == "book"
    tick = F.when(book, F.nullif(F.col("tick_size"), F.lit(0.0))).when(F.col("event_type") == "tick_size_change", F.col("tick_size"))
    trade = F.when(F.col("event_type") == "last_trade_price", F.col("price"))
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < float("inf"))
    sound = F.col("side").isin("BUY", "SELL") & finite("price") & finite("size") & (F.col("size") >= 0)
    last_of_frame = F.col("change_index").isNull() | F.col("change_count").isNull() | (F.col("change_index") + 1 >= F.col("change_count"))
    rows = events.filter("asset_id <> ''").withColumns({"book_range": F.floor(F.col("sequence") / RANGE), "own_tick": tick, "own_trade": trade})
    # of each range its books and last prices: a row per asset and range
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("sequence")))
    ends = rows.groupBy("asset_id", "book_range").agg(F.count_if(book).alias("books"), last("own_tick").alias("t"), last("own_trade").alias("p"))
    before = Window.partitionBy("asset_id").orderBy("book_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("asset_id", "book_range", F.coalesce(F.sum("books").over(before), F.lit(0).cast("long")).alias("epochs_before"), locf(F.col("t"), before).alias("tick_before"), locf(F.col("p"), before).alias("trade_before"))
    own = Window.partitionBy("asset_id", "book_range").orderBy("sequence")
    return (
        rows.join(carried, ["asset_id", "book_range"])
        .withColumn("epoch", F.col("epochs_before") + F.sum(F.when(book, 1).otherwise(0)).over(own))
        .withColumn("tick_state", F.coalesce(locf(F.col("own_tick"), own), "tick_before"))
        .withColumn("trade_state", F.coalesce(locf(F.col("own_trade"), own), "trade_before"))
        .withColumn("tol", tolerance(F.col("tick_state")))
        .withColumn("valid", ~is_change() | F.coalesce(sound, F.lit(False)))
        .withColumn("final", ~is_change() | last_of_frame)
        .drop("book_range", "own_tick", "own_trade", "epochs_before", "tick_before", "trade_before")
    )


class Side:
    """Sizes by price; way is 1 where the highest price is the best and -1 where the lowest is."""

    def __init__(self, way: int) -> None:
        self.way, self.sizes = way, {}
        self.best: float | None = None

    def set(self, price: float, size: float) -> None:
        if size > 0:
            self.sizes[price] = size
            if self.best is None or self.way * (price - self.best) > 0:
                self.best = price
        elif self.sizes.pop(price, None) is not None and price == self.best:
            self.best = (max if self.way > 0 else min)(self.sizes, default=None)

    def cut(self, limit: float) -> int:
        """Takes away the levels beyond a price."""
        n = 0
        while self.best is not None and self.way * (self.best - limit) > 0:
            self.set(self.best, 0.0)
            n += 1
        return n

    def top(self, n: int) -> list[dict]:
        prices = (nlargest if self.way > 0 else nsmallest)(n, self.sizes)
        return [{"price": p, "size": self.sizes[p]} for p in prices]


_LEVELS = "array<struct<price: double, size: double>>"
_STATE = f"asset_id string, epoch long, sequence long, event_type string, point boolean, reason string, pruned int, book_bid double, book_ask double, bids {_LEVELS}, asks {_LEVELS}"
_EVENT = ["asset_id", "epoch", "sequence", "loaded", "event_type", "exchange_timestamp_ms", "side", "price", "size", "best_bid", "best_ask", "tol", "valid", "final"]


def states(annotated: DataFrame, levels: DataFrame, top: int = 20, interval_ms: int = 0, keep: tuple[str, ...] = (), every: bool = False, due_only: bool = False) -> DataFrame:
    """The book after each event of a started epoch that shows or reconciles it: asset_id, epoch, sequence,
    event_type, point (whether it may emit a snapshot), reason (``book`` or ``interval`` if one is due),
    pruned (levels that an observed best price took away), book_bid, book_ask, the `top` best levels as
    bids and asks (for due snapshots alone with `due_only`), and the events' columns to `keep`.

    A snapshot is due with each book, and with another point at least `interval_ms` after the last one.
    Points without a time are due only with a book, which then starts its epoch without a last one.
    Changes that are invalid or not the last of their frame neither emit nor reconcile. With `every` all
    events come out, those before an asset's first book too.
    """
    if interval_ms < 0 or top < 0:
        raise ValueError("interval and depth must not be negative")
    rows = annotated if every else annotated.filter("epoch > 0")
    taken = [f"kept_{c}" for c in keep]
    order = F.sort_array(F.collect_list(F.struct("source_rank", "side", "price", "size")))
    loaded = levels.groupBy("sequence").agg(F.transform(order, lambda x: F.struct(x["side"].alias("side"), x["price"].alias("price"), x["size"].alias("size"))).alias("loaded"))
    own = rows.withColumns({f"kept_{c}": F.col(c) for c in keep}).join(loaded, "sequence", "left").select(*_EVENT, *taken)
    dealt = own.repartition("asset_id", "epoch").sortWithinPartitions("asset_id", "epoch", "sequence")
    schema = T.StructType([*T.StructType.fromDDL(_STATE).fields, *(T.StructField(c, rows.schema[c].dataType) for c in keep)])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sides, last = None, {}, None
        for batch in batches:
            for at in range(0, batch.num_rows, 10_000):
                out: list[tuple] = []
                for asset, epoch, seq, loaded, kind, now, side, price, size, best_bid, best_ask, tol, valid, final, *more in zip(*(c.to_pylist() for c in batch.slice(at, 10_000).columns), strict=True):
                    if (asset, epoch) != key:
                        key, sides, last = (asset, epoch), {"BUY": Side(1), "SELL": Side(-1)}, None
                    if kind == "book" and loaded:
                        for x in loaded:
                            sides["BUY" if x["side"] == "BUY" else "SELL"].set(x["price"], x["size"])
                    if kind == "price_change" and valid and epoch:
                        sides[side].set(price, size)
                    shows, pruned, reason = valid and final and epoch > 0, 0, None
                    if shows:
                        pruned += sides["BUY"].cut(best_bid + tol) if best_bid is not None else 0
                        pruned += sides["SELL"].cut(best_ask - tol) if best_ask is not None else 0
                    point = shows and kind != "best_bid_ask"
                    if point and (kind == "book" or (now is not None and (last is None or now - last >= interval_ms))):
                        reason, last = ("book" if kind == "book" else "interval"), last if now is None else now
                    if shows or every:
                        listed = top and shows and (reason or not due_only)
                        bids, asks = (sides["BUY"].top(top), sides["SELL"].top(top)) if listed else ([], [])
                        out.append((asset, epoch, seq, kind, point, reason, pruned, sides["BUY"].best, sides["SELL"].best, bids, asks, *more))
                found = list(zip(*out, strict=True)) or [()] * len(arrow)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, arrow.types, strict=True)], schema=arrow)

    return dealt.mapInArrow(run, schema)


def book_states(events: DataFrame, levels: DataFrame, top: int = 20, keep: tuple[str, ...] = ()) -> DataFrame:
    """The book after each event that may emit a snapshot, as `states`."""
    return states(annotate(events), levels, top, keep=keep).filter("point")


def with_prices(state: DataFrame) -> DataFrame:
    """Adds mid, spread and crossed."""
    bid, ask = F.col("book_bid"), F.col("book_ask")
    return state.withColumns({"mid": mid(bid, ask), "spread": ask - bid, "crossed": crossed(bid, ask)})


def depth(levels: str, n: int) -> Column:
    return F.aggregate(F.slice(levels, 1, n), F.lit(0.0), lambda total, x: total + x["size"])


def with_metrics(state: DataFrame, top: int = 20) -> DataFrame:
    """Best prices, mid, spread, crossed, depths, imbalance of depth 5, and the best levels as JSON."""
    columns = {}
    for n in DEPTHS:
        columns |= {f"bid_depth_{n}": depth("bids", n), f"ask_depth_{n}": depth("asks", n)}
    out = with_prices(state).withColumns(columns).withColumn("imbalance_5", imbalance(F.col("bid_depth_5"), F.col("ask_depth_5")))
    pairs = lambda c: F.to_json(F.transform(F.slice(c, 1, top), lambda x: F.array(x["price"], x["size"])))
    return out.withColumns({"bids_json": pairs("bids"), "asks_json": pairs("asks")})


def snapshots(events: DataFrame, levels: DataFrame, interval_ms: int = 1000, top: int = 20) -> DataFrame:
    """Periodic snapshots with their reason; levels are listed for those alone."""
    if interval_ms < 0 or top < 1:
        raise ValueError("interval must be non-negative and depth positive")
    due = states(annotate(events), levels, max(top, *DEPTHS), interval_ms, due_only=True).filter("reason IS NOT NULL")
    return with_metrics(due, top)


def gap_stats(events: DataFrame, threshold_ms: int = 120_000) -> DataFrame:
    """asset_id, gaps, max_gap_ms over the threshold, against the latest time so far."""
    if threshold_ms < 1:
        raise ValueError("gap threshold must be positive")
    before = Window.partitionBy("asset_id").orderBy("sequence").rowsBetween(Window.unboundedPreceding, -1)
    gap = F.col("exchange_timestamp_ms") - F.max("exchange_timestamp_ms").over(before)
    return events.filter("asset_id <> ''").withColumn("gap", gap).filter(F.col("gap") > threshold_ms).groupBy("asset_id").agg(F.count("*").alias("gaps"), F.max("gap").alias("max_gap_ms"))


def _off(observed: str, own: str) -> Column:
    """Whether an observed best price is off the book's by more than the tolerance, or has none to go by."""
    far = F.abs(F.col(observed) - F.col(own)) > F.col("tol")
    return F.coalesce(F.col(observed).isNotNull() & F.when(F.col(own).isNull(), F.col("event_type") == "best_bid_ask").otherwise(far), F.lit(False))


_OBSERVED = ("best_bid", "best_ask", "tol")


def mismatches(events: DataFrame, levels: DataFrame) -> DataFrame:
    """Events with an observed best price, and the best prices of the book after reconciling it:
    sequence, event_type, bid_off, ask_off (whether they differ by more than the tolerance)."""
    seen = states(annotate(events), levels, 0, keep=_OBSERVED).filter("best_bid IS NOT NULL OR best_ask IS NOT NULL")
    return seen.select("sequence", "asset_id", "event_type", _off("best_bid", "book_bid").alias("bid_off"), _off("best_ask", "book_ask").alias("ask_off"))


def replay_counters(events: DataFrame, levels: DataFrame, interval_ms: int = 1000) -> DataFrame:
    """One row with the counters of a replay, from one pass over the books."""
    rows = states(annotate(events), levels, 0, interval_ms, (*_OBSERVED, "valid", "final", "tick_size", "price"), every=True)
    shows = F.col("valid") & F.col("final") & (F.col("epoch") > 0)
    rows = rows.withColumns({"bid_off": shows & _off("best_bid", "book_bid"), "ask_off": shows & _off("best_ask", "book_ask")})
    kind, started, note = F.col("event_type"), F.col("epoch") > 0, F.col("event_type") == "best_bid_ask"
    due = F.col("reason").isNotNull()
    zero = F.lit(0).cast("long")
    counted = rows.agg(
        F.count_if(kind == "book").alias("full_snapshots"),
        F.count_if(is_change() & ~started).alias("changes_before_snapshot"),
        F.count_if(is_change() & started & F.col("valid")).alias("price_changes"),
        F.count_if(is_change() & started & ~F.col("valid")).alias("invalid_price_changes"),
        F.count_if((kind == "tick_size_change") & F.col("tick_size").isNotNull()).alias("tick_size_changes"),
        F.count_if((kind == "last_trade_price") & F.col("price").isNotNull()).alias("trades"),
        F.count_if(note & started).alias("top_notifications"),
        F.count_distinct(F.when(kind == "book", F.col("asset_id"))).alias("assets_initialized"),
        F.coalesce(F.sum("pruned"), zero).alias("levels_pruned_by_authoritative_top"),
        F.count_if(F.col("pruned") > 0).alias("authoritative_top_reconciliations"),
        F.count_if(note & F.col("bid_off")).alias("top_notifications_awaiting_bid_level"),
        F.count_if(note & F.col("ask_off")).alias("top_notifications_awaiting_ask_level"),
        F.count_if(~note & F.col("bid_off")).alias("best_bid_mismatches"),
        F.count_if(~note & F.col("ask_off")).alias("best_ask_mismatches"),
        F.count_if(due).alias("snapshots_written"),
        F.count_if(due & crossed(F.col("book_bid"), F.col("book_ask"))).alias("crossed_snapshots"),
        F.count("*").alias("with_asset"),
    )
    seen = events.agg(F.count("*").alias("events_seen"))
    # single rows side by side: a join on a constant key
    out = seen.withColumn("one", F.lit(1)).join(counted.withColumn("one", F.lit(1)), "one")
    return out.withColumn("events_without_asset", F.col("events_seen") - F.col("with_asset")).drop("one", "with_asset")


def markouts(trades: DataFrame, mids: DataFrame, after_ms: int = 60_000) -> DataFrame:
    """sequence, markout_mid, markout_pnl of trades (asset_id, sequence, exchange_timestamp_ms, side, price, size).

    The mid is the first one that is processed after the trade (by sequence) with a time `after_ms` later
    or more; null if there is none. mids are asset_id, sequence, exchange_timestamp_ms, mid. Times may go
    back: each task runs through an asset's rows by sequence and holds the trades that aren't due yet.
    """
    blank = lambda *names: {c: F.lit(None).cast("string" if c == "side" else "double") for c in names}
    names = ["asset_id", "sequence", "exchange_timestamp_ms", "side", "price", "size", "mid"]
    rows = trades.withColumns(blank("mid")).select(*names).unionByName(mids.filter("mid IS NOT NULL").withColumns(blank("side", "price", "size")).select(*names))
    # at one sequence the event's own mid comes first: it was there when the trade was processed
    rows = rows.repartition("asset_id").sortWithinPartitions("asset_id", "sequence", F.col("mid").isNull())
    schema = pa.schema([("sequence", pa.int64()), ("markout_mid", pa.float64()), ("markout_pnl", pa.float64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, waiting, done = None, [], []
        for batch in batches:
            for asset, seq, now, side, price, size, middle in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if asset != own:
                    done += [(x[1], None, None) for x in waiting]
                    own, waiting = asset, []
                if middle is None and now is None:
                    done.append((seq, None, None))
                elif middle is None:
                    heappush(waiting, (now + after_ms, seq, side == "BUY", price, size))
                elif now is not None:
                    while waiting and waiting[0][0] <= now:
                        _, at, buys, paid, n = heappop(waiting)
                        done.append((at, middle, None if paid is None or n is None else (middle - paid if buys else paid - middle) * n))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*done, strict=True)) or [()] * 3, schema.types, strict=True)], schema=schema)
            done = []
        done += [(x[1], None, None) for x in waiting]
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), schema.types, strict=True)], schema=schema)

    return rows.mapInArrow(run, "sequence long, markout_mid double, markout_pnl double")


def markouts(trades: DataFrame, mids: DataFrame, after_ms: int = 60_000) -> DataFrame:
    """sequence, markout_mid, markout_pnl of trades (asset_id, sequence, exchange_timestamp_ms, side, price, size).

    The mid is the first one that is processed after the trade (by sequence) with a time `after_ms` later
    or more; null if there is none. mids are asset_id, sequence, exchange_timestamp_ms, mid. Times may go
    back: each task runs through an asset's rows by sequence and holds the trades that aren't due yet.
    """
    blank = lambda *names: {c: F.lit(None).cast("string" if c == "side" else "double") for c in names}
    names = ["asset_id", "sequence", "exchange_timestamp_ms", "side", "price", "size", "mid"]
    rows = trades.withColumns(blank("mid")).select(*names).unionByName(mids.filter("mid IS NOT NULL").withColumns(blank("side", "price", "size")).select(*names))
    # at one sequence the event's own mid comes first: it was there when the trade was processed
    rows = rows.repartition("asset_id").sortWithinPartitions("asset_id", "sequence", F.col("mid").isNull())
    schema = pa.schema([("sequence", pa.int64()), ("markout_mid", pa.float64()), ("markout_pnl", pa.float64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, waiting, done = None, [], []
        for batch in batches:
            for asset, seq, now, side, price, size, middle in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if asset != own:
                    done += [(x[1], None, None) for x in waiting]
                    own, waiting = asset, []
                if middle is None and now is None:
                    done.append((seq, None, None))
                elif middle is None:
                    heappush(waiting, (now + after_ms, seq, side == "BUY", price, size))
                elif now is not None:
                    while waiting and waiting[0][0] <= now:
                        _, at, buys, paid, n = heappop(waiting)
                        done.append((at, middle, None if paid is None or n is None else (middle - paid if buys else paid - middle) * n))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*done, strict=True)) or [()] * 3, schema.types, strict=True)], schema=schema)
            done = []
        done += [(x[1], None, None) for x in waiting]
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), schema.types, strict=True)], schema=schema)

    return rows.mapInArrow(run, "sequence long, markout_mid double, markout_pnl double")
