"""Order books kept up as a stream, one state per asset, in order of arrival."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.backtest import Levels

EVENTS = "sequence long, exchange_timestamp_ms long, asset_id string, event_type string, side string, price double, size double, best_bid double, best_ask double, tick_size double, change_index int, change_count int, levels array<struct<side: string, price: double, size: double>>"
STATES = "asset_id string, sequence long, book_bid double, book_ask double, bid_levels int, ask_levels int"


class BookProcessor(StatefulProcessor):
    """The state is the asset's levels and tick; a row comes out for each event that settles a frame."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("book", "sides array<string>, prices array<double>, sizes array<double>, tick double, ready boolean")

    def _load(self) -> Levels:
        book = Levels()
        if self.state.exists():
            sides, prices, sizes, tick, ready = self.state.get()
            for side, price, size in zip(sides, prices, sizes, strict=True):
                book.side[side][price] = size
            book.tick, book.ready = tick, ready
        return book

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        book, out = self._load(), []
        for e in pd.concat(rows).sort_values("sequence").astype(object).where(lambda d: d.notna(), None).to_dict("records"):
            kind = e["event_type"]
            if kind == "book":
                book.load([{"side": x["side"], "price": x["price"], "size": x["size"]} for x in (e["levels"] if e["levels"] is not None else [])])
                book.tick = e["tick_size"] or book.tick
            elif kind == "price_change" and book.ready:
                if e["side"] not in ("BUY", "SELL") or e["price"] is None or e["size"] is None or e["size"] < 0:
                    continue
                book.set(e["side"], e["price"], e["size"])
                if e["change_index"] is not None and e["change_count"] is not None and e["change_index"] + 1 < e["change_count"]:
                    continue
            elif kind == "tick_size_change" and e["tick_size"] is not None:
                book.tick = e["tick_size"]
            if not book.ready:
                continue
            if e["best_bid"] is not None or e["best_ask"] is not None:
                book.prune(e["best_bid"], e["best_ask"])
            if kind != "best_bid_ask":
                bid, ask = book.best
                out.append((key[0], int(e["sequence"]), bid, ask, len(book.side["BUY"]), len(book.side["SELL"])))
        flat = [(s, p, n) for s in ("BUY", "SELL") for p, n in book.side[s].items()]
        self.state.update(([x[0] for x in flat], [x[1] for x in flat], [x[2] for x in flat], book.tick, book.ready))
        yield pd.DataFrame(out, columns=["asset_id", "sequence", "book_bid", "book_ask", "bid_levels", "ask_levels"])

    def close(self) -> None:
        pass


def book_stream(events: DataFrame) -> DataFrame:
    """Best prices after each event, from a stream of normalised events (`EVENTS`). Events are applied in
    the order that they arrive in; there is no watermark, and late ones aren't dropped."""
    return events.filter("asset_id <> ''").groupBy("asset_id").transformWithStateInPandas(BookProcessor(), STATES, "Append", "None")


def event_files(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """A stream of normalised events from a folder that Parquet files are added to."""
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def run_book_stream(spark: SparkSession, source: str, target: str, checkpoint: str) -> None:
    """Works off what the folder holds and stops; a later call goes on from the checkpoint."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    query = book_stream(event_files(spark, source)).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
