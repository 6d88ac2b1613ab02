"""Message feeds as a streaming data source, and the records that frames become."""

from __future__ import annotations

import importlib
import json
import random
import time
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

#: Seconds between attempts after a failure: doubled up to the last.
FIRST_WAIT, LAST_WAIT = 1.0, 60.0


def next_wait(wait: float, connected_for: float = 0.0, steady: float = 30.0) -> float:
    """The wait after another failure; a connection that held for `steady` seconds starts over."""
    return FIRST_WAIT if connected_for >= steady else min(wait * 2, LAST_WAIT)


class Feed(DataSource):
    """Frames of a feed. The option `connect` names a function (``module:function``) that takes the
    number of frames read so far and gives the next ones as text; a failure becomes a control record
    and is tried again with the next batch."""

    @classmethod
    def name(cls) -> str:
        return "message_feed"

    def schema(self) -> str:
        return "frame_at long, received_at_ns long, received_monotonic_ns long, kind string, frame string"

    def simpleStreamReader(self, schema) -> FeedReader:
        return FeedReader(dict(self.options))


class Subscription:
    """The assets that a feed is asked for, and how often that has changed."""

    def __init__(self) -> None:
        self.assets: frozenset[str] = frozenset()
        self.revision = 0

    def update(self, desired: Iterable[str]) -> list[str]:
        """The messages that bring the feed from its assets to the desired ones, as text; none if nothing changes."""
        wanted = frozenset(desired)
        gone, new = sorted(self.assets - wanted), sorted(wanted - self.assets)
        self.revision += bool(gone or new)
        self.assets = wanted
        asked = [{"assets_ids": gone, "operation": "unsubscribe"}] if gone else []
        asked += [{"assets_ids": new, "operation": "subscribe", "custom_feature_enabled": True}] if new else []
        return [json.dumps(x, separators=(",", ":")) for x in asked]


class FeedReader(SimpleDataSourceStreamReader):
    """Options besides `connect`: `send`, a function that sends a text to the feed; `assets`, one that gives
    the desired assets, compared before each batch; `ping_seconds`, after which a PING is sent;
    `stale_seconds` without a frame, after which a `stale` control is told and waits start over.

    After a failure no attempt is made before its wait is over; waits are doubled and get up to a tenth more
    by chance, so that many readers don't come back at once.
    """

    def __init__(self, options: dict) -> None:
        def function(name: str):
            module, _, attribute = options[name].partition(":")
            return getattr(importlib.import_module(module), attribute)

        self.connect = function("connect")
        self.send = function("send") if "send" in options else None
        self.assets = function("assets") if "assets" in options else None
        self.ping, self.stale = float(options.get("ping_seconds", 10)), float(options.get("stale_seconds", 30))
        self.clock, self.options, self.subscription = time.monotonic, options, Subscription()
        self.wait, self.blocked_until, self.pinged = FIRST_WAIT / 2, 0.0, None
        self.connected_at: float | None = None
        self.heard = self.clock()

    def initialOffset(self) -> dict:
        return {"read": 0}

    def _rows(self, at: int, frames: list[str]) -> list[tuple]:
        return [(at + i, time.time_ns(), time.monotonic_ns(), "pong" if f.strip().upper() == "PONG" else "frame", f) for i, f in enumerate(frames)]

    def _control(self, at: int, kind: str, text: str) -> tuple:
        return (at, time.time_ns(), time.monotonic_ns(), kind, text)

    def _keep_up(self, at: int) -> list[tuple]:
        """Sends what is due; control rows of changed subscriptions."""
        told = []
        if self.send and self.assets:
            messages = self.subscription.update(self.assets())
            for message in messages:
                self.send(message)
            if messages:
                told.append(self._control(at, "subscription_update", json.dumps({"revision": self.subscription.revision, "subscribed_asset_count": len(self.subscription.assets)})))
        if self.send and (self.pinged is None or self.clock() - self.pinged >= self.ping):
            self.send("PING")
            self.pinged = self.clock()
        return told

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        now, at, told = self.clock(), start["read"], []
        if now < self.blocked_until:
            return iter([]), start
        try:
            told += self._keep_up(at)
            frames = list(self.connect(at))
        except Exception as e:
            held = 0.0 if self.connected_at is None else now - self.connected_at
            self.wait = next_wait(self.wait, held)
            self.blocked_until, self.connected_at = now + self.wait * (1 + random.random() / 10), None
            self.subscription.assets, self.pinged = frozenset(), None  # a new connection is asked anew
            return iter([*told, self._control(at, "connection_error", f"{type(e).__name__}: {e}")]), start
        if self.connected_at is None:
            self.connected_at = now
            told.append(self._control(at, "connected", ""))
        if frames:
            self.heard = now
        elif now - self.heard >= self.stale:
            told.append(self._control(at, "stale", ""))
            self.heard, self.connected_at = now, None
            self.subscription.assets, self.pinged = frozenset(), None
        return iter([*told, *self._rows(at, frames)]), {"read": at + len(frames)}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        frames = list(self.connect(start["read"]))[: end["read"] - start["read"]]
        return iter(self._rows(start["read"], frames))


def records(frames: DataFrame, source: str = "market_ws", any_item: bool = False) -> DataFrame:
    """A JSON record per message: lists are flattened with their place, controls and what isn't JSON
    become records of their own. `any_item` lets elements of any type through, else only objects."""
    frame = F.try_parse_json("frame")
    listed = F.try_variant_get(frame, "$", "array<variant>")
    items = F.when(F.col("kind") != "frame", F.array(F.lit(None).cast("variant"))).when(listed.isNotNull(), listed).otherwise(F.array(frame))
    flat = frames.withColumn("frame_message_count", F.size(items)).select("*", F.posexplode(items).alias("frame_index", "item"))
    is_object = F.coalesce(F.startswith(F.schema_of_variant("item"), F.lit("OBJECT")), F.lit(False))
    kind: Column = (
        F.when(F.col("kind") != "frame", f"{source}_control")
        .when(F.col("item").isNull(), f"invalid_{source}")
        .when(F.lit(any_item) | is_object, source)
        .otherwise(f"invalid_{source}_item")
    )
    control = F.when(F.col("kind") != "frame", F.col("kind"))
    common = [kind.alias("record_type"), "received_at_ns", "received_monotonic_ns", F.lit(f"{source}-1").alias("connection_id"), "frame_index", "frame_message_count", control.alias("control_event")]
    payload = F.when(kind == source, F.col("item"))
    raw = F.when(F.startswith(kind, F.lit("invalid")), F.col("frame")).alias("raw")
    return flat.select("frame_at", F.to_json(F.struct(*common, payload.alias("payload"), raw)).alias("value"))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Feed)
