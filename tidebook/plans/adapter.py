"""A market feed made from the test tables: deterministic views in place of recorded archives."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_dir

#: Neighbouring events whose price changes make up one frame, and such blocks per archive.
BLOCK, BLOCKS = 4, 500
_written: dict[tuple[str, str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _kept(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """Where a table made of the test tables lies; it is written once per session and folder of tables."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
        write(path)
        _written[key] = path
    return _written[key]


def market_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as a recorded feed of market events, a table that stands for what an ingest has left."""
    made = _market_events(spark, sf_dir)
    path = _kept(spark, sf_dir, "events", lambda path: made.write.parquet(path))
    return spark.read.schema(made.schema).parquet(path)


def _market_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring price changes of an asset form frames of two."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    v = F.floor("value").cast("long")
    kind = (
        F.when((F.col("event_type") == "signup") & (k % 4 == 0), "book")
        .when(F.col("event_type") == "purchase", "last_trade_price")
        .when(F.col("event_type") == "view", "best_bid_ask")
        .when((F.col("event_type") == "error") & (k % 10 == 0), "tick_size_change")
        .otherwise("price_change")
    )
    top = F.col("event_type").isin("view", "click")
    rows = e.select(
        (F.col("event_id") + 1).alias("sequence"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("exchange_timestamp_ms"),
        F.concat(F.lit("A"), (F.col("user_id") % 40).cast("string")).alias("asset_id"),
        F.concat(F.lit("M"), (F.col("user_id") % 20).cast("string")).alias("market"),
        kind.alias("event_type"),
        F.when(v % 2 == 0, "BUY").otherwise("SELL").alias("side"),
        (F.when(v % 2 == 0, 40 + k % 12).otherwise(49 + k % 12) / F.lit(100.0)).alias("price"),
        ((v % 8) * 5).cast("double").alias("size"),
        F.when(top & (k % 3 == 0), (46 + k % 5) / F.lit(100.0)).alias("best_bid"),
        F.when(top & (k % 5 < 2), (50 + k % 4) / F.lit(100.0)).alias("best_ask"),
        F.when((F.col("event_type") == "error") & (k % 10 == 0), F.when(k % 20 == 0, 0.001).otherwise(0.01))
        .when((F.col("event_type") == "signup") & (k % 8 == 0), 0.01)
        .alias("tick_size"),
        k.alias("k"),
        v.alias("v"),
    )
    own = Window.partitionBy("asset_id").orderBy("sequence")
    change = F.col("event_type") == "price_change"
    island = F.sum(F.when(change, 0).otherwise(1)).over(own)
    rows = rows.withColumn("island", island)
    within = Window.partitionBy("asset_id", "island", change).orderBy("sequence")
    rows = rows.withColumn("place", F.row_number().over(within) - 1).withColumn("of", F.count("*").over(Window.partitionBy("asset_id", "island", change)))
    return (
        rows.withColumn("change_index", F.when(change, F.col("place") % 2).cast("int"))
        .withColumn("change_count", F.when(change, F.least(F.lit(2), F.col("of") - F.floor(F.col("place") / 2) * 2)).cast("int"))
        .drop("island", "place", "of")
    )


def book_levels(events: DataFrame) -> DataFrame:
    """Five levels on either side for each book event."""
    i = F.explode(F.sequence(F.lit(1), F.lit(5))).alias("i")
    books = events.filter("event_type = 'book'").select("sequence", "asset_id", i)
    side = F.explode(F.array(F.lit("BUY"), F.lit("SELL"))).alias("side")
    price = F.when(F.col("side") == "BUY", 50 - F.col("i")).otherwise(50 + F.col("i")) / F.lit(100.0)
    return books.select("sequence", "asset_id", side, "i").select("sequence", "asset_id", "side", price.alias("price"), (F.col("i") * 10).cast("double").alias("size"), (F.col("i") - 1).alias("source_rank"))


def markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markets from `part`: reward from the price, volume from the quantities that were sold."""
    volume = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("volume"))
    p = table(spark, sf_dir, "part").join(volume, F.col("p_partkey") == F.col("l_partkey"), "left")
    key = F.col("p_partkey").cast("string")
    tokens = F.when(F.col("p_partkey") % 7 == 0, F.array(F.concat(F.lit("y"), key))).when(F.col("p_partkey") % 11 == 0, F.array(F.concat(F.lit("y"), key), F.lit(""))).otherwise(F.array(F.concat(F.lit("y"), key), F.concat(F.lit("n"), key)))
    return p.select(
        F.col("p_partkey").alias("ord"),
        F.concat(F.lit("c"), key).alias("condition_id"),
        F.when(F.col("p_size") % 5 == 0, F.lit(None).cast("double")).otherwise(F.floor("p_retailprice") / 100).alias("total_daily_rate"),
        F.array((F.col("p_size") % 10).cast("string"), F.lit("1.5"), F.lit("x")).alias("rates"),
        F.coalesce("volume", F.lit(0.0)).alias("volume_24hr"),
        tokens.alias("tokens"),
    )


def feed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The market feed as recorded lines: part (archive), block, ord, sub (their order) and value.

    The price changes of `BLOCK` neighbouring events are one frame behind the block's other events. Before
    every tenth block stand a control record, a price topic and a discovery of one market.
    """
    e = market_events(spark, sf_dir).withColumn("block", F.floor((F.col("sequence")) / BLOCK))
    text = lambda c: F.col(c).cast("string").alias(c)
    prices = [text(c) for c in ("price", "size", "best_bid", "best_ask")]

    def side(way: int) -> F.Column:
        level = lambda i: F.struct(((50 + way * i) / F.lit(100.0)).cast("string").alias("price"), (i * 10).cast("double").cast("string").alias("size"))
        return F.when(F.col("event_type") == "book", F.transform(F.sequence(F.lit(1), F.lit(5)), level))

    def line(kind: str, received: F.Column, *fields: F.Column) -> F.Column:
        return F.to_json(F.struct(F.lit(kind).alias("record_type"), received.cast("long").alias("received_at_ns"), *fields)).alias("value")

    stamp = F.col("exchange_timestamp_ms")
    payload = F.struct("event_type", stamp.cast("string").alias("timestamp"), "market", "asset_id", "side", *prices, text("tick_size"), side(-1).alias("bids"), side(1).alias("asks"))
    plain = e.filter("event_type <> 'price_change'").select("block", F.lit(3).alias("ord"), F.col("sequence").alias("sub"), line("market_ws", (stamp + F.col("k")) * 1_000_000, payload.alias("payload")))
    frames = e.filter("event_type = 'price_change'").groupBy("block").agg(F.min("exchange_timestamp_ms").alias("at"), F.min("k").alias("k"), F.min("market").alias("market"), F.sort_array(F.collect_list(F.struct("sequence", "asset_id", "side", *prices))).alias("changes"))
    changes = F.transform("changes", lambda x: F.struct(*[x[c].alias(c) for c in ("asset_id", "side", "price", "size", "best_bid", "best_ask")]))
    frame = F.struct(F.lit("price_change").alias("event_type"), F.col("at").cast("string").alias("timestamp"), "market", changes.alias("price_changes"))
    framed = frames.select("block", F.lit(4).alias("ord"), F.lit(0).cast("long").alias("sub"), line("market_ws", (F.col("at") + F.col("k")) * 1_000_000, frame.alias("payload")))
    b = F.col("block")
    token = lambda side, name: F.struct(F.concat(F.lit(side), b.cast("string")).alias("token_id"), F.lit(name).alias("outcome"), ((b % 100) / F.lit(100.0)).cast("string").alias("price"))
    market = F.struct(F.concat(F.lit("c"), b.cast("string")).alias("condition_id"), (b % 90).alias("collector_daily_reward"), F.array(token("y", "Yes"), token("n", "No")).alias("tokens"))
    topic = F.struct(F.lit("prices").alias("topic"), F.struct(F.lit("coin").alias("symbol"), b.alias("timestamp"), b.cast("string").alias("value")).alias("payload"))
    extra = e.select("block").distinct().filter(b % 10 == 0)
    extras = [
        extra.select("block", F.lit(i).alias("ord"), F.lit(0).cast("long").alias("sub"), value)
        for i, value in enumerate((line("market_ws_control", b * 1_000_000, F.lit("connected").alias("control_event")), line("rtds", b * 1_000_000, topic.alias("payload")), line("rewarded_market_discovery", b * 1_000_000, F.array(market).alias("markets"))))
    ]
    lines = plain.unionByName(framed)
    for more in extras:
        lines = lines.unionByName(more)
    return lines.withColumn("part", F.lpad(F.floor(b / BLOCKS).cast("string"), 12, "0"))


def archives(spark: SparkSession, sf_dir: str) -> str:
    """A folder with the feed's lines as text files, one per part, written once per session and table."""
    lines = feed_lines(spark, sf_dir).repartition("part").sortWithinPartitions("part", "block", "ord", "sub")
    return _kept(spark, sf_dir, "feed", lambda path: lines.select("part", "value").write.partitionBy("part").text(path))
