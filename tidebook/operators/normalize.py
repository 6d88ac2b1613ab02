"""Raw records to typed events, book levels and markets."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.coerce import as_bool, as_double, as_long, as_text, at, canonical_json, first_present, first_truthy, is_truthy
from ..sources.archives import parsed, read_lines

MARKET_RECORDS = ("rewarded_market_discovery", "rewarded_market_universe")
FEED_RECORDS = ("market_ws", "rest_book_checkpoint")
TOPIC_RECORDS = ("sports_ws", "rtds")
ENVELOPE_LONGS = ("received_at_ns", "received_monotonic_ns", "subscription_revision")
ENVELOPE_INTS = ("frame_index", "frame_message_count")


def staged(rows: DataFrame, plain: list, values: dict[str, tuple[Column, Callable[[Column], Column]]], order: list[str] | None = None) -> DataFrame:
    """Looks the values up in one projection and coerces them in the next, so that an expression that a
    coercion uses several times is planned and run once."""
    first = rows.select(*plain, *[v.alias(f"__{name}") for name, (v, _) in values.items()])
    kept = [c for c in first.columns if not c.startswith("__")]
    return first.select(*kept, *[f(F.col(f"__{name}")).alias(name) for name, (_, f) in values.items()]).select(*(order or [*kept, *values]))


def _object(value: Column) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(value), F.lit("OBJECT")), F.lit(False))


def _list(value: Column) -> Column:
    """The elements of a list; null for anything else."""
    return F.try_variant_get(value, "$", "array<variant>")


#: What a line keeps on its way to events.
LINE_COLUMNS = ["source_file", "source_block", "source_line", "record", "record_type", "route", "event_type", "payload", "items", "assets"]


def routed_lines(records: DataFrame) -> DataFrame:
    """One row per record: route, event_type, the payload it is projected from, its items (a change frame's
    objects, else one null) and the assets that they name. Values are looked up in one projection and
    coerced in the next, so that none is looked up twice."""
    kind = F.coalesce("record_type", F.lit(""))
    places = [F.col(c) if c in records.columns else F.lit(0).alias(c) for c in ("source_file", "source_block", "source_line")]
    first = records.filter("record IS NOT NULL").select(*places, "record", "record_type", kind.alias("kind"), at(F.col("record"), "$.payload").alias("p"), at(F.col("record"), "$.control_event").alias("control"), at(F.col("record"), "$.record_type").alias("own"))
    p, k = F.col("p"), F.col("kind")
    looked = first.withColumns({"is_object": k.isin(*FEED_RECORDS, *TOPIC_RECORDS) & _object(p), "told": at(p, "$.event_type"), "t1": at(p, "$.type"), "t2": at(p, "$.topic"), "asset": at(p, "$.asset_id"), "own_asset": at(F.col("record"), "$.asset_id")})
    feed, topic, market = F.col("is_object") & k.isin(*FEED_RECORDS), F.col("is_object") & k.isin(*TOPIC_RECORDS), k.isin(*MARKET_RECORDS)
    named = F.when(feed, F.col("told")).when(topic, first_present(F.col("told"), F.col("t1"), F.col("t2"), F.col("own"))).otherwise(first_present(F.col("control"), F.col("own"), F.parse_json(F.lit('"unknown_record"'))))
    asset = F.when(feed | topic, F.col("asset")).otherwise(F.col("own_asset"))
    looked = looked.select(*first.columns, "is_object", named.alias("named"), asset.alias("asset"))
    text = as_text(F.col("named"))
    typed = looked.withColumn("text", text).withColumn("asset", as_text(F.col("asset")))
    own_type = F.when(k == "rest_book_checkpoint", "book").otherwise(F.coalesce(F.nullif("text", F.lit("")), F.lit("unknown")))
    typed = typed.withColumn("event_type", F.when(market, k).when(feed, own_type).otherwise(F.col("text")))
    typed = typed.withColumn("route", F.when(market, "market").when(feed & (F.col("event_type") == "price_change"), "change").when(feed, "feed").when(topic, "topic").otherwise("other"))
    typed = typed.withColumn("payload", F.when(F.col("is_object"), p).otherwise(F.col("record")))
    change = F.col("route") == "change"
    # a change frame gives a row per object in it, and none if there isn't one; all else gives a row
    listed = typed.withColumn("list", F.when(change, _list(at(F.col("payload"), "$.price_changes"))))
    items = F.when(change, F.filter(F.coalesce("list", F.array().cast("array<variant>")), _object)).otherwise(F.array(F.parse_json(F.lit("null"))))
    listed = listed.withColumn("items", items)
    named = listed.withColumn("named", F.when(change, F.transform("items", lambda x: at(x, "$.asset_id"))).otherwise(F.array(F.lit(None).cast("variant"))))
    assets = F.when(change, F.transform("named", as_text)).otherwise(F.array("asset"))
    return named.withColumn("assets", assets).select(*LINE_COLUMNS)


def exploded(lines: DataFrame) -> DataFrame:
    """One row per item of `routed_lines`, with its place, asset and place among the frame's changes of it."""
    places = [c for c in lines.columns if c not in ("items", "assets")]
    rows = lines.select(*places, "assets", F.posexplode("items").alias("pos", "item")).withColumn("asset_id", F.get("assets", F.col("pos")))
    change = F.col("route") == "change"
    same = lambda ids: F.size(F.filter(ids, lambda x: x == F.col("asset_id")))
    index, count = same(F.slice("assets", 1, F.col("pos"))), same(F.col("assets"))
    return rows.withColumns({"change_index": F.when(change, index), "change_count": F.when(change, count)}).drop("assets")


def routed(records: DataFrame) -> DataFrame:
    """One row per event: its record, the payload it is projected from, event_type, frame places."""
    return exploded(routed_lines(records))


def invalid_items(records: DataFrame) -> Column:
    """How many parts of a record can't be used: change frames that aren't lists, elements that aren't
    objects, levels without a sound price and size, markets that aren't objects."""
    payload, kind = at(F.col("record"), "$.payload"), F.coalesce(F.col("record_type"), F.lit(""))
    feed = kind.isin(*FEED_RECORDS) & _object(payload)

    def bad(value: Column, sound) -> Column:
        items = _list(value)
        return F.when(~is_truthy(value), 0).when(items.isNull(), 1).otherwise(F.size(F.filter(items, lambda x: ~sound(x))))

    levels = bad(at(payload, "$.bids"), _sound_level) + bad(at(payload, "$.asks"), _sound_level)
    book = feed & ((kind == "rest_book_checkpoint") | (F.try_variant_get(payload, "$.event_type", "string") == "book"))
    change = feed & ~book & (F.try_variant_get(payload, "$.event_type", "string") == "price_change")
    return F.when(book, levels).when(change, bad(at(payload, "$.price_changes"), _object)).when(kind.isin(*MARKET_RECORDS), bad(at(F.col("record"), "$.markets"), _object)).otherwise(0)


def _sound_level(x: Column) -> Column:
    price, size = as_double(at(x, "$.price")), as_double(at(x, "$.size"))
    return F.coalesce(_object(x) & price.isNotNull() & (size >= 0), F.lit(False))


def with_sequence(lines: DataFrame, start: int = 0) -> DataFrame:
    """Rows of `exploded` with sequence: a gapless number in the order of files, lines and places.

    Items are summed up by block of a file first, so the global step sees one row per block (of 128 MB by
    default). Lines are dealt out by block since they were read, and stay where they are.
    """
    sized = lines.withColumn("line_items", F.size("items"))
    blocks = sized.groupBy("source_file", "source_block").agg(F.sum("line_items").alias("n"))
    before = Window.orderBy("source_file", "source_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("source_file", "source_block", (F.lit(start) + F.coalesce(F.sum("n").over(before), F.lit(0).cast("long"))).alias("block_start"))
    own = Window.partitionBy("source_file", "source_block").orderBy("source_line").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("line_start", F.coalesce(F.sum("line_items").over(own), F.lit(0).cast("long"))).join(starts, ["source_file", "source_block"])
    rows = exploded(placed.drop("line_items").withColumn("first", F.col("block_start") + F.col("line_start")).drop("block_start", "line_start"))
    return rows.withColumn("sequence", F.col("first") + F.col("pos") + 1).drop("first")


EVENT_COLUMNS = (
    "sequence source_file source_line record_type data_source event_type received_at_ns received_monotonic_ns subscription_revision frame_index frame_message_count connection_id control_event checkpoint_id "
    "exchange_timestamp_ms capture_latency_ms market asset_id change_index change_count side price size best_bid best_ask spread tick_size last_trade_price fee_rate_bps transaction_hash book_hash symbol "
    "reference_value game_id slug status score period elapsed live ended payload_json"
).split()


def events(rows: DataFrame) -> DataFrame:
    """The events table, from `routed` rows with their sequence."""
    record, payload, change = F.col("record"), F.col("payload"), F.col("route") == "change"
    nested = at(payload, "$.payload")
    # fields of a change come from it, but market and timestamp from the frame
    field = lambda name: F.when(change, at(F.col("item"), f"$.{name}")).otherwise(at(payload, f"$.{name}"))
    framed = lambda name: at(payload, f"$.{name}")
    own = F.try_variant_get("item", "$", "map<string,variant>")
    laid = F.map_filter(F.create_map(*[x for n in ("event_type", "market", "timestamp") for x in (F.lit(n), framed(n))]), lambda _, v: v.isNotNull())
    merged = F.map_concat(F.map_filter(own, lambda k, _: ~F.array_contains(F.map_keys(laid), k)), laid)
    merged = F.map_from_entries(F.transform(F.array_sort(F.map_keys(merged)), lambda k: F.struct(k, merged[k])))
    as_int = lambda v: as_long(v).cast("int")
    values: dict[str, tuple[Column, Callable[[Column], Column]]] = {c: (at(record, f"$.{c}"), as_long) for c in ENVELOPE_LONGS}
    values |= {c: (at(record, f"$.{c}"), as_int) for c in ENVELOPE_INTS}
    values |= {c: (at(record, f"$.{c}"), as_text) for c in ("connection_id", "control_event", "checkpoint_id")}
    values["exchange_timestamp_ms"] = (first_present(framed("timestamp"), F.when(~change, at(nested, "$.timestamp"))), as_long)
    values["market"] = (first_truthy(framed("market"), field("condition_id"), field("slug")), as_text)
    values["side"] = (field("side"), lambda v: F.upper(as_text(v)))
    values |= {c: (field(c), as_double) for c in ("price", "size", "best_bid", "best_ask", "spread")}
    values["tick_size"] = (first_truthy(*map(field, ("tick_size", "new_tick_size", "order_price_min_tick_size"))), as_double)
    values["last_trade_price"] = (field("last_trade_price"), as_double)
    values["fee_rate_bps"] = (field("fee_rate_bps"), as_int)
    values |= {"transaction_hash": (field("transaction_hash"), as_text), "book_hash": (field("hash"), as_text)}
    values["symbol"] = (first_present(field("symbol"), at(nested, "$.symbol")), as_text)
    values["reference_value"] = (first_present(field("value"), at(nested, "$.value")), as_double)
    values["game_id"] = (first_present(field("gameId"), field("game_id")), as_text)
    values |= {c: (field(c), as_text) for c in ("slug", "status", "score", "period", "elapsed")}
    values |= {c: (field(c), as_bool) for c in ("live", "ended")}
    kind = F.coalesce("record_type", F.lit(""))
    text = F.when(change, F.to_json(merged)).otherwise(canonical_json(payload))
    out = staged(rows, ["sequence", "source_file", "source_line", kind.alias("record_type"), kind.alias("data_source"), "event_type", "asset_id", "change_index", "change_count", text.alias("payload_json")], values)
    latency = F.col("received_at_ns") / 1e6 - F.col("exchange_timestamp_ms")
    return out.withColumn("capture_latency_ms", latency).select(*EVENT_COLUMNS)


def levels(rows: DataFrame) -> DataFrame:
    """Depth levels of book events, in the order that they were sent in."""
    books = rows.filter("event_type = 'book' AND route = 'feed'")
    sides = F.array(*[F.struct(F.lit(side).alias("side"), F.coalesce(_list(at(F.col("payload"), f"$.{field}")), F.array().cast("array<variant>")).alias("items")) for field, side in (("bids", "BUY"), ("asks", "SELL"))])
    flat = books.select("sequence", "source_file", "source_line", "asset_id", as_long(at(F.col("payload"), "$.timestamp")).alias("exchange_timestamp_ms"), F.explode(sides).alias("s"))
    flat = flat.select("*", F.posexplode("s.items").alias("source_rank", "x"))
    return flat.filter(_sound_level(F.col("x"))).select("sequence", "source_file", "source_line", "exchange_timestamp_ms", "asset_id", "s.side", as_double(at(F.col("x"), "$.price")).alias("price"), as_double(at(F.col("x"), "$.size")).alias("size"), "source_rank")


# The columns of the markets table, and where each is looked for first, second, ...
# M market, R its current rewards, C its book settings, G its catalogue entry, E its event, F fee details.
MARKET_TEXTS = {
    "condition_id": "M.condition_id", "market_id": "M.market_id", "market_slug": "M.market_slug", "event_id": "M.event_id", "event_slug": "M.event_slug", "question": "M.question", "description": "G.description M.description",
    "category": "G.category E.category", "subcategory": "G.subcategory E.subcategory", "resolution_source": "G.resolutionSource G.resolution_source E.resolutionSource", "created_at": "M.created_at G.createdAt G.created_at",
    "start_date": "G.startDate G.start_date E.startDate", "end_date": "M.end_date G.endDate G.end_date E.endDate", "game_start_time": "C.gst G.gameStartTime G.game_start_time M.game_start_time", "group_item_title": "M.group_item_title",
}
MARKET_DOUBLES = {
    "daily_reward": "M.collector_daily_reward M.total_daily_rate R.total_daily_rate", "native_daily_rate": "R.native_daily_rate", "sponsored_daily_rate": "R.sponsored_daily_rate",
    "rewards_max_spread_cents": "M.rewards_max_spread R.rewards_max_spread", "rewards_min_size": "M.rewards_min_size R.rewards_min_size", "market_competitiveness": "M.market_competitiveness", "spread": "M.spread",
    "volume_24hr": "M.collector_volume_24hr M.volume_24hr", "one_day_price_change": "M.one_day_price_change", "minimum_order_size": "C.mos G.orderMinSize G.minimum_order_size", "minimum_tick_size": "C.mts G.orderPriceMinTickSize G.minimum_tick_size",
    "seconds_delay": "G.secondsDelay G.seconds_delay", "maker_base_fee_bps": "C.mbf G.makerBaseFee G.maker_base_fee", "taker_base_fee_bps": "C.tbf G.takerBaseFee G.taker_base_fee", "fee_rate": "F.r", "fee_exponent": "F.e", "minimum_order_age_seconds": "C.oas",
}
MARKET_BOOLS = {
    "active": "G.active M.active", "closed": "G.closed M.closed", "archived": "G.archived M.archived", "accepting_orders": "G.acceptingOrders G.accepting_orders M.accepting_orders",
    "enable_order_book": "G.enableOrderBook G.enable_order_book M.enable_order_book", "neg_risk": "G.negRisk G.neg_risk M.neg_risk", "fees_enabled": "G.feesEnabled G.fees_enabled", "fee_taker_only": "F.to", "rfq_enabled": "C.rfqe G.rfqEnabled",
    "taker_order_delay_enabled": "C.itode", "blockaid_check_enabled": "C.ibce",
}


def markets(rows: DataFrame) -> DataFrame:
    """One row per market and token of each discovery; a market without tokens gives one row."""
    found = rows.filter("route = 'market'").select("sequence", "record", "event_type", F.posexplode(F.coalesce(_list(at(F.col("record"), "$.markets")), F.array().cast("array<variant>"))).alias("market_index", "M")).filter(_object(F.col("M")))
    m = F.col("M")
    found = found.withColumns({"R": at(m, "$.current_rewards"), "C": at(m, "$.clob_market_info"), "G": at(m, "$.gamma_market"), "E0": at(m, "$.gamma_event")})
    events_of = F.filter(F.coalesce(_list(at(F.col("G"), "$.events")), F.array().cast("array<variant>")), _object)
    found = found.withColumns({"E": F.when(is_truthy(F.col("E0")), F.col("E0")).otherwise(F.get(events_of, F.lit(0))), "F": at(F.col("C"), "$.fd")}).drop("E0")
    tokens = _list(at(m, "$.tokens"))
    found = found.withColumn("tokens", F.when(F.size(F.coalesce(tokens, F.array().cast("array<variant>"))) > 0, F.filter(tokens, _object)).otherwise(F.array(F.parse_json(F.lit("{}")))))
    found = found.select("*", F.posexplode("tokens").alias("token_index", "T")).drop("tokens")
    look = lambda spec: [at(F.col(s[0]), "$." + s[2:]) for s in spec.split()]
    t = F.col("T")
    tags = first_present(at(F.col("G"), "$.tags"), at(F.col("E"), "$.tags"), at(m, "$.tags"))
    as_json = lambda v: F.coalesce(canonical_json(v), F.lit(""))
    values: dict[str, tuple[Column, Callable[[Column], Column]]] = {"received_at_ns": (at(F.col("record"), "$.received_at_ns"), as_long)}
    values |= {name: (first_present(*look(spec)), as_text) for name, spec in MARKET_TEXTS.items()}
    values["tags_json"] = (tags, as_json)
    values |= {"token_id": (at(t, "$.token_id"), as_text), "outcome": (at(t, "$.outcome"), as_text), "token_price": (at(t, "$.price"), as_double), "winner": (at(t, "$.winner"), as_bool)}
    values |= {name: (first_present(*look(spec)), as_double) for name, spec in MARKET_DOUBLES.items()}
    values["sponsors_count"] = (at(F.col("R"), "$.sponsors_count"), lambda v: as_long(v).cast("int"))
    values |= {name: (first_present(*look(spec)), as_bool) for name, spec in MARKET_BOOLS.items()}
    rewards, fees = at(F.col("C"), "$.r"), F.col("F")
    values |= {"clob_rewards_json": (F.when(_object(rewards), rewards), as_json), "fee_details_json": (F.when(is_truthy(fees), fees), as_json), "market_json": (m, canonical_json)}
    plain = [F.col("sequence").alias("discovery_sequence"), F.col("event_type").alias("discovery_record_type"), (F.col("event_type") == MARKET_RECORDS[0]).alias("is_selected")]
    out = staged(found, [*plain, "market_index", "token_index"], values)
    # fees count as enabled if nothing says so but their rate is known
    enabled = F.coalesce("fees_enabled", F.col("fee_rate") > 0)
    order = [c for c in out.columns if c not in ("market_index", "token_index")]
    return out.withColumn("fees_enabled", enabled).select(*order, "market_index", "token_index")


@dataclass
class Normalized:
    records: DataFrame
    events: DataFrame
    levels: DataFrame
    markets: DataFrame
    shared: DataFrame

    def release(self) -> None:
        """Drops what the tables share; they are computed anew if they are read again."""
        self.shared.unpersist()


def normalize(spark, paths: list[str], sequence_start: int = 0) -> Normalized:
    """All tables of a set of archives; events are numbered in the order of files and lines."""
    return normalize_lines(read_lines(spark, paths), sequence_start)


def normalize_lines(lines: DataFrame, sequence_start: int = 0) -> Normalized:
    records = parsed(lines)
    # parsed once for the numbers and the three tables; what an executor loses is computed anew
    shared = routed_lines(records).persist()
    rows = with_sequence(shared, sequence_start)
    return Normalized(records, events(rows), levels(rows), markets(rows), shared)
