"""Every query of the engine over the test tables, each with SQL for DuckDB where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import coerce, market_math as m
from ..operators import backtest, book, discovery, normalize, quality
from .adapter import archives, book_levels, market_events, markets, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The adapter's views once more, for DuckDB.
EVENTS_SQL = """
  raw AS (
    SELECT event_id + 1 AS sequence, epoch_us(ts) // 1000 AS exchange_timestamp_ms, 'A' || (user_id % 40) AS asset_id, 'M' || (user_id % 20) AS market,
           event_type AS et, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(floor(value) AS BIGINT) AS v
    FROM events),
  typed AS (
    SELECT sequence, exchange_timestamp_ms, asset_id, market, k, v,
           CASE WHEN et = 'signup' AND k % 4 = 0 THEN 'book' WHEN et = 'purchase' THEN 'last_trade_price' WHEN et = 'view' THEN 'best_bid_ask'
                WHEN et = 'error' AND k % 10 = 0 THEN 'tick_size_change' ELSE 'price_change' END AS event_type,
           CASE WHEN v % 2 = 0 THEN 'BUY' ELSE 'SELL' END AS side,
           CASE WHEN v % 2 = 0 THEN 40 + k % 12 ELSE 49 + k % 12 END / 100.0::DOUBLE AS price,
           ((v % 8) * 5)::DOUBLE AS size,
           CASE WHEN et IN ('view', 'click') AND k % 3 = 0 THEN (46 + k % 5) / 100.0::DOUBLE END AS best_bid,
           CASE WHEN et IN ('view', 'click') AND k % 5 < 2 THEN (50 + k % 4) / 100.0::DOUBLE END AS best_ask,
           CASE WHEN et = 'error' AND k % 10 = 0 THEN CASE WHEN k % 20 = 0 THEN 0.001 ELSE 0.01 END::DOUBLE WHEN et = 'signup' AND k % 8 = 0 THEN 0.01::DOUBLE END AS tick_size
    FROM raw),
  islands AS (
    SELECT *, sum(CASE WHEN event_type = 'price_change' THEN 0 ELSE 1 END) OVER (PARTITION BY asset_id ORDER BY sequence) AS island FROM typed),
  placed AS (
    SELECT *, row_number() OVER (PARTITION BY asset_id, island, event_type = 'price_change' ORDER BY sequence) - 1 AS place,
           count(*) OVER (PARTITION BY asset_id, island, event_type = 'price_change') AS of_all FROM islands),
  m AS (
    SELECT * EXCLUDE (island, place, of_all),
           CASE WHEN event_type = 'price_change' THEN place % 2 END::INTEGER AS change_index,
           CASE WHEN event_type = 'price_change' THEN least(2, of_all - place // 2 * 2) END::INTEGER AS change_count
    FROM placed),
  lv AS (
    SELECT sequence, asset_id, s.side, CASE WHEN s.side = 'BUY' THEN 50 - i ELSE 50 + i END / 100.0::DOUBLE AS price, (i * 10)::DOUBLE AS size, (i - 1)::INTEGER AS source_rank
    FROM m, (SELECT unnest(range(1, 6)) AS i) t, (SELECT unnest(['BUY', 'SELL']) AS side) s WHERE event_type = 'book')"""

ANNOTATED_SQL = EVENTS_SQL + """,
  a0 AS (
    SELECT *, sum(CASE WHEN event_type = 'book' THEN 1 ELSE 0 END) OVER w AS epoch,
           last_value(CASE WHEN event_type = 'book' THEN nullif(tick_size, 0) WHEN event_type = 'tick_size_change' THEN tick_size END IGNORE NULLS) OVER w AS tick_state
    FROM m WINDOW w AS (PARTITION BY asset_id ORDER BY sequence ROWS UNBOUNDED PRECEDING)),
  a AS (
    SELECT *, coalesce(nullif(tick_state, 0), 0.001) / 2 + 1e-12 AS tol,
           event_type <> 'price_change' OR (side IN ('BUY', 'SELL') AND price IS NOT NULL AND size >= 0) AS valid,
           event_type <> 'price_change' OR change_index IS NULL OR change_index + 1 >= change_count AS final
    FROM a0),
  writes AS (
    SELECT asset_id, epoch, side, price, size, sequence AS start, 0 AS rank FROM a WHERE epoch > 0 AND event_type = 'price_change' AND valid
    UNION ALL
    SELECT lv.asset_id, a.epoch, lv.side, lv.price, lv.size, lv.sequence, source_rank FROM lv JOIN a USING (sequence)),
  spans AS (
    SELECT *, lead(start) OVER (PARTITION BY asset_id, epoch, side, price ORDER BY start, rank) AS next FROM writes),
  iv AS (
    SELECT s.asset_id, s.epoch, s.side, s.price, s.size, s.start, s.next, min(p.sequence) AS cut
    FROM spans s LEFT JOIN a p ON p.asset_id = s.asset_id AND p.epoch = s.epoch AND p.valid AND p.final AND p.sequence >= s.start
         AND (s.next IS NULL OR p.sequence < s.next) AND CASE WHEN s.side = 'BUY' THEN s.price > p.best_bid + p.tol ELSE s.price < p.best_ask - p.tol END
    WHERE s.size > 0 GROUP BY ALL),
  live AS (SELECT * EXCLUDE (next), coalesce(least(next, cut), 9223372036854775807) AS stop FROM iv),
  pts AS (SELECT * FROM a WHERE epoch > 0 AND event_type <> 'best_bid_ask' AND valid AND final)"""

STATE_SQL = ANNOTATED_SQL + """,
  at_points AS (
    SELECT p.sequence, l.side, l.price, l.size, row_number() OVER (PARTITION BY p.sequence, l.side ORDER BY CASE WHEN l.side = 'BUY' THEN -l.price ELSE l.price END) AS rn
    FROM pts p JOIN live l ON l.asset_id = p.asset_id AND l.epoch = p.epoch AND l.start <= p.sequence AND p.sequence < l.stop),
  st AS (
    SELECT p.sequence, p.asset_id, max(price) FILTER (side = 'BUY') AS book_bid, min(price) FILTER (side = 'SELL') AS book_ask,
           coalesce(sum(size) FILTER (side = 'BUY' AND rn <= 1), 0) AS bid_depth_1, coalesce(sum(size) FILTER (side = 'SELL' AND rn <= 1), 0) AS ask_depth_1,
           coalesce(sum(size) FILTER (side = 'BUY' AND rn <= 5), 0) AS bid_depth_5, coalesce(sum(size) FILTER (side = 'SELL' AND rn <= 5), 0) AS ask_depth_5,
           coalesce(sum(size) FILTER (side = 'BUY' AND rn <= 10), 0) AS bid_depth_10, coalesce(sum(size) FILTER (side = 'SELL' AND rn <= 10), 0) AS ask_depth_10
    FROM (SELECT sequence, asset_id FROM pts) p LEFT JOIN (SELECT sequence, side, price, size, rn FROM at_points) x USING (sequence) GROUP BY ALL)"""


# The lines of `adapter.feed_lines` as events, numbered in their order.
FEED_SQL = EVENTS_SQL + """,
  blk AS (SELECT *, sequence // 4 AS block FROM m),
  tenth AS (SELECT DISTINCT block FROM blk WHERE block % 10 = 0),
  rec AS (
    SELECT block, 3 AS ord, sequence AS sub, CASE WHEN event_type = 'book' THEN sequence END AS book, 'feed' AS route, event_type, asset_id, side, price, size, best_bid, best_ask, tick_size, exchange_timestamp_ms AS ts, (exchange_timestamp_ms + k) * 1000000 AS received,
           NULL::INTEGER AS change_index, NULL::INTEGER AS change_count
    FROM blk WHERE event_type <> 'price_change'
    UNION ALL
    SELECT block, 4, sequence, NULL, 'change', event_type, asset_id, side, price, size, best_bid, best_ask, NULL, min(exchange_timestamp_ms) OVER b, (min(exchange_timestamp_ms) OVER b + min(k) OVER b) * 1000000,
           (row_number() OVER (PARTITION BY block, asset_id ORDER BY sequence) - 1)::INTEGER, (count(*) OVER (PARTITION BY block, asset_id))::INTEGER
    FROM blk WHERE event_type = 'price_change' WINDOW b AS (PARTITION BY block)
    UNION ALL
    SELECT block, o, 0, NULL, r, t, '', '', NULL, NULL, NULL, NULL, NULL, CASE WHEN o = 1 THEN block END, block * 1000000, NULL, NULL
    FROM tenth, (VALUES (0, 'other', 'connected'), (1, 'topic', 'prices'), (2, 'market', 'rewarded_market_discovery')) x(o, r, t)),
  fe AS (
    SELECT *, row_number() OVER (ORDER BY block, ord, sub) AS seq, received / 1e6 - ts AS capture_latency_ms,
           dense_rank() OVER (PARTITION BY block // 500 ORDER BY block, ord, CASE WHEN ord = 3 THEN sub ELSE 0 END) AS line
    FROM rec)"""


def _recorded(spark: SparkSession, sf_dir: str):
    """The feed, written as archives and read back through the whole ingest."""
    return normalize.normalize(spark, [archives(spark, sf_dir)])


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _feed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = market_events(spark, sf_dir)
    return events, book_levels(events)


# counts and coercions ------------------------------------------------------------------------------


@query(f"WITH {EVENTS_SQL} SELECT event_type, count(*) AS n FROM m GROUP BY 1")
def event_type_counts(spark, sf_dir):
    return quality.type_counts(market_events(spark, sf_dir))


_COLUMNS = ["asset_id", "event_type", "side", "price", "size", "best_bid", "best_ask", "tick_size", "change_index", "change_count", "capture_latency_ms"]


@query(f"WITH {FEED_SQL} SELECT seq AS sequence, ts AS exchange_timestamp_ms, {', '.join(_COLUMNS)} FROM fe")
def events_projection(spark, sf_dir):
    return _recorded(spark, sf_dir).events.select("sequence", "exchange_timestamp_ms", *_COLUMNS)


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k_double, json_extract_string(props, '$.k') <> '0' AS k_bool, CASE WHEN json_extract_string(props, '$.k') = '0' THEN '' ELSE json_extract_string(props, '$.k') END AS k_text FROM events")
def json_props_extract(spark, sf_dir):
    v = coerce.at(F.try_parse_json("props"), "$.k")
    return table(spark, sf_dir, "events").select("event_id", coerce.as_long(v).alias("k"), coerce.as_double(v).alias("k_double"), coerce.as_bool(v).alias("k_bool"), coerce.as_text(v).alias("k_text"))


@query(f"WITH {EVENTS_SQL} SELECT sequence, asset_id, event_type, price, size, best_bid FROM m")
def raw_json_roundtrip(spark, sf_dir):
    from ..sources.archives import parsed

    e = market_events(spark, sf_dir)
    text = F.to_json(F.struct("sequence", "asset_id", "event_type", F.col("price").cast("string").alias("price"), "size", "best_bid"))
    record = F.col("record")
    rows = parsed(e.select(text.alias("value")), "value").filter("record IS NOT NULL")
    return rows.select(*[f(coerce.at(record, f"$.{c}")).alias(c) for c, f in (("sequence", coerce.as_long), ("asset_id", coerce.as_text), ("event_type", coerce.as_text), ("price", coerce.as_double), ("size", coerce.as_double), ("best_bid", coerce.as_double))])


@query(f"WITH {FEED_SQL} SELECT route, event_type, count(*) AS n, count(DISTINCT asset_id) AS assets FROM fe GROUP BY 1, 2")
def route_events(spark, sf_dir):
    rows = normalize.exploded(_recorded(spark, sf_dir).shared)
    return rows.groupBy("route", "event_type").agg(F.count("*").alias("n"), F.count_distinct("asset_id").alias("assets"))


@query(f"WITH {FEED_SQL} SELECT seq AS sequence, fe.asset_id, lv.side, lv.price, lv.size, lv.source_rank FROM fe JOIN lv ON lv.sequence = fe.book")
def explode_levels(spark, sf_dir):
    return _recorded(spark, sf_dir).levels.select("sequence", "asset_id", "side", "price", "size", F.col("source_rank").cast("int").alias("source_rank"))


@query(f"WITH {FEED_SQL} SELECT seq AS sequence, asset_id, change_index, change_count FROM fe WHERE event_type = 'price_change'")
def price_change_index(spark, sf_dir):
    return _recorded(spark, sf_dir).events.filter("event_type = 'price_change'").select("sequence", "asset_id", "change_index", "change_count")


@query(f"WITH {FEED_SQL} SELECT seq AS sequence, line AS source_line, event_type, asset_id FROM fe")
def sequence_assign(spark, sf_dir):
    return _recorded(spark, sf_dir).events.select("sequence", "source_line", "event_type", "asset_id")


@query(f"""WITH {FEED_SQL} SELECT seq AS discovery_sequence, s || block AS token_id, o AS outcome, (block % 100) / 100.0::DOUBLE AS token_price, (block % 90)::DOUBLE AS daily_reward, 'c' || block AS condition_id, i AS token_index, TRUE AS is_selected
  FROM fe, (VALUES (0, 'y', 'Yes'), (1, 'n', 'No')) t(i, s, o) WHERE route = 'market'""")
def market_rows(spark, sf_dir):
    return _recorded(spark, sf_dir).markets.select("discovery_sequence", "token_id", "outcome", "token_price", "daily_reward", "condition_id", "token_index", "is_selected")


@query(f"""WITH {FEED_SQL} SELECT count(DISTINCT (block // 500, line)) AS raw_rows, 0::BIGINT AS invalid_json_rows, 0::BIGINT AS invalid_record_rows, count(*) AS event_rows, (SELECT count(*) FROM lv) AS level_rows, count(*) FILTER (route = 'market') * 2 AS market_rows,
  count(DISTINCT block // 500) AS input_files, 0::BIGINT AS duplicates FROM fe""")
def ingest_report(spark, sf_dir):
    t = _recorded(spark, sf_dir)
    return quality.report(t.events, t.records, t.levels, t.markets).select("raw_rows", "invalid_json_rows", "invalid_record_rows", "event_rows", "level_rows", "market_rows", "input_files", "duplicates")


# quality -------------------------------------------------------------------------------------------

_HOLES = "SELECT sequence, event_type, CASE WHEN k % 9 = 0 THEN '' ELSE asset_id END AS asset_id, CASE WHEN k % 5 = 0 THEN NULL ELSE price END AS price, CASE WHEN k % 6 = 0 THEN NULL ELSE size END AS size, CASE WHEN k % 8 = 0 THEN '' ELSE side END AS side FROM m"


@query(f"""WITH {EVENTS_SQL}, h AS ({_HOLES}), u AS (
  SELECT event_type || '.asset_id' AS field FROM h WHERE asset_id = '' UNION ALL
  SELECT event_type || '.price' FROM h WHERE price IS NULL AND event_type IN ('price_change', 'last_trade_price') UNION ALL
  SELECT event_type || '.size' FROM h WHERE size IS NULL AND event_type IN ('price_change', 'last_trade_price') UNION ALL
  SELECT event_type || '.side' FROM h WHERE side = '' AND event_type IN ('price_change', 'last_trade_price'))
  SELECT field, count(*) AS n FROM u GROUP BY 1""")
def missing_required(spark, sf_dir):
    e = market_events(spark, sf_dir)
    k = F.col("k")
    holes = e.withColumns({"asset_id": F.when(k % 9 == 0, "").otherwise(F.col("asset_id")), "price": F.when(k % 5 != 0, F.col("price")), "size": F.when(k % 6 != 0, F.col("size")), "side": F.when(k % 8 == 0, "").otherwise(F.col("side"))})
    return quality.missing_required(holes)


@query("SELECT count(*) AS rows, count(DISTINCT coalesce(text, '')) AS distinct_rows, count(*) - count(DISTINCT coalesce(text, '')) AS duplicates FROM documents")
def duplicate_count(spark, sf_dir):
    return quality.duplicate_count(table(spark, sf_dir, "documents"), "text")


_JITTER = "SELECT sequence, 'c' || (v % 3) AS connection_id, asset_id, exchange_timestamp_ms - CASE WHEN k % 13 = 0 THEN 90000000 ELSE 0 END AS exchange_timestamp_ms FROM m"


@query(f"""WITH {EVENTS_SQL}, j AS ({_JITTER}), w AS (
  SELECT *, max(exchange_timestamp_ms) OVER (PARTITION BY connection_id, asset_id ORDER BY sequence ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest FROM j)
  SELECT sequence, connection_id, asset_id, latest - exchange_timestamp_ms AS behind_ms FROM w WHERE exchange_timestamp_ms < latest""")
def timestamp_regressions(spark, sf_dir):
    e = market_events(spark, sf_dir)
    late = F.when(F.col("k") % 13 == 0, 90_000_000).otherwise(0)
    e = e.withColumns({"connection_id": F.concat(F.lit("c"), (F.col("v") % 3).cast("string")), "exchange_timestamp_ms": F.col("exchange_timestamp_ms") - late})
    return quality.timestamp_regressions(e)


@query(f"WITH {EVENTS_SQL} SELECT count(*) FILTER (k % 7 - 3 < -1) AS negative_latencies FROM m")
def negative_latency(spark, sf_dir):
    return quality.negative_latencies(market_events(spark, sf_dir).withColumn("capture_latency_ms", (F.col("k") % 7 - 3).cast("double")))


@query(f"""WITH {EVENTS_SQL}, w AS (SELECT asset_id, exchange_timestamp_ms - max(exchange_timestamp_ms) OVER (PARTITION BY asset_id ORDER BY sequence ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS gap FROM m)
  SELECT asset_id, count(*) AS gaps, max(gap) AS max_gap_ms FROM w WHERE gap > 120000 GROUP BY 1""")
def gap_stats_by_asset(spark, sf_dir):
    return book.gap_stats(market_events(spark, sf_dir))


_DAYS = "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2"


@query(f"WITH d AS ({_DAYS}) SELECT key, sum(n)::BIGINT AS value, (SELECT sum(n) FROM d)::BIGINT AS event_rows FROM (SELECT event_type AS key, n FROM d) GROUP BY 1")
def quality_summary_merge(spark, sf_dir):
    days = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("n"))
    reports = days.groupBy("day").agg(F.sum("n").alias("event_rows"), F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("event_types"))
    merged = quality.merge_summaries(reports, ["event_rows"], ["event_types"])
    return merged.select("event_rows", F.explode("event_types").alias("key", "value"))


# markets -------------------------------------------------------------------------------------------

MARKETS_SQL = """
  vol AS (SELECT l_partkey, sum(l_quantity) AS volume FROM lineitem GROUP BY 1),
  mk AS (
    SELECT p_partkey AS ord, 'c' || p_partkey AS condition_id, CASE WHEN p_size % 5 = 0 THEN NULL ELSE floor(p_retailprice) / 100 END AS total, coalesce(volume, 0) AS volume_24hr,
           CASE WHEN p_size % 5 = 0 THEN (p_size % 10) + 1.5 ELSE floor(p_retailprice) / 100 END AS daily_reward,
           CASE WHEN p_partkey % 7 = 0 THEN ['y' || p_partkey] WHEN p_partkey % 11 = 0 THEN ['y' || p_partkey, ''] ELSE ['y' || p_partkey, 'n' || p_partkey] END AS tokens
    FROM part LEFT JOIN vol ON l_partkey = p_partkey),
  sel AS (SELECT * FROM mk WHERE len(list_filter(tokens, lambda t: t <> '')) >= 2 AND daily_reward >= 5 AND volume_24hr >= 100 ORDER BY daily_reward DESC, volume_24hr DESC, ord LIMIT 75)"""


def _markets(spark, sf_dir):
    return markets(spark, sf_dir).withColumn("daily_reward", discovery.daily_reward(F.col("total_daily_rate"), F.col("rates")))


@query(f"WITH {MARKETS_SQL} SELECT condition_id, daily_reward FROM mk")
def daily_reward(spark, sf_dir):
    return _markets(spark, sf_dir).select("condition_id", "daily_reward")


@query(f"WITH {MARKETS_SQL} SELECT condition_id, daily_reward, volume_24hr FROM sel")
def select_markets(spark, sf_dir):
    return discovery.select_markets(_markets(spark, sf_dir), 75, 5, 100).select("condition_id", "daily_reward", "volume_24hr")


@query(f"WITH {MARKETS_SQL} SELECT t AS asset_id, row_number() OVER (ORDER BY daily_reward DESC, volume_24hr DESC, ord, p)::INTEGER AS place FROM (SELECT *, unnest(tokens) AS t, generate_subscripts(tokens, 1) AS p FROM sel)")
def selected_assets(spark, sf_dir):
    return discovery.selected_assets(discovery.select_markets(_markets(spark, sf_dir), 75, 5, 100))


@query(f"""WITH {MARKETS_SQL}, rich AS (SELECT * FROM mk WHERE volume_24hr > 700), rew AS (SELECT ord, condition_id, total + 1 AS total FROM mk WHERE daily_reward < 12)
  SELECT condition_id, coalesce(rew.total, rich.total) AS total_daily_rate, coalesce(rich.volume_24hr, 0) AS volume_24hr, coalesce(rich.ord, rew.ord) AS ord, array_to_string(rich.tokens, ',') AS tokens, rich.ord IS NULL AS metadata_incomplete FROM rich FULL JOIN rew USING (condition_id)""")
def universe_merge(spark, sf_dir):
    return _universe(spark, sf_dir).select("condition_id", "total_daily_rate", "volume_24hr", "ord", F.array_join("tokens", ",").alias("tokens"), "metadata_incomplete")


def _universe(spark, sf_dir):
    rows = _markets(spark, sf_dir)
    rewards = rows.filter("daily_reward < 12").select("condition_id", "ord", (F.col("total_daily_rate") + 1).alias("total_daily_rate"))
    return discovery.merge_universe(rows.filter("volume_24hr > 700"), rewards)


@query(f"""WITH {MARKETS_SQL}, rich AS (SELECT * FROM mk WHERE volume_24hr > 700), rew AS (SELECT condition_id FROM mk WHERE daily_reward < 12), u AS (SELECT rich.ord, rich.tokens FROM rich FULL JOIN rew USING (condition_id))
  SELECT count(*) AS market_count, count(*) FILTER (len(list_filter(tokens, lambda t: t <> '')) >= 2) AS candidate_count, count(*) FILTER (ord IS NULL) AS sponsored_count, count(*) FILTER (ord IS NULL) = 0 AS complete FROM u""")
def universe_coverage(spark, sf_dir):
    return discovery.coverage(_universe(spark, sf_dir))


@query("""WITH s AS (SELECT 'T' || (o_custkey % 500) AS token_id, o_orderkey AS ord, epoch_us(o_orderdate) // 1000000 * 1000000000 AS received_at_ns, o_totalprice AS tick FROM orders)
  SELECT token_id, received_at_ns, tick FROM s QUALIFY row_number() OVER (PARTITION BY token_id ORDER BY received_at_ns DESC, ord) = 1""")
def market_settings_latest(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    seen = o.select(F.concat(F.lit("T"), (F.col("o_custkey") % 500).cast("string")).alias("token_id"), F.col("o_orderkey").alias("ord"), (F.unix_timestamp(F.col("o_orderdate").cast("timestamp")) * 1_000_000_000).alias("received_at_ns"), F.col("o_totalprice").alias("tick"))
    return discovery.latest_settings(seen).select("token_id", "received_at_ns", "tick")


@query(f"WITH {EVENTS_SQL} SELECT asset_id, count(*) FILTER (event_type = 'book') AS books, count(*) FILTER (event_type = 'last_trade_price') AS trades FROM m GROUP BY 1")
def asset_book_trade_counts(spark, sf_dir):
    return discovery.asset_counts(market_events(spark, sf_dir))


@query(f"WITH {EVENTS_SQL}, c AS (SELECT asset_id, count(*) FILTER (event_type = 'book') AS books, count(*) FILTER (event_type = 'last_trade_price') AS trades FROM m GROUP BY 1) SELECT * FROM c WHERE books > 0 AND trades > 0 ORDER BY trades DESC, books DESC, asset_id DESC LIMIT 1")
def choose_asset(spark, sf_dir):
    return discovery.choose_asset(market_events(spark, sf_dir))


@query("""WITH c AS (SELECT DISTINCT 'T' || o_custkey AS a FROM orders WHERE o_orderstatus = 'F'), d AS (SELECT DISTINCT 'T' || o_custkey AS a FROM orders WHERE o_orderstatus = 'O')
  SELECT a AS asset_id, 'unsubscribe' AS action FROM (FROM c EXCEPT FROM d) UNION ALL SELECT a, 'subscribe' FROM (FROM d EXCEPT FROM c)""")
def subscription_diff(spark, sf_dir):
    """From the customers with finished orders to those with open ones."""
    orders = table(spark, sf_dir, "orders").withColumn("asset_id", F.concat(F.lit("T"), F.col("o_custkey").cast("string")))
    return discovery.subscription_diff(orders.filter("o_orderstatus = 'F'"), orders.filter("o_orderstatus = 'O'"))


@query("""WITH p AS (SELECT p_partkey, p_retailprice FROM part), e AS (SELECT l_partkey, sum(l_quantity) AS sold FROM lineitem WHERE l_quantity > 45 GROUP BY 1), s AS (SELECT l_partkey, min(l_suppkey) AS first_supplier FROM lineitem WHERE l_discount > 0.08 GROUP BY 1)
  SELECT p_partkey, sold, first_supplier, concat_ws(',', CASE WHEN sold IS NULL THEN 'sales' END, CASE WHEN first_supplier IS NULL THEN 'suppliers' END) AS errors FROM p LEFT JOIN e ON e.l_partkey = p_partkey LEFT JOIN s ON s.l_partkey = p_partkey""")
def enrich_markets(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").withColumnRenamed("l_partkey", "p_partkey")
    sales = line.filter("l_quantity > 45").groupBy("p_partkey").agg(F.sum("l_quantity").alias("sold"))
    suppliers = line.filter("l_discount > 0.08").groupBy("p_partkey").agg(F.min("l_suppkey").alias("first_supplier"))
    out = discovery.enrich(table(spark, sf_dir, "part").select("p_partkey"), {"sales": (sales, "p_partkey"), "suppliers": (suppliers, "p_partkey")})
    return out.select("p_partkey", "sales.sold", "suppliers.first_supplier", F.concat_ws(",", "enrichment_errors").alias("errors"))


_ARCHIVES = """
  d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders),
  l AS (SELECT CASE WHEN dayofmonth(day) % 5 = 0 THEN 'raw/feed one/extra-' || dayofmonth(day) || '-' || month(day) || '-' || year(day) || '.jsonl'
                    ELSE 'raw/feed/' || strftime(day, '%Y/%m/%d') || '/feed-' || strftime(day, '%Y%m%d') || 'T010000Z.jsonl.gz' END AS key FROM d
        UNION ALL SELECT 'analytics/x.jsonl' UNION ALL SELECT 'raw/readme.txt'),
  a AS (SELECT key, nullif(regexp_extract(key, '(\\d{8}T\\d{6})', 1), '') AS stamp,
               CASE WHEN regexp_matches(key, '\\d{4}/\\d{2}/\\d{2}') THEN replace(regexp_extract(key, '\\d{4}/\\d{2}/\\d{2}'), '/', '-') END AS date,
               regexp_replace(replace(regexp_replace(key, '\\.jsonl(\\.gz)?$', ''), '/', '__'), '[^A-Za-z0-9_.-]+', '_', 'g') AS stem FROM l)"""


def _listing(spark, sf_dir):
    day = F.col("day")
    text = lambda c: c.cast("string")
    odd = F.concat(F.lit("raw/feed one/extra-"), text(F.dayofmonth(day)), F.lit("-"), text(F.month(day)), F.lit("-"), text(F.year(day)), F.lit(".jsonl"))
    even = F.concat(F.lit("raw/feed/"), F.date_format(day, "yyyy/MM/dd"), F.lit("/feed-"), F.date_format(day, "yyyyMMdd"), F.lit("T010000Z.jsonl.gz"))
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return days.select(F.when(F.dayofmonth(day) % 5 == 0, odd).otherwise(even).alias("key")).unionByName(spark.createDataFrame([("analytics/x.jsonl",), ("raw/readme.txt",)], "key string"))


@query(f"WITH {_ARCHIVES} SELECT key, stamp, date, stem, lpad(CAST(length(key) AS VARCHAR), 20, '0') AS padded FROM a")
def archive_dates(spark, sf_dir):
    return discovery.archive_columns(_listing(spark, sf_dir)).select("key", "stamp", "date", "stem", F.lpad(F.length("key").cast("string"), 20, "0").alias("padded"))


@query(f"WITH {_ARCHIVES} SELECT key, stamp, date, stem FROM a WHERE regexp_matches(key, '\\.jsonl(\\.gz)?$') AND NOT starts_with(key, 'analytics/') AND length(key) % 3 <> 0 AND coalesce(stamp, '') NOT LIKE '%1T%' ORDER BY stamp IS NULL, stamp, key LIMIT 24")
def manifest_pending(spark, sf_dir):
    listing = _listing(spark, sf_dir)
    done = listing.filter((F.length("key") % 3 == 0) | F.regexp_extract("key", r"(\d{8}T\d{6})", 1).like("%1T%"))
    return discovery.pending_archives(listing, done)


# books ---------------------------------------------------------------------------------------------


@query(f"WITH {EVENTS_SQL} SELECT m.sequence, m.asset_id, lv.side, lv.price, lv.size FROM m LEFT JOIN lv USING (sequence) WHERE m.event_type IN ('book', 'tick_size_change')")
def levels_join(spark, sf_dir):
    e, lv = _feed(spark, sf_dir)
    return e.filter("event_type IN ('book', 'tick_size_change')").select("sequence", "asset_id").hint("merge").join(lv.select("sequence", F.col("side"), "price", "size"), "sequence", "left")


@query(f"WITH {ANNOTATED_SQL} SELECT sequence, tick_state, tol FROM a")
def tick_locf(spark, sf_dir):
    return book.annotate(market_events(spark, sf_dir)).select("sequence", "tick_state", "tol")


@query(f"WITH {ANNOTATED_SQL} SELECT sequence, epoch::BIGINT AS epoch FROM a")
def book_epochs(spark, sf_dir):
    return book.annotate(market_events(spark, sf_dir)).select("sequence", F.col("epoch").cast("long").alias("epoch"))


def _state(spark, sf_dir, top=20, keep=()):
    return book.book_states(*_feed(spark, sf_dir), top, keep)


@query(f"WITH {STATE_SQL} SELECT sequence, asset_id, book_bid, book_ask, (book_bid + book_ask) / 2 AS mid, book_ask - book_bid AS spread, coalesce(book_bid >= book_ask, FALSE) AS crossed FROM st")
def book_state_best(spark, sf_dir):
    return book.with_prices(_state(spark, sf_dir, 0)).select("sequence", "asset_id", "book_bid", "book_ask", "mid", "spread", "crossed")


@query(f"WITH {STATE_SQL} SELECT sequence, bid_depth_1, ask_depth_1, bid_depth_5, ask_depth_5, bid_depth_10, ask_depth_10 FROM st")
def book_depth(spark, sf_dir):
    return book.with_metrics(_state(spark, sf_dir, 10)).select("sequence", *[f"{s}_depth_{n}" for n in book.DEPTHS for s in ("bid", "ask")])


@query(f"WITH {STATE_SQL} SELECT sequence, CASE WHEN bid_depth_5 + ask_depth_5 > 0 THEN (bid_depth_5 - ask_depth_5) / (bid_depth_5 + ask_depth_5) END AS imbalance_5 FROM st")
def book_imbalance(spark, sf_dir):
    return book.with_metrics(_state(spark, sf_dir, 10)).select("sequence", "imbalance_5")


@query(f"""WITH {STATE_SQL}, t AS (SELECT sequence, string_agg('[' || price || ',' || size || ']', ',' ORDER BY rn) FILTER (side = 'BUY') AS b, string_agg('[' || price || ',' || size || ']', ',' ORDER BY rn) FILTER (side = 'SELL') AS s FROM at_points WHERE rn <= 3 GROUP BY 1)
  SELECT sequence, '[' || coalesce(b, '') || ']' AS bids_json, '[' || coalesce(s, '') || ']' AS asks_json FROM pts LEFT JOIN t USING (sequence)""")
def top_levels_json(spark, sf_dir):
    return book.with_metrics(_state(spark, sf_dir, 3), top=3).select("sequence", "bids_json", "asks_json")


_THROTTLED = STATE_SQL.replace("WITH ", "") + """,
  num AS (SELECT sequence, asset_id, exchange_timestamp_ms AS ts, event_type = 'book' AS is_book, row_number() OVER (PARTITION BY asset_id ORDER BY sequence) AS rn FROM pts),
  scan AS (
    SELECT asset_id, rn, sequence, ts AS last_emit, TRUE AS emitted, is_book FROM num WHERE rn = 1
    UNION ALL
    SELECT n.asset_id, n.rn, n.sequence, CASE WHEN n.is_book OR n.ts - s.last_emit >= 3600000 THEN n.ts ELSE s.last_emit END, n.is_book OR n.ts - s.last_emit >= 3600000, n.is_book
    FROM scan s JOIN num n ON n.asset_id = s.asset_id AND n.rn = s.rn + 1)"""


@query(f"WITH RECURSIVE {_THROTTLED} SELECT sequence, CASE WHEN is_book THEN 'book' ELSE 'interval' END AS reason, book_bid, book_ask, bid_depth_10, ask_depth_10 FROM scan JOIN st USING (sequence) WHERE emitted")
def book_snapshots_throttled(spark, sf_dir):
    e, lv = _feed(spark, sf_dir)
    return book.snapshots(e, lv, 3_600_000).select("sequence", "reason", "book_bid", "book_ask", "bid_depth_10", "ask_depth_10")


@query(f"WITH {ANNOTATED_SQL} SELECT cut AS sequence, count(*) AS levels_pruned FROM live WHERE cut IS NOT NULL GROUP BY 1")
def pruned_levels(spark, sf_dir):
    e, lv = _feed(spark, sf_dir)
    return book.states(book.annotate(e), lv, 0).filter("pruned > 0").select("sequence", F.col("pruned").cast("long").alias("levels_pruned"))


_SEEN = ANNOTATED_SQL + """,
  seen AS (SELECT * FROM a WHERE epoch > 0 AND valid AND final AND (best_bid IS NOT NULL OR best_ask IS NOT NULL)),
  own AS (SELECT s.sequence, max(l.price) FILTER (l.side = 'BUY') AS book_bid, min(l.price) FILTER (l.side = 'SELL') AS book_ask
          FROM seen s LEFT JOIN live l ON l.asset_id = s.asset_id AND l.epoch = s.epoch AND l.start <= s.sequence AND s.sequence < l.stop GROUP BY 1),
  offs AS (
    SELECT sequence, asset_id, event_type,
           best_bid IS NOT NULL AND CASE WHEN book_bid IS NULL THEN event_type = 'best_bid_ask' ELSE abs(best_bid - book_bid) > tol END AS bid_off,
           best_ask IS NOT NULL AND CASE WHEN book_ask IS NULL THEN event_type = 'best_bid_ask' ELSE abs(best_ask - book_ask) > tol END AS ask_off
    FROM seen JOIN own USING (sequence))"""


@query(f"WITH {_SEEN} SELECT * FROM offs")
def top_mismatches(spark, sf_dir):
    return book.mismatches(*_feed(spark, sf_dir))


@query(f"""WITH RECURSIVE {_SEEN}, {_THROTTLED[_THROTTLED.index("at_points AS"):]}
  SELECT (SELECT count(*) FROM m) AS events_seen, 0::BIGINT AS events_without_asset, (SELECT count(*) FROM a WHERE event_type = 'book') AS full_snapshots,
    (SELECT count(*) FROM a WHERE event_type = 'price_change' AND epoch = 0) AS changes_before_snapshot, (SELECT count(*) FROM a WHERE event_type = 'price_change' AND epoch > 0 AND valid) AS price_changes,
    (SELECT count(*) FROM a WHERE event_type = 'price_change' AND epoch > 0 AND NOT valid) AS invalid_price_changes, (SELECT count(*) FROM a WHERE event_type = 'tick_size_change') AS tick_size_changes,
    (SELECT count(*) FROM a WHERE event_type = 'last_trade_price') AS trades, (SELECT count(*) FROM a WHERE event_type = 'best_bid_ask' AND epoch > 0) AS top_notifications,
    (SELECT count(DISTINCT asset_id) FROM a WHERE event_type = 'book') AS assets_initialized,
    (SELECT count(*) FROM live WHERE cut IS NOT NULL) AS levels_pruned_by_authoritative_top, (SELECT count(DISTINCT cut) FROM live) AS authoritative_top_reconciliations,
    (SELECT count(*) FROM offs WHERE event_type = 'best_bid_ask' AND bid_off) AS top_notifications_awaiting_bid_level, (SELECT count(*) FROM offs WHERE event_type = 'best_bid_ask' AND ask_off) AS top_notifications_awaiting_ask_level,
    (SELECT count(*) FROM offs WHERE event_type <> 'best_bid_ask' AND bid_off) AS best_bid_mismatches, (SELECT count(*) FROM offs WHERE event_type <> 'best_bid_ask' AND ask_off) AS best_ask_mismatches,
    (SELECT count(*) FROM scan WHERE emitted) AS snapshots_written, (SELECT count(*) FROM scan JOIN st USING (sequence) WHERE emitted AND book_bid >= book_ask) AS crossed_snapshots""")
def reconstruct_counters(spark, sf_dir):
    return book.replay_counters(*_feed(spark, sf_dir), interval_ms=3_600_000)


# prices, rewards, simulation -----------------------------------------------------------------------


@query(f"WITH {EVENTS_SQL} SELECT sequence, CASE WHEN size > 0 AND k % 6 BETWEEN 0 AND 3 THEN ((3.0 - k % 6) / 3.0) ** 2 * size ELSE 0 END AS score FROM m")
def reward_order_score(spark, sf_dir):
    return market_events(spark, sf_dir).select("sequence", m.reward_order_score(F.lit(3.0), (F.col("k") % 6).cast("double"), F.col("size")).alias("score"))


@query(f"""WITH {EVENTS_SQL}, q AS (SELECT sequence, size, 0.05 + (v % 10) / 10.0::DOUBLE AS mid, best_bid, best_ask FROM m),
  s AS (SELECT *, CASE WHEN best_bid IS NULL OR size <= 0 OR (mid - best_bid) * 100 < 0 OR (mid - best_bid) * 100 > 30 THEN 0 ELSE ((30 - (mid - best_bid) * 100) / 30) ** 2 * size END AS b,
           CASE WHEN best_ask IS NULL OR size <= 0 OR (best_ask - mid) * 100 < 0 OR (best_ask - mid) * 100 > 30 THEN 0 ELSE ((30 - (best_ask - mid) * 100) / 30) ** 2 * size END AS a FROM q)
  SELECT sequence, CASE WHEN size < 10 THEN 0 WHEN mid BETWEEN 0.10 AND 0.90 THEN greatest(least(b, a), greatest(b / 3, a / 3)) ELSE least(b, a) END AS score FROM s""")
def reward_two_sided(spark, sf_dir):
    e = market_events(spark, sf_dir)
    middle = F.lit(0.05) + (F.col("v") % 10) / F.lit(10.0)
    return e.select("sequence", m.reward_two_sided(middle, F.col("best_bid"), F.col("best_ask"), F.col("size"), F.lit(30.0), F.lit(10.0)).alias("score"))


@query(f"""WITH {STATE_SQL}, q AS (SELECT sequence, book_bid, book_ask, CASE WHEN tick_state > 0 THEN tick_state ELSE least(greatest(book_ask - book_bid, 0.001), 0.01) END AS tick, round_even((v % 200 - 100) / 200.0::DOUBLE * 2 * 2, 0) AS skew
    FROM st JOIN pts USING (sequence) WHERE book_bid < book_ask)
  SELECT sequence, least(greatest(round(floor((book_bid - (1 + skew) * tick + 1e-12) / tick) * tick, 10), tick), 1 - tick) AS bid_price,
         least(greatest(round(ceil((book_ask + (1 - skew) * tick - 1e-12) / tick) * tick, 10), tick), 1 - tick) AS ask_price FROM q""")
def quote_prices(spark, sf_dir):
    s = _state(spark, sf_dir, 0, ("tick_state", "v")).filter("book_bid < book_ask")
    tick = F.coalesce(F.nullif("tick_state", F.lit(0.0)), F.least(F.greatest(F.col("book_ask") - F.col("book_bid"), F.lit(0.001)), F.lit(0.01)))
    skew = m.inventory_skew((F.col("v") % 200).cast("double"), 0, 200, 25, 2)
    s = s.withColumns({"tick": tick, "skew": skew})
    t = F.col("tick")
    bid = m.floor_to_tick(F.col("book_bid") - (1 + F.col("skew")) * t, t)
    ask = m.ceil_to_tick(F.col("book_ask") + (1 - F.col("skew")) * t, t)
    return s.select("sequence", m.clamp(bid, t).alias("bid_price"), m.clamp(ask, t).alias("ask_price"))


_LATE = "CASE WHEN k % 13 = 0 THEN 90000 ELSE 0 END"


@query(f"""WITH {STATE_SQL}, mids AS (SELECT asset_id, sequence AS ms, exchange_timestamp_ms - {_LATE} AS mt, (book_bid + book_ask) / 2 AS mid FROM st JOIN pts USING (sequence, asset_id) WHERE book_bid IS NOT NULL AND book_ask IS NOT NULL),
  tr AS (SELECT sequence, asset_id, side, price, size, exchange_timestamp_ms - {_LATE} + 60000 AS due FROM m WHERE event_type = 'last_trade_price' AND size > 0),
  j AS (SELECT tr.*, arg_min(mid, ms) AS mid FROM tr LEFT JOIN mids ON mids.asset_id = tr.asset_id AND mt >= due AND ms > sequence GROUP BY ALL)
  SELECT sequence, mid AS markout_mid, CASE WHEN side = 'BUY' THEN (mid - price) * size ELSE (price - mid) * size END AS markout_pnl FROM j""")
def markout_asof(spark, sf_dir):
    """Each trade with the first mid price processed a minute later or more, with some times that go back."""
    e, lv = _feed(spark, sf_dir)
    e = e.withColumn("exchange_timestamp_ms", F.col("exchange_timestamp_ms") - F.when(F.col("k") % 13 == 0, 90_000).otherwise(0))
    mids = book.with_prices(book.book_states(e, lv, 0, ("exchange_timestamp_ms",)))
    return book.markouts(e.filter("event_type = 'last_trade_price' AND size > 0"), mids)


@query("""WITH p AS (SELECT user_id, value, max(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS peak FROM events) SELECT user_id, max(peak - value) AS max_drawdown FROM p GROUP BY 1""")
def drawdown(spark, sf_dir):
    so_far = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(Window.unboundedPreceding, 0)
    return table(spark, sf_dir, "events").withColumn("fall", F.max("value").over(so_far) - F.col("value")).groupBy("user_id").agg(F.max("fall").alias("max_drawdown"))


@query(f"WITH {EVENTS_SQL} SELECT sequence, size * 0.02 * price * (1 - price) AS fee FROM m WHERE event_type = 'last_trade_price'")
def fee_equivalent(spark, sf_dir):
    return market_events(spark, sf_dir).filter("event_type = 'last_trade_price'").select("sequence", m.fee_equivalent(F.col("size"), F.lit(0.02), F.col("price")).alias("fee"))


_GRID = [backtest.Config(reward_max_spread_cents=5.0), backtest.Config(order_size=10.0, quote_offset_ticks=1, latency_ms=0, reward_max_spread_cents=5.0), backtest.Config(inventory_skew_ticks=0, queue_ahead_fraction=0.0, refresh_ms=60_000)]


@query()
def backtest_fills(spark, sf_dir):
    return backtest.fills(backtest.simulate(*_feed(spark, sf_dir), [_GRID[1]]))


@query()
def backtest_equity(spark, sf_dir):
    return backtest.equity(backtest.simulate(*_feed(spark, sf_dir)))


@query()
def backtest_summary(spark, sf_dir):
    done = backtest.summaries(backtest.simulate(*_feed(spark, sf_dir)))
    return done.select("asset_id", "market", F.col("summary")["gross_pnl"].alias("gross_pnl"), F.col("summary")["fills"].cast("long").alias("fills"), F.col("summary")["max_drawdown"].alias("max_drawdown"), F.col("summary")["score_minutes"].alias("score_minutes"))


@query()
def backtest_sweep(spark, sf_dir):
    done = backtest.summaries(backtest.simulate(*_feed(spark, sf_dir), _GRID))
    return done.groupBy("config_id").agg(F.count("*").alias("assets"), F.sum(F.col("summary")["gross_pnl"]).alias("gross_pnl"), F.sum(F.col("summary")["fills"]).cast("long").alias("fills"))
