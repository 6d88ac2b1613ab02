"""Archives to events, levels and markets."""

import json

import fixtures as f
import pytest
from pyspark.sql import functions as F

from tidebook.functions import coerce
from tidebook.operators import quality
from tidebook.operators.normalize import invalid_items, normalize
from tidebook.sources.archives import parsed, read_lines, resolve_inputs


def test_scenario(spark, tmp_path):
    t = normalize(spark, [f.write(tmp_path / "in/rain.jsonl.gz", f.SCENARIO)])
    events = t.events.orderBy("sequence").collect()
    assert [e["sequence"] for e in events] == [*range(1, 11)] and [e["event_type"] for e in events] == f.TYPES
    assert [(e["asset_id"], e["change_index"], e["change_count"]) for e in events[3:6]] == [("W", 0, 2), ("W", 1, 2), ("D", 0, 1)]
    assert [(e["asset_id"], e["side"], e["price"], e["size"]) for e in events[3:9]] == [("W", "BUY", 0.29, 0), ("W", "SELL", 0.33, 12), ("D", "BUY", 0.66, 4), ("W", "BUY", 0.33, 7), ("W", "BUY", 0.34, 1), ("W", "SELL", 0.30, 46)]
    assert (events[1]["tick_size"], events[1]["book_hash"], events[1]["exchange_timestamp_ms"], events[1]["capture_latency_ms"]) == (0.01, "w1", 10_000, 3)
    assert (events[6]["transaction_hash"], events[6]["fee_rate_bps"], events[6]["best_bid"], events[6]["symbol"], events[6]["connection_id"]) == ("hash-7", 20, None, "", "feed-7")
    assert json.loads(events[4]["payload_json"]) == f.CHANGES["price_changes"][1] | {"event_type": "price_change", "market": "rain", "timestamp": "12000"}
    assert sorted(tuple(r) for r in t.levels.select("sequence", "side", "source_rank", "price", "size").collect()) == [
        (2, "BUY", 0, 0.30, 40), (2, "BUY", 1, 0.29, 10), (2, "SELL", 0, 0.34, 8), (2, "SELL", 1, 0.36, 5), (3, "BUY", 0, 0.65, 9), (3, "SELL", 0, 0.70, 9), (10, "BUY", 0, 0.32, 3), (10, "SELL", 0, 0.36, 3),
    ]
    markets = t.markets.orderBy("token_index").collect()
    assert [(m["token_id"], m["outcome"], m["token_price"], m["daily_reward"], m["volume_24hr"], m["is_selected"]) for m in markets] == [("W", "Wet", 0.31, 48.0, 250.25, True), ("D", "Dry", 0.69, 48.0, 250.25, True)]
    report = quality.report(t.events, t.records, t.levels, t.markets).head()
    assert (report["raw_rows"], report["invalid_json_rows"], report["invalid_record_rows"], report["event_rows"], report["level_rows"], report["market_rows"]) == (9, 1, 0, 10, 8, 2)
    assert report["event_types"]["price_change"] == 3 and report["duplicates"] == 0 and report["timestamp_regressions"] == 0
    assert report["input_files"] == 1 and report["input_bytes"] == (tmp_path / "in/rain.jsonl.gz").stat().st_size


def test_other_records(spark, tmp_path):
    universe = {"record_type": "rewarded_market_universe", "received_at_ns": 1, "markets": [{"condition_id": "u", "current_rewards": {"total_daily_rate": "12.5", "sponsors_count": 2}}, 5]}
    checkpoint = {"record_type": "rest_book_checkpoint", "received_at_ns": 5, "checkpoint_id": "k", "payload": {"timestamp": "3", "asset_id": "A", "market": "m", "bids": [{"price": "0.1", "size": "0"}, {"price": "x", "size": "1"}], "asks": [{"price": "0.9", "size": "2"}, {"price": "0.8", "size": "-1"}]}}
    sports = {"record_type": "sports_ws", "received_at_ns": 6, "payload": {"gameId": "game-1", "slug": "s", "live": "yes", "ended": 0}}
    rtds = {"record_type": "rtds", "received_at_ns": 7, "payload": {"topic": "prices", "payload": {"symbol": "btcusdt", "timestamp": 1234, "value": "100000"}}}
    control = {"record_type": "market_ws_control", "control_event": "connected", "received_at_ns": 8}
    bad = [{"record_type": "market_ws", "payload": {"event_type": "price_change", "price_changes": "no"}}, {"record_type": "market_ws", "payload": {"event_type": "price_change", "price_changes": [3, {"asset_id": "B"}]}}, {"record_type": "market_ws", "payload": 4}]
    path = f.write(tmp_path / "x.jsonl", [universe, checkpoint, sports, rtds, control, *bad], extra=("", "[1]", '{"a":1}x', '{"a":1,"a":2}'))
    t = normalize(spark, [path])
    rows = {(e["source_line"], e["change_index"]): e for e in t.events.collect()}
    assert [rows[i, None]["event_type"] for i in (1, 2, 3, 4, 5, 8)] == ["rewarded_market_universe", "book", "sports_ws", "prices", "connected", "market_ws"]
    assert rows[3, None]["game_id"] == "game-1" and rows[3, None]["live"] is True and rows[3, None]["ended"] is False
    assert rows[4, None]["symbol"] == "btcusdt" and rows[4, None]["reference_value"] == 100000 and rows[4, None]["exchange_timestamp_ms"] == 1234
    assert rows[7, 0]["change_count"] == 1 and (6, 0) not in rows
    assert [tuple(r) for r in t.levels.select("side", "price", "size", "source_rank").collect()] == [("BUY", 0.1, 0.0, 0), ("SELL", 0.9, 2.0, 0)]
    m = t.markets.collect()
    assert len(m) == 1 and m[0]["token_id"] == "" and m[0]["daily_reward"] == 12.5 and m[0]["sponsors_count"] == 2 and m[0]["is_selected"] is False
    flags = t.records.orderBy("source_line").collect()
    assert [(r["invalid_json"], r["not_object"]) for r in flags[8:]] == [(True, False), (False, True), (True, False), (False, False)]
    assert t.records.filter("record IS NOT NULL").agg(F.sum(invalid_items(t.records))).head()[0] == 1 + 2 + 1 + 1
    # a line that isn't an object counts too
    assert quality.report(t.events, t.records, t.levels, t.markets).head()["invalid_record_rows"] == 1 + 2 + 1 + 1 + 1


def test_lines_are_numbered_over_splits(spark, tmp_path):
    path = tmp_path / "big.jsonl"
    path.write_text("".join(("" if i % 10 == 0 else json.dumps({"i": i})) + "\n" for i in range(1, 5001)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        rows = parsed(read_lines(spark, [str(path)])).select("source_line", coerce.as_long(coerce.at(F.col("record"), "$.i")).alias("i")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 5000 and all(r["i"] == r["source_line"] for r in rows if r["i"] is not None) and sum(r["i"] is None for r in rows) == 500


def test_inputs(spark, tmp_path):
    f.write(tmp_path / "a/2.jsonl", [])
    f.write(tmp_path / "a/b/1.jsonl.gz", [])
    (tmp_path / "a/no.txt").write_text("x")
    assert [p.rsplit("/", 1)[1] for p in resolve_inputs(spark, [str(tmp_path / "a"), str(tmp_path / "a/2.jsonl")])] == ["2.jsonl", "1.jsonl.gz"]
    for wrong in ("missing", "a/no.txt"):
        with pytest.raises(FileNotFoundError):
            resolve_inputs(spark, [str(tmp_path / wrong)])


def test_coercions(spark):
    values = ['"1000"', '"1000.0"', "1000.7", "true", '""', "null", '"x"', '"0.5"', '"1d"', '"NaN"', "0", "[]", '"Yes"', '" off "', "2.5"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, j string").withColumn("v", F.parse_json("j"))
    v = F.col("v")
    rows = df.select("i", coerce.as_long(v), coerce.as_double(v), coerce.as_bool(v), coerce.as_text(v), coerce.is_present(v), coerce.is_truthy(v)).orderBy("i").collect()
    got = {values[r[0]]: tuple(r)[1:] for r in rows}
    assert got['"1000"'] == (1000, 1000.0, None, "1000", True, True)
    assert got['"1000.0"'][:2] == (None, 1000.0)
    assert got["1000.7"][:3] == (1000, 1000.7, True)
    assert got["true"] == (1, 1.0, True, "True", True, True)
    assert got['""'] == (None, None, None, "", False, False) and got["null"] == (None, None, None, "", False, False)
    assert got['"1d"'][1] is None and got['"NaN"'][1] is None
    assert got["0"][2:] == (False, "", True, False) and got["[]"][4:] == (True, False)
    assert got['"Yes"'][2] is True and got['" off "'][2] is False
