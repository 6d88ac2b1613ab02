"""Incremental conversion, streaming, sources, and the queries against their SQL."""

import json
import os
from threading import Event

import duckdb
import fixtures as f
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from tidebook.operators import book
from tidebook.plans import adapter, catalogue
from tidebook.plans.incremental import Folder, incremental_convert, load_manifest, read_table
from tidebook.functions import coerce
from tidebook.operators import discovery
from tidebook.sources import feeds, rest, writers
from tidebook.sources.archives import common_root, resolve_inputs
from tidebook.streaming import loops, replay

SF = "/root/testdata/sf0.001"


def test_incremental(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    first = raw / "market_ws/2026/07/31/market_ws-20260731T010000Z.jsonl.gz"
    f.write(first, f.SCENARIO)
    f.write(raw / "rtds/2026/08/01/rtds-20260801T010100Z.jsonl", [{"record_type": "rtds", "payload": {"topic": "t"}}], extra=())
    done = incremental_convert(spark, str(raw), out)
    assert [k.split("/")[0] for k in done["processed"]] == ["market_ws", "rtds"] and done["totals"]["events"] == 11 and done["totals"]["event_types"]["price_change"] == 3
    again = incremental_convert(spark, str(raw), out)
    assert not again["processed"] and len(again["skipped"]) == 2 and again["totals"] == done["totals"]
    rows = read_table(spark, out, "events").select("sequence", F.col("date").cast("string").alias("date")).orderBy("sequence").collect()
    assert [r["sequence"] for r in rows] == [*range(1, 12)] and {r["date"] for r in rows} == {"2026-07-31", "2026-08-01"}
    folder = Folder(spark, out)
    manifest = load_manifest(folder)
    key = next(k for k in manifest["archives"] if k.startswith("rtds"))
    manifest["archives"][key]["status"] = "processing"  # as a run leaves it that dies here
    folder.replace("manifest.json", json.dumps(manifest))
    assert incremental_convert(spark, str(raw), out)["processed"] == [key]
    assert load_manifest(folder)["archives"][key]["sequence_start"] == 10 and read_table(spark, out, "events").count() == 11
    with folder.lock(), pytest.raises(RuntimeError, match="another run"):
        incremental_convert(spark, str(raw), out)
    f.write(first, f.SCENARIO[:2])
    with pytest.raises(ValueError, match="changed after processing"):
        incremental_convert(spark, str(raw), out)
    with pytest.raises(ValueError, match="outside"):
        folder.path("../x")


def test_manifest_is_checked(spark, tmp_path):
    for text, match in (("{", "not JSON"), ("[]", "not an object"), ('{"schema_version": 9, "archives": {}}', "version")):
        (tmp_path / "manifest.json").write_text(text)
        with pytest.raises(ValueError, match=match):
            load_manifest(Folder(spark, str(tmp_path)))


def test_stream_equals_batch(spark, tmp_path):
    e = adapter.market_events(spark, SF)
    lv = adapter.book_levels(e)
    nested = lv.groupBy("sequence").agg(F.collect_list(F.struct("side", "price", "size")).alias("levels"))
    names = [x.split()[0] for x in replay.EVENTS.split(", ")[:12]]
    rows = e.join(nested, "sequence", "left").select(*names, "levels")
    cut = rows.agg(F.expr("percentile(sequence, 0.5)")).head()[0]
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "ck")
    for part in (rows.filter(F.col("sequence") <= cut), rows.filter(F.col("sequence") > cut)):  # a second run goes on
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        replay.run_book_stream(spark, str(tmp_path / "in"), target, checkpoint)
    got = {r["sequence"]: (r["book_bid"], r["book_ask"]) for r in spark.read.parquet(target).collect()}
    want = book.book_states(e, lv, 0).collect()
    assert got == {r["sequence"]: (r["book_bid"], r["book_ask"]) for r in want}


def pages(method, url, body):
    cursor = url.partition("next_cursor=")[2]
    if "endless" in url:
        return {"data": [1], "next_cursor": "a"}
    return {"data": [{"n": cursor or "first"}], "next_cursor": {"": "two", "two": "LTE%3D"}.get(cursor, "LTE=").replace("%3D", "=")}


def books(method, url, body):
    if body[0]["token_id"] == "bad":
        raise OSError("down")
    return [{"asset_id": b["token_id"], "bids": [], "asks": []} for b in body] + ["noise"]


def test_rest_sources(spark, monkeypatch):
    rest.register(spark)
    reader = rest.PageReader({"endpoint": "http://x/list", "transport": "test_plans:pages"})
    assert [json.loads(item)["n"] for _, item in reader.read(None)] == ["first", "two"]
    with pytest.raises(RuntimeError, match="pages"):
        list(rest.PageReader({"endpoint": "http://x/endless", "transport": "test_plans:pages"}).read(None))
    assets = ["bad", *(f"a{i}" for i in range(1200)), "a1"]
    source = rest.BookReader({"endpoint": "http://x/books", "transport": "test_plans:books", "assets": json.dumps(assets)})
    parts = source.partitions()
    assert [len(p.assets) for p in parts] == [500, 500, 201]
    records = [json.loads(v) for p in parts for (v,) in source.read(p)]
    assert [r["record_type"] for r in records].count("rest_book_checkpoint_error") == 1 and len(records) == 702 and records[1]["payload"]["asset_id"] == "a499"


def test_feed_records(spark):
    frames = [(0, 1, 1, "frame", '[{"a": 1}, 5]'), (1, 2, 2, "frame", "{no"), (2, 3, 3, "pong", "PONG"), (3, 4, 4, "frame", '{"b": 2}')]
    df = spark.createDataFrame(frames, "frame_at long, received_at_ns long, received_monotonic_ns long, kind string, frame string")
    got = [json.loads(r["value"]) for r in feeds.records(df).orderBy("frame_at").collect()]
    assert [(r["record_type"], r["frame_index"], r["frame_message_count"]) for r in got] == [("market_ws", 0, 2), ("invalid_market_ws_item", 1, 2), ("invalid_market_ws", 0, 1), ("market_ws_control", 0, 1), ("market_ws", 0, 1)]
    assert got[0]["payload"] == {"a": 1} and got[3]["control_event"] == "pong"
    reader = feeds.FeedReader({"connect": "test_plans:frames_from"})
    rows, end = reader.read(reader.initialOffset())
    assert [r[3] for r in rows] == ["connected", "frame", "pong"] and end == {"read": 2} and [r[0] for r in reader.readBetweenOffsets({"read": 1}, end)] == [1]
    assert [feeds.next_wait(1), feeds.next_wait(40), feeds.next_wait(40, connected_for=31)] == [2, 60, 1]


SENT: list[str] = []
WANTED = ["b", "a"]
DOWN: list[bool] = []


def wanted():
    return WANTED


def frames_or_failure(read):
    if DOWN:
        raise OSError("down")
    return ['{"a": 1}'][read:]


def test_feed_keeps_up(monkeypatch):
    reader = feeds.FeedReader({"connect": "test_plans:frames_or_failure", "assets": "test_plans:wanted", "ping_seconds": "5", "stale_seconds": "30"} | {"send": "test_plans:sent"})
    now = [100.0]
    reader.clock = lambda: now[0]
    reader.heard = 100.0
    kinds = lambda at: [r[3] for r in reader.read({"read": at})[0]]
    assert kinds(0) == ["subscription_update", "connected", "frame"]
    assert SENT == ['{"assets_ids":["a","b"],"operation":"subscribe","custom_feature_enabled":true}', "PING"] and reader.subscription.revision == 1
    WANTED[:] = ["b", "c"]
    now[0] += 6
    assert kinds(1) == ["subscription_update"] and SENT[2:] == ['{"assets_ids":["a"],"operation":"unsubscribe"}', '{"assets_ids":["c"],"operation":"subscribe","custom_feature_enabled":true}', "PING"]
    DOWN.append(True)
    now[0] += 1
    assert kinds(1) == ["connection_error"] and kinds(1) == []  # it waits about a second
    now[0] += 1.2
    assert kinds(1) == ["subscription_update", "connection_error"] and 2 <= reader.blocked_until - now[0] <= 2.2
    DOWN.clear()
    now[0] += 2.3
    assert kinds(1) == ["subscription_update", "connected"]
    now[0] += 25
    assert kinds(1) == ["stale"] and kinds(1) == ["subscription_update", "connected"]


def sent(text):
    SENT.append(text)


def test_loops():
    stop, waits, told = Event(), [], []

    def step():
        if len(waits) < 3:
            raise OSError("down")

    def wait(seconds):
        waits.append(seconds)
        if len(waits) == 6:
            stop.set()

    assert loops.repeat(step, 900, stop, told.append, wait) == 3
    assert waits == [10, 20, 40, 900, 900, 900] and len(told) == 3
    assert json.loads(loops.error_record("discovery", told[0]))["record_type"] == "discovery_error"


def test_lock_of_a_dead_run(spark, tmp_path):
    folder = Folder(spark, str(tmp_path))
    with folder.lock(lease_seconds=-1) as renew:  # a lease that has ended already
        with folder.lock():
            with pytest.raises(RuntimeError, match="another run holds"), folder.lock():
                pass
            with pytest.raises(RuntimeError, match="taken over"):
                renew()
    assert not folder.exists("manifest.lock")


def test_ages_and_roots(spark, tmp_path):
    f.write(tmp_path / "a/x/1.jsonl", [])
    f.write(tmp_path / "a/y/2.jsonl", [])
    os.utime(tmp_path / "a/y/2.jsonl", (1, 1))
    found = resolve_inputs(spark, [str(tmp_path / "a")], min_age_seconds=3600)
    assert [p.rsplit("/", 1)[1] for p in found] == ["2.jsonl"]
    assert common_root(["/r/a/x/1", "/r/a/y/2"]) == "/r/a" and common_root(["/r/a/1"]) == "/r/a" and common_root([]) == ""
    at = spark.range(1).select(coerce.iso_utc(F.lit(1785456000123456789)).alias("t"), coerce.iso_utc(F.lit(0)).alias("z")).head()
    assert tuple(at) == ("2026-07-31T00:00:00.123456+00:00", "1970-01-01T00:00:00.000000+00:00")
    with pytest.raises(ValueError, match="no asset"):
        discovery.chosen_asset(spark.createDataFrame([], "asset_id string, event_type string"))


def frames_from(read):
    return ['{"a": 1}', "PONG"][read:]


def test_archives_are_written(spark, tmp_path):
    lines = spark.createDataFrame([('{"received_at_ns": 1785456000000000000}',), ("x",)], "value string")
    writers.write_archives(lines, str(tmp_path / "o"))
    assert sorted(os.listdir(tmp_path / "o"))[-2:] == ["date=2026-07-31", "date=unknown"]


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_its_sql(spark, name):
    rows = catalogue.QUERIES[name](spark, SF)
    got = rows.collect()
    if name not in catalogue.ORACLES:
        assert rows.columns and isinstance(got, list)  # the simulator's results are tested on fixtures
        return
    db = duckdb.connect()
    for table in os.listdir(SF):
        db.execute(f"CREATE VIEW {table.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{SF}/{table}')")
    cursor = db.execute(catalogue.ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(rows.columns)
    plain = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    assert sorted(tuple(plain(r[c]) for c in columns) for r in got) == sorted(tuple(map(plain, r)) for r in cursor.fetchall())


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns[:2] == ["sequence", "asset_id"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
