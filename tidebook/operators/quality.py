"""Data-quality counts over normalised events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .normalize import invalid_items

#: Fields that an event of a type must have.
TRADE_FIELDS = ("asset_id", "price", "size", "side")
REQUIRED = {"price_change": TRADE_FIELDS, "last_trade_price": TRADE_FIELDS, "book": ("asset_id",), "best_bid_ask": ("asset_id",), "tick_size_change": ("asset_id",)}


def type_counts(events: DataFrame, column: str = "event_type") -> DataFrame:
    """Rows by type; a missing type counts as ``<missing>``."""
    kind = F.when(F.coalesce(F.col(column), F.lit("")) == "", "<missing>").otherwise(F.col(column))
    return events.groupBy(kind.alias(column)).agg(F.count("*").alias("n"))


def absent(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("")) == ""


def missing_required(events: DataFrame) -> DataFrame:
    """field (``type.field``) and how many events of the type lack it; only fields that are lacked."""
    checks = [F.when((F.col("event_type") == kind) & absent(field), f"{kind}.{field}") for kind, fields in REQUIRED.items() for field in fields]
    return events.select(F.explode(F.array_compact(F.array(*checks))).alias("field")).groupBy("field").agg(F.count("*").alias("n"))


def duplicate_count(records: DataFrame, column: str) -> DataFrame:
    """rows, distinct and duplicates of whole records in canonical form. Two steps of aggregation by
    digest: the shuffle holds a digest per distinct record of a task, not the records."""
    digests = records.groupBy(F.sha2(F.coalesce(F.col(column), F.lit("")), 256).alias("digest")).agg(F.count("*").alias("n"))
    return digests.agg(F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("rows"), F.count("*").alias("distinct_rows"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0).cast("long")).alias("duplicates"))


def timestamp_regressions(events: DataFrame, connection: str = "connection_id", instrument: str = "asset_id") -> DataFrame:
    """Events with a time below the latest so far of their connection and instrument, and how far."""
    before = Window.partitionBy(connection, instrument).orderBy("sequence").rowsBetween(Window.unboundedPreceding, -1)
    sound = events.filter(~absent(connection) & ~absent(instrument) & F.col("exchange_timestamp_ms").isNotNull())
    late = sound.withColumn("latest", F.max("exchange_timestamp_ms").over(before)).filter(F.col("exchange_timestamp_ms") < F.col("latest"))
    return late.select("sequence", connection, instrument, (F.col("latest") - F.col("exchange_timestamp_ms")).alias("behind_ms"))


def negative_latencies(events: DataFrame) -> DataFrame:
    """How many events were received over 1 ms before they were sent."""
    return events.agg(F.count_if(F.col("capture_latency_ms") < -1).alias("negative_latencies"))


def input_sizes(records: DataFrame) -> DataFrame:
    """input_files and input_bytes of the archives that the records were read from."""
    files = records.groupBy("source_file").agg(F.max("source_bytes").alias("size"))
    return files.agg(F.count("*").alias("input_files"), F.coalesce(F.sum("size"), F.lit(0).cast("long")).alias("input_bytes"))


def report(events: DataFrame, records: DataFrame, levels: DataFrame, markets: DataFrame) -> DataFrame:
    """One row: counts, and maps of counts by type and missing field.

    invalid_record_rows counts lines that aren't objects and, within records, change frames that aren't
    lists, elements and markets that aren't objects, and levels without a sound price and size.
    """

    def as_map(counts: DataFrame, key: str, name: str) -> DataFrame:
        return counts.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col(key).alias("key"), F.col("n").alias("value"))))).alias(name), F.lit(1).alias("one"))

    parts = [
        records.agg(F.count("*").alias("raw_rows"), F.count_if("invalid_json").alias("invalid_json_rows"), (F.count_if("not_object") + F.coalesce(F.sum(F.when(F.col("record").isNotNull(), invalid_items(records))), F.lit(0).cast("long"))).alias("invalid_record_rows"), F.lit(1).alias("one")),
        input_sizes(records).withColumn("one", F.lit(1)),
        events.agg(F.count("*").alias("event_rows"), F.count_if(F.col("capture_latency_ms") < -1).alias("negative_latencies"), F.lit(1).alias("one")),
        levels.agg(F.count("*").alias("level_rows"), F.lit(1).alias("one")),
        markets.agg(F.count("*").alias("market_rows"), F.lit(1).alias("one")),
        as_map(type_counts(events), "event_type", "event_types"),
        as_map(type_counts(records.filter("record IS NOT NULL"), "record_type"), "record_type", "record_types"),
        as_map(missing_required(events), "field", "missing_required"),
        duplicate_count(records.filter("record IS NOT NULL"), "canonical").select("duplicates", F.lit(1).alias("one")),
        timestamp_regressions(events.withColumn("instrument", F.coalesce(F.nullif("market", F.lit("")), F.nullif("symbol", F.lit("")), "asset_id")), instrument="instrument").agg(F.count("*").alias("timestamp_regressions"), F.lit(1).alias("one")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.join(part, "one")
    return out.drop("one")


def merge_summaries(summaries: DataFrame, counters: list[str], maps: list[str]) -> DataFrame:
    """One row of summed counters and merged count maps from a row per archive."""
    total = summaries.agg(*[F.coalesce(F.sum(c), F.lit(0).cast("long")).alias(c) for c in counters], F.lit(1).alias("one"))
    for name in maps:
        entries = summaries.select(F.explode(name)).groupBy("key").agg(F.sum("value").alias("value"))
        total = total.join(entries.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("key", "value")))).alias(name), F.lit(1).alias("one")), "one")
    return total.drop("one")
