"""Sinks: rotating JSON-lines archives and single-object reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def write_archives(lines: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """gz JSON-lines files by day of receipt; the commit protocol publishes whole files only."""
    _daily(lines).write.option("compression", "gzip").option("maxRecordsPerFile", rows_per_file).partitionBy("date").mode("append").text(path)


def stream_archives(lines: DataFrame, path: str, checkpoint: str, rotation_seconds: int = 900) -> StreamingQuery:
    """The same from a stream, a set of files per rotation; what a crash leaves is done again."""

    def put(batch: DataFrame, number: int) -> None:
        _daily(batch).write.option("compression", "gzip").partitionBy("date").mode("overwrite").text(f"{path}/batch={number:012d}")

    return lines.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(processingTime=f"{rotation_seconds} seconds").start()


def _daily(lines: DataFrame) -> DataFrame:
    received = F.try_variant_get(F.try_parse_json("value"), "$.received_at_ns", "bigint")
    return lines.select("value", F.coalesce(F.date_format(F.timestamp_seconds(received / 1_000_000_000), "yyyy-MM-dd"), F.lit("unknown")).alias("date"))


def write_report(row: DataFrame, path: str) -> None:
    """One row as one JSON object."""
    row.coalesce(1).write.mode("overwrite").json(path)
