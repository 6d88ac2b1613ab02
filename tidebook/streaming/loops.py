"""Steps that are repeated for as long as a collection runs, and its end."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable
from threading import Event

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

#: Seconds before another attempt after a failure: doubled up to the last.
FIRST_WAIT, LAST_WAIT = 10.0, 300.0


def repeat(step: Callable[[], None], interval: float, stop: Event, failed: Callable[[Exception], None] | None = None, wait: Callable[[float], object] | None = None) -> int:
    """Runs `step` every `interval` seconds until `stop` is set; how often it succeeded.

    After a failure `failed` is told and the step is tried again sooner, with waits that double: a
    discovery or a round of book checkpoints that fails doesn't end the collection.
    """
    pause, done, again = wait or stop.wait, 0, FIRST_WAIT
    while not stop.is_set():
        try:
            step()
            done, again, rest = done + 1, FIRST_WAIT, interval
        except Exception as e:
            if failed:
                failed(e)
            rest, again = min(again, interval), min(again * 2, LAST_WAIT)
        pause(rest)
    return done


def error_record(kind: str, error: Exception) -> str:
    """A line that tells of a failure, as `kind`_error."""
    return json.dumps({"record_type": f"{kind}_error", "received_at_ns": time.time_ns(), "error_type": type(error).__name__, "error": str(error)})


def append_lines(lines: DataFrame, path: str) -> Callable[[], None]:
    """A step that reads a source of lines (listings, book checkpoints) and appends them to an archive."""
    return lambda: lines.write.mode("append").option("compression", "gzip").text(path)


def stop_gracefully(queries: Iterable[StreamingQuery], seconds: float = 10.0) -> list[str]:
    """Lets the running batches of streams end within `seconds` and stops them; names of those cut off."""
    late, until = [], time.monotonic() + seconds
    for query in queries:
        while query.isActive and query.status["isTriggerActive"] and time.monotonic() < until:
            time.sleep(0.05)
        if query.isActive and query.status["isTriggerActive"]:
            late.append(query.name or str(query.id))
        query.stop()
    return late
