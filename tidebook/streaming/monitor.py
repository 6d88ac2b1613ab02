"""What running streams report: state as a dictionary and as Prometheus text, and staleness."""

from __future__ import annotations

import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener


class Monitor(StreamingQueryListener):
    """Counts rows and batches of all queries, and remembers when rows came last."""

    def __init__(self, stale_after_seconds: float = 30.0) -> None:
        self.stale_after, self.started = stale_after_seconds, time.time()
        self.rows = self.batches = self.failures = self.running = 0
        self.last_rows_at: float | None = None

    def onQueryStarted(self, event) -> None:
        self.running += 1

    def onQueryProgress(self, event) -> None:
        self.batches += 1
        self.rows += event.progress.numInputRows
        if event.progress.numInputRows:
            self.last_rows_at = time.time()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.running -= 1
        self.failures += event.exception is not None

    def state(self, now: float | None = None) -> dict:
        now = time.time() if now is None else now
        reasons = [("no query is running", not self.running), ("no rows yet", self.last_rows_at is None and now - self.started > self.stale_after), ("no recent rows", self.last_rows_at is not None and now - self.last_rows_at > self.stale_after)]
        reason = next((text for text, bad in reasons if bad), None)
        return {"healthy": reason is None, "reason": reason, "rows": self.rows, "batches": self.batches, "failures": self.failures, "running": self.running, "uptime_seconds": now - self.started}

    def prometheus(self, now: float | None = None) -> str:
        state = self.state(now)
        return "".join(f"tidebook_{k} {float(v):g}\n" for k, v in state.items() if k != "reason")


class StalenessProcessor(StatefulProcessor):
    """A `stale` control row for a source without messages for a time, by a processing-time timer."""

    def __init__(self, after_ms: int) -> None:
        self.after_ms = after_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("last", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        n, now = sum(len(r) for r in rows), timer_values.getCurrentProcessingTimeInMs()
        if self.state.exists():
            self.handle.deleteTimer(self.state.get()[0] + self.after_ms)
        self.state.update((now,))
        self.handle.registerTimer(now + self.after_ms)
        yield pd.DataFrame({"source": [key[0]], "control_event": ["messages"], "n": [n]})

    def handleExpiredTimer(self, key, timer_values, expired) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"source": [key[0]], "control_event": ["stale"], "n": [0]})

    def close(self) -> None:
        pass


def staleness(messages: DataFrame, after_seconds: float = 30.0) -> DataFrame:
    """source, control_event (``messages`` or ``stale``) and n, from a stream with a source column."""
    return messages.groupBy("source").transformWithStateInPandas(StalenessProcessor(int(after_seconds * 1000)), "source string, control_event string, n long", "Append", "ProcessingTime")
