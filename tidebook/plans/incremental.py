"""Archives to date-partitioned tables, each exactly once.

A manifest beside the tables says what was done: per archive its digest, status, rows and range of
sequences. An archive that is being worked on when a run dies is done again with the same sequences; one
that has changed since it was done is an error. The manifest is replaced by a rename.
"""

from __future__ import annotations

import json
import time
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.discovery import archive_columns
from ..operators.normalize import normalize
from ..operators.quality import type_counts
from ..sources.archives import resolve_inputs

VERSION = 1
TABLES = ("events", "book_levels", "markets")


class Folder:
    """A folder of any Hadoop file system, used by the driver alone."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.jvm = spark.sparkContext._jvm
        self.root = self.jvm.org.apache.hadoop.fs.Path(root)
        self.fs = self.root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.fs.mkdirs(self.root)
        self.name = self.fs.makeQualified(self.root).toString()

    def path(self, name: str):
        if name.startswith("/") or ".." in name.split("/"):
            raise ValueError(f"{name} lies outside of {self.name}")
        return self.jvm.org.apache.hadoop.fs.Path(self.root, name)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace(self, name: str, text: str) -> None:
        part = self.path(name + ".tmp")
        stream = self.fs.create(part, True)
        stream.write(bytearray(text.encode()))
        stream.hsync()
        stream.close()
        if not self.fs.rename(part, self.path(name)):
            self.fs.delete(self.path(name), False)
            if not self.fs.rename(part, self.path(name)):
                raise OSError(f"{name} can't be replaced")

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def _claim(self, name: str, owner: str, until: float) -> bool:
        try:
            stream = self.fs.create(self.path(name), False)
        except Exception:  # it exists
            return False
        stream.write(bytearray(json.dumps({"owner": owner, "until": until}).encode()))
        stream.close()
        return True

    def _owner(self, name: str) -> str | None:
        return json.loads(self.read(name))["owner"] if self.exists(name) else None

    @contextmanager
    def lock(self, name: str = "manifest.lock", lease_seconds: float = 3600):
        """Held by one run at a time; yields a function that renews the lease. The lock of a run that died
        is taken over when its lease has ended: it is renamed first, which only one run can do."""
        owner = uuid.uuid4().hex
        if not self._claim(name, owner, time.time() + lease_seconds):
            try:
                until = json.loads(self.read(name))["until"]
            except Exception:  # gone by now, or not yet written
                until = float("inf")
            old = self.path(f"{name}.{owner}")
            if until > time.time() or not self.fs.rename(self.path(name), old):
                raise RuntimeError(f"another run holds {self.name}/{name}")
            self.fs.delete(old, False)
            if not self._claim(name, owner, time.time() + lease_seconds):
                raise RuntimeError(f"another run holds {self.name}/{name}")

        def renew() -> None:
            if self._owner(name) != owner:
                raise RuntimeError(f"another run has taken over {self.name}/{name}")
            self.replace(name, json.dumps({"owner": owner, "until": time.time() + lease_seconds}))

        try:
            yield renew
        finally:
            if self._owner(name) == owner:
                self.delete(name)


def load_manifest(folder: Folder) -> dict:
    if not folder.exists("manifest.json"):
        return {"schema_version": VERSION, "next_sequence": 0, "archives": {}}
    try:
        found = json.loads(folder.read("manifest.json"))
    except ValueError as e:
        raise ValueError("the manifest is not JSON") from e
    if not isinstance(found, dict) or not isinstance(found.get("archives"), dict):
        raise ValueError("the manifest is not an object of archives")
    if found.get("schema_version") != VERSION:
        raise ValueError(f"the manifest has version {found.get('schema_version')}, not {VERSION}")
    return found


def describe(spark: SparkSession, root: str, paths: list[str]) -> list[dict]:
    """key (relative to the root, or the file's name), date, stamp, stem, size and time of archives, in the
    order that they are worked on. Their bytes aren't read."""
    base = Folder(spark, root).name.rstrip("/") + "/"
    files = spark.read.format("binaryFile").load(paths)
    key = F.when(F.startswith("path", F.lit(base)), F.substring("path", len(base) + 1, 1 << 30)).otherwise(F.substring_index("path", "/", -1))
    rows = archive_columns(files.select(key.alias("key"), "path", "length", F.to_date("modificationTime").cast("string").alias("modified"), F.unix_millis("modificationTime").alias("modified_ms")))
    return [r.asDict() | {"date": r["date"] or r["modified"]} for r in rows.orderBy(F.col("stamp").isNull(), "stamp", "key").collect()]


def digests(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """SHA-256 of archives by path, taken by the executors, a task each."""
    if not paths:
        return {}
    files = spark.read.format("binaryFile").load(paths).select("path", F.sha2("content", 256).alias("sha256"))
    return {r["path"]: r["sha256"] for r in files.collect()}


def incremental_convert(spark: SparkSession, source_root: str, out_root: str, most: int | None = None) -> dict:
    """Works on the archives below `source_root` that aren't done; returns processed, skipped and totals."""
    folder = Folder(spark, out_root)
    with folder.lock() as renew:
        manifest = load_manifest(folder)
        done, processed, skipped = manifest["archives"], [], []
        listed = describe(spark, source_root, resolve_inputs(spark, [source_root]))
        # what is done and has the size and time that it had then isn't read again
        same = {a["key"] for a in listed if (e := done.get(a["key"])) and e["status"] == "completed" and (e["size"], e.get("modified_ms")) == (a["length"], a["modified_ms"])}
        fresh = [a for a in listed if a["key"] not in done]
        wanted = fresh if most is None else fresh[:most]
        hashed = digests(spark, [a["path"] for a in [*wanted, *(a for a in listed if a["key"] in done and a["key"] not in same)]])
        for archive in listed:
            key, entry = archive["key"], done.get(archive["key"])
            if key in same:
                skipped.append(key)
                continue
            if most is not None and len(processed) >= most:
                break
            archive["sha256"] = hashed[archive["path"]]
            if entry and entry["status"] not in ("completed", "processing"):
                raise ValueError(f"{key} has the status {entry['status']}")
            if entry and entry["sha256"] != archive["sha256"]:
                raise ValueError(f"{key} has changed after processing")
            if entry and entry["status"] == "completed":
                skipped.append(key)
                continue
            renew()
            start = entry["sequence_start"] if entry else manifest["next_sequence"]
            places = {t: f"{t}/date={archive['date']}/archive={start:020d}__{archive['stem']}" for t in TABLES}
            for place in places.values():
                if entry:
                    folder.delete(place)
                elif folder.exists(place):
                    raise ValueError(f"{place} exists but is not in the manifest")
            done[key] = {"status": "processing", "sha256": archive["sha256"], "size": archive["length"], "modified_ms": archive["modified_ms"], "sequence_start": start, "places": places}
            folder.replace("manifest.json", json.dumps(manifest, sort_keys=True))
            summary = _convert(spark, archive["path"], start, {t: f"{folder.name}/{p}" for t, p in places.items()})
            done[key] |= {"status": "completed", "sequence_end": start + summary["events"], "summary": summary}
            manifest["next_sequence"] = max(manifest["next_sequence"], start + summary["events"])
            folder.replace("manifest.json", json.dumps(manifest, sort_keys=True))
            processed.append(key)
    return {"processed": processed, "skipped": skipped, "totals": merged(manifest)}


def _convert(spark: SparkSession, path: str, start: int, places: dict[str, str]) -> dict:
    tables = normalize(spark, [path], start)
    for name, df in (("events", tables.events), ("book_levels", tables.levels), ("markets", tables.markets)):
        df.write.option("compression", "zstd").parquet(places[name])
    tables.release()
    events = spark.read.parquet(places["events"])
    raw = tables.records.agg(F.count("*").alias("raw_rows"), F.count_if("invalid_json").alias("invalid_json")).head()
    return {
        "raw_rows": raw["raw_rows"],
        "invalid_json": raw["invalid_json"],
        "events": events.count(),
        "book_levels": spark.read.parquet(places["book_levels"]).count(),
        "markets": spark.read.parquet(places["markets"]).count(),
        "event_types": {r["event_type"]: r["n"] for r in type_counts(events).collect()},
    }


def merged(manifest: dict) -> dict:
    """Counters and count maps of all completed archives."""
    out: dict = {}
    for entry in manifest["archives"].values():
        for name, value in (entry.get("summary") or {}).items():
            if isinstance(value, dict):
                own = out.setdefault(name, {})
                for k, n in value.items():
                    own[k] = own.get(k, 0) + n
            else:
                out[name] = out.get(name, 0) + value
    return out


def read_table(spark: SparkSession, out_root: str, name: str) -> DataFrame:
    """A table of all archives with date and archive as partition columns."""
    return spark.read.parquet(f"{out_root.rstrip('/')}/{name}")
