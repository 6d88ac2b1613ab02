"""Removal of repeated byte strings by prefix-free parsing.

1. Parse. A rolling hash runs over every text; the smallest hash in each window of `WINDOW` bytes is
   its trigger. Triggers depend on the bytes of the window alone, so equal windows have equal triggers
   at equal offsets, and every window start belongs to exactly one phrase: the run of windows with one
   trigger. The parse is a row per phrase: its document and place, the trigger's and the phrase's hash.
2. Parse order. Rows with equal trigger and phrase are equal strings: where a phrase occurs twice, all
   its windows are repeats and no byte has to be looked at. A trigger that occurs once has no repeat.
3. Dictionary. Phrases of one trigger that differ can still share windows. One copy of each such
   phrase is fetched, and the suffixes of these phrases, cut at `WINDOW` bytes, are sorted: a suffix
   array of the dictionary in corpus order, in which repeated windows are neighbours.
4. The windows found by 2 and 3 are united per document and cut out.

Triggers with a great many occurrences (found by a frequent-items sketch, at most `MAX_HEAVY`) take
another exact way that never gathers them: counts by phrase and, where phrases differ, by halves, quarters
and so on of their windows, aggregated before each shuffle; only what a repeat's end lies in is halved. All other groups are bounded by the sketch's guarantee.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, in_few_files, mapped, scratch, written

#: Bytes of a repeat that is removed.
WINDOW = 200
#: Bytes that the rolling hash covers (a power of two).
TRIGGER = 32
#: Window starts that are parsed at once.
BLOCK = 1 << 22
#: Counters of the sketch, triggers that take the way for heavy ones, and rows that make one heavy.
TRACKED, MAX_HEAVY, MIN_HEAVY = 4096, 1024, 256
#: Windows that are sorted at once, about.
SORTED = 60_000
#: A phrase's place: start << 20 | number of windows << 10 | offset of the trigger. Both are below 1024.
FIELD = 10


def _hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of each run of TRIGGER bytes."""
    h, power, m = data.astype(np.uint64) + np.uint64(1), np.uint64(0x9E3779B97F4A7C15), 1
    with np.errstate(over="ignore"):
        while m < TRIGGER:
            h = h[:-m] * power + h[m:]
            power = power * power
            m *= 2
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
    return h


def parse(text: bytes, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each phrase: first window start, number of windows, offset of the trigger from the first
    start, hash of the trigger. Texts shorter than a window have none."""
    span, low = window - TRIGGER + 1, np.uint64((1 << 24) - 1)
    out: list[tuple] = []
    data = np.frombuffer(text, np.uint8)
    for at in range(0, max(0, len(data) - window + 1), BLOCK):
        part = data[at : at + BLOCK + window - 1]
        h = _hashes(part)
        least = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        m = 1
        while 2 * m <= span:
            least = np.minimum(least[:-m], least[m:])
            m *= 2
        if m < span:
            least = np.minimum(least[: -(span - m)], least[span - m :])
        trigger = (least & low).astype(np.int64)
        start = np.concatenate([[0], np.flatnonzero(trigger[1:] != trigger[:-1]) + 1])
        count = np.diff(np.concatenate([start, [len(trigger)]]))
        out.append((start + at, count, trigger[start] - start, h[trigger[start]].view(np.int64)))
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))  # type: ignore[return-value]


def _phrases(texts: DataFrame, window: int) -> DataFrame:
    """id, h, place, trig, phrase of every phrase of (id, h, text)."""
    kind = texts.schema["id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, cols, size = [], [[], [], []], 0
            for i, (text, part) in enumerate(zip(batch.column("text"), range(batch.num_rows), strict=True)):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                start, count, offset, trig = parse(raw, window)
                if len(start):
                    hashed = xxhash.xxh3_64_intdigest
                    phrase = [hashed(raw[s : s + n + window - 1], o) for s, n, o in zip(start.tolist(), count.tolist(), offset.tolist(), strict=True)]
                    rows.append(np.full(len(start), part))
                    for c, x in zip(cols, (start << 2 * FIELD | count << FIELD | offset, trig, np.array(phrase, np.uint64).view(np.int64)), strict=True):
                        c.append(x)
                    size += len(start)
                if rows and (size > 200_000 or i + 1 == batch.num_rows):
                    at = pa.array(np.concatenate(rows))
                    yield pa.RecordBatch.from_arrays([batch.column("id").take(at), batch.column("h").take(at), *(pa.array(np.concatenate(c)) for c in cols)], ["id", "h", "place", "trig", "phrase"])
                    rows, cols, size = [], [[], [], []], 0

    return mapped(texts, run, f"id {kind}, h long, place long, trig long, phrase long")


def _fetched(texts: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """`wanted` (id, h, place, trig, phrase, copies) with the bytes of the phrases."""
    kind = texts.schema["id"].dataType.simpleString()
    lists = wanted.groupBy("id", "h").agg(F.collect_list(F.struct("place", "trig", "phrase", "copies")).alias("list"))
    lists = lists.select(F.col("id").alias("i"), F.col("h").alias("g"), "list")
    joined = texts.join(lists, F.col("id").eqNullSafe(F.col("i")) & (F.col("h") == F.col("g"))).select("id", "h", "text", "list")
    names = ["place", "trig", "phrase", "copies"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                raw = (batch.column("text")[i].as_py() or "").encode("utf-8", "surrogatepass")
                found = batch.column("list").slice(i, 1).flatten()
                place = found.field("place").to_numpy(zero_copy_only=False)
                start, count = (place >> 2 * FIELD).tolist(), (place >> FIELD & 1023).tolist()
                own = pa.array(np.full(len(place), i))
                yield pa.RecordBatch.from_arrays([batch.column("id").take(own), batch.column("h").take(own), *(found.field(n) for n in names), pa.array([raw[s : s + n + window - 1] for s, n in zip(start, count, strict=True)], pa.binary())], ["id", "h", *names, "bytes"])

    return mapped(joined, run, f"id {kind}, h long, place long, trig long, phrase long, copies long, bytes binary")


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edge[::2], edge[1::2]


def _sorted_windows(phrases: DataFrame, window: int) -> DataFrame:
    """Spans (id, h, start, stop) of repeated windows among different phrases of one trigger. The rows
    are dealt out and sorted by trigger; of a phrase with copies no span is needed, but it counts."""
    kind = phrases.schema["id"].dataType.simpleString()
    stride = 8 + 2 + window

    def found(batch: pa.Table) -> Iterator[pa.RecordBatch]:
        place = batch.column("place").to_numpy()
        count, offset, texts = place >> FIELD & 1023, place & 1023, batch.column("bytes").to_pylist()
        total = int(count.sum())
        suffixes = np.zeros((total, stride), np.uint8)
        owner, at = np.repeat(np.arange(len(count)), count), np.concatenate([[0], count.cumsum()])
        within = np.arange(total) - at[owner]
        trig = batch.column("trig").to_numpy()
        suffixes[:, :8] = trig.astype(">i8").view(np.uint8).reshape(-1, 8)[owner]
        suffixes[:, 8:10] = (offset[owner] - within).astype(">u2").view(np.uint8).reshape(-1, 2)
        for i, raw in enumerate(texts):
            suffixes[at[i] : at[i + 1], 10:] = np.lib.stride_tricks.sliding_window_view(np.frombuffer(raw, np.uint8), window)
        order = np.argsort(suffixes.view(f"S{stride}").ravel(), kind="stable")
        same = (suffixes[order[1:]] == suffixes[order[:-1]]).all(axis=1)
        repeated = np.zeros(total, bool)
        repeated[order[1:][same]] = repeated[order[:-1][same]] = True
        rows, start, stop = [], [], []
        copies = batch.column("copies").to_numpy()
        for i in np.unique(owner[repeated]):
            if copies[i] == 1:
                a, b = _runs(repeated[at[i] : at[i + 1]])
                rows += [i] * len(a)
                first = int(place[i] >> 2 * FIELD)
                start += (a + first).tolist()
                stop += (b + first + window - 1).tolist()
        if rows:
            own = pa.array(rows)
            yield from pa.table({"id": batch.column("id").take(own), "h": batch.column("h").take(own), "start": pa.array(start, pa.int64()), "stop": pa.array(stop, pa.int64())}).to_batches()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0
        for batch in batches:
            kept.append(batch)
            size += batch.num_rows
            if size * 100 >= SORTED:
                whole = pa.Table.from_batches(kept)
                trig = whole.column("trig").to_numpy()
                upto = int(np.searchsorted(trig, trig[-1], "left"))
                while upto:
                    # groups stay whole, and about SORTED windows are sorted at once
                    cut = min(upto, max(1, SORTED // 100))
                    cut = int(np.searchsorted(trig[:upto], trig[cut - 1], "right"))
                    yield from found(whole.slice(0, cut).combine_chunks())
                    whole, trig, upto = whole.slice(cut), trig[cut:], upto - cut
                kept, size = whole.to_batches(), whole.num_rows
        if size:
            yield from found(pa.Table.from_batches(kept).combine_chunks())

    return mapped(phrases, run, f"id {kind}, h long, start long, stop long")


def _halves(segments: DataFrame, window: int) -> DataFrame:
    """Both halves of each segment of a phrase's windows, where they aren't empty.

    A segment is a row (id, h, at, n, off, low, high, alone, bytes): n windows from `at` on, the first with
    the trigger at offset off, all with offsets from low to high; bytes are what the windows cover. Added
    are c1 and c2 (a hash of what every window with such an offset covers, so equal windows have it in
    common) and u (a hash of the bytes and of the offsets).
    """
    kind = segments.schema["id"].dataType.simpleString()
    names = ["at", "n", "off", "low", "high"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 4000):
                part, own, rows, texts, core, whole = batch.slice(i, 4000), [], [], [], [], []
                for k, (at, n, off, low, high, raw) in enumerate(zip(*(part.column(c).to_pylist() for c in [*names, "bytes"]), strict=True)):
                    middle = (low + high) // 2
                    for a, b in ((low, middle), (middle + 1, high)):
                        x, y = max(a, off - n + 1), min(b, off)  # offsets that the segment has
                        if x <= y:
                            first = off - y
                            own.append(k)
                            rows.append((at + first, y - x + 1, y, a, b))
                            texts.append(raw[first : off - x + window])
                            core.append(xxhash.xxh3_128_digest(raw[off - a : off - b + window], a << 16 | b))
                            whole.append(xxhash.xxh3_64_intdigest(texts[-1], x << 16 | y))
                c, take = np.frombuffer(b"".join(core), np.int64).reshape(-1, 2), pa.array(own, pa.int64())
                columns = [pa.array(col, pa.int64()) for col in (zip(*rows, strict=True) if rows else [()] * 5)]
                yield pa.RecordBatch.from_arrays([*(part.column(x).take(take) for x in ("id", "h")), *columns, part.column("alone").take(take), pa.array(texts, pa.binary()), pa.array(c[:, 0]), pa.array(c[:, 1]), pa.array(np.array(whole, np.uint64).view(np.int64))], ["id", "h", *names, "alone", "bytes", "c1", "c2", "u"])

    return mapped(segments.select("id", "h", *names, "alone", "bytes"), run, f"id {kind}, h long, at long, n long, off long, low long, high long, alone boolean, bytes binary, c1 long, c2 long, u long")


def _heavy_spans(phrases: DataFrame, window: int) -> list[DataFrame]:
    """Spans of repeated windows among different phrases of heavy triggers, never gathered by trigger.

    A phrase's windows are halved by their offset from the trigger, again and again. If all that a half
    covers occurs twice, so do its windows; if not even what its windows have in common does, none can.
    Only halves between the two are halved further: those in which a repeat begins or ends, one per end
    and round, so no table has more rows than twice the halves before. After 8 rounds they are windows.
    """
    place = F.col("place")
    segments = phrases.select("id", "h", F.shiftright(place, 2 * FIELD).alias("at"), F.shiftright(place, FIELD).bitwiseAND(1023).alias("n"), place.bitwiseAND(1023).alias("off"), F.lit(0).cast("long").alias("low"), F.lit(window - TRIGGER).cast("long").alias("high"), (F.col("copies") == 1).alias("alone"), "bytes")
    one = F.struct("id", "h", "at", "n", "off", "low", "high", "alone", "bytes")
    spans = []
    while True:
        halves = written(_halves(segments, window), "halves")
        kinds = written(in_few_files(halves.groupBy("c1", "c2", "u").agg(F.count("*").alias("times"), F.min_by(one, F.struct("at", "h")).alias("one"))), "kinds")
        often = kinds.filter("times > 1").select("c1", "c2", "u")
        spans.append(halves.filter("alone").join(often, ["c1", "c2", "u"], "left_semi").select("id", "h", F.col("at").alias("start"), (F.col("at") + F.col("n") - 1 + window).alias("stop")))
        mixed = written(in_few_files(kinds.groupBy("c1", "c2").agg(F.count("*").alias("n")).filter("n > 1").select("c1", "c2")), "mixed")
        if mixed.isEmpty():
            return spans
        # of equal halves one is enough from here on; if there were several, they are all found
        segments = kinds.join(mixed, ["c1", "c2"], "left_semi").select("one.*", "times").withColumn("alone", F.col("alone") & (F.col("times") == 1)).drop("times")


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(df[text_col], F.lit(""))).alias("h"), F.col(text_col).alias("text"))


def repeated_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The spans (id, h, start, stop) that repeats cover, h a hash of the text; they may touch or overlap."""
    if not TRIGGER < window < 1000:
        raise ValueError("window must lie between 33 and 999 bytes")
    spark, texts = df.sparkSession, _texts(df, id_col, text_col)
    rows = written(_phrases(texts, window), "parse")
    sketch = rows.select("trig", F.expr("spark_partition_id() div 32").alias("node")).groupBy("node").agg(F.expr(f"approx_top_k_accumulate(trig, {TRACKED}) AS part"))
    top = sketch.groupBy(F.expr("node < 0").alias("all")).agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(part, {TRACKED}), {MAX_HEAVY}) AS top")).head()
    heavy = [(x["item"],) for x in (top["top"] if top and top["top"] else []) if x["count"] >= MIN_HEAVY]
    chosen = spark.createDataFrame(heavy, "trig long")

    by_trigger, by_phrase = Window.partitionBy("trig"), Window.partitionBy("trig", "phrase")
    light = rows.join(F.broadcast(chosen), "trig", "left_anti") if heavy else rows
    light = (
        light.withColumn("n", F.count("*").over(by_trigger))
        .withColumn("least", F.min("phrase").over(by_trigger))
        .withColumn("most", F.max("phrase").over(by_trigger))
        .filter("n > 1")
        .withColumn("copies", F.count("*").over(by_phrase))
        .withColumn("no", F.row_number().over(by_phrase.orderBy("place", "h")))
        .select("id", "h", "place", "trig", "phrase", "copies", ((F.col("no") == 1) & (F.col("least") != F.col("most"))).alias("fetch"))
    )
    light = written(light, "light")
    wanted, counted = [light.filter("fetch")], [light.filter("copies > 1")]
    columns = ["id", "h", "place", "trig", "phrase", "copies"]
    if heavy:
        often = rows.join(F.broadcast(chosen), "trig", "left_semi")
        counts = written(often.groupBy("trig", "phrase").agg(F.count("*").alias("copies"), F.min(F.struct("place", "h", "id")).alias("one")), "heavy")
        wanted.append(counts.select("one.id", "one.h", "one.place", "trig", "phrase", "copies"))
        many = written(counts.filter("copies > 1").select("trig", "phrase", "copies"), "many")
        counted.append(often.join(many, ["trig", "phrase"]))
    fetched = written(_fetched(texts, wanted[0].select(*columns) if len(wanted) == 1 else wanted[0].select(*columns).unionByName(wanted[1].select(*columns)), window), "dictionary")
    spans = [
        rows.select("id", "h", F.shiftright("place", 2 * FIELD).alias("start"), (F.shiftright("place", 2 * FIELD) + F.shiftright("place", FIELD).bitwiseAND(1023) + (window - 1)).alias("stop"))
        for rows in counted
    ]
    few = fetched.join(F.broadcast(chosen), "trig", "left_anti") if heavy else fetched
    spans.append(_sorted_windows(few.repartition("trig").sortWithinPartitions("trig"), window))
    if heavy:
        spans += _heavy_spans(fetched.join(F.broadcast(chosen), "trig", "left_semi"), window)
    out = spans[0]
    for more in spans[1:]:
        out = out.unionByName(more)
    return out


def _merged(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(start, kind="stable")
    start, stop = start[order], np.maximum.accumulate(stop[order])
    first = np.concatenate([[True], start[1:] > stop[:-1]])
    return start[first], stop[np.concatenate([first[1:], [True]])]


def _span_lists(df: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """i, g (hash of the text) and the different spans of a document, no more than it is long. Tables
    that led to them are deleted."""
    with scratch():
        spans = repeated_spans(df, id_col, text_col, window)
        lists = spans.groupBy("id", "h").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
        return written(lists.select(F.col("id").alias("i"), F.col("h").alias("g"), "spans"), "spans", keep=True)


def _cut(raw: bytes, spans: pa.Scalar) -> tuple[bytes, int]:
    if spans.as_py() is None:
        return raw, 0
    start, stop = _merged(spans.values.field("start").to_numpy(), spans.values.field("stop").to_numpy())
    at, kept = 0, []
    for a, b in zip(start.tolist(), stop.tolist(), strict=True):
        kept.append(raw[at:a])
        at = b
    return b"".join([*kept, raw[at:]]), len(start)


def cut_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row of `df`: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Every byte is removed that a `window`-byte string covers which also starts anywhere else in the
    corpus, in the same text or another, overlaps included; strings are judged on the input. Null
    texts are empty; texts below `window` bytes keep all; of repeated rows each counts as a place, so
    they lose all their windows. Any id, null too, is handed on. Other columns are not read.
    """
    lists = _span_lists(df, id_col, text_col, window)
    joined = _texts(df, id_col, text_col).join(lists, F.col("id").eqNullSafe(F.col("i")) & (F.col("h") == F.col("g")), "left")
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, gone, n, sha = [], [], [], []
            for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                kept, runs = _cut(raw, spans)
                size.append(len(raw))
                gone.append(len(raw) - len(kept))
                n.append(runs)
                sha.append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(x, pa.int64()) for x in (size, gone, n)), pa.array(sha, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return mapped(joined.select("id", "text", "spans"), run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """`df` with the text that is left, every row and column kept.

    Bytes of a character that a cut has split are left out too, as a text can't hold them. Texts that
    lose nothing, null ones too, stay as they are. Columns of any name are handed on.
    """
    h, i, g, found = fresh(df, "h", "i", "g", "spans")
    lists = _span_lists(df, id_col, text_col, window).toDF(i, g, found)
    hashed = df.withColumn(h, F.xxhash64(F.coalesce(df[text_col], F.lit(""))))
    joined = hashed.join(lists, F.col(id_col).eqNullSafe(F.col(i)) & (F.col(h) == F.col(g)), "left").select(*[F.col(f"`{c}`") for c in df.columns], found)
    at, names = df.columns.index(text_col), df.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, kept = batch.column(at), []
            for text, spans in zip(texts, batch.column(found), strict=True):
                raw = text.as_py()
                kept.append(raw if spans.as_py() is None else _cut((raw or "").encode("utf-8", "surrogatepass"), spans)[0].decode("utf-8", "ignore"))
            yield pa.RecordBatch.from_arrays([pa.array(kept, texts.type) if i == at else batch.column(i) for i in range(len(names))], names)

    return mapped(joined, run, df.schema)
