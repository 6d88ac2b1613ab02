"""Packing of tokenised documents into windows by non-negative least squares.

Whole windows are cut off the front of each document. What is left, one tail a document, has a length
below the window, so a histogram of at most window - 1 numbers describes all tails. Combinations of two
or three lengths that fill a window are enumerated, how often each is used is solved against the
histogram by non-negative least squares (coordinate descent), rounded down to what is there, and the
residual tails are packed greedily one behind the other, cut where a window ends. The last window is
cut into powers of two, which need no padding.

The driver sees the histogram and the plan (a few thousand ranges). Which tail goes where follows from
its rank among the tails of its length: the task counts its own, and counts by task give the offsets.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .bpe import BYTE_LEVEL_WORDS, SPACE, byte_symbols, texts_in_groups
from .common import held, mapped, written

WINDOW = 1024
#: Lengths that combinations of three are built from: the most frequent ones.
FREQUENT = 64
#: Rounds of coordinate descent.
ROUNDS = 200
#: The id behind each document.
END = 0
#: Code points that are encoded at once: longer texts are cut between words.
SLICE = 50_000

_between = re.compile(f"[^{SPACE}] [^{SPACE}]")


class Encoder:
    """Ids of a byte-level BPE file in the tokenizers format, as the tokenizers library gives them.

    Texts are cut where one space stands between words. A stretch of more than two `SLICE` without such a
    place (white space, or a script without spaces) goes through the library itself: the faster encoder
    gives up on very long runs.
    """

    def __init__(self, path: str) -> None:
        self.path, self.library = path, None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        back = {c: b for b, c in enumerate(byte_symbols())}
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in self.added}
        ranks = {bytes(back[c] for c in t): i for t, i in vocab.items()}
        self.encoding = tiktoken.Encoding("file", pat_str=BYTE_LEVEL_WORDS, mergeable_ranks=ranks, special_tokens={})
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        for segment in self.split.split(text) if self.split and any(x in text for x in self.added) else [text]:
            if segment in self.added:
                ids.append(self.added[segment])
                continue
            at = 0
            while at < len(segment):
                end = len(segment)
                if end - at > SLICE and (m := _between.search(segment, at + SLICE)):
                    end = m.start() + 1
                ids += self.encoding.encode_ordinary(segment[at:end]) if end - at <= 2 * SLICE else self.slowly(segment[at:end])
                at = end
        return ids

    def slowly(self, text: str) -> list[int]:
        if self.library is None:
            self.library = Tokenizer.from_file(self.path)
            self.library.no_truncation()
            self.library.no_padding()
        return self.library.encode(text, add_special_tokens=False).ids


def loaded(path: str) -> Encoder:
    """One per file and worker process."""
    return held(("encoder", path), lambda: Encoder(path))


def combinations_of(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[int, ...]]:
    """Two lengths that fill the window, and three of which two are among the frequent ones."""
    found = {(a, window - a) for a in histogram if a <= window - a and window - a in histogram}
    often = sorted(sorted(histogram, key=lambda a: (-histogram[a], a))[:FREQUENT])
    for i, a in enumerate(often):
        for b in often[i:]:
            if (c := window - a - b) > 0 and c in histogram:
                found.add(tuple(sorted((a, b, c))))
    return sorted(found)


def solve(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """How often each combination is used; no length more often than the histogram has it."""
    combos = combinations_of(histogram, window)
    left = {a: float(n) for a, n in histogram.items()}
    uses = [[(a, c.count(a)) for a in sorted(set(c))] for c in combos]
    norm = [sum(k * k for _, k in u) for u in uses]
    x = [0.0] * len(combos)
    for _ in range(ROUNDS):
        moved = 0.0
        for j, use in enumerate(uses):
            step = max(-x[j], sum(k * left[a] for a, k in use) / norm[j])
            if step:
                x[j] += step
                for a, k in use:
                    left[a] -= k * step
                moved = max(moved, abs(step))
        if moved < 0.01:
            break
    there, plan = dict(histogram), []
    for j in sorted(range(len(combos)), key=lambda j: (-x[j], combos[j])):
        n = min([int(x[j] + 0.5), *(there[a] // k for a, k in uses[j])])
        if n > 0:
            plan.append((combos[j], n))
            for a, k in uses[j]:
                there[a] -= k * n
    return plan


class Plan:
    """Where the tail of a length with a rank goes."""

    def __init__(self, histogram: dict[int, int], window: int = WINDOW) -> None:
        self.window, self.ranges = window, {a: ([], []) for a in histogram}
        used = dict.fromkeys(histogram, 0)
        self.sequences = 0

        def take(a: int, n: int, *what: int) -> None:
            lows, told = self.ranges[a]
            lows.append(used[a])
            told.append((used[a], *what))
            used[a] += n

        for combo, n in solve(histogram, window):
            offset = 0
            for a in combo:
                take(a, n, 0, self.sequences, offset)
                offset += a
            self.sequences += n
        at = 0
        for a in sorted(histogram, reverse=True):  # the longest first
            if n := histogram[a] - used[a]:
                take(a, n, 1, at, 0)
                at += n * a
        self.row, self.whole, rest = self.sequences, at // window, at % window
        #: Where the pieces of the last window begin: its length as a sum of powers of two.
        self.cuts = [0]
        for bit in reversed(range(window.bit_length())):
            if rest >> bit & 1:
                self.cuts.append(self.cuts[-1] + (1 << bit))
        self.sequences += self.whole + len(self.cuts) - 1

    def pieces(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """Start in the tail, length, sequence and offset of each piece."""
        lows, told = self.ranges[length]
        low, greedy, base, offset = told[bisect_right(lows, rank) - 1]
        if not greedy:
            return [(0, length, base + rank - low, offset)]
        at, end, out = base + (rank - low) * length, base + (rank - low + 1) * length, []
        start = 0
        while at < end:
            row, within = divmod(at, self.window)
            if row < self.whole:
                size, sequence, place = min(end - at, self.window - within), self.row + row, within
            else:
                k = bisect_right(self.cuts, within) - 1
                size, sequence, place = min(end - at, self.cuts[k + 1] - within), self.row + self.whole + k, within - self.cuts[k]
            out.append((start, size, sequence, place))
            start, at = start + size, at + size
        return out


def _tokenised(df: DataFrame, path: str, window: int, id_col: str, text_col: str) -> DataFrame:
    """Per document: doc_tokens, the crc32 of each whole window, the tail's ids (2 or 4 bytes each),
    and its places: task, whole windows of the task before it, tails of the same length before it."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = loaded(path), TaskContext.get().partitionId()
        whole, same = 0, np.zeros(window, np.int64)
        for batch, texts in texts_in_groups(batches):
            n, crcs, tails, before, rank = [], [], [], [], []
            for text in texts:
                ids = np.array([*encoder.encode(text), END], "<u4")
                cut = len(ids) - len(ids) % window
                n.append(len(ids))
                before.append(whole)
                crcs.append([zlib.crc32(ids[i : i + window].tobytes()) for i in range(0, cut, window)])
                whole += len(crcs[-1])
                tail = ids[cut:]
                rank.append(int(same[len(tail)]))
                same[len(tail)] += 1
                tails.append((tail.astype("<u2") if tail.max(initial=0) < 1 << 16 else tail).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(crcs, pa.list_(pa.int64())), pa.array(tails, pa.binary()), pa.array([part] * len(n), pa.int32()), pa.array(before, pa.int64()), pa.array(rank, pa.int64())], ["doc_id", "doc_tokens", "crcs", "tail", "part", "before", "rank"])

    texts = df.selectExpr(f"`{id_col}` AS doc_id", f"`{text_col}` AS text")
    return mapped(texts, run, f"doc_id {kind}, doc_tokens long, crcs array<long>, tail binary, part int, before long, rank long", holds=True)


def pack(df: DataFrame, path: str, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Each document is its ids and id 0; each id lies in exactly one piece, and the pieces of a sequence
    leave no gap from offset 0 on. Every sequence has `window` ids or a power of two of them. A null
    text is empty (id 0 alone); a text may be of any length and without any space. Repeated rows, and
    rows with one id, are packed each; a null id is handed on. No rows give no pieces. Other columns are
    not read.
    """
    kind = df.schema[id_col].dataType.simpleString()
    docs = written(_tokenised(df, path, window, id_col, text_col), "tokens").withColumn("tail_length", (F.col("doc_tokens") % window).cast("int"))
    by_task = written(docs.groupBy("part", "tail_length").agg(F.count("*").alias("n"), F.sum(F.size("crcs")).alias("windows")), "tasks")
    histogram = {r["tail_length"]: r["n"] for r in by_task.filter("tail_length > 0").groupBy("tail_length").agg(F.sum("n").alias("n")).collect()}
    plan = Plan(histogram, window)
    first, parts, base = plan.sequences, [], 0
    for r in by_task.groupBy("part").agg(F.sum("windows").alias("windows")).orderBy("part").collect():  # a row a task
        parts.append((r["part"], first + base))
        base += r["windows"]
    begin = docs.sparkSession.createDataFrame(parts, "part int, begin long")
    full = (
        docs.filter("size(crcs) > 0")
        .select("doc_id", "doc_tokens", "part", "before", F.posexplode("crcs").alias("at", "ids_crc32"))
        .join(begin, "part")
        .select("doc_id", (F.col("at").cast("long") * window).alias("start"), F.lit(window).cast("long").alias("length"), "ids_crc32", "doc_tokens", (F.col("begin") + F.col("before") + F.col("at")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    )
    earlier = Window.partitionBy("tail_length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(by_task.filter("tail_length > 0").select("part", "tail_length", F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("long")).alias("ranked")), "ranks")
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = [], []
            for i, (tail, length, rank, tokens) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("tail", "tail_length", "rank", "doc_tokens")), strict=True)):
                ids = np.frombuffer(tail, "<u2" if len(tail) == 2 * length else "<u4").astype("<u4")
                for start, size, sequence, offset in plan.pieces(length, rank):
                    at.append(i)
                    rows.append((tokens - length + start, size, zlib.crc32(ids[start : start + size].tobytes()), tokens, sequence, offset))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(at, pa.int64())), *(pa.array(c, pa.int64()) for c in columns)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    tails = docs.filter("tail_length > 0").join(offsets, ["part", "tail_length"]).select("doc_id", "doc_tokens", "tail", "tail_length", (F.col("rank") + F.col("ranked")).alias("rank"))
    return full.unionByName(mapped(tails, place, schema))
