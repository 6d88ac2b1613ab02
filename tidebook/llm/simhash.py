"""SimHash near-duplicates with pivot distance tables.

Each text gets a 64-bit fingerprint of its word shingles. Distinct fingerprints that may lie within
`max_bits` of each other meet in buckets: with `max_bits` + 2 blocks of bits, two such fingerprints
agree on two blocks at least. In a bucket every fingerprint has its row of Hamming distances to the
reference fingerprints (pivots). By the triangle inequality a pair whose rows differ by more than
`max_bits` in any coordinate cannot be linked; the rows are swept in order of the first coordinate,
the others discard by the maximum difference, and the survivors are verified bit by bit.

A bucket hands on a spanning star of what it linked, never its pairs. Buckets above `CROWDED`
fingerprints are split by further blocks, and what is still crowded by a grid of salted cells, so no
task holds an unbounded bucket and no link is lost. Components are found by alternating star
contractions over written tables.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import in_few_files, written

BITS = 64
SEED = 42
#: Fingerprints that one bucket may hold.
CROWDED = 4096
#: Reference fingerprints.
PIVOTS = 24
#: Shingles whose bits are counted at once.
COUNTED = 1 << 16


def pivots(n: int = PIVOTS) -> np.ndarray:
    """The reference fingerprints: hashes of 0, 1, 2, ..."""
    return np.array([xxhash.xxh64_intdigest(i.to_bytes(8, "little"), SEED) for i in range(n)], np.uint64)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Bit by bit the majority of the XXH64 hashes of the text's word shingles (strictly over half).

    Words are runs of bytes other than space and 09-0D, A-Z lower-cased; with fewer words than a
    shingle takes, the whole sequence is one; without words (null, empty) the fingerprint is 0.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    digest, join = xxhash.xxh64_digest, b" ".join
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, COUNTED):
        part = words[at : min(n, at + COUNTED) + shingle - 1]
        parts = zip(*(part[i:] for i in range(shingle)), strict=False) if len(words) >= shingle else [words]
        raw = b"".join([digest(join(x), SEED) for x in parts])
        counts += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """doc_id and fingerprint (as a signed long) of every row."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x.as_py(), shingle) for x in batch.column("text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], ["doc_id", "fp"])

    return df.selectExpr(f"`{id_col}` AS doc_id", f"`{text_col}` AS text").mapInArrow(run, f"doc_id {kind}, fp long")


def _mask(bits: Iterable[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def _cut(bits: list[int], n: int) -> list[list[int]]:
    return [bits[len(bits) * i // n : len(bits) * (i + 1) // n] for i in range(n)]


def bucket_masks(max_bits: int) -> tuple[list[int], list[list[int]]]:
    """Masks of the first buckets (two of `max_bits` + 2 blocks), and for each the finer masks
    (one more of `max_bits` + 1 blocks of the other bits) for crowded ones."""
    blocks = _cut([*range(BITS)], max_bits + 2)
    first, finer = [], []
    for pair in combinations(blocks, 2):
        own = [b for x in pair for b in x]
        rest = [b for b in range(BITS) if b not in own]
        first.append(_mask(own))
        finer.append([_mask(own + x) for x in _cut(rest, max_bits + 1)])
    return first, finer


def _linked(key: np.ndarray, fp: np.ndarray, max_bits: int, refs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For whole buckets (equal keys are neighbours): fingerprints that have a link, and the smallest
    they are linked to over links found here."""
    near = np.zeros(0, np.int64)
    table = np.bitwise_count(fp.view(np.uint64)[:, None] ^ refs[None, :]).astype(np.int8)
    start = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
    group = np.zeros(len(key), np.int64)
    group[start[1:]] = 1
    group = group.cumsum()
    order = np.lexsort((table[:, 0], group))
    group, fp, table = group[order], fp[order], table[order]
    a, b = [near], [near]
    i, lag = np.arange(len(fp) - 1), 1
    while True:
        i = i[i + lag < len(fp)]
        # sorted by the first coordinate: once it is too far, so are all later ones
        i = i[(group[i] == group[i + lag]) & (table[i + lag, 0] - table[i, 0] <= max_bits)]
        if not len(i):
            break
        j = i + lag
        left = np.flatnonzero((np.abs(table[i] - table[j]) <= max_bits).all(axis=1))
        left = left[np.bitwise_count((fp[i[left]] ^ fp[j[left]]).view(np.uint64)) <= max_bits]
        a.append(i[left])
        b.append(j[left])
        lag += 1
    a, b = np.concatenate(a), np.concatenate(b)
    if not len(a):
        return near, near
    values, at = np.unique(np.concatenate([fp[a], fp[b]]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    label = np.arange(len(values))
    while True:
        least = label.copy()
        np.minimum.at(least, a, label[b])
        np.minimum.at(least, b, label[a])
        least = least[least]
        if (least == label).all():
            break
        label = least
    moved = label != np.arange(len(values))
    return values[moved], values[label[moved]]


def _sweep(buckets: DataFrame, max_bits: int) -> DataFrame:
    """Links (a, b) from rows (key, fp) that are dealt out by key."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs = pivots()
        key, fp = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def out(upto: int) -> Iterator[pa.RecordBatch]:
            if upto > 1:
                a, b = _linked(key[:upto], fp[:upto], max_bits, refs)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            key = np.concatenate([key, batch.column("key").to_numpy(zero_copy_only=False)])
            fp = np.concatenate([fp, batch.column("fp").to_numpy(zero_copy_only=False)])
            if len(key):
                changes = np.flatnonzero(key[1:] != key[:-1])
                upto = int(changes[-1]) + 1 if len(changes) else 0
                yield from out(upto)
                key, fp = key[upto:], fp[upto:]
        yield from out(len(key))

    return buckets.select("key", "fp").mapInArrow(run, "a long, b long")


def links(distinct: DataFrame, max_bits: int = 3, crowded: int = CROWDED) -> DataFrame:
    """Links (a, b) that join the same components as all pairs of `distinct` (fp) within `max_bits`."""
    first, finer = bucket_masks(max_bits)
    mine = Window.partitionBy("key")

    def keyed(rows: DataFrame, masks: list[F.Column]) -> DataFrame:
        return rows.select("fp", F.explode(F.array(*masks)).alias("b")).select("fp", "b.no", "b.key")

    def bucket(no: int, mask: int) -> F.Column:
        return F.struct(F.lit(no).alias("no"), F.xxhash64(F.lit(no), F.col("fp").bitwiseAND(F.lit(mask).cast("long"))).alias("key"))

    level = keyed(distinct, [bucket(i, m) for i, m in enumerate(first)]).withColumn("n", F.count("*").over(mine)).filter("n > 1")
    found = [_sweep(level.filter(F.col("n") <= crowded), max_bits)]
    choice = F.array(*[F.array(*[F.lit(m).cast("long") for m in masks]) for masks in finer])
    again = (
        level.filter(F.col("n") > crowded)
        .select("fp", "no", F.posexplode(F.get(choice, F.col("no"))).alias("part", "mask"))
        .select("fp", F.xxhash64("no", "part", F.col("fp").bitwiseAND(F.col("mask"))).alias("key"))
        .withColumn("n", F.count("*").over(mine))
        .filter("n > 1")
    )
    found.append(_sweep(again.filter(F.col("n") <= crowded), max_bits))
    half = crowded // 2
    cells = (
        again.filter(F.col("n") > crowded)
        .withColumn("g", F.ceil(F.col("n") / half).cast("long"))
        .withColumn("i", F.pmod(F.xxhash64("fp", F.lit(SEED)), F.col("g")))
        .select("fp", "key", "i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("g") - 1)).alias("j"))
        .select("fp", F.xxhash64("key", F.least("i", "j"), F.greatest("i", "j")).alias("key"))
        .repartition("key")
        .sortWithinPartitions("key")
    )
    found.append(_sweep(cells, max_bits))
    return reduce(DataFrame.unionByName, found)


def components(edges: DataFrame) -> DataFrame:
    """fp and root (the smallest of its component) for every value in `edges` (a, b) but the roots.

    Large-star and small-star steps alternate until nothing changes, about log(n) times. Minima are
    aggregated before the shuffle, and the joins have plain exchanges on both sides, so that a value
    with very many links can be split.
    """
    now = written(in_few_files(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()), "links")
    seen = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % (1 << 40)).alias("s")).head()
        if state == seen or not state["n"]:
            return now.select(F.col("u").alias("fp"), F.col("v").alias("root"))
        seen = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(in_few_files(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))), "large")
        large = written(in_few_files(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()), "star")
        least = written(in_few_files(large.groupBy("u").agg(F.min("v").alias("m"))), "small")
        rest = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(in_few_files(rest.unionByName(least.select("u", F.col("m").alias("v"))).distinct()), "links")


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3, crowded: int = CROWDED) -> DataFrame:
    """One row per row of `df`: doc_id, fingerprint (16 hex digits), component_id.

    Fingerprints link at `max_bits` or fewer differing bits; component_id is the smallest doc_id that
    can be reached, null ids left out (null if there is no other). Texts without words (null, empty)
    have fingerprint zero and link like any other; repeated rows come out each. No rows give no rows.
    Other columns of `df` are not read.
    """
    docs = written(fingerprints(df, id_col, text_col, shingle), "fingerprints")
    own = written(docs.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct")
    stars = written(components(links(own.select("fp"), max_bits, crowded)), "stars")
    members = stars.unionByName(stars.select(F.col("root").alias("fp"), "root").distinct())
    lowest = written(members.join(own, "fp").groupBy("root").agg(F.min("low").alias("component_id")), "lowest")
    of = written(members.join(lowest, "root").select("fp", "component_id"), "members")
    all_of = written(own.join(of, "fp", "left").select("fp", F.coalesce("component_id", "low").alias("component_id")), "components")
    return docs.join(all_of, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, max_bits: int = 3) -> DataFrame:
    """`df` with one document of each component, the one with the smallest id; same columns.

    Repeated rows of that id stay together, and rows with a null id stay if no other id is in their
    component. Only ids of dropped documents are shuffled against the documents.
    """
    dropped = near_groups(df, id_col, text_col, shingle, max_bits).filter("NOT doc_id <=> component_id").select(F.col("doc_id").alias("__dropped")).distinct()
    return df.join(dropped, F.col(id_col).eqNullSafe(F.col("__dropped")), "left_anti")
