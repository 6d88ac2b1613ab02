"""SimHash fingerprints, links and components against brute force."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from tidebook.llm.simhash import drop_near_copies, fingerprint, links, near_groups

DATA = "/root/testdata/sf0.001/documents.parquet"


def slow_fingerprint(text, k=3):
    words, word = [], bytearray()
    for b in (text or "").encode():
        if b == 0x20 or 0x09 <= b <= 0x0D:
            words += [bytes(word)] if word else []
            word = bytearray()
        else:
            word.append(b + 32 if 65 <= b <= 90 else b)
    words += [bytes(word)] if word else []
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps):
    """fps: list of (id, fp); the smallest id that can be reached from each."""
    label = [i for i, _ in fps]
    changed = True
    while changed:
        changed = False
        for x, (_, a) in enumerate(fps):
            for y, (_, b) in enumerate(fps):
                if (a ^ b).bit_count() <= 3 and label[y] < label[x]:
                    label[x], changed = label[y], True
    return label


def test_fingerprint_is_spark_xxhash64(spark):
    one = spark.sql("SELECT xxhash64('a b c') AS h").head()["h"] % (1 << 64)
    assert fingerprint("A  b\tc") == one
    assert fingerprint(None) == fingerprint(" \n") == 0
    assert fingerprint("a b") == xxhash.xxh64(b"a b", seed=42).intdigest()


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet(DATA)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows += [(9000 + i, t) for i, t in enumerate([None, "", " \t", "one", "one two", "one\x85two three", rows[0][1], "É é e"])]
    got = {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    fps = [(i, slow_fingerprint(t)) for i, t in rows]
    assert {i: x[0] for i, x in got.items()} == dict(fps)
    assert [got[i][1] for i, _ in fps] == slow_components(fps)


@pytest.mark.parametrize("crowded", [4096, 8, 4])
def test_links_lose_nothing(spark, crowded):
    rnd = random.Random(5)
    values = set()
    for _ in range(25):  # chains and clouds around a few centres, so that buckets are crowded
        x = rnd.getrandbits(64)
        for _ in range(12):
            values.add(x)
            for _ in range(rnd.randint(1, 4)):
                x ^= 1 << rnd.randrange(64)
    values = sorted(values)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    found = links(spark.createDataFrame(signed, "fp long"), crowded=crowded).collect()
    root = {v: v for v in values}

    def top(v):
        while root[v] != v:
            v = root[v]
        return v

    for r in found:
        root[top(r["a"] % (1 << 64))] = top(r["b"] % (1 << 64))
    want = slow_components([(i, v) for i, v in enumerate(values)])
    got = [top(v) for v in values]
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def test_empty_table_extra_columns_and_repeated_rows(spark):
    schema = "fp string, doc_id long, key long, text string"
    assert near_groups(spark.createDataFrame([], schema)).count() == 0
    df = spark.createDataFrame([("a", 2, 1, "x y z"), ("b", 2, 1, "x y z"), ("c", None, 1, "x y z"), ("d", 5, 1, "q")], schema)
    assert sorted((r["doc_id"] or -1, r["component_id"]) for r in near_groups(df).collect()) == [(-1, 2), (2, 2), (2, 2), (5, 5)]
    left = drop_near_copies(df)
    assert left.columns == df.columns and sorted(r["doc_id"] for r in left.select(F.col("doc_id")).collect()) == [2, 2, 5]
