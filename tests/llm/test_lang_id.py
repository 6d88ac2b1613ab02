"""Language identification: accuracy on documents that were not learned from."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tidebook.llm.lang_id import ROW, CrossParser, _folded, identify, keep_known, learn, suffix_automaton

DATA = "/root/testdata/sf0.01/documents.parquet"


def slow_phrases(text, sample):
    """Longest matches one after the other; each row of bytes starts anew."""
    n = 0
    for at in range(0, len(text), ROW):
        row, i = text[at : at + ROW], 0
        while i < len(row):
            k = 1
            while i + k <= len(row) and row[i : i + k] in sample:
                k += 1
            i += max(1, k - 1)
            n += 1
    return n


def test_automaton_has_all_substrings():
    text = bytes(random.Random(1).choice(b"abc") for _ in range(60))
    go, subs = suffix_automaton(bytes(c - 97 for c in text), 3), {text[i:j] for i in range(60) for j in range(i, 61)}
    paths, queue = set(), [(0, b"")]
    while queue:
        s, p = queue.pop()
        paths.add(p)
        queue += [(go[s * 3 + c], p + bytes([97 + c])) for c in range(3) if go[s * 3 + c]]
    assert paths == subs


def test_phrases_are_longest_matches():
    rnd = random.Random(2)
    text = lambda n, a: bytes(rnd.choice(a) for _ in range(n))
    samples = {"x": text(400, b"abcd "), "y": text(300, b"cdef ")}
    parser = CrossParser(samples)
    samples = {k: _folded(v) for k, v in samples.items()}
    texts = [text(n, b"abcdef ") for n in (1, 2, 50, ROW, ROW + 1, 3 * ROW + 7)]
    want = [[slow_phrases(t, samples[lang]) for lang in parser.langs] for t in texts]
    assert np.array_equal(parser.phrases(texts), np.array(want))


def test_all_bytes_are_told_apart(spark):
    """Languages that together use far more than 63 bytes, one script apart by single letters."""
    alphabets = {"a": range(0x430, 0x450), "g": range(0x3B1, 0x3CA), "h": range(0x5D0, 0x5EB), "j": range(0x3041, 0x3097), "k": range(0xAC00, 0xAC40), "l": range(0x61, 0x7B), "t": range(0xE01, 0xE2F)}
    rnd = random.Random(5)
    text = lambda a, n: " ".join("".join(chr(rnd.choice(a)) for _ in range(5)) for _ in range(n))
    samples = {k: text(a, 400).encode() for k, a in alphabets.items()}
    parser = CrossParser(samples)
    assert parser.decide([text(a, 20) for a in alphabets.values()])[0] == list(alphabets)
    texts = [_folded((text(alphabets["j"], 30) + text(alphabets["k"], 30)).encode())]
    assert parser.phrases(texts).tolist() == [[slow_phrases(texts[0], _folded(samples[k])) for k in parser.langs]]
    long = text(alphabets["t"], 300_000)
    assert parser.decide([long, None, ""])[0] == ["t", "und", "und"]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(DATA)
    got = {r["doc_id"]: r for r in identify(docs).collect()}
    right = total = 0
    for r in docs.collect():
        g = got[r["doc_id"]]
        assert g["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= g["score"] <= 1
        if g["held_out"] and any(map(str.isalpha, r["text"])):
            total += 1
            right += g["lang_pred"] == r["lang"]
    assert total > 100 and right / total > 0.97


def test_odd_rows(spark):
    rows = [(i, "the cat sat on the mat and that was that", "en") for i in range(20)] + [(50 + i, "der Hund und die Katze sind nicht da", "de") for i in range(20)]
    rows += [(100, None, "en"), (101, "12 !?", "de"), (102, "", None), (103, "die Katze", None), (103, "die Katze", None), (None, "that cat", "xx")]
    df = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, score double")
    got = [tuple(r)[2] for r in sorted(identify(df).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"]))][40:]
    assert got == ["und", "und", "und", "de", "de", "en"]
    assert identify(df.limit(0)).count() == 0
    assert {r["lang_pred"] for r in identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    kept = keep_known(df, learn(df))
    assert kept.columns == df.columns and kept.count() == 43
