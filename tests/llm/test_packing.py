"""Packing: every id once, no gaps, lengths that need no padding."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidebook.llm import packing
from tidebook.llm.packing import Encoder, Plan, pack, solve

PATH = public_tokenizers.path("byte_bpe_50k.json")
DATA = "/root/testdata/sf0.001/documents.parquet"


def check(rows, pieces, window=1024):
    tokenizer = Tokenizer.from_file(PATH)
    docs = defaultdict(list)
    for doc, text in rows:
        docs[doc].append([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0])
    by_doc, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    assert set(by_doc) == set(docs)
    for doc, all_ids in docs.items():
        if len(all_ids) == 1:
            at = 0
            for p in sorted(by_doc[doc], key=lambda p: p["start"]):
                ids = all_ids[0][p["start"] : p["start"] + p["length"]]
                assert p["start"] == at and p["doc_tokens"] == len(all_ids[0]) and p["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
                at += p["length"]
            assert at == len(all_ids[0])
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window and at & (at - 1) == 0  # full, or a power of two
    assert sum(p["length"] for p in pieces) == sum(len(x) for ids in docs.values() for x in ids)


def test_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(DATA).collect()] + [(9001, None), (9002, "")]
    check(rows, pack(spark.createDataFrame(rows, "doc_id long, text string"), PATH).collect())


def test_odd_rows(spark):
    rows = [(1, "x " * 3000), (2, "<|endoftext|>a"), (3, None), (4, "same"), (4, "same"), (None, " \n\n　 b  c")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, start long, part long")
    check(rows, pack(df, PATH).collect())
    assert pack(df.limit(0), PATH).count() == 0


@pytest.mark.parametrize("histogram", [{}, {600: 1000}, {512: 7, 1: 3}, {100: 50, 924: 80, 300: 10, 424: 9}, {n: n % 17 for n in range(1, 1024) if n % 17}])
def test_plan_uses_each_tail_once(histogram):
    plan, sequences = Plan(histogram), defaultdict(list)
    for length, n in histogram.items():
        for rank in range(n):
            at = 0
            for start, size, sequence, offset in plan.pieces(length, rank):
                assert start == at
                at += size
                sequences[sequence].append((offset, size))
            assert at == length
    sizes = Counter()
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        sizes[at] += 1
    assert set(sequences) == set(range(plan.sequences))
    assert all(n & (n - 1) == 0 and n <= 1024 for n in sizes) and all(sizes[n] == 1 for n in sizes if n < 1024)


def test_solution_fills_windows():
    histogram = {n: 40 + n % 7 for n in range(1, 1024)}
    plan = solve(histogram)
    used = Counter()
    for combo, n in plan:
        assert sum(combo) == 1024 and 2 <= len(combo) <= 3
        for a in combo:
            used[a] += n
    assert all(used[a] <= histogram[a] for a in used)
    assert sum(a * n for a, n in used.items()) > 0.9 * sum(a * n for a, n in histogram.items())


def test_ids_are_the_librarys(spark):
    tokenizer, own = Tokenizer.from_file(PATH), Encoder(PATH)
    texts = ["", " ", "a b \x1c c", "it's 12½ ǅ İ́ 😀  x\n\n y", "<|endoftext|> <|endoftext|", "z" * 3000, " a" * 2000, "\x85　. \t\r\n'LL've"]
    assert [own.encode(t) for t in texts] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_very_long_texts(monkeypatch):
    """Long runs without a place to cut, and texts that are cut, give the library's ids."""
    encoder, library = Encoder(PATH), Tokenizer.from_file(PATH)
    words = "The 12 cats' naps,  don't\n\tend\u3000here; l'été <|endoftext|> "
    texts = [" " * 5_000_000, " \n" * 500_000, "\n" * 300_000 + "end", "a" * 5_000_000, "\u4e2d\u6587" * 200_000, words * 9000, "x" + " " * 120_000 + "y z" * 20_000, "é" * 100_001 + " b"]
    for text in texts:
        assert encoder.encode(text) == library.encode(text, add_special_tokens=False).ids
    monkeypatch.setattr(packing, "SLICE", 20)
    assert encoder.encode(words * 50) == library.encode(words * 50, add_special_tokens=False).ids
