"""Removal of repeated byte strings against brute force."""

import hashlib
import random
from collections import Counter

import pytest

from tidebook.llm import suffix_dedup
from tidebook.llm.suffix_dedup import cut_report, parse, without_repeats

DATA = "/root/testdata/sf0.001/documents.parquet"


def brute(rows, window):
    """rows: (id, text); every byte that a repeated window covers goes."""
    raws = [(t or "").encode() for _, t in rows]
    seen = Counter(raw[i : i + window] for raw in raws for i in range(len(raw) - window + 1))
    out = []
    for (doc, _), raw in zip(rows, raws, strict=True):
        gone = bytearray(len(raw))
        for i in range(len(raw) - window + 1):
            if seen[raw[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df, **kw):
    return sorted((tuple(r) for r in cut_report(df, **kw).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


def test_every_window_has_one_phrase():
    rnd = random.Random(3)
    for size in (0, 199, 200, 201, 1500, 6000):
        text = bytes(rnd.choice(b"ab") for _ in range(size))
        start, count, offset, _ = parse(text)
        assert [s for a, n in zip(start, count, strict=True) for s in range(a, a + n)] == [*range(max(0, size - 199))]
        assert all(0 <= o + 0 <= n - 1 + 200 - suffix_dedup.TRIGGER for o, n in zip(offset, count, strict=True))


def test_blocks_do_not_matter(monkeypatch):
    text = bytes(random.Random(4).choice(b"abc ") for _ in range(5000))
    whole = parse(text)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 700)
    cut = parse(text)
    place = lambda p: [(s + k, s + o, t) for s, n, o, t in zip(*map(list, p), strict=True) for k in range(n)]
    assert place(whole) == place(cut)


def test_whole_table_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(DATA).collect()]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows, 200)


@pytest.mark.parametrize("heavy", [10**9, 2])
def test_planted_cases(spark, monkeypatch, heavy):
    monkeypatch.setattr(suffix_dedup, "MIN_HEAVY", heavy)
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, other = text(60), text(50)
    rows = [(None, None), (1, ""), (2, "short"), (3, "a" * 1000), (4, "a" * 199), (5, "ab" * 300), (6, text(300))]
    rows += [(10 + i, text(rnd.randint(0, 40)) + " " + passage + " " + text(rnd.randint(0, 40))) for i in range(12)]
    rows += [(30 + i, text(30) + other[i : i + 220] + text(20)) for i in range(6)]
    rows += [(40, other + other), (41, passage), (41, passage), (42, text(80)), (42, text(80)), (43, rows[6][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df) == brute(rows, 200)
    assert got(df, window=64) == brute(rows, 64)


def test_rest_of_texts_and_columns(spark):
    passage = "é" * 150
    rows = [(1, "x" + passage, "u"), (2, passage + "y", "v"), (3, None, "w")]
    df = spark.createDataFrame(rows, "id long, text string, spans string")
    left = without_repeats(df, id_col="id")
    assert left.columns == df.columns
    assert sorted(map(tuple, left.collect())) == [(1, "x", "u"), (2, "y", "v"), (3, None, "w")]
    assert without_repeats(df.limit(0), id_col="id").count() == 0
    assert cut_report(df.limit(0), id_col="id").count() == 0


def test_tables_grow_in_proportion(spark, monkeypatch):
    """One passage in ever more documents: no written table grows faster than they do."""
    rnd = random.Random(9)
    text = lambda n: " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8))) for _ in range(n))
    passage, sizes = text(80), {}
    write = suffix_dedup.written

    def counted(df, name, keep=False):
        out = write(df, name, keep)
        seen.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(suffix_dedup, "written", counted)
    monkeypatch.setattr(suffix_dedup, "MIN_HEAVY", 64)
    for n in (100, 400):
        seen: dict[str, list[int]] = {}
        rows = [(i, f"{text(12)} {passage} {text(12)}") for i in range(n)]
        assert got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows, 200)
        sizes[n] = {name: max(found) for name, found in seen.items()}
    assert sizes[400]["halves"] <= 2 * 4 * 400  # two ends, each in two phrases at most
    assert all(found <= 5 * sizes[100].get(name, 0) + 200 for name, found in sizes[400].items())


def test_repeated_rows_and_clashing_columns(spark):
    rnd = random.Random(2)
    text = "".join(rnd.choice("abcdef ") for _ in range(700))
    rows = [(1, text, "a", "b", "c", "d")] * 9 + [(2, "kept", "e", "f", "g", "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, h string, i string, g string, spans string")
    assert sorted(map(tuple, without_repeats(df).collect())) == sorted([(1, "", "a", "b", "c", "d")] * 9 + [rows[-1]])
    lists = suffix_dedup._span_lists(df, "doc_id", "text", 200).collect()
    assert len(lists) == 1 and len(lists[0]["spans"]) <= len(text)
