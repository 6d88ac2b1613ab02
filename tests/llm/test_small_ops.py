"""Exact top-k, URL filters, revisits, exact dedup and BPE on odd rows, against brute force."""

import hashlib
import random
import string

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidebook.llm import bpe, exact_dedup, topk
from tidebook.llm.exact_dedup import drop_exact_copies, exact_groups
from tidebook.llm.queries import ORACLES, QUERIES
from tidebook.llm.topk import top_k
from tidebook.llm.url_filter import judge_urls
from tidebook.llm.warc import canonical_url, resolve_revisits

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    import os

    db = duckdb.connect()
    for t in os.listdir(SF):
        db.execute(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{SF}/{t}')")
    cursor = db.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    rows = QUERIES[name](spark, SF)
    assert sorted(columns) == sorted(rows.columns)
    assert sorted(str(tuple(r[c] for c in columns)) for r in rows.collect()) == sorted(map(str, cursor.fetchall()))


@pytest.mark.parametrize("at_once", [16 << 20, 3 * 6 * 8])
def test_topk(spark, monkeypatch, at_once):
    monkeypatch.setattr(topk, "BLOCK_BYTES", at_once)
    rnd = np.random.default_rng(1)
    vectors = [(i, [float(x) for x in rnd.integers(-3, 4, 6)]) for i in range(120)]
    vectors += [(200, None), (201, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (202, [float("nan")] * 6), (203, [1.0]), (None, [1.0] * 6), (5, vectors[5][1])]
    df = spark.createDataFrame([(*v, "x", 0) for v in vectors], "vec_id long, vec array<double>, score string, q int")
    got = {}
    for r in top_k(df, df.filter("vec_id % 10 = 0"), 5).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    good = [v for v in vectors if v[0] is not None and v[1] and len(v[1]) == 6 and all(x is not None and x == x for x in v[1])]
    for i, q in vectors[:120:10]:
        best = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in good if j != i)[:5]
        assert sorted(got[i]) == [(n + 1, j, -s) for n, (s, j) in enumerate(best)]
    assert set(got) == {*range(0, 120, 10)}
    few = df.filter("vec_id < 3")
    assert top_k(few, few, 5).count() == 6 and top_k(df.limit(0), df, 5).count() == 0 and top_k(df, df.limit(0), 5).count() == 0


@pytest.mark.parametrize("width", [1, 3, 16])
def test_threshold_resolves_few_pairs(width):
    """The lists hand over what reaches the cutoff, all of it, and some pairs are never resolved."""
    rnd = np.random.default_rng(width)
    queries, vectors = rnd.integers(-40, 40, (50, width)).astype(float), rnd.integers(-40, 40, (900, width)).astype(float)
    others = rnd.random((50, 900)) < 0.95
    whole = np.where(others, queries @ vectors.T, -np.inf)
    best = topk.heads(queries, vectors, others, 5)
    assert (best[:, :5] <= -np.sort(-whole, axis=1)[:, :5]).all() and (best > -np.inf).all()
    for cutoff in (best[:, 4], np.full(50, -np.inf), np.full(50, -3.0), np.full(50, 1e9)):
        row, col, total, resolved = topk.sufficient(queries, vectors, others, cutoff)
        want = {(i, j): whole[i, j] for i, j in zip(*np.nonzero((whole >= cutoff[:, None]) & others), strict=True)}
        assert dict(zip(zip(row, col, strict=True), total, strict=True)) == want
        if cutoff[0] == best[0, 4]:
            assert resolved < others.sum()  # how many depends on the vectors: the README has figures


def test_url_rules(spark):
    rules = [("com", "/", "allow"), ("a.com", "/x/", "block"), ("b.a.com", "/x/", "allow"), ("b.a.com", "/x/y", "block"), ("b.a.com", "/x/y", "allow"), ("net", "/es/", "block"), ("a-b.com", "/", "block"), (None, "/", "block"), ("", "/", "block"), ("com", None, "block")]
    hosts = ["com", "a.com", "A.com", "b.a.com", "c.b.a.com", "xa.com", "a-b.com", "a.net", "net", "a.com.", "..com", "", "a.com:80"]
    paths = ["", "/", "/x", "/x/", "/x/y", "/x/yz/?q#f", "/es/1", "/X/", "?x", "#/x/"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "no scheme/x/", "a://b://a.com/x/", "http://a.com/x/"] * 3
    df = spark.createDataFrame([(i, u, "h", "k") for i, u in enumerate(urls)], "page_id long, url string, host string, part string")
    got = {r["page_id"]: tuple(r)[1:] for r in judge_urls(df, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}
    assert len(got) == len(urls)
    lower = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    for i, u in enumerate(urls):
        host = path = ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
            host, tail = rest[:cut].translate(lower), rest[cut:]
            path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
        fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if h and p and (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=None)
        assert got[i] == (host, path, best[3] if best else None, best[4] if best else "allow"), u
    empty = spark.createDataFrame([], "host string, path string, verdict string")
    assert {tuple(r)[3:] for r in judge_urls(df, empty, "block").collect()} == {(None, "block")}
    assert judge_urls(df.limit(0), empty).count() == 0


def test_canonical_url(spark):
    urls = {"http://WWW.a.com:80/x/?#f": "a.com/x", "https://a.com/x?b=1#c": "a.com/x?b=1", "HTTP://a.com/": "a.com", "plain": "plain", None: None}
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r[0] for r in df.select(canonical_url(F.col("url"))).collect()] == list(urls.values())


def test_revisits(spark):
    rnd = random.Random(9)
    rows = []
    for i in range(400):
        url = rnd.choice(["http://hot/", "http://hot", "http://www.hot/", "http://a/1", "http://b/2?"])
        kind = rnd.choice(["response", "revisit", "revisit"])
        head = {"etag": rnd.choice(['"1"', '"2"', 'W/"1"']), "last-modified": rnd.choice(["m", "n"]), "content-type": kind, "x": str(i)}
        head = None if rnd.random() < 0.1 else {k: v for k, v in head.items() if rnd.random() < 0.7}
        rows.append((i, url, rnd.randrange(300), kind, head))
    rows += [(900, None, 1, "revisit", {}), (901, "http://a/1", None, "revisit", {}), (902, "http://a/1", 5, "other", {}), (903, "http://never/", 5, "revisit", None), rows[0], rows[1], rows[2]]
    schema = "capture_id long, url string, ts long, kind string, headers map<string,string>"
    got = sorted((r["capture_id"], r["source_id"], r["status"], sorted((r["headers"] or {}).items())) for r in resolve_revisits(spark.createDataFrame(rows, schema)).collect())
    key = lambda u: u.replace("www.", "").split("://")[1].rstrip("/?")
    want = []
    for i, u, t, k, h in rows:
        if k != "revisit" or u is None or t is None:
            continue
        h = h or {}
        earlier = [(t2, i2, h2 or {}) for i2, u2, t2, k2, h2 in rows if k2 == "response" and u2 and t2 is not None and key(u2) == key(u) and t2 < t]
        if not earlier:
            want.append((i, None, "missing", sorted(h.items())))
            continue
        _, source, kept = max(earlier, key=lambda x: x[:2])
        weak = lambda x: x.removeprefix("W/")
        if "etag" in h and "etag" in kept:
            status = "resolved" if weak(h["etag"]) == weak(kept["etag"]) else "changed"
        elif "last-modified" in h and "last-modified" in kept:
            status = "resolved" if h["last-modified"] == kept["last-modified"] else "changed"
        else:
            status = "changed" if "etag" in h or "last-modified" in h else "resolved"
        merged = kept | {k: v for k, v in h.items() if k != "content-type"} if status == "resolved" else h
        want.append((i, source, status, sorted(merged.items())))
    assert got == sorted(want)
    assert resolve_revisits(spark.createDataFrame([], schema)).count() == 0


@pytest.mark.parametrize("least", [64, 2])
def test_exact_dedup(spark, monkeypatch, least):
    monkeypatch.setattr(exact_dedup, "MIN_HEAVY", least)
    monkeypatch.setattr(exact_dedup.heavy_digests, "__defaults__", (exact_dedup.MAX_HEAVY, least))
    rows = [(i, f"Text {i % 7}") for i in range(100)] + [(200, None), (201, ""), (202, "É"), (203, "é"), (204, "TEXT 1"), (99, "text 1"), (99, "text 1"), (None, "text 2"), (None, "alone"), (None, "alone")]
    rows += [(300 + i, "x" * 50_000) for i in range(3)]
    df = spark.createDataFrame([(d, t, "w", 1) for d, t in rows], "doc_id long, text string, winner string, kept int")
    got = exact_groups(df).collect()
    assert len(got) == len(rows)
    lower = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    groups = {}
    for d, t in rows:
        groups.setdefault((t or "").translate(lower), []).append(d)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for sha, ids in by_sha.items():
        own = [r for r in got if r["text_sha256"] == sha]
        top = max((i for i in ids if i is not None), default=None)
        assert len(own) == len(ids) and {(r["keep_id"], r["group_size"]) for r in own} == {(top, len(ids))}
        assert [r["doc_id"] for r in own if r["kept"]] == [top]
    left = drop_exact_copies(df)
    assert left.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(str(max((i for i in ids if i is not None), default=None)) for ids in by_sha.values())
    assert exact_groups(df.limit(0)).count() == 0 and drop_exact_copies(df.limit(0)).count() == 0


ALPHABET = ["a", "B", "é", "ß", " ", "  ", "\n", "\t", "\x1c", "\x85", "1", "½", "²", "Ⅷ", "'s", "'LL", "!", "…", "Σ", "İ", "e\u0301", "中", "😀", "<|endoftext|>", "<|startoftext|>", "\u200b", "_", "ǅ", "ΑΣ ", "\0", " x", "\u3000"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_bpe_equals_library(spark, monkeypatch, name):
    monkeypatch.setattr(bpe, "REMEMBERED", 500)
    path, rnd = public_tokenizers.path(name), random.Random(3)
    library, own = Tokenizer.from_file(path), bpe.Bpe(path)
    texts = ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    texts += ["", "a" * 5000, " " * 300, "ab" * 3000 + " " + "xyz " * 10, "é" * 400]
    texts += [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    for i in range(0, len(texts), 100):
        for text, raw in zip(texts[i : i + 100], own.encode(texts[i : i + 100]), strict=True):
            ids = library.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(raw, "<u4").tolist() == ids, text
            assert own.decode(np.array(ids, np.int64)) == library.decode(ids, skip_special_tokens=False)


def test_bpe_query_rows(spark, monkeypatch):
    monkeypatch.setattr(bpe, "SLICE", 50)
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rows = [(1, None), (2, ""), (3, "Some words, and  more " * 40), (3, "dup"), (3, "dup"), (None, "x")]
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, n_tokens int")
    got = sorted(map(str, (tuple(r) for r in bpe.encode_documents(df, path).collect())))
    want = []
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(map(str, want))
    assert bpe.encode_documents(df.limit(0), path).count() == 0
