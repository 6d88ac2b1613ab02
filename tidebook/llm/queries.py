"""The opN_ queries: each applies its operator to the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import encode_documents
from .common import table
from .exact_dedup import exact_groups
from .html_main import extract
from .lang_id import identify
from .packing import pack
from .simhash import near_groups
from .suffix_dedup import cut_report
from .topk import scaled, top_k
from .url_filter import judge_urls
from .warc import captures_of_pages, resolve_revisits


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer file lies on this machine and on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


#: Rules of op4: verdict, host, path.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", scaled("embedding").alias("vec"))
    return top_k(vectors, vectors.filter("vec_id % 50 = 0"), 5)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_report(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve_revisits(captures_of_pages(table(spark, sf_dir, "pages")))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return found.select("capture_id", "url_key", "source_id", "status", F.array_join(lines, "|").alias("headers"))


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_topk": op2_topk,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_url_filter": op4_url_filter,
    "op5_warc": op5_warc,
    "op6_html": op6_html,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_language": op8_language,
    "op9_simhash": op9_simhash,
    "op10_bpe": op10_bpe,
}

_RULES_SQL = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)

ORACLES = {
    "op4_url_filter": f"""
        WITH r(verdict, rhost, rpath) AS (VALUES {_RULES_SQL}),
        u AS (
          SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
          FROM pages),
        p AS (
          SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
          FROM u)
        SELECT page_id, host, path, max_by(rhost || rpath, length(rhost || rpath)) AS rule,
               coalesce(max_by(r.verdict, length(rhost || rpath)), 'allow') AS verdict
        FROM p LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
        GROUP BY ALL""",
    "op7_exact_dedup": """
        WITH t AS (
          SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
          FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, text_sha256
        FROM t WINDOW w AS (PARTITION BY text_sha256)""",
    "op2_topk": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec FROM embeddings
          WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
          SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.vec, c.vec)::BIGINT AS score
          FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
        SELECT query_id, row_number() OVER w::INTEGER AS rank, vec_id, score
        FROM s WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
        QUALIFY row_number() OVER w <= 5""",
    "op5_warc": """
        WITH p AS (
          SELECT page_id, regexp_extract(url, '^([^?]*/)\\d*[^/]*/?$', 1)
                 || (coalesce(try_cast(nullif(regexp_extract(url, '/(\\d+)[^/]*/?$', 1), '') AS BIGINT), 0) % 50) AS url
          FROM pages WHERE page_id IS NOT NULL AND url IS NOT NULL),
        k AS (
          SELECT page_id, page_id // 4096 AS version,
                 CASE WHEN contains(url, '://') THEN
                   regexp_replace(regexp_replace(translate(regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*'),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ':\\d*$', ''), '^www\\d*\\.', '')
                   || regexp_replace(regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*([^#]*)', 1), '(/|\\?)+$', '')
                 ELSE url END AS url_key
          FROM p),
        r AS (
          SELECT page_id * 4 + n AS capture_id, url_key, page_id * 10 + n * 2003 AS ts,
                 CASE WHEN (page_id + n) % 7 = 0 THEN '"other"' ELSE 'W/"' || version || '"' END AS etag
          FROM k, (VALUES (1), (2)) t(n)),
        j AS (
          SELECT r.*, k.page_id AS found, k.version
          FROM r ASOF LEFT JOIN k ON r.url_key = k.url_key AND r.ts > k.page_id * 10),
        s AS (
          SELECT *, CASE WHEN found IS NULL THEN 'missing' WHEN regexp_replace(etag, '^W/', '') = '"' || version || '"' THEN 'resolved' ELSE 'changed' END AS status
          FROM j)
        SELECT capture_id, url_key, found * 4 AS source_id, status,
               'content-type: ' || CASE WHEN status = 'resolved' THEN 'text/html' ELSE 'text/plain' END
               || '|date: ' || ts || '|etag: ' || etag || '|x-cache: hit' AS headers
        FROM s""",
}
