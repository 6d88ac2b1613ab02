"""Not-modified revisits of web archives, resolved against earlier full responses.

A revisit is joined as of its time with the latest earlier full response of its canonical URL; their
validators are compared, and the headers that a not-modified answer may renew are merged into the
stored ones. The as-of join is a window of (URL, slice of time): what each slice ends with is
aggregated first and carried into the following ones, so that one URL with a great many captures is
many tasks. The window hands the response's headers on, so no join gathers a popular response's revisits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch, written
from .url_filter import url_host

#: Slices of time with about as many captures each, and parts of equal width of each slice.
TIME_SLICES, PARTS = 256, 64

# Fields that a not-modified answer doesn't renew (they describe the stored body or one hop).
NOT_RENEWED = ("connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive", "proxy-authenticate", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade")


def canonical_url(url: Column) -> Column:
    """Host (A-Z lower-cased, without www. and the port) and what follows it up to #; without the
    scheme, the / at the end, and with an empty query dropped. Null for null; a text without :// as it is."""
    host = F.regexp_replace(F.regexp_replace(url_host(url), r":\d*$", ""), r"^www\d*\.", "")
    rest = F.substring(url, F.length(F.substring_index(url, "://", 1)) + 4, F.length(url))
    tail = F.regexp_replace(F.regexp_extract(rest, r"^[^/?#]*([^#]*)", 1), r"(/|\?)+$", "")
    return F.when(F.contains(url, F.lit("://")), F.concat(host, tail)).otherwise(url)


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """One row per revisit of `captures`: capture_id, url_key, source_id, status, headers.

    `captures` has capture_id (long), url (string), ts (long), kind (``response`` or ``revisit``) and
    headers (map of lower-case names to values). source_id is the capture_id of the latest response of
    the same canonical URL with a smaller ts (of several at that ts the largest capture_id). status is

    * ``resolved``: the revisit's etag equals the response's (weak marks W/ left out); or one of the
      two has none and their last-modified are equal; or the revisit has neither,
    * ``changed``: a validator differs, so the response isn't the one that was meant,
    * ``missing``: there is no earlier response (source_id is null).

    headers are the response's, renewed from the revisit's but for `NOT_RENEWED`, when resolved; else
    the revisit's own. Null headers are no headers. Rows with a null url, ts or kind, or another kind,
    give nothing and serve nothing. Repeated revisits come out each; of repeated responses with different
    headers the last by headers counts. No rows give no rows; URLs and headers may be of any length,
    other columns are not read.
    """
    entries = F.array_sort(F.map_entries(F.coalesce("headers", F.expr("map()").cast("map<string,string>"))))
    rows = captures.select("capture_id", canonical_url(F.col("url")).alias("url_key"), "ts", "kind", entries.alias("headers"))
    rows = rows.filter("url_key IS NOT NULL AND ts IS NOT NULL AND kind IN ('response', 'revisit')")
    with scratch():
        return written(_judged(written(rows, "captures")), "revisits", keep=True)


def _sliced(rows: DataFrame) -> DataFrame:
    """Adds slice: intervals of time in order, of equal counts and then of equal width. A URL with a great
    share of all captures has that share of the slices too; a stray time makes a slice of its own."""
    ends = rows.agg(F.percentile_approx("ts", [i / TIME_SLICES for i in range(TIME_SLICES + 1)], 10_000).alias("ends")).head()["ends"]
    if not ends:
        return rows.withColumn("slice", F.lit(0).cast("long"))
    ends = sorted(set(ends))
    limits = F.array(*[F.lit(x).cast("long") for x in ends])
    place = F.size(F.filter(limits, lambda x: x <= F.col("ts"))).cast("long")  # 0 before the first, len(ends) from the last on
    low, high = F.get(limits, F.col("place").cast("int") - 1), F.get(limits, F.col("place").cast("int"))
    part = F.coalesce(F.floor((F.col("ts") - low) / (high - low) * PARTS), F.lit(0).cast("long"))
    return rows.withColumn("place", place).withColumn("slice", F.col("place") * PARTS + F.least(part, F.lit(PARTS - 1))).drop("place")


def _judged(rows: DataFrame) -> DataFrame:
    rows = _sliced(rows)
    stored = F.when(F.col("kind") == "response", F.struct("ts", "capture_id", "headers"))
    # one row for each URL and slice at most
    slices = rows.groupBy("url_key", "slice").agg(F.max(stored).alias("last"))
    before = Window.partitionBy("url_key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = written(slices.select("url_key", "slice", F.max("last").over(before).alias("carried")), "carried")
    # of equal times only earlier ones count: a range that ends below the row's own time
    earlier = Window.partitionBy("url_key", "slice").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    found = rows.withColumn("near", F.max(stored).over(earlier)).filter("kind = 'revisit'").join(carried, ["url_key", "slice"])
    source = F.coalesce("near", "carried")
    pairs = found.select("capture_id", "url_key", source.alias("source"), F.map_from_entries("headers").alias("sent"), F.map_from_entries(source["headers"]).alias("kept"))
    etag = lambda m: F.regexp_replace(F.get(F.array(F.col(m)["etag"]), F.lit(0)), r"^W/", "")
    sent, kept = etag("sent"), etag("kept")
    since, changed = F.col("sent")["last-modified"], F.col("kept")["last-modified"]
    status = (
        F.when(F.col("source").isNull(), "missing")
        .when(sent.isNotNull() & kept.isNotNull(), F.when(sent == kept, "resolved").otherwise("changed"))
        .when(since.isNotNull() & changed.isNotNull(), F.when(since == changed, "resolved").otherwise("changed"))
        .when(sent.isNull() & since.isNull(), "resolved")
        .otherwise("changed")
    )
    renewed = F.map_filter("sent", lambda k, _: ~k.isin(*NOT_RENEWED))
    merged = F.map_concat(F.map_filter("kept", lambda k, _: ~F.array_contains(F.map_keys(renewed), k)), renewed)
    judged = pairs.withColumn("status", status)
    return judged.select("capture_id", "url_key", F.col("source.capture_id").alias("source_id"), "status", F.when(F.col("status") == "resolved", merged).otherwise(F.col("sent")).alias("headers"))


def captures_of_pages(pages: DataFrame) -> DataFrame:
    """Captures made from web pages (page_id, url): of each page a response and, later, two revisits.

    Sites are taken for the URL without the page's own number, so that responses and revisits of
    several pages meet; etags follow the response's time, and every seventh revisit asks for another.
    """
    # the number in the path taken modulo 50: many pages share a URL, some a great many
    url = F.concat(F.regexp_extract("url", r"^([^?]*/)\d*[^/]*/?$", 1), (F.coalesce(F.regexp_extract("url", r"/(\d+)[^/]*/?$", 1).try_cast("long"), F.lit(0).cast("long")) % 50).cast("string"))
    page = pages.filter("page_id IS NOT NULL AND url IS NOT NULL").select("page_id", url.alias("url"))
    etag = lambda n: F.concat(F.lit('"'), n.cast("string"), F.lit('"'))
    version = F.floor(F.col("page_id") / 4096)
    response = page.select((F.col("page_id") * 4).alias("capture_id"), "url", (F.col("page_id") * 10).alias("ts"), F.lit("response").alias("kind"), F.create_map(F.lit("etag"), etag(version), F.lit("content-type"), F.lit("text/html"), F.lit("date"), (F.col("page_id") * 10).cast("string")).alias("headers"))
    both = [response]
    for n in (1, 2):
        at = F.col("page_id") * 10 + n * 2003
        asked = F.when((F.col("page_id") + n) % 7 == 0, F.lit('"other"')).otherwise(F.concat(F.lit("W/"), etag(version)))
        both.append(page.select((F.col("page_id") * 4 + n).alias("capture_id"), "url", at.alias("ts"), F.lit("revisit").alias("kind"), F.create_map(F.lit("etag"), asked, F.lit("content-type"), F.lit("text/plain"), F.lit("date"), at.cast("string"), F.lit("x-cache"), F.lit("hit")).alias("headers")))
    return both[0].unionByName(both[1]).unionByName(both[2])
