"""URL filters as a sort-merge range join.

A host is reversed label by label (``www.example.com`` gives ``com.example.www.``), so a rule's host
and all its subdomains form one interval of keys, and intervals nest. URLs and rules are dealt out by
ranges of the key (a rule goes to each range that its interval meets), sorted, and swept once: a
stack holds the rules whose interval is open, the innermost host on top.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .exact_dedup import LOWER, UPPER

#: Rows of the sample that the ranges are cut by, at most about twice as many.
SAMPLED = 100_000
#: Ranges for each shuffle partition.
FINER = 4


def url_host(url: Column) -> Column:
    """What lies between the first :// and the next /, ? or # (or the end), A-Z lower-cased; else empty."""
    rest = F.substring_index(url, "://", 1)
    after = F.substring(url, F.length(rest) + 4, F.length(url))
    return F.when(F.contains(url, F.lit("://")), F.translate(F.regexp_extract(after, r"^[^/?#]*", 0), UPPER, LOWER)).otherwise("")


def url_path(url: Column) -> Column:
    """What follows the host, up to ? or # (or the end); empty without ://."""
    rest = F.substring_index(url, "://", 1)
    after = F.substring(url, F.length(rest) + 4, F.length(url))
    return F.when(F.contains(url, F.lit("://")), F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def host_key(host: Column) -> Column:
    """The labels in reverse, each with a dot behind it."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _after(prefix: str) -> str:
    """The smallest key above all that start with a prefix that ends in a dot."""
    return prefix[:-1] + chr(ord(".") + 1)


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict of each row of `pages`.

    `rules` has host, path and verdict (``allow`` or ``block``). A rule fits its host and all
    subdomains if the URL's path starts with the rule's; the longest host and path together win, of
    equal ones that with the longer host, of rules for the same place ``block``. Without a rule: null
    and `default`. A null URL or one without :// has an empty host and path, which no rule fits.
    Repeated rows are judged each; no rows give no rows, no rules give `default`. Rules with a null
    or empty host, or a null path, fit nothing. Other columns are not read.
    """
    spark = pages.sparkSession
    kind = pages.schema[id_col].dataType.simpleString()
    n = FINER * int(spark.conf.get("spark.sql.shuffle.partitions"))
    url = F.col(url_col)
    urls = pages.select(F.col(id_col).alias("page_id"), url_host(url).alias("host"), url_path(url).alias("path"))
    # host first, then path and a row number: one host, one URL or one repeated row can be many ranges
    urls = urls.withColumn("key", F.concat_ws("\0", host_key(F.col("host")), "path", F.lpad(F.conv(F.monotonically_increasing_id().cast("string"), 10, 36), 13, "0")))
    rows = urls.count()
    share = max(1, -(-rows // SAMPLED))
    sampled = sorted(r["key"].encode() for r in urls.select("key").filter(F.pmod(F.xxhash64("key"), F.lit(share)) == 0).collect())
    bounds = [sampled[len(sampled) * i // n] for i in range(1, n)] if sampled else []

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("part", pa.array([bisect_right(bounds, k.as_py().encode()) for k in batch.column("key")], pa.int32()))

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, parts = [], []
            for i, key in enumerate(batch.column("key")):
                lo, hi = key.as_py(), _after(key.as_py())
                for part in range(bisect_right(bounds, lo.encode()), bisect_right(bounds, hi.encode()) + 1):
                    at.append(i)
                    parts.append(part)
            yield batch.take(pa.array(at, pa.int64())).append_column("part", pa.array(parts, pa.int32()))

    columns = f"page_id {kind}, host string, path string, key string, verdict string"
    placed = urls.withColumn("verdict", F.lit(None).cast("string")).mapInArrow(place, columns + ", part int")
    own = rules.filter("host <> '' AND path IS NOT NULL").select("host", "path", "verdict").distinct()
    own = own.select(F.lit(None).cast(kind).alias("page_id"), "host", "path", host_key(F.col("host")).alias("key"), "verdict")
    spread_rules = own.mapInArrow(spread, columns + ", part int")

    def sweep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, stack = None, []  # of (prefix, verdicts by path, lengths of the paths)
        for batch in batches:
            ids, hosts, paths, rule, verdict = [], [], [], [], []
            for i, (p, key, host, path, told) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("part", "key", "host", "path", "verdict")), strict=True)):
                if p != part:
                    part, stack = p, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if told is not None:
                    if not stack or stack[-1][0] != key:
                        stack.append((key, {}, []))
                    _, by_path, lengths = stack[-1]
                    if told == "block" or path not in by_path:
                        by_path[path] = told
                    if len(path) not in lengths:
                        lengths.append(len(path))
                        lengths.sort(reverse=True)
                    continue
                best = (-1, "", "")
                for prefix, by_path, lengths in reversed(stack):
                    for size in lengths:
                        if size <= len(path) and path[:size] in by_path:
                            if len(prefix) - 1 + size > best[0]:
                                ruled = host[len(host) - len(prefix) + 1 :] + path[:size]
                                best = (len(prefix) - 1 + size, ruled, by_path[path[:size]])
                            break
                ids.append(i)
                hosts.append(host)
                paths.append(path)
                rule.append(best[1] if best[0] >= 0 else None)
                verdict.append(best[2] if best[0] >= 0 else default)
            yield pa.RecordBatch.from_arrays([batch.column("page_id").take(pa.array(ids, pa.int64())), *(pa.array(x, pa.string()) for x in (hosts, paths, rule, verdict))], ["page_id", "host", "path", "rule", "verdict"])

    # rules come before URLs of the same key: a URL's key is always longer than its host's
    return placed.unionByName(spread_rules).repartition(n, "part").sortWithinPartitions("part", "key").mapInArrow(sweep, f"page_id {kind}, host string, path string, rule string, verdict string")
