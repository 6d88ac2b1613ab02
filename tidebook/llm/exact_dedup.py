"""Exact dedup by heavy-hitter split, with DataFrame and SQL functions only.

A Misra-Gries summary of the digests (Spark's frequent-items sketch, built in each task and merged
by a two-level tree) proposes frequent digests. Their counts are then verified exactly and the
verified winners, at most `max_heavy` rows, are broadcast: their copies are settled where they are
read. All other digests go through an ordinary shuffle of digests, which by then has no large group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of the broadcast table at most.
MAX_HEAVY = 256
#: Counters of the sketch: any digest above about 1/1000 of the rows is sure to be among them.
TRACKED = 4096
#: A digest with fewer rows isn't worth a place in the broadcast table.
MIN_HEAVY = 64


def text_digest(text: str | Column) -> Column:
    """SHA-256 (32 bytes) of the text with A-Z lower-cased; null counts as the empty text."""
    text = F.col(text) if isinstance(text, str) else text
    return F.unhex(F.sha2(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), 256))


def heavy_digests(rows: DataFrame, max_heavy: int = MAX_HEAVY, min_heavy: int = MIN_HEAVY) -> DataFrame:
    """Verified heavy hitters of `rows` (digest, id, rid): digest, winner (id, rid), group_size.

    `max_heavy` bounds the result whatever the input; a heavy digest that is left out is still
    settled correctly by the shuffle.
    """
    spark = rows.sparkSession
    items = rows.select(F.xxhash64("digest").alias("item"), F.expr("spark_partition_id() div 32").alias("node"))
    sketch = items.groupBy("node").agg(F.expr(f"approx_top_k_accumulate(item, {TRACKED}) AS part"))
    # a key, though there is one group: Spark's combiner can't take a partition without rows
    top = sketch.groupBy(F.expr("node < 0").alias("all")).agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(part, {TRACKED}), {max_heavy}) AS top")).head()
    found = [x["item"] for x in (top["top"] if top and top["top"] else []) if x["count"] >= min_heavy]
    if not found:
        return rows.limit(0).groupBy("digest").agg(F.max(F.struct("id", "rid")).alias("winner"), F.count("*").alias("group_size"))
    proposed = spark.createDataFrame([(x,) for x in found], "item long")
    exact = (
        rows.join(F.broadcast(proposed), F.xxhash64("digest") == F.col("item"), "left_semi")
        .groupBy("digest")
        .agg(F.max(F.struct("id", "rid")).alias("winner"), F.count("*").alias("group_size"))
        .filter(F.col("group_size") >= min_heavy)
    )
    # two digests with one 64-bit item are too rare to matter for size, yet the bound stays proven
    return exact.orderBy(F.desc("group_size"), "digest").limit(max_heavy)


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `df`: doc_id, keep_id, group_size, kept, text_sha256.

    Equal texts are those that are identical after lower-casing A-Z only. The row with the largest
    id stays; among repeated rows with that id exactly one. A null text equals the empty text, a
    null id is smaller than any other. An empty table gives an empty result. Other columns of
    `df` are not read, so their names cannot clash.
    """
    rows = written(
        df.select(F.col(id_col).alias("id"), text_digest(df[text_col]).alias("digest")).withColumn("rid", F.monotonically_increasing_id()),
        "digests",
    )
    heavy = written(heavy_digests(rows), "heavy")
    joined = rows.join(F.broadcast(heavy), "digest", "left")
    settled = joined.filter("winner IS NOT NULL")
    group = Window.partitionBy("digest")
    light = (
        rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
        .withColumn("winner", F.max(F.struct("id", "rid")).over(group))
        .withColumn("group_size", F.count("*").over(group))
    )
    return settled.unionByName(light).select(
        F.col("id").alias("doc_id"),
        F.col("winner.id").alias("keep_id"),
        F.col("group_size").cast("long").alias("group_size"),
        (F.col("rid") == F.col("winner.rid")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`df` with one row of each group of equal texts, the one with the largest id; same columns.

    Copies of heavy digests are removed where they are read, so the shuffle of whole rows has no
    large group. Of repeated rows with that id one stays, whichever is met first. Null texts are empty
    ones; a null id is smaller than any other. Columns of any name are handed on; no rows give none.
    """
    columns = df.columns
    mark, rank, found, stays = fresh(df, "digest", "rank", "heavy", "stays")
    rows = written(df.select(F.col(id_col).alias("id"), text_digest(df[text_col]).alias("digest")).withColumn("rid", F.lit(0).cast("long")), "digests")
    heavy = written(heavy_digests(rows), "heavy").select(F.col("digest").alias(found), F.col("winner.id").alias(stays))
    marked = df.withColumn(mark, text_digest(df[text_col]))
    mine = marked.join(F.broadcast(heavy), F.col(mark) == F.col(found), "left").filter(F.col(found).isNull() | F.col(id_col).eqNullSafe(F.col(stays)))
    first = Window.partitionBy(mark).orderBy(F.col(id_col).desc())
    # equal rows of one heavy text are still many only if their id repeats: partial aggregation can't carry whole rows
    return mine.withColumn(rank, F.row_number().over(first)).filter(F.col(rank) == 1).select(*[F.col(f"`{c}`") for c in columns])
