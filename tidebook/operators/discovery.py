"""Choosing markets: rewards, eligibility, ranking, merging of sources, pending archives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def daily_reward(total: Column, rates: Column) -> Column:
    """The explicit total if there is one, else the sum of the rates that can be read."""
    read = F.transform(rates, lambda x: F.coalesce(x.try_cast("double"), F.lit(0.0)))
    return F.coalesce(total, F.aggregate(F.coalesce(read, F.array().cast("array<double>")), F.lit(0.0), lambda a, x: a + x))


def sound_tokens(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: t.isNotNull() & (t != ""))


def eligible(markets: DataFrame, min_reward: float = 0.0, min_volume: float = 0.0) -> DataFrame:
    """Markets with two tokens at least, and enough reward and volume."""
    return markets.filter((F.size(sound_tokens(F.col("tokens"))) >= 2) & (F.col("daily_reward") >= min_reward) & (F.col("volume_24hr") >= min_volume))


def select_markets(markets: DataFrame, most: int, min_reward: float = 0.0, min_volume: float = 0.0) -> DataFrame:
    """The `most` eligible markets by reward, then volume; equal ones in input order (ord). A top-n
    plan: each task keeps n rows, nothing is sorted as a whole."""
    return eligible(markets, min_reward, min_volume).orderBy(F.desc("daily_reward"), F.desc("volume_24hr"), "ord").limit(most)


def selected_assets(selected: DataFrame) -> DataFrame:
    """Distinct tokens of the selected markets with their place in first-seen order."""
    seen = selected.select("daily_reward", "volume_24hr", "ord", F.posexplode(sound_tokens(F.col("tokens"))).alias("pos", "asset_id"))
    first = seen.groupBy("asset_id").agg(F.min(F.struct((-F.col("daily_reward")).alias("r"), (-F.col("volume_24hr")).alias("v"), "ord", "pos")).alias("at"))
    # a selection has a fixed number of rows
    return first.select("asset_id", F.row_number().over(Window.orderBy("at")).alias("place"))


def merge_universe(rich: DataFrame, rewards: DataFrame) -> DataFrame:
    """All markets of both sources by condition_id, the last row of each, with all of their columns.

    The current reward wins where it is known. What only the reward source has is marked
    metadata_incomplete. Most reward first, then most volume; missing ones count as 0.
    """

    def last(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("condition_id").agg(F.max_by(F.struct(*df.columns), "ord").alias(name))

    both = last(rich, "m").join(last(rewards, "r"), "condition_id", "full_outer")
    own = {"condition_id", "total_daily_rate", "volume_24hr"}
    more = [F.coalesce(f"m.{c}", f"r.{c}").alias(c) if c in rewards.columns else F.col(f"m.{c}").alias(c) for c in rich.columns if c not in own]
    more += [F.col(f"r.{c}").alias(c) for c in rewards.columns if c not in own and c not in rich.columns]
    merged = both.select(
        "condition_id",
        F.coalesce("r.total_daily_rate", "m.total_daily_rate").alias("total_daily_rate"),
        F.coalesce(F.col("m.volume_24hr"), F.lit(0.0)).alias("volume_24hr"),
        *more,
        F.col("m").isNull().alias("metadata_incomplete"),
    )
    return merged.orderBy(F.desc(F.coalesce("total_daily_rate", F.lit(0.0))), F.desc("volume_24hr"), "condition_id")


def coverage(universe: DataFrame) -> DataFrame:
    """One row: market_count, candidate_count (markets with two tokens at least), sponsored_count (those
    that only the reward source has) and complete (whether there is none of them)."""
    return universe.agg(
        F.count("*").alias("market_count"),
        F.count_if(F.size(sound_tokens(F.col("tokens"))) >= 2).alias("candidate_count"),
        F.count_if("metadata_incomplete").alias("sponsored_count"),
        (F.count_if("metadata_incomplete") == 0).alias("complete"),
    )


def latest_settings(markets: DataFrame) -> DataFrame:
    """Per token the settings of the latest discovery (the first one at that time)."""
    order = F.struct(F.coalesce("received_at_ns", F.lit(0).cast("long")).alias("at"), (-F.col("ord")).alias("first"))
    own = [c for c in markets.columns if c != "token_id"]
    return markets.groupBy("token_id").agg(F.max_by(F.struct(*own), order).alias("s")).select("token_id", "s.*")


def enrich(selection: DataFrame, sources: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Left joins with every source by its key; a row is never dropped, and enrichment_errors names the
    sources that had nothing for it. Of a source's rows with one key the largest counts, column by column."""
    out, missing = selection, []
    for name, (df, key) in sources.items():
        part = df.groupBy(F.col(key).alias(f"__{name}")).agg(F.max(F.struct(*[c for c in df.columns if c != key])).alias(name))
        out = out.join(part, F.col(key) == F.col(f"__{name}"), "left").drop(f"__{name}")
        missing.append(F.when(F.col(name).isNull(), name))
    return out.withColumn("enrichment_errors", F.array_compact(F.array(*missing)))


def asset_counts(events: DataFrame) -> DataFrame:
    """Books and trades per asset."""
    return events.filter("asset_id <> ''").groupBy("asset_id").agg(F.count_if(F.col("event_type") == "book").alias("books"), F.count_if(F.col("event_type") == "last_trade_price").alias("trades"))


def choose_asset(events: DataFrame) -> DataFrame:
    """The asset with most trades, then books, then the last by name; it needs one of each. Empty if none."""
    return asset_counts(events).filter("books > 0 AND trades > 0").orderBy(F.desc("trades"), F.desc("books"), F.desc("asset_id")).limit(1)


def chosen_asset(events: DataFrame) -> str:
    """The asset of `choose_asset`; ValueError if none has both a book and a trade."""
    found = choose_asset(events).head()
    if found is None:
        raise ValueError("no asset has both a book and a trade")
    return found["asset_id"]


def subscription_diff(current: DataFrame, desired: DataFrame) -> DataFrame:
    """asset_id and action (``subscribe`` or ``unsubscribe``) for what differs."""
    both = current.select("asset_id", F.lit(1).alias("c"), F.lit(0).alias("d")).unionByName(desired.select("asset_id", F.lit(0).alias("c"), F.lit(1).alias("d")))
    sides = both.groupBy("asset_id").agg(F.max("c").alias("c"), F.max("d").alias("d")).filter("c <> d")
    return sides.select("asset_id", F.when(F.col("d") == 1, "subscribe").otherwise("unsubscribe").alias("action"))


def archive_columns(keys: DataFrame, column: str = "key") -> DataFrame:
    """Date, stamp and stem of archive names: the date from YYYY/MM/DD in the path, else the stamp."""
    key = F.col(column)
    stamp = F.regexp_extract(key, r"(\d{8}T\d{6})", 1)
    path = F.regexp_extract(key, r"(\d{4})/(\d{2})/(\d{2})", 0)
    date = F.when(path != "", F.translate(path, "/", "-")).when(stamp != "", F.concat_ws("-", F.substring(stamp, 1, 4), F.substring(stamp, 5, 2), F.substring(stamp, 7, 2)))
    plain = F.regexp_replace(F.regexp_replace(key, r"\.jsonl(\.gz)?$", ""), "/", "__")
    return keys.withColumns({"date": date, "stamp": F.nullif(stamp, F.lit("")), "stem": F.regexp_replace(plain, r"[^A-Za-z0-9_.-]+", "_")})


def pending_archives(listing: DataFrame, completed: DataFrame, most: int = 24, skip_prefix: str = "analytics/") -> DataFrame:
    """The first `most` archives that aren't done: those with a stamp by it, the others after them by name."""
    todo = listing.filter(F.col("key").rlike(r"\.jsonl(\.gz)?$") & ~F.startswith("key", F.lit(skip_prefix))).join(completed.select("key"), "key", "left_anti")
    return archive_columns(todo).orderBy(F.col("stamp").isNull(), "stamp", "key").limit(most)
