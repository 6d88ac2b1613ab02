"""Prices, ticks, rewards and fees as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_TICK = 0.001
EPSILON = 1e-12
#: What a one-sided quote counts for, at mid prices from 0.10 to 0.90: this part of it.
ONE_SIDED = 3.0


def tolerance(tick: Column) -> Column:
    """Half a tick (0 and null: the default tick) and a hair."""
    return F.coalesce(F.nullif(tick, F.lit(0.0)), F.lit(DEFAULT_TICK)) / 2 + EPSILON


def mid(bid: Column, ask: Column) -> Column:
    return (bid + ask) / 2


def crossed(bid: Column, ask: Column) -> Column:
    """A locked book counts as crossed."""
    return F.coalesce(bid >= ask, F.lit(False))


def imbalance(bids: Column, asks: Column) -> Column:
    """(bids - asks) / (bids + asks); null without depth."""
    return F.when(bids + asks > 0, (bids - asks) / (bids + asks))


def floor_to_tick(price: Column, tick: Column) -> Column:
    return F.round(F.floor((price + EPSILON) / tick) * tick, 10)


def ceil_to_tick(price: Column, tick: Column) -> Column:
    return F.round(F.ceil((price - EPSILON) / tick) * tick, 10)


def clamp(price: Column, tick: Column) -> Column:
    return F.least(F.greatest(price, tick), 1 - tick)


def inventory_skew(inventory: Column, least: float, most: float, order_size: float, ticks: int) -> Column:
    """Ticks to move quotes by, rounded half to even."""
    return F.rint((inventory - (most + least) / 2) / max(most - least, order_size) * 2 * ticks)


def reward_order_score(max_spread: Column, distance: Column, size: Column) -> Column:
    """((max - distance) / max)^2 * size; 0 outside of the spread or without size."""
    inside = (max_spread > 0) & (size > 0) & (distance >= 0) & (distance <= max_spread)
    return F.when(inside, F.pow((max_spread - distance) / max_spread, F.lit(2)) * size).otherwise(0.0)


def reward_two_sided(mid_price: Column, bid: Column, ask: Column, size: Column, max_spread_cents: Column, min_size: Column) -> Column:
    """Score of a quote on both sides; a missing side scores 0, a size below the minimum nothing."""
    distance_bid, distance_ask = (mid_price - bid) * 100, (ask - mid_price) * 100
    b = F.when(bid.isNull(), 0.0).otherwise(reward_order_score(max_spread_cents, distance_bid, size))
    a = F.when(ask.isNull(), 0.0).otherwise(reward_order_score(max_spread_cents, distance_ask, size))
    middle = F.greatest(F.least(b, a), F.greatest(b / ONE_SIDED, a / ONE_SIDED))
    return F.when(size < min_size, 0.0).when(mid_price.between(0.10, 0.90), middle).otherwise(F.least(b, a))


def fee_equivalent(size: Column, rate: Column, price: Column) -> Column:
    return size * rate * price * (1 - price)
