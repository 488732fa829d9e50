"""Candles, factors and market snapshots as Spark jobs and lazy DataFrames."""

from candlemill.plans.store import MarketStore

__all__ = ["MarketStore"]
