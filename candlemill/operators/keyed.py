"""One row per key: first occurrence or latest version.

Both are an aggregate over ``min_by`` / ``max_by`` of the packed row, so every map task
sends at most one row per key: a key that holds a large share of all rows costs no more
than any other. The packed row also keeps the exchange identical for every consumer,
which lets Spark reuse one shuffle when a plan reads the result more than once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KLINE_VERSION = ("ingested_at", "src_path", "line_no")
FACTOR_VERSION = ("update_time", "source", "factor_value")
SNAPSHOT_VERSION = ("ingest_version", "status_code", "latency_ms", "source_url")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    return _pick(df, keys, F.min_by, order)


def latest_per_key(df: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """Rows a newer version has not replaced; ``version`` is compared left to right."""
    return _pick(df, keys, F.max_by, F.struct(*version))


def latest_klines(df: DataFrame) -> DataFrame:
    """Latest candle per (symbol, open_time) within its interval; last inserted wins."""
    version = [c for c in KLINE_VERSION if c in df.columns]
    keys = [c for c in ("interval", "month", "symbol", "open_time") if c in df.columns]
    return latest_per_key(df, keys, version) if version else df


def latest_factors(df: DataFrame) -> DataFrame:
    keys = [c for c in ("month", "symbol", "datetime", "factor_name") if c in df.columns]
    return latest_per_key(df, keys, FACTOR_VERSION)


def latest_snapshots(df: DataFrame) -> DataFrame:
    keys = ["market", "endpoint", "pulled_at", "payload_hash"]
    version = [c for c in SNAPSHOT_VERSION if c in df.columns]
    return latest_per_key(df, keys, version)


def _pick(df: DataFrame, keys: Sequence[str], pick, order: Column) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    return (
        df.groupBy(*keys)
        .agg(pick(F.struct(*rest), order).alias("_row"))
        .select(*keys, "_row.*")
        .select(*df.columns)
    )
