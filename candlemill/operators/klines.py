"""Kline queries: symbol and time filters, projection, order, limit, pages, batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from datetime import datetime

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlemill.functions.arguments import as_names, one_of, require
from candlemill.functions.times import floor_div, kline_time_ms, month_or_edge, utc_month
from candlemill.operators.keyed import latest_klines
from candlemill.schema import INTERVAL_MS

Moment = str | int | datetime

# Grid slots per stretch when rows are numbered: bounds one window group.
STRETCH = 4096
DEFAULT_BATCH = 10_000

_RENAMED = {
    "open_price": "open", "high_price": "high", "low_price": "low", "close_price": "close",
}
_RETURNED = (
    "symbol", "open_time", "close_time", "open_price", "high_price", "low_price",
    "close_price", "volume", "quote_volume", "trades_count", "taker_buy_volume",
    "taker_buy_quote_volume",
)


def select_interval(klines: DataFrame, interval: str) -> DataFrame:
    return klines.filter(F.col("interval") == one_of(interval, INTERVAL_MS, "interval"))


def select_klines(
    klines: DataFrame,
    symbols: str | Iterable[str],
    interval: str = "1m",
    start: Moment | None = None,
    end: Moment | None = None,
) -> DataFrame:
    """Latest candles of the symbols and interval, both time bounds inclusive."""
    return latest_klines(stored_klines(klines, symbols, interval, start, end))


def stored_klines(
    klines: DataFrame,
    symbols: str | Iterable[str],
    interval: str = "1m",
    start: Moment | None = None,
    end: Moment | None = None,
) -> DataFrame:
    """Every stored version of the candles wanted.

    All filters are on key columns, so they run before old versions are resolved and
    reach the scan; the month bounds prune partitions.
    """
    symbol = F.col("symbol")
    wanted = symbol.isNotNull() & symbol.isin(*as_names(symbols, "symbols"))
    rows = select_interval(klines, interval).filter(wanted)
    has_month = "month" in klines.columns
    if start is not None:
        low = kline_time_ms(start)
        rows = rows.filter(F.col("open_time") >= low)
        if has_month:
            rows = rows.filter(F.col("month") >= month_or_edge(low))
    if end is not None:
        high = kline_time_ms(end)
        rows = rows.filter(F.col("open_time") <= high)
        if has_month:
            rows = rows.filter(F.col("month") <= month_or_edge(high))
    return rows


def returned_columns(rows: DataFrame) -> DataFrame:
    return rows.select(*[F.col(c).alias(_RENAMED.get(c, c)) for c in _RETURNED])


def query_klines(
    klines: DataFrame,
    symbols: str | Iterable[str],
    interval: str = "1m",
    start: Moment | None = None,
    end: Moment | None = None,
    limit: int | None = None,
) -> DataFrame:
    names = as_names(symbols, "symbols")
    rows = returned_columns(select_klines(klines, names, interval, start, end))
    several = len(set(names)) > 1
    ordered = rows.orderBy("symbol", "open_time") if several else rows.orderBy("open_time")
    return ordered if limit is None else ordered.limit(limit)


def page_after(
    klines: DataFrame,
    symbols: str | Iterable[str],
    interval: str = "1m",
    start: Moment | None = None,
    end: Moment | None = None,
    after: tuple[str, int] | None = None,
    page_size: int = DEFAULT_BATCH,
) -> DataFrame:
    """The page of rows strictly behind the (symbol, open_time) cursor.

    The keys of the page come first, from narrow columns; versions are resolved for these alone. The page's
    last key bounds the scan of the wide rows: files, row groups and months behind it are not read.
    With one symbol the cursor's month prunes partitions, too.
    """
    _check_batch_size(page_size)
    rows = stored_klines(klines, symbols, interval, start, end)
    single = len(set(as_names(symbols, "symbols"))) == 1
    has_month = "month" in rows.columns
    if after is not None:
        rows = rows.filter(_behind(*after))
        if has_month and set(as_names(symbols, "symbols")) == {after[0]}:
            rows = rows.filter(F.col("month") >= month_or_edge(after[1]))
    key = ["symbol", "open_time"]
    keys = rows.select(*key).distinct().orderBy(*key).limit(page_size)
    last = keys.agg(F.max("symbol").alias("symbol"), F.max("open_time").alias("open_time"))
    latest = last.select("open_time").scalar()
    bounded = rows.filter((F.col("symbol") <= last.select("symbol").scalar()) & (F.col("open_time") <= latest))
    if has_month and single:
        bounded = bounded.filter(F.col("month") <= last.select(utc_month(F.col("open_time"))).scalar())
    return returned_columns(latest_klines(bounded.join(keys, key))).orderBy(*key)


def query_batches(
    klines: DataFrame,
    symbols: str | Iterable[str],
    interval: str = "1m",
    start: Moment | None = None,
    end: Moment | None = None,
    batch_size: int = DEFAULT_BATCH,
) -> DataFrame:
    """The whole result with ``batch_id`` 0, 1, …: equal batches in (symbol, open_time) order.

    A row's position is the number of rows in earlier stretches plus its rank in its own
    stretch, so nothing is numbered in one task: the running total runs over one row per
    stretch, and over symbols, which the caller lists. Stretches are counted by distinct keys, so whole
    rows are scanned, and their versions resolved, once.
    """
    _check_batch_size(batch_size)
    stored = stored_klines(klines, symbols, interval, start, end)
    width = INTERVAL_MS[interval] * STRETCH
    stretch = floor_div(F.col("open_time"), width).alias("_stretch")
    rows = returned_columns(latest_klines(stored)).select("*", stretch)

    # ``month`` follows from the time, so these keys are those by which versions are resolved.
    keys = stored.select("symbol", "open_time").distinct().select("symbol", stretch)
    stretches = keys.groupBy("symbol", "_stretch").agg(F.count(F.lit(1)).alias("_rows"))
    totals = stretches.groupBy("symbol").agg(F.sum("_rows").alias("_total"))
    earlier_symbols = Window.orderBy("symbol").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("symbol").orderBy("_stretch").rowsBetween(
        Window.unboundedPreceding, -1
    )
    totals = totals.select(
        "symbol", F.coalesce(F.sum("_total").over(earlier_symbols), F.lit(0)).alias("_before")
    )
    offsets = stretches.join(totals, "symbol").select(
        "symbol", "_stretch",
        (F.col("_before") + F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).alias("_offset"),
    )
    rank = F.row_number().over(Window.partitionBy("symbol", "_stretch").orderBy("open_time"))
    position = F.col("_offset") + rank - 1
    return (
        rows.join(offsets, ["symbol", "_stretch"])
        .withColumn("batch_id", F.call_function("div", position, F.lit(batch_size).cast("long")))
        .drop("_stretch", "_offset")
    )


def stream_batches(
    klines: DataFrame,
    symbols: str | Iterable[str],
    interval: str = "1m",
    start: Moment | None = None,
    end: Moment | None = None,
    batch_size: int = DEFAULT_BATCH,
) -> Iterator[pd.DataFrame]:
    """Batches as local frames, one after another; holds one partition at a time.

    Rows come as Arrow blocks, of which the frames are cut.
    """
    _check_batch_size(batch_size)
    rows = returned_columns(select_klines(klines, symbols, interval, start, end))
    ordered = rows.orderBy("symbol", "open_time")

    def packed(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks:
            held = pa.BufferOutputStream()
            with pa.ipc.new_stream(held, block.schema) as stream:
                stream.write_batch(block)
            yield pa.RecordBatch.from_arrays([pa.array([held.getvalue().to_pybytes()], pa.binary())], ["block"])

    waiting: list[pa.Table] = []
    size = 0
    for row in ordered.mapInArrow(packed, "block binary").toLocalIterator():
        waiting.append(pa.ipc.open_stream(row["block"]).read_all())
        size += waiting[-1].num_rows
        if size >= batch_size:
            table = pa.concat_tables(waiting)
            whole = size - size % batch_size
            for start_row in range(0, whole, batch_size):
                yield table.slice(start_row, batch_size).to_pandas()
            waiting, size = [table.slice(whole)], size - whole
    if size:
        yield pa.concat_tables(waiting).to_pandas()


def count_by_symbol(rows: DataFrame) -> DataFrame:
    return rows.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows")).orderBy("symbol")


def _behind(symbol: str, open_time: int) -> Column:
    same = F.col("symbol") == symbol
    return (F.col("symbol") > symbol) | (same & (F.col("open_time") > open_time))


def _check_batch_size(size: int) -> None:
    require(size > 0, f"a batch of {size} rows holds nothing")
