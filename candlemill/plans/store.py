"""The query surface: one object over the three stored tables."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from datetime import date, datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.operators import existing, factors, klines, snapshots
from candlemill.operators.existing import stored_days
from candlemill.plans.factor_ingest import ingest_factors
from candlemill.plans.ingest import IngestStats, ingest_directory, ingest_pending
from candlemill.plans.report import LandingReport
from candlemill.plans.snapshot_ingest import ingest_snapshots
from candlemill.schema import FACTOR_WRITE_SOURCE
from candlemill.session import Staging, use_utc
from candlemill.sinks.ledger import Ledger
from candlemill.sinks.tables import write_factors, write_klines
from candlemill.sources.tables import factor_table, kline_table, snapshot_table
from candlemill.streaming.landing import stream_archives

Moment = str | int | datetime
Names = str | Iterable[str]


class MarketStore:
    """Klines, factors and market snapshots below one root folder.

    Queries return lazy DataFrames; nothing runs until the caller acts on them.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = use_utc(spark)
        self.root = root.rstrip("/")
        self.klines_path = f"{self.root}/klines"
        self.factors_path = f"{self.root}/factors"
        self.snapshots_path = f"{self.root}/snapshots"
        self.ingested_path = f"{self.root}/ingested"

    # ---------------------------------------------------------------- queries

    def get_klines(
        self,
        symbols: Names,
        interval: str = "1m",
        start: Moment | None = None,
        end: Moment | None = None,
        limit: int | None = None,
    ) -> DataFrame:
        table = kline_table(self.spark, self.klines_path)
        return klines.query_klines(table, symbols, interval, start, end, limit)

    def kline_batches(
        self,
        symbols: Names,
        interval: str = "1m",
        start: Moment | None = None,
        end: Moment | None = None,
        batch_size: int = klines.DEFAULT_BATCH,
    ) -> DataFrame:
        """The whole result with a ``batch_id`` column, for distributed consumers."""
        table = kline_table(self.spark, self.klines_path)
        return klines.query_batches(table, symbols, interval, start, end, batch_size)

    def stream_klines(
        self,
        symbols: Names,
        interval: str = "1m",
        start: Moment | None = None,
        end: Moment | None = None,
        batch_size: int = klines.DEFAULT_BATCH,
    ) -> Iterator[pd.DataFrame]:
        """The result as local frames of ``batch_size`` rows, for a local consumer."""
        table = kline_table(self.spark, self.klines_path)
        yield from klines.stream_batches(table, symbols, interval, start, end, batch_size)

    def get_symbols(
        self, market: str = "um", quote_asset: str | None = None, exclude_stable_base: bool = False
    ) -> DataFrame:
        table = snapshot_table(self.spark, self.snapshots_path)
        return snapshots.query_symbols(table, market, quote_asset, exclude_stable_base)

    def get_factors(
        self,
        symbols: Names,
        factor_names: Names,
        start: Moment | None = None,
        end: Moment | None = None,
        format: str = "long",
    ) -> DataFrame:
        table = factor_table(self.spark, self.factors_path)
        return factors.query_factors(table, symbols, factor_names, start, end, format)

    # ----------------------------------------------------------------- writes

    def write_factors(self, data, source: str = FACTOR_WRITE_SOURCE) -> int:
        """Append checked factor rows; all of them are checked before any is written."""
        staging = Staging(self.spark, "factor-write")
        try:
            frame = factors.as_frame(self.spark, data)
            rows, accepted = factors.write_rows(frame, source, materialise=staging)
            if accepted:
                write_factors(rows, self.factors_path)
            return accepted
        finally:
            staging.drop()

    def write_klines(self, rows: DataFrame) -> None:
        """Append candles and enter their days; rows that are stored nowhere are evaluated once more."""
        ledger = Ledger(self.spark, self.klines_path)
        ledger.adopt()
        origin = [F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c)
                  for c in ("src_path", "symbol", "interval")]
        run = ledger.begin(rows.select(*origin).distinct())
        write_klines(rows, self.klines_path)
        ledger.commit(run, stored_days(rows), rows.count())

    def has_day(self, symbol: str, interval: str, day: date) -> bool:
        """Has a finished run stored a candle of the UTC day; no candle is read."""
        month = day.year * 100 + day.month
        return existing.has_day(self._days(interval, month), symbol, interval, day)

    def has_month(self, symbol: str, interval: str, year: int, month: int) -> bool:
        days = self._days(interval, year * 100 + month)
        return existing.has_month(days, symbol, interval, year, month)

    def _days(self, interval: str, month: int) -> DataFrame:
        ledger = Ledger(self.spark, self.klines_path)
        ledger.adopt()
        return ledger.days([interval], [month])

    def open_files(self) -> DataFrame:
        """Archives of runs that died and that no later run has stored."""
        return Ledger(self.spark, self.klines_path).open_files()

    def ingest_klines(self, source: str, **options) -> IngestStats:
        return ingest_directory(self.spark, source, self.klines_path, **options)

    def ingest_pending(self, data: str) -> tuple[list[str], IngestStats]:
        return ingest_pending(self.spark, data, self.ingested_path, self.klines_path)

    def ingest_factors(self, folder: str, **options) -> LandingReport:
        return ingest_factors(self.spark, folder, self.factors_path, **options)

    def ingest_snapshots(self, folder: str, **options) -> LandingReport:
        return ingest_snapshots(self.spark, folder, self.snapshots_path, **options)

    def stream_ingest(self, source: str, checkpoint: str, **options):
        return stream_archives(self.spark, source, self.klines_path, checkpoint, **options)
