"""The registered queries: library operators over the adapters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.functions.times import utc_month
from candlemill.operators import clean, existing, factors, keyed, klines, reports, snapshots
from candlemill.schema import KLINE, interval_ms
from candlemill.session import Staging
from candlemill.sinks import tables
from candlemill.sources.factor_files import factor_cells, read_truths, records, rejected_factor_files
from candlemill.sources.kline_files import good_rows, rejected_files, typed_lines, unzip_lines
from checks import adapters

Query = Callable[[SparkSession, str], DataFrame]

MANY = ["view", "click", "purchase"]
RANGE = {"interval": "1h", "start": "2024-01-05", "end": "2024-01-20T12:00:00Z"}


def queries() -> dict[str, Query]:
    return {
        "clean_dedup_first": lambda s, d: clean.keep_first(adapters.kline_feed(s, d)),
        "clean_valid": lambda s, d: clean.keep_valid(clean.keep_first(adapters.kline_feed(s, d))),
        "clean_invalid_report": _invalid_report,
        "clean_gap_fill": _gap_rows,
        "clean_full": lambda s, d: _numbered(clean.clean(adapters.kline_feed(s, d))),
        "clean_stats": lambda s, d: clean.cleaning_stats(adapters.kline_feed(s, d)),
        "ingest_totals": lambda s, d: reports.run_totals(
            clean.cleaning_stats(adapters.kline_feed(s, d))
        ),
        "file_time_range": lambda s, d: reports.file_time_range(adapters.kline_feed(s, d)),
        "kline_latest": _kline_latest,
        "kline_query_one": lambda s, d: klines.query_klines(adapters.klines(s, d), "view", **RANGE),
        "kline_query_many": lambda s, d: klines.query_klines(adapters.klines(s, d), MANY, **RANGE),
        "kline_query_limit": lambda s, d: klines.query_klines(
            adapters.klines(s, d), MANY, **RANGE, limit=100
        ),
        "kline_page_after": lambda s, d: klines.page_after(
            adapters.klines(s, d), MANY, **RANGE, after=("click", 1_705_000_000_000), page_size=250
        ),
        "kline_batches": lambda s, d: klines.query_batches(
            adapters.klines(s, d), [*MANY, "error"], "1h", batch_size=100
        ),
        "kline_counts_by_symbol": lambda s, d: klines.count_by_symbol(
            keyed.latest_klines(klines.select_interval(adapters.klines(s, d), "1h"))
        ),
        "partition_month": lambda s, d: adapters.klines(s, d).select(
            "symbol", "interval", "open_time", utc_month(F.col("open_time")).alias("month")
        ),
        "file_name_fields": lambda s, d: existing.described_files(adapters.file_names(s, d)),
        "file_filter": _file_filter,
        "interval_ms": lambda s, d: existing.described_files(adapters.file_names(s, d)).select(
            "event_id", "interval",
            F.coalesce(interval_ms(F.col("interval")), F.lit(0)).cast("long").alias("step_ms"),
        ),
        "has_data_day": lambda s, d: _has_data(s, d, monthly=False),
        "has_data_month": lambda s, d: _has_data(s, d, monthly=True),
        "skip_existing": lambda s, d: existing.skip_existing(
            _files(s, d), existing.stored_days(adapters.stored_candles(s, d))
        ).drop("monthly"),
        "ledger_days": lambda s, d: existing.committed_days(
            adapters.ledger_entries(s, d), adapters.ledger_runs(s, d)
        ).withColumn("day", F.col("day").cast("string")),
        "ledger_open_files": lambda s, d: existing.open_files(
            adapters.ledger_files(s, d), adapters.ledger_runs(s, d)
        ),
        "ledger_skip": lambda s, d: existing.skip_existing(
            _files(s, d), existing.committed_days(adapters.ledger_entries(s, d), adapters.ledger_runs(s, d))
        ).drop("monthly"),
        "csv_typed_strict": _typed_strict,
        "csv_rejected_files": lambda s, d: rejected_files(typed_lines(adapters.csv_lines(s, d))),
        "pending_markers": _pending,
        "marker_files": _marker_files,
        "factor_unpivot": _unpivot,
        "factor_coerce": lambda s, d: _plain(
            factors.factor_rows(_text_cells(s, d))
        ),
        "factor_drop_stats": lambda s, d: factors.drop_stats(_text_cells(s, d)),
        "factor_write_rows": _write_rows,
        "factor_write_faults": lambda s, d: factors.judged_write_rows(
            adapters.factor_write_input(s, d)
        ).groupBy(F.coalesce("fault", F.lit("none")).alias("fault")).agg(
            F.count(F.lit(1)).alias("rows")
        ),
        "factor_latest": lambda s, d: _plain(
            keyed.latest_factors(adapters.factor_versions(s, d)).drop("update_time", "month")
        ),
        "factor_query_long": lambda s, d: _plain(
            factors.query_factors(
                adapters.factor_versions(s, d), ["O", "F"], ["price", "cust"],
                start="1995-01-01", end="1998-06-30",
            )
        ),
        "factor_query_wide": lambda s, d: _plain(
            factors.query_factors(
                adapters.factor_versions(s, d), ["O", "F", "P"], ["price", "cust"], format="wide"
            )
        ),
        "factor_coverage": lambda s, d: _plain(factors.coverage(adapters.factor_versions(s, d))),
        "snapshot_latest": _snapshot_latest,
        "snapshot_symbols": lambda s, d: snapshots.filter_symbols(_listed(s, d)),
        "snapshot_symbols_filtered": lambda s, d: snapshots.filter_symbols(
            _listed(s, d), " usdt ", exclude_stable_base=True
        ),
        "snapshot_hash": lambda s, d: adapters.snapshots(s, d).select(
            "market", F.col("ingest_version").alias("block"),
            snapshots.payload_hash(F.col("payload")).alias("payload_hash"),
        ),
        "factor_file_cells": _file_cells,
        "factor_rejects": _rejects,
        "archive_rows": _archive_rows,
        "kline_table_rows": lambda s, d: tables.kline_table_rows(adapters.klines(s, d)).select(
            "interval", "month", "symbol", "open_time", "close_time", "close_price", "trades_count", "line_no"
        ),
        "factor_table_rows": lambda s, d: _plain(
            tables.factor_table_rows(adapters.factor_versions(s, d).drop("month"))
        ),
        "snapshot_table_rows": lambda s, d: _plain(
            tables.snapshot_table_rows(snapshots.snapshot_rows(adapters.snapshots(s, d)))
        ).select("market", "endpoint", "status_code", "payload_hash", "month", "pulled_at"),
        "snapshot_valid_json": lambda s, d: adapters.payload_texts(s, d).select(
            "event_id", snapshots.is_json(F.col("payload")).alias("valid")
        ),
        "snapshot_pulls": lambda s, d: _pulls(s, d).withColumn("pulled_ms", F.unix_millis("pulled_at")).drop("pulled_at"),
        "snapshot_broken_pulls": lambda s, d: snapshots.broken_pulls(_pulls(s, d)).select("market", "name"),
        "snapshot_rows_of_pulls": _pull_rows,
        "symbols_query": lambda s, d: snapshots.query_symbols(
            adapters.spot_snapshots(s, d), "spot", "usdt", exclude_stable_base=True
        ),
        "snapshot_counts": lambda s, d: snapshots.payload_sizes(adapters.snapshots(s, d)).select(
            "market", F.col("ingest_version").alias("block"), "symbols_count", "assets_count"
        ),
    }


def _plain(df: DataFrame) -> DataFrame:
    """Times without a zone, as the other engine has them."""
    times = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


def _numbered(cleaned: DataFrame) -> DataFrame:
    """Filled candles have no line; -1 keeps the column a whole number everywhere."""
    return cleaned.withColumn("line_no", F.coalesce("line_no", F.lit(-1)))


def _invalid_report(spark: SparkSession, folder: str) -> DataFrame:
    report = clean.invalid_report(adapters.kline_feed(spark, folder))
    return report.withColumn("reasons", F.array_join("reasons", "; "))


def _gap_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = clean.keep_valid(clean.keep_first(adapters.kline_feed(spark, folder)))
    return (
        clean.fill_gaps(rows)
        .filter(F.col("line_no").isNull())
        .select("src_path", "open_time", "close_time", "close_price", "trades_count")
    )


def _kline_latest(spark: SparkSession, folder: str) -> DataFrame:
    return keyed.latest_klines(adapters.klines(spark, folder)).select(
        "interval", "symbol", "open_time", "close_price",
        F.unix_seconds("ingested_at").alias("version"),
    )


def _file_filter(spark: SparkSession, folder: str) -> DataFrame:
    described = existing.described_files(adapters.file_names(spark, folder))
    wanted = existing.filter_files(described, ["SYM1", "SYM2", "SYM3", ""], ["1m", "1h"])
    return wanted.select("event_id", "src_path", "symbol", "interval")


def _files(spark: SparkSession, folder: str) -> DataFrame:
    names = adapters.file_names(spark, folder).select("src_path").distinct()
    return existing.filter_files(existing.described_files(names))


def _has_data(spark: SparkSession, folder: str, monthly: bool) -> DataFrame:
    files = _files(spark, folder).filter(F.col("monthly") == monthly)
    days = existing.stored_days(adapters.stored_candles(spark, folder))
    return existing.has_data(files, days).drop("monthly")


def _typed_strict(spark: SparkSession, folder: str) -> DataFrame:
    rows = good_rows(typed_lines(adapters.csv_lines(spark, folder)))
    doubles = [f.name for f in KLINE.fields if f.dataType.typeName() == "double"]
    return rows.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in doubles})


def _pending(spark: SparkSession, folder: str) -> DataFrame:
    return existing.pending_markers(
        adapters.markers(spark, folder), adapters.ingested(spark, folder)
    )


def _marker_files(spark: SparkSession, folder: str) -> DataFrame:
    files = existing.described_files(
        adapters.file_names(spark, folder).select("src_path").distinct()
    )
    announced = existing.marker_files(_pending(spark, folder), files)
    return announced.select("src_path", "interval", "date")


def _records(spark: SparkSession, folder: str, staging: Staging) -> DataFrame:
    # As in a run: what is read more than once is stored once.
    return staging(records(staging(adapters.factor_lines(spark, folder), "lines"), staging), "records")


def _rejects(spark: SparkSession, folder: str) -> DataFrame:
    return rejected_factor_files(_records(spark, folder, Staging(spark, "factor-rejects")))


def _file_cells(spark: SparkSession, folder: str) -> DataFrame:
    staging = Staging(spark, "factor-cells")
    read = _records(spark, folder, staging)
    rejected = staging(rejected_factor_files(read), "rejected")
    cells = read_truths(factor_cells(read, rejected, staging))
    return _plain(factors.factor_rows(factors.coerce_factors(cells)))


def _archive_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = good_rows(typed_lines(unzip_lines(adapters.zipped_lines(spark, folder))))
    return rows.select("src_path", "line_no", "symbol", "interval", "open_time", "high_price", "trades_count")


def _unpivot(spark: SparkSession, folder: str) -> DataFrame:
    long = factors.unpivot_factors(adapters.factor_wide(spark, folder), ["symbol"])
    return _plain(factors.factor_rows(factors.coerce_factors(long)))


def _text_cells(spark: SparkSession, folder: str) -> DataFrame:
    texts = adapters.factor_text(spark, folder)
    timed = texts.withColumn("datetime", factors.factor_time(F.col("time"))).drop("time")
    return factors.coerce_factors(timed)


def _write_rows(spark: SparkSession, folder: str) -> DataFrame:
    judged = factors.judged_write_rows(adapters.factor_write_input(spark, folder))
    return _plain(factors.accepted_write_rows(judged, "sdk").drop("update_time"))


def _markets(spark: SparkSession, folder: str) -> list[str]:
    """The event types of the data, which stand for markets."""
    types = adapters.table(spark, folder, "events").select("event_type").distinct().collect()
    return sorted(row["event_type"] for row in types)


def _snapshot_latest(spark: SparkSession, folder: str) -> DataFrame:
    return snapshots.latest_payloads(adapters.snapshots(spark, folder), _markets(spark, folder)).select(
        "market", F.unix_millis("pulled_at").alias("pulled_ms"), "payload"
    )


def _pulls(spark: SparkSession, folder: str) -> DataFrame:
    return snapshots.with_envelope(adapters.pull_documents(spark, folder), adapters.pull_envelopes(spark, folder))


def _pull_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Stored rows of the pulls, and whether a query would see them."""
    rows = snapshots.snapshot_rows(_pulls(spark, folder), F.lit(1))
    good = snapshots.good_snapshots(rows).select("market", "payload_hash", F.lit(True).alias("seen"))
    return rows.groupBy("market", "payload_hash", "status_code", "err_msg").agg(F.count("*").alias("pulls")).join(
        good.distinct(), ["market", "payload_hash"], "left"
    ).withColumn("seen", F.coalesce("seen", F.lit(False)))


def _listed(spark: SparkSession, folder: str) -> DataFrame:
    payloads = snapshots.latest_payloads(adapters.snapshots(spark, folder), _markets(spark, folder))
    return snapshots.listed_symbols(payloads, keep=("market",))
