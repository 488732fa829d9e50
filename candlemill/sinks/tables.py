"""Writing the tables: layout, append, compaction.

Kline files are laid out by range, so a busy month is shared by many tasks, every task
writes to few partitions, and row groups have narrow symbol and time ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlemill.functions.times import utc_month
from candlemill.operators.keyed import (
    FACTOR_VERSION,
    KLINE_VERSION,
    SNAPSHOT_VERSION,
    latest_per_key,
)
from candlemill.schema import FACTOR_TABLE, INTERVALS, KLINE, KLINE_TABLE, SNAPSHOT_TABLE
from candlemill.session import Staging
from candlemill.sources.paths import remove_files
from candlemill.sources.tables import factor_table, kline_table, snapshot_table

KLINE_PARTITIONS = ("interval", "month")
MONTH = ("month",)


def kline_table_rows(rows: DataFrame) -> DataFrame:
    """Candles in the shape of the stored table; an unknown interval is an error."""
    unknown = F.raise_error(F.concat(F.lit("Invalid interval: "), F.col("interval")))
    checked = F.when(F.col("interval").isin(*INTERVALS), F.col("interval")).otherwise(
        unknown.cast("string")
    )
    for name in ("src_path", "line_no"):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast(KLINE_TABLE[name].dataType))
    if "ingested_at" not in rows.columns:
        rows = rows.withColumn("ingested_at", F.current_timestamp())
    table = (
        rows.select(*KLINE.names, "ingested_at", "src_path", "line_no")
        .withColumn("interval", checked)
        .withColumn("month", utc_month(F.col("open_time")))
    )
    return table.select(*KLINE_TABLE.names)


def factor_table_rows(rows: DataFrame) -> DataFrame:
    return rows.withColumn("month", _month_of(F.col("datetime"))).select(*FACTOR_TABLE.names)


def snapshot_table_rows(rows: DataFrame) -> DataFrame:
    return rows.withColumn("month", _month_of(F.col("pulled_at"))).select(*SNAPSHOT_TABLE.names)


def write_klines(rows: DataFrame, path: str) -> None:
    """Append candles to the partitions of their interval and month."""
    _write(kline_table_rows(rows), path, KLINE_PARTITIONS, ("symbol", "open_time"))


def write_factors(rows: DataFrame, path: str, max_rows_per_file: int | None = None) -> None:
    order = ("symbol", "datetime", "factor_name")
    _write(factor_table_rows(rows), path, MONTH, order, max_rows_per_file)


def write_snapshots(rows: DataFrame, path: str) -> None:
    _write(snapshot_table_rows(rows), path, MONTH, ("market", "pulled_at"))


def mark_ingested(markers: DataFrame, path: str) -> None:
    """Add marker names to the ingested set; adding one again changes nothing."""
    markers.select("name").write.mode("append").parquet(path)


def compact_klines(spark, path: str, condition: Column | None = None) -> None:
    keys = ("interval", "month", "symbol", "open_time")
    _compact(kline_table(spark, path), path, keys, KLINE_VERSION, KLINE_PARTITIONS, condition)


def compact_factors(spark, path: str, condition: Column | None = None) -> None:
    keys = ("month", "symbol", "datetime", "factor_name")
    _compact(factor_table(spark, path), path, keys, FACTOR_VERSION, MONTH, condition)


def compact_snapshots(spark, path: str, condition: Column | None = None) -> None:
    keys = ("month", "market", "endpoint", "pulled_at", "payload_hash")
    _compact(snapshot_table(spark, path), path, keys, SNAPSHOT_VERSION, MONTH, condition)


def _compact(
    table: DataFrame,
    path: str,
    keys: Sequence[str],
    version: Sequence[str],
    partitions: Sequence[str],
    condition: Column | None,
) -> None:
    """Rewrite partitions with only the latest rows.

    ``condition`` is on partition columns and says which partitions. New files are added first, then
    exactly the files that were read go. Rows appended meanwhile stay, and until the old files are
    gone readers see rows twice, which reading the latest row resolves.
    """
    old = table if condition is None else table.filter(condition)
    spark = table.sparkSession
    staging = Staging(spark, "compact")
    try:
        read = staging(old.select(F.col("_metadata.file_path").alias("file")).distinct(), "read")
        latest = staging(latest_per_key(old, keys, version), "latest")
        order = [k for k in keys if k not in partitions]
        _write(latest, path, partitions, order)
        remove_files(spark, (row["file"] for row in read.toLocalIterator()))
    finally:
        staging.drop()


def _write(
    table: DataFrame,
    path: str,
    partitions: Sequence[str],
    order: Sequence[str],
    max_rows_per_file: int | None = None,
) -> None:
    layout = [*partitions, *order]
    writer = (
        table.repartitionByRange(*layout)
        .sortWithinPartitions(*layout)
        .write.mode("append")
        .partitionBy(*partitions)
        .option("compression", "zstd")
    )
    if max_rows_per_file is not None:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    writer.parquet(path)


def _month_of(moment: Column) -> Column:
    return utc_month(F.unix_millis(moment))
