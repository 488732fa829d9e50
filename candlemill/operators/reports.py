"""Run reports: totals of a kline ingest and time range per file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def file_time_range(rows: DataFrame) -> DataFrame:
    """open_time of the first and the last row of each file, in file order."""
    return rows.groupBy("src_path").agg(
        F.min_by("open_time", "line_no").alias("first_time"),
        F.max_by("open_time", "line_no").alias("last_time"),
    )


def run_totals(per_file: DataFrame) -> DataFrame:
    """One row of totals over the per-file cleaning statistics."""
    total = lambda name: F.coalesce(F.sum(name), F.lit(0)).cast("long")
    return per_file.agg(
        F.count(F.lit(1)).alias("files_processed"),
        F.count_distinct("symbol").alias("symbols_processed"),
        total("rows_out").alias("records_written"),
        total("duplicates_removed").alias("duplicates_removed"),
        total("gaps_filled").alias("gaps_filled"),
        total("invalid_removed").alias("invalid_records_removed"),
    )
