"""Factor ingest: a tree of wide CSVs to rows of the factor table."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from candlemill.functions.times import to_millisecond
from candlemill.operators.factors import coerce_factors, drop_stats, factor_rows
from candlemill.plans.report import LandingReport
from candlemill.session import Staging, use_utc
from candlemill.sinks.tables import write_factors
from candlemill.sources.factor_files import (
    factor_cells,
    factor_files,
    factor_lines,
    read_truths,
    records,
    rejected_factor_files,
)

ROWS_PER_FILE = 5_000_000


def ingest_factors(
    spark: SparkSession,
    folder: str,
    table: str,
    symbols: list[str] | None = None,
    dry_run: bool = False,
    rows_per_file: int = ROWS_PER_FILE,
) -> LandingReport:
    """Ingest all CSVs below ``csv/``; a file that cannot be read is counted and left out.

    All rows of a run carry the same update time.
    """
    use_utc(spark)
    staging = Staging(spark, "factors")
    try:
        # The files are read here, once; everything else reads staged records by column.
        lines = staging(factor_lines(spark, folder, symbols), "lines")
        read = staging(records(lines, staging), "records")
        rejected = staging(rejected_factor_files(read), "rejected")
        coerced = staging(coerce_factors(read_truths(factor_cells(read, rejected, staging))), "cells")
        counts = drop_stats(coerced, by=()).first()
        if not dry_run and counts["rows_kept"]:
            stamp = F.lit(datetime.now(timezone.utc)).cast("timestamp")
            rows = factor_rows(coerced).withColumn("update_time", to_millisecond(stamp))
            write_factors(rows, table, rows_per_file)
        total = factor_files(spark, folder, symbols).count()
        # A file without any record has no header either.
        empty = total - read.select("src_path").distinct().count()
        errors = rejected.count() + empty
        return LandingReport(
            read=total - errors,
            refused=errors,
            stored=0 if dry_run else counts["rows_kept"],
            left_out=counts["dropped_non_numeric"],
        )
    finally:
        staging.drop()
