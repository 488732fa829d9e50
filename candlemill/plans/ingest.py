"""Kline ingest: archives in a folder to rows in the kline table.

One run unzips each archive once into a staged table; everything later (rejects,
statistics, cleaning, the skip rules) reads that table column by column. Staged tables
live in the shared folder, so a lost executor costs a task and not the run. What is stored
already is asked of the ledger (``sinks.ledger``): only days of finished runs count, so a run
that died is made up for by the next one over its files.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.functions.times import utc_day
from candlemill.operators.clean import clean, cleaning_stats, foreign_units
from candlemill.operators.existing import (
    has_data,
    marker_files,
    path_order,
    pending_markers,
    skipped_in_run,
)
from candlemill.operators.reports import run_totals
from candlemill.session import Staging, use_utc
from candlemill.sinks.ledger import Ledger
from candlemill.sinks.tables import mark_ingested, write_klines
from candlemill.sources.kline_files import (
    good_rows,
    list_archives,
    rejected_files,
    typed_lines,
    unzip_lines,
)
from candlemill.sources.markers import marker_names
from candlemill.sources.tables import ingested_markers

# Archives named in one condition on file metadata; a run takes as many groups as it needs.
PATHS_AT_ONCE = 20_000


@dataclass(frozen=True)
class IngestStats:
    symbols_processed: int = 0
    records_written: int = 0
    files_processed: int = 0
    files_skipped: int = 0
    files_rejected: int = 0
    duplicates_removed: int = 0
    gaps_filled: int = 0
    invalid_records_removed: int = 0


def ingest_directory(
    spark: SparkSession,
    source: str,
    table: str,
    symbols: list[str] | None = None,
    intervals: list[str] | None = None,
    pattern: str = "**/*.zip",
    force: bool = False,
    dry_run: bool = False,
) -> IngestStats:
    """Ingest the archives of a folder that are not in the table yet.

    A file is skipped when its day (or month) is already stored, or is written by an
    earlier file of this run; ``force`` ingests everything. ``dry_run`` does all the work
    except writing, and reports no records.
    """
    use_utc(spark)
    archives = list_archives(spark, source, symbols, intervals, pattern)
    return ingest_archives(archives, table, force, dry_run)


def ingest_archives(
    archives: DataFrame, table: str, force: bool = False, dry_run: bool = False
) -> IngestStats:
    """Ingest archives given as (src_path, content) with the fields of their names."""
    spark = archives.sparkSession
    staging = Staging(spark, "ingest")
    try:
        return _ingest(spark, archives, table, force, dry_run, staging)
    finally:
        staging.drop()


def _ingest(
    spark: SparkSession,
    archives: DataFrame,
    table: str,
    force: bool,
    dry_run: bool,
    staging: Staging,
) -> IngestStats:
    if "place" not in archives.columns:
        archives = archives.withColumn("place", path_order(F.col("src_path")))
    listed = staging(archives.drop("content"), "files")
    ledger = Ledger(spark, table)
    ledger.adopt()
    skipped_already = None
    if not force:
        stored = _months_of(listed, ledger)
        skipped_already = staging(has_data(listed, stored).select("src_path"), "stored")

    typed = _typed(archives, listed, skipped_already, staging)
    spoiled = staging(rejected_files(typed), "spoiled")
    read_rows = good_rows(typed, spoiled)
    rejected = staging(spoiled.unionByName(foreign_units(read_rows)), "rejected")
    rows = good_rows(typed, rejected)
    stats = staging(cleaning_stats(rows), "stats")
    cleaned = staging(clean(rows), "cleaned")

    days = staging(
        cleaned.select("src_path", "symbol", "interval", utc_day(F.col("open_time")).alias("day")).distinct(), "days"
    )
    kept_stats, skipped = stats, 0
    if not force:
        read = listed.join(stats.select("src_path"), "src_path", "left_semi")
        redundant = staging(skipped_in_run(read, days.select("src_path", "day"), staging), "redundant")
        days = days.join(redundant, "src_path", "left_anti")
        cleaned = cleaned.join(redundant, "src_path", "left_anti")
        kept_stats = stats.join(redundant, "src_path", "left_anti")
        skipped = skipped_already.count() + redundant.count()

    totals = run_totals(kept_stats).first()
    seen = stats.select("symbol")
    if skipped_already is not None:
        seen = seen.union(listed.join(skipped_already, "src_path", "left_semi").select("symbol"))
    if not dry_run and totals["records_written"] > 0:
        run = ledger.begin(kept_stats)
        write_klines(cleaned, table)
        ledger.commit(run, days, totals["records_written"])
    return IngestStats(
        symbols_processed=seen.distinct().count(),
        records_written=0 if dry_run else totals["records_written"],
        files_processed=totals["files_processed"] + skipped,
        files_skipped=skipped,
        files_rejected=rejected.count(),
        duplicates_removed=totals["duplicates_removed"],
        gaps_filled=totals["gaps_filled"],
        invalid_records_removed=totals["invalid_records_removed"],
    )


def _months_of(listed: DataFrame, ledger: Ledger) -> DataFrame:
    """The stored days of the months the files are about.

    The months and intervals in file names are few (a calendar's worth), so they become
    literals and prune partitions before anything is read.
    """
    day = F.col("date").cast("date")
    month = (F.year(day) * 100 + F.month(day)).alias("month")
    named = listed.filter(F.col("date").isNotNull()).select("interval", month).distinct().collect()
    months, intervals = {row["month"] for row in named}, {row["interval"] for row in named}
    return ledger.days(sorted(intervals), sorted(months))


def _typed(
    archives: DataFrame, listed: DataFrame, skipped: DataFrame | None, staging: Staging
) -> DataFrame:
    """Typed lines of the archives that aren't skipped; no other archive is opened.

    What is to be read is settled from metadata alone. Paths in a condition on file metadata keep
    Spark from opening other files; they come in groups, so their number has no bound.
    """
    if skipped is None or skipped.isEmpty():
        return staging(typed_lines(unzip_lines(archives)), "typed")
    wanted = listed.join(skipped, "src_path", "left_anti").select("src_path")
    typed = staging(typed_lines(unzip_lines(archives.filter(F.lit(False)))), "typed")
    for paths in _groups(row["src_path"] for row in wanted.toLocalIterator()):
        some = archives.filter(F.col("src_path").isin(paths))
        typed = staging(typed_lines(unzip_lines(some)), "typed", "append")
    return typed


def _groups(paths: Iterator[str]) -> Iterator[list[str]]:
    while group := list(islice(paths, PATHS_AT_ONCE)):
        yield group


def ingest_pending(
    spark: SparkSession, data: str, state: str, table: str
) -> tuple[list[str], IngestStats]:
    """Ingest the files of all pending markers in one run; returns the marker names.

    Files count in marker order, oldest first. Markers are recorded after their files
    are stored; a failure leaves them pending, and the next run takes again what was not finished.
    """
    use_utc(spark)
    pending = pending_markers(marker_names(spark, data), ingested_markers(spark, state))
    names = [row["name"] for row in pending.collect()]
    if not names:
        return [], IngestStats()
    stats = ingest_archives(marker_files(pending, list_archives(spark, data)), table)
    mark_ingested(spark.createDataFrame([(name,) for name in names], "name string"), state)
    return names, stats
