"""Incremental ingest of archives as they land, as a Structured Streaming query.

The checkpoint remembers which files were taken, so no marker bookkeeping is needed. An
archive arrives whole and is cleaned by itself: there is no state between batches. A
failed batch fails the query, so its files are taken again; what it left half-way does not
count as stored (see ``sinks.ledger``), and rows written twice resolve to one on read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from candlemill.operators.existing import described_files, filter_files
from candlemill.plans.ingest import ingest_archives
from candlemill.session import use_utc
from candlemill.sources.kline_files import archives_at
from candlemill.sources.paths import require_folder


FILES_PER_BATCH = 5_000
_BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"


def landing_files(
    spark: SparkSession,
    source: str,
    symbols: list[str] | None = None,
    intervals: list[str] | None = None,
    file_filter: str = "*.zip",
    files_per_batch: int = FILES_PER_BATCH,
) -> DataFrame:
    """The unbounded table of archives below a folder, oldest first; none is opened."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(_BINARY_FILE)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", file_filter)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(require_folder(spark, source))
        .select(F.col("path").alias("src_path"))
    )
    return filter_files(described_files(files), symbols, intervals)


def stream_archives(
    spark: SparkSession,
    source: str,
    table: str,
    checkpoint: str,
    symbols: list[str] | None = None,
    intervals: list[str] | None = None,
    file_filter: str = "*.zip",
    files_per_batch: int = FILES_PER_BATCH,
    force: bool = False,
    available_now: bool = True,
) -> StreamingQuery:
    """Start ingesting new archives; with ``available_now`` it ends when all are taken.

    The stream carries paths only, at most ``files_per_batch`` at a time; a batch opens
    its own files.
    """
    use_utc(spark)
    files = landing_files(spark, source, symbols, intervals, file_filter, files_per_batch)

    def store(batch: DataFrame, _number: int) -> None:
        session = batch.sparkSession
        paths = [row["src_path"] for row in batch.select("src_path").collect()]
        if paths:
            ingest_archives(archives_at(session, paths), table, force)

    writer = files.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
