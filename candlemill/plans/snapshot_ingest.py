"""Snapshot ingest: landed JSON documents to rows of the snapshot table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from candlemill.operators.snapshots import broken_pulls, snapshot_rows
from candlemill.plans.report import LandingReport
from candlemill.session import Staging, use_utc
from candlemill.sinks.tables import write_snapshots
from candlemill.sources.snapshot_files import landed_snapshots


def ingest_snapshots(
    spark: SparkSession,
    folder: str,
    table: str,
    markets: list[str] | None = None,
    pulled_at: datetime | None = None,
    dry_run: bool = False,
) -> LandingReport:
    """Append all landed pulls, or none if one that went well is not JSON.

    Failed pulls are stored with their status and error; queries pass over them. Files are read once, so what
    is stored is what was checked.
    """
    use_utc(spark)
    staging = Staging(spark, "snapshots")
    try:
        landed = staging(landed_snapshots(spark, folder, markets, pulled_at), "landed")
        broken = broken_pulls(landed).count()
        if broken:
            raise ValueError(f"{broken} snapshot document(s) are not valid JSON")
        counts = landed.agg(
            F.count(F.lit(1)).alias("pulls"), F.count_if(F.col("status_code") != 200).alias("failed")
        ).first()
        if not dry_run and counts["pulls"]:
            write_snapshots(snapshot_rows(landed), table)
        return LandingReport(
            read=counts["pulls"] - counts["failed"], refused=counts["failed"],
            stored=0 if dry_run else counts["pulls"],
        )
    finally:
        staging.drop()
