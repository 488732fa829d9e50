"""The ledger beside a kline table: runs, the files they took, the days they stored.

Three small tables in the folder ``<table>-ledger``:

* ``files``: what a run set out to store, written before its first row;
* ``days``: (symbol, interval, day) with at least one candle, by run, written after its last row;
* ``runs``: one row per finished run, in one file, written last. Only this row makes a run count.

A run that dies in between leaves rows in the kline table, but none of its days counts as stored: the
next run takes its files again, and candles written twice resolve to one on read. Deciding what is
stored reads the days of the months in question and never a candle.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlemill.operators.existing import committed_days, open_files, stored_days
from candlemill.sources.paths import exists
from candlemill.sources.tables import kline_table, stored_table

FILES = T.StructType([
    T.StructField("run", T.StringType()),
    T.StructField("src_path", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("interval", T.StringType()),
    T.StructField("begun_at", T.TimestampType()),
])
DAYS = T.StructType([
    T.StructField("run", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("day", T.DateType()),
    T.StructField("interval", T.StringType()),
    T.StructField("month", T.IntegerType()),
])
RUNS = T.StructType([
    T.StructField("run", T.StringType()),
    T.StructField("committed_at", T.TimestampType()),
    T.StructField("records", T.LongType()),
])


class Ledger:
    """The ledger of one kline table; nothing is read before a table of it is asked for."""

    def __init__(self, spark: SparkSession, table: str):
        self._spark = spark
        self._table = table.rstrip("/")
        self.folder = f"{self._table}-ledger"

    def begin(self, files: DataFrame) -> str:
        """Open a run over files (src_path, symbol, interval); its name."""
        run = uuid.uuid4().hex
        rows = files.select(
            F.lit(run).alias("run"), "src_path", "symbol", "interval", F.current_timestamp().alias("begun_at")
        )
        rows.write.mode("append").parquet(f"{self.folder}/files")
        return run

    def commit(self, run: str, days: DataFrame, records: int) -> None:
        """Close a run: the days it has stored count from here on."""
        day = F.col("day")
        rows = days.select(
            F.lit(run).alias("run"), "symbol", "day", "interval", (F.year(day) * 100 + F.month(day)).alias("month")
        ).distinct()
        (
            rows.repartitionByRange("interval", "month", "symbol", "day")
            .sortWithinPartitions("interval", "month", "symbol", "day")
            .write.mode("append").partitionBy("interval", "month").parquet(f"{self.folder}/days")
        )
        done = self._spark.range(1).select(
            F.lit(run).alias("run"), F.current_timestamp().alias("committed_at"),
            F.lit(records).cast("long").alias("records"),
        )
        done.coalesce(1).write.mode("append").parquet(f"{self.folder}/runs")

    def adopt(self) -> None:
        """Enter what a table holds that was written before it had a ledger; once, by one scan."""
        if exists(self._spark, self._table) and not exists(self._spark, self.folder):
            rows = kline_table(self._spark, self._table)
            self.commit("adopted", stored_days(rows), 0)

    def runs(self) -> DataFrame:
        return stored_table(self._spark, f"{self.folder}/runs", RUNS)

    def entries(self) -> DataFrame:
        """Days with their runs, finished or not."""
        return stored_table(self._spark, f"{self.folder}/days", DAYS)

    def files(self) -> DataFrame:
        return stored_table(self._spark, f"{self.folder}/files", FILES)

    def days(self, intervals: list[str] | None = None, months: list[int] | None = None) -> DataFrame:
        """(symbol, interval, day) that finished runs have stored, of the given partitions."""
        entries = self.entries()
        if intervals is not None:
            entries = entries.filter(F.col("interval").isin(intervals))
        if months is not None:
            entries = entries.filter(F.col("month").isin(months))
        return committed_days(entries, self.runs())

    def open_files(self) -> DataFrame:
        """Files that a run began and neither it nor another has finished."""
        return open_files(self.files(), self.runs())
