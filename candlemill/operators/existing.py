"""Which files, periods and markers are already done."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlemill.functions.names import date_of, interval_of, is_monthly, symbol_of
from candlemill.functions.times import day_bounds_ms, month_bounds_ms, month_of, utc_day
from candlemill.schema import INTERVAL_MS, MARKER

_PERIOD = ["symbol", "interval", "period"]


def described_files(files: DataFrame) -> DataFrame:
    """File paths with symbol, interval, date text and whether the name is a monthly one."""
    path = F.col("src_path")
    return files.select(
        "*",
        F.coalesce(F.nullif(symbol_of(path), F.lit("")), F.lit("UNKNOWN")).alias("symbol"),
        interval_of(path).alias("interval"),
        date_of(path).alias("date"),
        is_monthly(path).alias("monthly"),
    )


def filter_files(
    described: DataFrame,
    symbols: list[str] | None = None,
    intervals: list[str] | None = None,
) -> DataFrame:
    """Files with a known interval, of the wanted symbols and intervals.

    None means no filter, an empty list lets nothing through. With a symbol filter the
    name's own (possibly empty) symbol counts and is kept.
    """
    kept = described.filter(F.col("interval").isNotNull())
    if symbols is not None:
        own = symbol_of(F.col("src_path"))
        kept = kept.withColumn("symbol", own).filter(F.col("symbol").isin(list(symbols)))
    if intervals is not None:
        kept = kept.filter(F.col("interval").isin(list(intervals)))
    return kept


def stored_days(klines: DataFrame) -> DataFrame:
    """Distinct (symbol, interval, day) that hold at least one candle."""
    return klines.select("symbol", "interval", utc_day(F.col("open_time")).alias("day")).distinct()


def committed_days(entries: DataFrame, runs: DataFrame) -> DataFrame:
    """Distinct (symbol, interval, day) of entries whose run is finished."""
    finished = entries.join(runs.select("run").distinct(), "run", "left_semi")
    return finished.select("symbol", "interval", "day").distinct()


def open_files(files: DataFrame, runs: DataFrame) -> DataFrame:
    """Files (run, src_path) of unfinished runs that no finished run has taken as well."""
    done = runs.select("run").distinct()
    taken = files.join(done, "run", "left_semi").select("src_path").distinct()
    begun = files.join(done, "run", "left_anti").select("src_path").distinct()
    return begun.join(taken, "src_path", "left_anti")


def stored_periods(days: DataFrame) -> DataFrame:
    """Every stored day and its month as one set of period keys."""
    return days.select("symbol", "interval", _periods_of_day()).distinct()


def with_period(described: DataFrame) -> DataFrame:
    """The period whose presence makes a file redundant; NULL for a name without a date."""
    kind = F.when(F.col("monthly"), F.lit("M")).otherwise(F.lit("D"))
    return described.withColumn("period", _period(kind, F.col("date").cast("date")))


def _periods_of_day() -> Column:
    """One row for the day and one for its month."""
    day = F.col("day")
    keys = F.array(_period(F.lit("D"), day), _period(F.lit("M"), F.trunc(day, "month")))
    return F.explode(keys).alias("period")


def _period(kind: Column, first_day: Column) -> Column:
    return F.concat(kind, first_day.cast("string"))


def has_data(described: DataFrame, days: DataFrame) -> DataFrame:
    """Files whose day (or month, for a monthly name) is among the stored (symbol, interval, day)."""
    wanted = with_period(described)
    return wanted.join(stored_periods(days), _PERIOD, "left_semi").drop("period")


def skip_existing(described: DataFrame, days: DataFrame, force: bool = False) -> DataFrame:
    """Files still to be read; names without a date are never skipped."""
    if force:
        return described
    wanted = with_period(described)
    return wanted.join(stored_periods(days), _PERIOD, "left_anti").drop("period")


def has_day(days: DataFrame, symbol: str, interval: str, day: date) -> bool:
    """Is the UTC day among the stored ones; False for an unknown interval."""
    return _has_days(days, symbol, interval, F.col("day") == F.lit(day))


def has_month(days: DataFrame, symbol: str, interval: str, year: int, month: int) -> bool:
    return _has_days(days, symbol, interval, F.trunc("day", "month") == F.lit(date(year, month, 1)))


def _has_days(days: DataFrame, symbol: str, interval: str, when: Column) -> bool:
    if interval not in INTERVAL_MS:
        return False
    found = days.filter((F.col("symbol") == symbol) & (F.col("interval") == interval) & when)
    return not found.select("symbol").isEmpty()


def has_data_for_day(klines: DataFrame, symbol: str, interval: str, day: date) -> bool:
    """Is any candle stored in the UTC day; False for an unknown interval."""
    return _has_rows(klines, symbol, interval, day_bounds_ms(day))


def has_data_for_month(klines: DataFrame, symbol: str, interval: str, year: int, month: int) -> bool:
    return _has_rows(klines, symbol, interval, month_bounds_ms(year, month))


def _has_rows(klines: DataFrame, symbol: str, interval: str, bounds: tuple[int, int]) -> bool:
    if interval not in INTERVAL_MS:
        return False
    start, end = bounds
    rows = klines.filter(
        (F.col("symbol") == symbol) & (F.col("interval") == interval)
        & (F.col("open_time") >= start) & (F.col("open_time") < end)
    )
    if "month" in klines.columns:
        rows = rows.filter(F.col("month") == month_of(start))
    return not rows.select("symbol").isEmpty()


def path_order(path: Column) -> Column:
    """Sort key that orders paths segment by segment."""
    return F.translate(path, "/", "\u0001")


def skipped_in_run(described: DataFrame, written_days: DataFrame, materialise) -> DataFrame:
    """Files made redundant by earlier files of the same run: their ``src_path``.

    Files count in the order of their ``place`` (see ``path_order``): a file is skipped
    when an earlier file that is itself kept writes rows into its day (or month).
    ``written_days`` has (src_path, day) of the rows a file would write.

    A file is settled as soon as no earlier unsettled file touches its period, so each
    round settles at least the first open file of every period and usually all of them.
    A round works on one minimum per (symbol, interval, period), never on pairs of
    files. ``materialise(df, name)`` stores a round's small result and reads it back.
    """
    named = described.select("src_path", "place", "symbol", "interval")
    writes = materialise(
        written_days.join(named, "src_path")
        .select("src_path", "place", "symbol", "interval", _periods_of_day())
        .distinct(),
        "writes",
    )
    dated = with_period(described).filter(F.col("period").isNotNull())
    reads = materialise(dated.select("src_path", "place", *_PERIOD), "reads")
    undated = named.select("src_path").join(reads.select("src_path"), "src_path", "left_anti")
    settled = materialise(undated.withColumn("kept", F.lit(True)), "settled_0")
    waiting, number = reads, 0
    while not waiting.isEmpty():
        number += 1
        earliest = (
            writes.join(settled, "src_path", "left")
            .groupBy(*_PERIOD)
            .agg(
                F.min(F.when(F.col("kept"), F.col("place"))).alias("_kept"),
                F.min(F.when(F.col("kept").isNull(), F.col("place"))).alias("_open"),
            )
        )
        redundant = F.coalesce(F.col("_kept") < F.col("place"), F.lit(False))
        blocked = F.coalesce(F.col("_open") < F.col("place"), F.lit(False))
        decided = (
            waiting.join(earliest, _PERIOD, "left")
            .filter(redundant | ~blocked)
            .select("src_path", (~redundant).alias("kept"))
        )
        settled = materialise(settled.unionByName(decided), f"settled_{number}")
        waiting = reads.join(settled.select("src_path"), "src_path", "left_anti")
    return settled.filter(~F.col("kept")).select("src_path")


# -------------------------------------------------------------------- markers

def parsed_markers(names: DataFrame) -> DataFrame:
    """Marker names with their date, market and interval; other names are left out."""
    name = F.col("name")
    return names.filter(name.rlike(MARKER)).select(
        "name",
        F.regexp_extract(name, MARKER, 1).alias("date"),
        F.regexp_extract(name, MARKER, 2).alias("market"),
        F.regexp_extract(name, MARKER, 3).alias("interval"),
    )


def pending_markers(names: DataFrame, ingested: DataFrame) -> DataFrame:
    """Markers not ingested yet, oldest first."""
    return (
        parsed_markers(names)
        .join(ingested.select("name"), "name", "left_anti")
        .orderBy("date", "market", "interval")
    )


def marker_files(markers: DataFrame, files: DataFrame) -> DataFrame:
    """Daily files the markers announce: same interval and date, whatever the market.

    ``place`` orders them by their first marker, then by path.
    """
    pattern = r"-([^-/]+)-(\d{4}-\d{2}-\d{2})\.zip$"
    announced = markers.groupBy("interval", "date").agg(F.min("market").alias("_market"))
    place = F.concat_ws(
        "\u0001", "_date", "_market", "_interval", path_order(F.col("src_path"))
    )
    return (
        files.withColumn("_interval", F.regexp_extract("src_path", pattern, 1))
        .withColumn("_date", F.regexp_extract("src_path", pattern, 2))
        .join(
            announced.select(
                F.col("interval").alias("_interval"), F.col("date").alias("_date"), "_market"
            ),
            ["_interval", "_date"],
        )
        .withColumn("place", place)
        .drop("_interval", "_date", "_market")
    )
