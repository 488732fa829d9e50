"""Cleaning of candles, per source file: first occurrence, validity, gap filling.

Rows carry ``src_path`` (the file), ``line_no`` (position in it) and the kline columns.

One way serves files of every size, and no step needs a whole file in a task:

* duplicates collapse in the map tasks (see ``keyed``);
* a file's extent is an aggregate of one row per file;
* the neighbour of a row is looked up inside a stretch of ``STRETCH`` grid slots, and
  across stretches through a table that holds one row per stretch.

Times are milliseconds. A file in microseconds would fill a huge grid with a wrong step; ``foreign_units``
tells such files by the size of their times, and a run rejects them. A file that spans more than the day
or month in its name is taken as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlemill.functions.ohlc import invalid_reasons, is_valid_candle
from candlemill.functions.times import floor_div
from candlemill.operators.keyed import first_per_key
from candlemill.schema import VOLUMES, interval_ms

# Grid slots per stretch: bounds the rows one window group can hold.
STRETCH = 1024
REPORTED_PER_FILE = 10
# Milliseconds stay below this until the year 5138; microseconds of any day since 1973 do not.
NO_MS = 100_000_000_000_000

# Each column of the candle ``_slot`` steps behind a row; in slot 0 that is the row itself.
_FILLED = {
    "open_time": "open_time + _slot * _step",
    "close_time": "if(_slot > 0, open_time + (_slot + 1) * _step - 1, close_time)",
    **{c: f"if(_slot > 0, close_price, {c})" for c in ("open_price", "high_price", "low_price")},
    **{
        c: f"if(_whole, {c}, if(_slot > 0, 0D, coalesce(nanvl({c}, 0D), 0D)))" for c in VOLUMES
    },
    "trades_count": "if(_whole, trades_count, if(_slot > 0, 0L, coalesce(trades_count, 0L)))",
    "line_no": "if(_slot > 0, null, line_no)",
}

_CHECKED = ("open_price", "high_price", "low_price", "close_price", "volume")
_STRETCH_KEY = ["src_path", "_step", "_stretch", "_phase"]


def keep_first(df: DataFrame) -> DataFrame:
    """First row of each open_time in a file, in line order."""
    return first_per_key(df, ["src_path", "open_time"], F.col("line_no"))


def keep_valid(df: DataFrame) -> DataFrame:
    return df.filter(is_valid_candle())


def fill_gaps(df: DataFrame, step_ms: int | None = None) -> DataFrame:
    """Put a flat candle at the previous close into every empty grid slot of a file.

    The grid runs from the first to the last row in steps of the interval (or
    ``step_ms``). A file with fewer than two rows, or with as many rows as slots, is left
    as it is; in any other file rows off the grid are dropped. Needs unique open_times.
    """
    rows = _on_stretches(df, step_ms)
    slot = Window.partitionBy(*_STRETCH_KEY).orderBy("open_time")
    until = F.coalesce(F.lead("open_time").over(slot), F.col("_stretch_until"))
    return _fill(rows.join(_neighbours(rows), _STRETCH_KEY).withColumn("_until", until), df.columns)


def clean(df: DataFrame, step_ms: int | None = None) -> DataFrame:
    """First occurrence, validity, gap filling; the order of the three steps matters."""
    return fill_gaps(keep_valid(keep_first(df)), step_ms)


def foreign_units(df: DataFrame) -> DataFrame:
    """Files with a valid row whose time is too large to be in milliseconds, and the reason."""
    reason = F.concat(F.lit("times are not in milliseconds: "), F.max("open_time").cast("string"))
    foreign = keep_valid(df).filter(F.abs("open_time") >= NO_MS)
    return foreign.groupBy("src_path").agg(reason.alias("reason"))


def cleaning_stats(df: DataFrame, step_ms: int | None = None) -> DataFrame:
    """Per file: rows in, duplicates, invalid rows, net gap count and rows out."""
    narrow = df.select("src_path", "symbol", "interval", "line_no", "open_time", *_CHECKED)
    marked = _collapsed(narrow)
    file = ["src_path", "symbol", "interval"]
    valid_time = F.when(F.col("_valid"), F.col("open_time"))
    per_file = marked.groupBy(*file).agg(
        F.sum("_copies").alias("rows_in"),
        (F.sum("_copies") - F.count(F.lit(1))).alias("duplicates_removed"),
        F.count_if(~F.col("_valid")).alias("invalid_removed"),
        F.count(valid_time).alias("_n"),
        F.min(valid_time).alias("_start"),
        F.max(valid_time).alias("_end"),
    ).withColumn("_step", _step(step_ms))
    whole = _is_whole()
    return per_file.select(
        *file, "rows_in", "duplicates_removed", "invalid_removed",
        F.when(whole, F.lit(0)).otherwise(_slots() - F.col("_n")).cast("long").alias("gaps_filled"),
        F.when(whole, F.col("_n")).otherwise(_slots()).cast("long").alias("rows_out"),
    )


def invalid_report(df: DataFrame, per_file: int = REPORTED_PER_FILE) -> DataFrame:
    """The first invalid rows of each file, in line order, with the rules they break."""
    invalid = keep_first(df).filter(~is_valid_candle())
    order = Window.partitionBy("src_path").orderBy("line_no")
    return (
        invalid.select("src_path", "line_no", "open_time", invalid_reasons().alias("reasons"))
        .withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") <= per_file)
        .drop("_rank")
    )


def _collapsed(df: DataFrame) -> DataFrame:
    """First occurrences, whether they are valid, and the number of their copies."""
    rest = ["symbol", "interval", "line_no", *_CHECKED]
    return (
        df.groupBy("src_path", "open_time")
        .agg(
            F.min_by(F.struct(*rest), "line_no").alias("_row"),
            F.count(F.lit(1)).alias("_copies"),
        )
        .select("src_path", "open_time", "_copies", "_row.*")
        .withColumn("_valid", is_valid_candle())
    )


def _fill(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Repeat each row for the empty slots before ``_until``.

    In two steps, so that not even a very long gap is held as one array.
    """
    filled = (
        rows.selectExpr("*", "if(_whole, 0L, (_until - open_time) div _step - 1) as _missing")
        .selectExpr("*", f"explode(sequence(0L, _missing, {STRETCH}L)) as _block")
        .selectExpr("*", f"explode(sequence(_block, least(_missing, _block + {STRETCH - 1}))) as _slot")
    )
    return filled.select(*[
        F.expr(_FILLED[c]).alias(c) if c in _FILLED else F.col(c) for c in columns
    ])


def _step(step_ms: int | None) -> Column:
    if step_ms is not None:
        return F.lit(step_ms).cast("long")
    unknown = F.raise_error(F.concat(F.lit("unknown interval: "), F.col("interval")))
    return F.coalesce(interval_ms(F.col("interval")).cast("long"), unknown.cast("long"))


def _on_stretches(df: DataFrame, step_ms: int | None) -> DataFrame:
    """Give each row its step, its phase on the step, and its stretch of the time line."""
    return (
        df.withColumn("_step", _step(step_ms))
        .withColumn("_phase", F.pmod("open_time", F.col("_step")))
        .withColumn("_stretch", floor_div(F.col("open_time"), F.col("_step") * STRETCH))
    )


def _slots() -> Column:
    return F.expr("(_end - _start) div _step + 1")


def _is_whole() -> Column:
    """Fewer than two rows (``_n``), or as many as slots from ``_start`` to ``_end``."""
    return F.expr("coalesce(_n < 2 or _n = (_end - _start) div _step + 1, true)")


def _neighbours(rows: DataFrame) -> DataFrame:
    """Per stretch that keeps rows: is the file whole, and where does the next one start."""
    stretches = rows.groupBy(*_STRETCH_KEY).agg(
        F.min("open_time").alias("_first"),
        F.max("open_time").alias("_last"),
        F.count(F.lit(1)).alias("_rows"),
    )
    files = stretches.groupBy("src_path").agg(
        F.min("_first").alias("_start"),
        F.max("_last").alias("_end"),
        F.sum("_rows").alias("_n"),
    )
    following = Window.partitionBy("src_path", "_step", "_phase").orderBy("_stretch")
    past_end = F.col("_start") + _slots() * F.col("_step")
    return (
        stretches.join(files, "src_path")
        .withColumn("_whole", _is_whole())
        .filter(F.col("_whole") | (F.col("_phase") == F.pmod("_start", F.col("_step"))))
        .withColumn("_stretch_until", F.coalesce(F.lead("_first").over(following), past_end))
        .select(*_STRETCH_KEY, "_whole", "_stretch_until")
    )
