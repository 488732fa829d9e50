"""Factors: wide to long, lenient typing, write checks, long and wide queries."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlemill.functions.arguments import as_names, one_of, require
from candlemill.functions.numbers import csv_number, written_number
from candlemill.functions.times import (
    data_time,
    factor_time_s,
    month_or_edge,
    time_in_form,
    to_millisecond,
)
from candlemill.operators.keyed import FACTOR_VERSION, latest_factors
from candlemill.schema import FACTOR, FACTOR_INGEST_SOURCE, FACTOR_WRITE_SOURCE

Moment = str | int | datetime
# Faults of a row that bar the whole write.
BARRING = ("symbol", "factor_name", "datetime")
WRITE_COLUMNS = ("symbol", "datetime", "factor_name", "factor_value")


# ------------------------------------------------------------------ reshaping

def unpivot_factors(wide: DataFrame, ids: Sequence[str], time: str = "time") -> DataFrame:
    """Every column that is neither an id nor the time becomes (factor_name, raw_value).

    Times are read before the rows multiply.
    """
    if time not in wide.columns:
        raise ValueError(f"missing required '{time}' column")
    metrics = [c for c in wide.columns if c not in (*ids, time)]
    moment = data_time(F.col(time), wide.schema[time].dataType)
    timed = wide.select(*ids, moment.alias("datetime"), *metrics)
    if not metrics:
        return timed.filter(F.lit(False)).withColumns(
            {"factor_name": F.lit(""), "raw_value": F.lit(None).cast("double")}
        )
    return timed.unpivot([*ids, "datetime"], metrics, "factor_name", "raw_value")


def factor_time(text: Column, form: Column | None = None) -> Column:
    """Time text of a factor file; NULL where it cannot be read.

    ``form`` is that of the file's first time cell (``times.time_form``); where it is NULL, or not given,
    the text is read by itself.
    """
    return time_in_form(F.trim(text), F.lit(None).cast("string") if form is None else form)


def coerce_factors(raw: DataFrame) -> DataFrame:
    """Cells in ``raw_value`` as ``factor_value``; unreadable ones become NULL.

    Infinite values are kept. Other columns pass through.
    """
    value = F.col("raw_value")
    if isinstance(raw.schema["raw_value"].dataType, T.StringType):
        value = csv_number(value)
    return raw.withColumn("factor_value", value.cast("double")).drop("raw_value")


def is_dropped() -> Column:
    """A cell without a readable time or value."""
    value = F.col("factor_value")
    return F.col("datetime").isNull() | value.isNull() | F.isnan(value)


def factor_rows(coerced: DataFrame) -> DataFrame:
    """Readable cells in long form, stamped with the ingest source."""
    return coerced.filter(~is_dropped()).select(
        "symbol", "datetime", "factor_name", "factor_value",
        F.lit(FACTOR_INGEST_SOURCE).alias("source"),
    )


def drop_stats(coerced: DataFrame, by: Sequence[str] = ("symbol",)) -> DataFrame:
    """Cells, kept rows and dropped cells per group."""
    return coerced.groupBy(*by).agg(
        F.count(F.lit(1)).alias("cells"),
        F.count_if(~is_dropped()).alias("rows_kept"),
        F.count_if(is_dropped()).alias("dropped_non_numeric"),
    )


# ---------------------------------------------------------------- write-back

def judged_write_rows(data: DataFrame) -> DataFrame:
    """Each input row with its converted fields and its ``fault``.

    Within a row the first of these counts: a blank symbol, a blank factor name, a value
    that is no finite number (the row is dropped), an unreadable datetime.
    """
    types = {f.name: f.dataType for f in data.schema.fields}
    value = written_number(F.col("factor_value"), types["factor_value"])
    moment = data_time(F.col("datetime"), types["datetime"])
    return data.select(
        F.col("symbol").cast("string").alias("symbol"),
        F.col("factor_name").cast("string").alias("factor_name"),
        value.alias("factor_value"),
        to_millisecond(moment).alias("datetime"),
    ).withColumn(
        "fault",
        F.when(_is_blank("symbol"), F.lit("symbol"))
        .when(_is_blank("factor_name"), F.lit("factor_name"))
        .when(F.col("factor_value").isNull(), F.lit("dropped"))
        .when(F.col("datetime").isNull(), F.lit("datetime")),
    )


def accepted_write_rows(
    judged: DataFrame, source: str, update_time: datetime | None = None
) -> DataFrame:
    """Faultless rows in table form with one source and one update time."""
    stamp = F.lit(update_time) if update_time is not None else F.current_timestamp()
    return (
        judged.filter(F.col("fault").isNull())
        .withColumn("source", F.lit(source.strip()))
        .withColumn("update_time", to_millisecond(stamp.cast("timestamp")))
        .select(*FACTOR.names)
    )


def check_write_rows(judged: DataFrame) -> int:
    """The number of rows to write; an error where there is no row, or one that bars the write.

    One pass over the data. Rows of a frame have no order, so faults are told by their number.
    """
    seen = {row["fault"]: row["rows"] for row in judged.groupBy("fault").agg(
        F.count(F.lit(1)).alias("rows")
    ).collect()}
    require(seen, "there are no rows to write")
    barred = [f"{seen[kind]} with an unusable {kind}" for kind in BARRING if kind in seen]
    require(not barred, f"rows that cannot be written: {', '.join(barred)}")
    return seen.get(None, 0)


def write_rows(
    data: DataFrame,
    source: str = FACTOR_WRITE_SOURCE,
    update_time: datetime | None = None,
    materialise: Callable[[DataFrame, str], DataFrame] = lambda rows, name: rows,
) -> tuple[DataFrame, int]:
    """Checked rows ready to append, and how many there are.

    ``materialise(rows, name)`` stores the judged rows, so that what is written is what was
    checked even if the frame doesn't repeat itself.
    """
    require(isinstance(source, str) and source.strip(), "rows need a named source")
    absent = [c for c in WRITE_COLUMNS if c not in getattr(data, "columns", ())]
    require(not absent, f"columns that are needed but absent: {', '.join(absent)}")
    judged = materialise(judged_write_rows(data), "judged")
    accepted = check_write_rows(judged)
    return accepted_write_rows(judged, source, update_time), accepted


def _is_blank(name: str) -> Column:
    """No character but white space, that of Unicode included."""
    return F.coalesce(~F.col(name).rlike(r"(?U)\S"), F.lit(True))


# -------------------------------------------------------------------- queries

def select_factors(
    factors: DataFrame,
    symbols: str | Iterable[str],
    factor_names: str | Iterable[str],
    start: Moment | None = None,
    end: Moment | None = None,
) -> DataFrame:
    """Stored rows of the symbols, names and time range (whole seconds, inclusive)."""
    rows = factors.filter(
        F.col("symbol").isin(*as_names(symbols, "symbols"))
        & F.col("factor_name").isin(*as_names(factor_names, "factor names"))
    )
    has_month = "month" in factors.columns
    if start is not None:
        low = factor_time_s(start)
        rows = rows.filter(F.col("datetime") >= F.timestamp_seconds(F.lit(low)))
        if has_month:
            rows = rows.filter(F.col("month") >= month_or_edge(low * 1000))
    if end is not None:
        high = factor_time_s(end)
        rows = rows.filter(F.col("datetime") <= F.timestamp_seconds(F.lit(high)))
        if has_month:
            rows = rows.filter(F.col("month") <= month_or_edge(high * 1000))
    return rows


def query_factors(
    factors: DataFrame,
    symbols: str | Iterable[str],
    factor_names: str | Iterable[str],
    start: Moment | None = None,
    end: Moment | None = None,
    format: str = "long",
) -> DataFrame:
    names = as_names(factor_names, "factor names")
    rows = select_factors(factors, symbols, names, start, end)
    if one_of(format.lower(), ("long", "wide"), "format") == "wide":
        columns = [n for i, n in enumerate(names) if n not in names[:i]]
        return _latest_wide(rows, columns).orderBy("symbol", "datetime")
    return (
        latest_factors(rows).select(*WRITE_COLUMNS).orderBy("symbol", "datetime", "factor_name")
    )


def _latest_wide(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """One column per requested name, holding its latest value; NULL where there is none.

    The latest version is picked while pivoting, so one shuffle does both.
    """
    version = F.struct(*FACTOR_VERSION)
    return rows.groupBy("symbol", "datetime").agg(*[
        F.max_by("factor_value", F.when(F.col("factor_name") == name, version)).alias(name)
        for name in names
    ])


def coverage(factors: DataFrame) -> DataFrame:
    """Rows and first and last time per symbol and source."""
    return (
        latest_factors(factors)
        .groupBy("symbol", "source")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min("datetime").alias("min_datetime"),
            F.max("datetime").alias("max_datetime"),
        )
    )


def as_frame(spark, data) -> DataFrame:
    """A Spark frame as it is; a pandas frame converted; anything else is an error."""
    if isinstance(data, DataFrame):
        return data
    import pandas as pd

    require(isinstance(data, pd.DataFrame), "rows come as a Spark or pandas frame")
    require(len(data), "there are no rows to write")
    columns = {c: _portable(data[c]) for c in data.columns}
    schema = T.StructType([T.StructField(str(c), t) for c, (_, t) in columns.items()])
    rows = list(zip(*[values for values, _ in columns.values()], strict=True))
    return spark.createDataFrame(rows, schema)


def _portable(series) -> tuple[list, T.DataType]:
    """Plain values and Spark type of one pandas column; mixed columns become text."""
    import pandas as pd

    values = series.tolist()
    if pd.api.types.is_bool_dtype(series):
        return values, T.BooleanType()
    if pd.api.types.is_integer_dtype(series):
        return [None if v is pd.NA else int(v) for v in values], T.LongType()
    if pd.api.types.is_float_dtype(series):
        return [None if v is pd.NA else float(v) for v in values], T.DoubleType()
    if pd.api.types.is_datetime64_any_dtype(series):
        times = series.dt.floor("us")
        times = times.dt.tz_localize("UTC") if times.dt.tz is None else times
        return [None if pd.isna(v) else v.to_pydatetime() for v in times], T.TimestampType()
    return [None if v is None or v is pd.NA else str(v) for v in values], T.StringType()
