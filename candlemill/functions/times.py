"""Time arguments given by a caller, and the same conversions for columns of data.

Everything is UTC. Text without an offset is read in the session time zone, which the
engine sets to UTC (``session.use_utc``); nothing else here depends on it.
"""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY_MS = 86_400_000
# A factor time above this many units is taken for milliseconds, otherwise seconds.
MILLIS_ABOVE = 10_000_000_000
# Last instant of year 9999, in milliseconds; integers beyond it are no time at all.
MAX_MS = 253_402_300_799_999

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
_INT_TEXT = re.compile(r"\s*[+-]?\d+(_\d+)*\s*")

# Date or date-time text; dashes or slashes, any fraction; seconds and offset may be absent.
_ISO = (
    r"^\d{4}([-/])\d{2}\1\d{2}"
    r"(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z|[+-]\d{2}(?::?\d{2})?)?)?$"
)
_NO_SECONDS = r"^(.{10}[T ]\d{2}:\d{2})(?=Z|[+-])"

# Other spellings of a time, by the order of their parts; what follows the date is as in ISO text.
_CLOCK = r"((?:[T ]\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z|[+-]\d{2}(?::?\d{2})?)?)?)$"
_NUMBERS = r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})" + _CLOCK
_YEAR_FIRST = r"^(\d{4})([-/])(\d{1,2})\2(\d{1,2})" + _CLOCK
_NAME_FIRST = r"^([A-Za-z]{3,9})\.?[ -](\d{1,2}),?[ -](\d{4})" + _CLOCK
_NAME_SECOND = r"^(\d{1,2})[ -]([A-Za-z]{3,9})\.?,?[ -](\d{4})" + _CLOCK
_MONTHS = (
    "january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november",
    "december",
)
ISO, MONTH_FIRST, DAY_FIRST, NAME_FIRST, NAME_SECOND = "iso", "month first", "day first", "name first", "name second"


def _instant(value: str | int | datetime) -> int | datetime:
    """The argument as a plain integer (unit still open) or as a UTC datetime."""
    if isinstance(value, int):
        return value
    if isinstance(value, str) and _INT_TEXT.fullmatch(value):
        return int(value)
    moment = value if isinstance(value, datetime) else datetime.fromisoformat(str(value))
    return moment.replace(tzinfo=timezone.utc) if moment.tzinfo is None else moment


def kline_time_ms(value: str | int | datetime) -> int:
    """A kline bound in epoch milliseconds; whole numbers always are milliseconds."""
    at = _instant(value)
    return at if isinstance(at, int) else (at - _EPOCH) // timedelta(milliseconds=1)


def factor_time_s(value: str | int | datetime) -> int:
    """A factor bound in epoch seconds; large whole numbers are milliseconds."""
    at = _instant(value)
    if isinstance(at, int):
        return at // 1000 if at > MILLIS_ABOVE else at
    return (at - _EPOCH) // timedelta(seconds=1)


def day_bounds_ms(day: date) -> tuple[int, int]:
    start = (day - date(1970, 1, 1)).days * DAY_MS
    return start, start + DAY_MS


def month_bounds_ms(year: int, month: int) -> tuple[int, int]:
    following = date(year + month // 12, month % 12 + 1, 1)
    return day_bounds_ms(date(year, month, 1))[0], day_bounds_ms(following)[0]


def month_of(ms: int) -> int:
    day = _EPOCH + timedelta(days=ms // DAY_MS)
    return day.year * 100 + day.month


def month_or_edge(ms: int) -> int:
    """Partition month of a bound; bounds outside the calendar take its first or last month."""
    return month_of(min(max(ms, -62_135_596_800_000), MAX_MS))


# ---------------------------------------------------------------- column forms

def floor_div(value: Column, unit: Column | int) -> Column:
    """Whole units in a long, rounding towards minus infinity."""
    unit = F.lit(unit) if isinstance(unit, int) else unit
    return F.call_function("div", value - F.pmod(value, unit), unit)


def utc_day(ms: Column) -> Column:
    return F.date_from_unix_date(floor_div(ms, DAY_MS).cast("int"))


def utc_month(ms: Column) -> Column:
    """yyyymm of an epoch-millisecond column."""
    day = utc_day(ms)
    return F.year(day) * 100 + F.month(day)


def from_seconds_or_millis(number: Column) -> Column:
    moment = (
        F.when(number > MILLIS_ABOVE, F.timestamp_millis(number))
        .otherwise(F.timestamp_seconds(number))
    )
    return F.when(number.between(-62_135_596_800, MAX_MS), moment)


def from_iso_text(text: Column) -> Column:
    """ISO date or date-time text as a timestamp; without an offset it is in session time, UTC.

    Slashes may part the date; a fraction is cut to microseconds.
    """
    iso = F.when(text.rlike(_ISO), F.regexp_replace(text, r"^(\d{4})/(\d{2})/", "$1-$2-"))
    iso = F.regexp_replace(iso, r"(\.\d{6})\d+", "$1")
    with_seconds = F.regexp_replace(iso, _NO_SECONDS, "$1:00")
    return F.coalesce(iso.try_cast("timestamp"), with_seconds.try_cast("timestamp"))


def time_form(text: Column) -> Column:
    """In which order a time text has its parts; NULL where that cannot be told.

    Of two numbers before the year the first is the month, unless it is too large for one.
    """
    return (
        F.when(text.rlike(_YEAR_FIRST), F.lit(ISO))
        .when(text.rlike(_NUMBERS), F.when(_large_first(text), F.lit(DAY_FIRST)).otherwise(F.lit(MONTH_FIRST)))
        .when(text.rlike(_NAME_FIRST), F.lit(NAME_FIRST))
        .when(text.rlike(_NAME_SECOND), F.lit(NAME_SECOND))
    )


def time_in_form(text: Column, form: Column) -> Column:
    """Time text read in one form, or in its own where the form is NULL; NULL where it is no such time.

    The text is brought into ISO order first, so it is parsed in one place.
    """
    return bound(text, lambda one: bound(_in_iso_order(one, form), from_iso_text))


def bound(value: Column, use) -> Column:
    """``use(value)``, with the value worked out once however often it stands in there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _in_iso_order(text: Column, form: Column) -> Column:
    day_first = F.coalesce(form == DAY_FIRST, _large_first(text))
    month_first = F.coalesce(form == MONTH_FIRST, F.lit(True))
    ordered = (
        F.when(text.rlike(_YEAR_FIRST), _if_form(form, ISO, F.regexp_replace(text, _YEAR_FIRST, "$1-$3-$4$5")))
        .when(text.rlike(_NUMBERS), F.when(day_first, F.regexp_replace(text, _NUMBERS, "$3-$2-$1$4")).when(
            month_first, F.regexp_replace(text, _NUMBERS, "$3-$1-$2$4")))
        .when(text.rlike(_NAME_FIRST), _if_form(form, NAME_FIRST, _named(text, _NAME_FIRST, 1, "$2$4")))
        .when(text.rlike(_NAME_SECOND), _if_form(form, NAME_SECOND, _named(text, _NAME_SECOND, 2, "$1$4")))
    )
    wide = F.regexp_replace(ordered, r"^(\d{4})-(\d)(?=-)", "$1-0$2")
    wide = F.regexp_replace(wide, r"^(\d{4}-\d{2})-(\d)(?!\d)", "$1-0$2")
    return F.regexp_replace(wide, r"^(.{10})[T ](?=\d:)", "$1 0")


def _large_first(text: Column) -> Column:
    return F.coalesce(F.regexp_extract(text, _NUMBERS, 1).try_cast("int") > 12, F.lit(False))


def _if_form(form: Column, name: str, value: Column) -> Column:
    return F.when(F.coalesce(form == name, F.lit(True)), value)


def _named(text: Column, pattern: str, name: int, rest: str) -> Column:
    """Year, number of the named month, and what follows; NULL for another name."""
    pairs = ", ".join(f"'{n}', '{i:02}'" for i, full in enumerate(_MONTHS, 1) for n in {full, full[:3]})
    number = F.try_element_at(F.expr(f"map({pairs})"), F.lower(F.regexp_extract(text, pattern, name)))
    return F.concat(
        F.regexp_extract(text, pattern, 3), F.lit("-"), number, F.lit("-"), F.regexp_replace(text, pattern, rest)
    )


def data_time(column: Column, dtype: T.DataType) -> Column:
    """A data column as a UTC timestamp, NULL where it cannot be read as a time."""
    if isinstance(dtype, T.TimestampType):
        return column
    if isinstance(dtype, (T.TimestampNTZType, T.DateType)):
        return column.cast("timestamp")
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return from_seconds_or_millis(column.cast("long"))
    if isinstance(dtype, T.StringType):
        number = F.when(
            column.rlike(r"^\s*[+-]?\d+(_\d+)*\s*$"),
            F.regexp_replace(F.trim(column), "_", "").try_cast("long"),
        )
        return F.when(number.isNotNull(), from_seconds_or_millis(number)).otherwise(
            from_iso_text(column)
        )
    return F.lit(None).cast("timestamp")


def to_millisecond(moment: Column) -> Column:
    """Stored times have millisecond precision."""
    return F.timestamp_millis(F.unix_millis(moment))
