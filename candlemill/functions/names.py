"""Fields carried by a file name: SYMBOL-INTERVAL-YYYY-MM[-DD].zip.

Each function reads the path with one pattern, so that conditions on its result stay
small when Spark moves them to the file listing. A name's suffix is its last dot and
what follows, unless the dot opens the name.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from candlemill.schema import INTERVALS

_START = r"(?:^|/)"
_SUFFIX = r"(?:(?<=[^/])\.[^./]+)?$"
_REST = rf"(?:-[^/]*)?{_SUFFIX}"
_STEM = rf"{_START}([^/]+?){_SUFFIX}"
_SYMBOL = rf"{_START}([^/-]*?){_REST}"
_INTERVAL = rf"{_START}[^/-]*-([^/-]*?){_REST}"
_DAILY = rf"{_START}[^/-]*-[^/-]*-(\d{{4}}-\d{{1,2}}-\d{{1,2}}){_REST}"
_MONTHLY = rf"{_START}[^/-]*-[^/-]*-(\d{{4}}-\d{{1,2}}){_REST}"
_FOUR_FIELDS = rf"{_START}[^/-]*-[^/-]*-[^/-]*-[^/-]*{_SUFFIX}"


def stem(path: Column) -> Column:
    """Last path segment without its suffix."""
    return F.regexp_extract(path, _STEM, 1)


def symbol_of(path: Column) -> Column:
    """Text before the first dash; may be empty."""
    return F.regexp_extract(path, _SYMBOL, 1)


def interval_of(path: Column) -> Column:
    """Second field when it is one of the known intervals, otherwise NULL."""
    field = F.regexp_extract(path, _INTERVAL, 1)
    return F.when(field.isin(*INTERVALS), field)


def date_of(path: Column) -> Column:
    """Date text of a daily name, first of the month of a monthly one, otherwise NULL."""
    daily = F.regexp_extract(path, _DAILY, 1)
    monthly = F.concat(F.regexp_extract(path, _MONTHLY, 1), F.lit("-01"))
    return F.coalesce(_if_date(daily), _if_date(monthly))


def is_monthly(path: Column) -> Column:
    """Exactly four fields and a readable month."""
    month = F.concat(F.regexp_extract(path, _MONTHLY, 1), F.lit("-01"))
    return path.rlike(_FOUR_FIELDS) & month.try_cast("date").isNotNull()


def _if_date(text: Column) -> Column:
    return F.when(text.try_cast("date").isNotNull(), text)
