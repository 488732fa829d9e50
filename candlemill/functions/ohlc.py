"""Candle validity as column predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from candlemill.functions.numbers import or_null
from candlemill.schema import CANDLE_FAULTS

_VALID = """coalesce(
    open_price > 0 and high_price > 0 and low_price > 0 and close_price > 0
    and high_price >= greatest(open_price, close_price)
    and low_price <= least(open_price, close_price)
    and high_price >= low_price and volume >= 0
    and not (isnan(open_price) or isnan(high_price) or isnan(low_price)
             or isnan(close_price) or isnan(volume)),
    false)"""


def is_valid_candle() -> Column:
    """Positive prices, high and low bracket open and close, volume not negative.

    A missing value (NULL or NaN) in any of the five columns makes the row invalid.
    """
    return F.expr(_VALID)


def invalid_reasons() -> Column:
    """Why a row is invalid, as an array of texts in a fixed order.

    A missing value breaks no rule by itself, so the array may be empty.
    """
    o, h, l, c, v = (
        or_null(F.col(name))
        for name in ("open_price", "high_price", "low_price", "close_price", "volume")
    )
    top = F.when(c > o, c).otherwise(o)
    bottom = F.when(c < o, c).otherwise(o)
    broken = {
        "price": (o <= 0) | (h <= 0) | (l <= 0) | (c <= 0), "top": h < top, "bottom": l > bottom,
        "range": h < l, "volume": v < 0,
    }
    texts = [
        F.when(broken[rule], F.concat(F.lit(f"{text} at "), F.col("open_time").cast("string")))
        for rule, text in CANDLE_FAULTS.items()
    ]
    return F.array_compact(F.array(*texts))
