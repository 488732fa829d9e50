"""Numbers out of text: strict for kline files, lenient for factors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Decimal text, or an infinity; what a cast alone would also take (1.5d, NaN) is left out.
# Every quantifier keeps what it took, so a mismatch is found in one pass.
NUMBER = r"\s*+[+-]?+(?:(?:\d++(?:\.\d*+)?+|\.\d++)(?:[eE][+-]?+\d++)?+|(?i:inf(?:inity)?+))\s*+"
_UNDERSCORED = (
    r"^\s*[+-]?((\d+(_\d+)*)(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?\s*$"
)


def csv_number(text: Column) -> Column:
    """Numeric text as a double, infinities included; NULL for anything else."""
    return F.when(text.rlike(f"^{NUMBER}$"), text.try_cast("double"))


def written_number(column: Column, dtype: T.DataType) -> Column:
    """A value handed in for writing, as a double; NULL unless convertible and finite."""
    if isinstance(dtype, T.StringType):
        value = F.when(
            column.rlike(_UNDERSCORED),
            F.regexp_replace(F.trim(column), "_", "").try_cast("double"),
        )
    elif isinstance(dtype, (T.NumericType, T.BooleanType)):
        value = column.cast("double")
    else:
        value = F.lit(None).cast("double")
    return F.when(is_finite(value), value)


def is_finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))


def or_null(value: Column) -> Column:
    """NaN and NULL are the same missing value; this leaves NULL only."""
    return F.when(~F.isnan(value), value)
