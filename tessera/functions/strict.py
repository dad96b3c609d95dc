"""Strict typing of attribute text.

Pages are read loosely: every attribute arrives as text, whatever the layer
sent it as. ``typed`` turns it into the declared type or raises, so a value
that doesn't fit is never a silent NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
#: Doubles hold every whole number up to here.
_EXACT = float(1 << 53)


def whole_number(text: Column) -> Column:
    """BIGINT of a whole number written as ``5``, ``5.0`` or ``5e3``; else NULL."""
    d = text.try_cast("double")
    return F.coalesce(text.try_cast("bigint"), F.when((d == F.floor(d)) & (F.abs(d) <= F.lit(_EXACT)), d.cast("bigint")))


def typed(text: Column, dtype: T.DataType, name: str) -> Column:
    """The text as dtype; NULL stays NULL, and text that isn't a dtype raises."""
    if isinstance(dtype, T.StringType):
        return text
    if isinstance(dtype, T.LongType):
        value = whole_number(text)
    elif isinstance(dtype, _WHOLE):
        value = whole_number(text).try_cast(dtype)
    elif isinstance(dtype, T.BooleanType):
        value = F.coalesce(text.try_cast("boolean"), text.try_cast("double") != 0)
    else:
        value = text.try_cast(dtype)
    wrong = F.raise_error(F.concat(F.lit(f"attribute {name}: not a {dtype.simpleString()}: "), text)).cast(dtype)
    return F.when(text.isNull() | value.isNotNull(), value).otherwise(wrong)
