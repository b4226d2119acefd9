"""Scalar functions of the marts and of the batch key."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Operands of money arithmetic. Their product has 38 digits, 12 of them decimals, which is as many as a decimal holds, so it
# is exact. A value that does not fit fails; decimals beyond these are rounded, which `cast_changes` counts.
PRICE, QUANTITY = T.DecimalType(21, 8), T.DecimalType(16, 4)

DS_PATTERN = r"^\d{4}-\d{2}-\d{2}$"


def clean_category(column: Column) -> Column:
    """Lower case without surrounding blanks."""
    return F.lower(F.trim(column))


def transaction_key(cart_id: Column, product_id: Column, at: Column) -> Column:
    """Stable id of a cart line: md5 over cart, product and second; a missing time counts as empty text."""
    second = F.coalesce(F.date_format(at, "yyyyMMddHHmmss"), F.lit(""))
    return F.md5(F.concat_ws("||", cart_id.cast("string"), product_id.cast("string"), second))


def cast_changes(column: Column, dtype: T.DecimalType) -> Column:
    """Aggregate: values that the cast to ``dtype`` rounds or cannot hold. Fractions count as the decimals they print as."""
    exact = column.cast("string").try_cast(T.DecimalType(38, 18))
    held = column.try_cast(dtype).cast(T.DecimalType(38, 18))
    return F.count_if(column.isNotNull() & ~F.coalesce(exact == held, F.lit(False)))


def valid_ds(column: Column) -> Column:
    """True for text that is a real day written YYYY-MM-DD."""
    return F.coalesce(column.rlike(DS_PATTERN) & column.try_cast("date").isNotNull(), F.lit(False))


def parse_ds(ds: str | dt.date) -> dt.date:
    """Batch day from its YYYY-MM-DD text."""
    if isinstance(ds, dt.date):
        return ds
    if not re.match(DS_PATTERN, ds):
        raise ValueError(f"ds must be YYYY-MM-DD, got {ds!r}")
    return dt.date.fromisoformat(ds)


def batch_day(ds: str | dt.date | None) -> dt.date:
    """The stated batch day, else today in UTC."""
    return parse_ds(ds) if ds is not None else dt.datetime.now(dt.timezone.utc).date()


def on_day(column: Column, dtype: T.DataType, ds: str | dt.date) -> Column:
    """Rows of one day. The column stays bare, so the test prunes partitions and reaches the scan."""
    day = parse_ds(ds)
    if isinstance(dtype, T.DateType):
        return column == F.lit(day)
    if isinstance(dtype, T.StringType):
        return column.try_cast("date") == F.lit(day)
    start = F.lit(day).cast(dtype)
    end = F.lit(day + dt.timedelta(days=1)).cast(dtype)
    return (column >= start) & (column < end)
