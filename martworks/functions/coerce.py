"""Lenient casts: a value that cannot be read as the wanted type becomes null, it never fails the job.

The column type is known when the plan is built, so each cast is one built-in expression per source type.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The type names a column config may use.
INT_NAMES = ("int", "int64", "integer")
FLOAT_NAMES = ("float", "float64", "double", "number")
BOOL_NAMES = ("bool", "boolean")
TIME_NAMES = ("datetime", "timestamp", "date")
TEXT_NAMES = ("str", "string", "text")

# Text that reads as a number. Spark alone would also take Java forms such as `1d` or `0x1p3`. The test also spares
# unreadable text a cast that fails, which is many times slower than one that succeeds.
NUMBER_TEXT = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"
WHOLE_TEXT = r"^\s*[+-]?\d+\s*$"

# Date forms read besides ISO, each with the shape a text must have: parsing only what fits spares a failed parse.
DATE_FORMS = (
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}$", "M/d/yyyy H:mm:ss"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{2}:\d{2}$", "yyyy/M/d H:mm:ss"),
    (r"^\d{8}$", "yyyyMMdd"),
)

_TARGETS: dict[str, T.DataType] = {
    **dict.fromkeys(INT_NAMES, T.LongType()),
    **dict.fromkeys(FLOAT_NAMES, T.DoubleType()),
    **dict.fromkeys(BOOL_NAMES, T.BooleanType()),
    **dict.fromkeys(TIME_NAMES, T.TimestampNTZType()),
    **dict.fromkeys(TEXT_NAMES, T.StringType()),
}


def target_type(type_name: str | None) -> T.DataType | None:
    """Spark type of a config type name; ``None`` when the name is unknown."""
    return _TARGETS.get((type_name or "").strip().lower())


def coerce(column: Column, source: T.DataType, type_name: str | None, strict: bool = False) -> Column:
    """Cast ``column`` of type ``source`` to the named type; an unknown name leaves it unchanged."""
    target = target_type(type_name)
    if isinstance(target, T.LongType):
        return to_int(column, source, strict)
    if isinstance(target, T.DoubleType):
        return to_float(column, source)
    if isinstance(target, T.BooleanType):
        return to_bool(column, source)
    if isinstance(target, T.TimestampNTZType):
        return to_timestamp(column, source)
    if isinstance(target, T.StringType):
        return to_text(column, source)
    return column


def to_int(column: Column, source: T.DataType, strict: bool = False) -> Column:
    """Whole numbers only. A fraction becomes null, or raises when ``strict``."""
    if isinstance(source, (T.IntegralType, T.BooleanType)):
        return column.cast("bigint")
    number = to_float(column, source) if not isinstance(source, T.DecimalType) else column
    whole = F.when(number % 1 == 0, number.try_cast("bigint"))
    if strict:
        whole = F.when(
            number % 1 != 0, F.raise_error(F.concat(F.lit("not a whole number: "), number.cast("string")))
        ).otherwise(whole)
    if isinstance(source, T.StringType):
        return F.when(column.rlike(WHOLE_TEXT), column.try_cast("bigint")).otherwise(whole)
    return whole


def to_float(column: Column, source: T.DataType) -> Column:
    """Double; NaN counts as missing."""
    if isinstance(source, (T.FloatType, T.DoubleType)):
        return F.nanvl(column.cast("double"), F.lit(None).cast("double"))
    if isinstance(source, (T.NumericType, T.BooleanType)):
        return column.cast("double")
    if isinstance(source, T.StringType):
        return F.when(column.rlike(NUMBER_TEXT), column.try_cast("double"))
    return F.lit(None).cast("double")


def to_bool(column: Column, source: T.DataType) -> Column:
    """Truthiness, not parsing: any non-empty text is true, any non-zero number is true."""
    if isinstance(source, T.BooleanType):
        return column
    if isinstance(source, T.StringType):
        return F.length(column) > 0
    if isinstance(source, (T.FloatType, T.DoubleType)):
        return to_float(column, source) != 0
    if isinstance(source, T.NumericType):
        return column != 0
    if isinstance(source, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.when(column.isNotNull(), F.lit(True))
    if isinstance(source, T.NullType):
        return F.lit(None).cast("boolean")
    raise TypeError(f"a {source.simpleString()} has no truth value")


def to_timestamp(column: Column, source: T.DataType) -> Column:
    """Timestamp without zone, in UTC. Numbers are nanoseconds since 1970, each text is parsed by itself."""
    if isinstance(source, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return column.cast("timestamp_ntz")
    if isinstance(source, T.StringType):
        # The first cast rejects bare times, which the second would place on today's date; the second moves a
        # stated offset to UTC.
        iso = F.when(
            column.try_cast("timestamp_ntz").isNotNull(), column.try_cast("timestamp").cast("timestamp_ntz")
        )
        text = F.trim(column)
        others = [
            F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(form)).cast("timestamp_ntz"))
            for shape, form in DATE_FORMS
        ]
        return F.coalesce(iso, *others)
    if isinstance(source, T.NumericType):
        micros = F.floor(column.try_cast("decimal(20,0)") / F.lit(1000))
        return F.timestamp_micros(micros.cast("bigint")).cast("timestamp_ntz")
    return F.lit(None).cast("timestamp_ntz")


def to_text(column: Column, source: T.DataType) -> Column:
    """Text form; truth values read ``True`` / ``False``."""
    text = column.cast("string")
    return F.initcap(text) if isinstance(source, T.BooleanType) else text


def lost(raw: Column, coerced: Column) -> Column:
    """True where a present value became null in its cast; count it to see what a lenient load dropped."""
    return raw.isNotNull() & coerced.isNull()
