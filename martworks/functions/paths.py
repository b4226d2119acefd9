"""Resolve config names and dotted paths against a schema, when the plan is built."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Found(NamedTuple):
    column: Column
    type: T.DataType


def quoted(name: str) -> Column:
    """Top-level column by its literal name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StructType, T.ArrayType, T.MapType))


def spellings(name: str) -> tuple[str, str, str]:
    """The name itself, then its underscored and dotted forms."""
    return name, name.replace(".", "_"), name.replace("_", ".")


def resolve_name(df: DataFrame, name: str) -> str | None:
    """Top-level column that ``name`` means: exact, dots as underscores, underscores as dots."""
    return next((s for s in spellings(name) if s in df.columns), None)


def lookup(df: DataFrame, path: str) -> Found | None:
    """Value at a dotted path. Whole-number parts index arrays from 0; a part that cannot apply gives ``None``."""
    head, *rest = path.split(".")
    if head not in df.columns:
        return None
    found = Found(quoted(head), df.schema[head].dataType)
    for part in rest:
        step = _step(found, part)
        if step is None:
            return None
        found = step
    return found


def _step(at: Found, part: str) -> Found | None:
    index = _as_index(part)
    if isinstance(at.type, T.ArrayType):
        if index is None or index < 0:
            return None
        return Found(F.get(at.column, F.lit(index)), at.type.elementType)
    if index is not None:
        return None
    if isinstance(at.type, T.StructType) and part in at.type.names:
        return Found(at.column.getField(part), at.type[part].dataType)
    if isinstance(at.type, T.MapType) and isinstance(at.type.keyType, T.StringType):
        return Found(at.column.getItem(part), at.type.valueType)
    return None


def _as_index(part: str) -> int | None:
    try:
        return int(part)
    except ValueError:
        return None


def resolve(df: DataFrame, name: str) -> Found | None:
    """Column or nested value a config path means. Structs and arrays are not storable, so they do not resolve."""
    column = resolve_name(df, name)
    if column is not None and not is_nested(df.schema[column].dataType):
        return Found(quoted(column), df.schema[column].dataType)
    for path in (name, name.replace("_", ".")):
        found = lookup(df, path)
        if found is not None and not is_nested(found.type):
            return found
    return None
