"""Derived columns a config may ask for, as a registry of column builders."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

Lookup = Callable[[str], Column | None]


def _length(args: Sequence[Any], column_of: Lookup) -> Column | None:
    source = column_of(args[0]) if args else None
    return None if source is None else F.length(source.cast("string")).cast("bigint")


def _concat_ws(args: Sequence[Any], column_of: Lookup) -> Column | None:
    if len(args) < 2:
        return None
    parts = [column_of(name) for name in args[1:]]
    if any(part is None for part in parts):
        return None
    return F.concat_ws(str(args[0]), *(part.cast("string") for part in parts))


def _split_part(args: Sequence[Any], column_of: Lookup) -> Column | None:
    source = column_of(args[0]) if len(args) == 3 else None
    return None if source is None else F.split_part(source.cast("string"), F.lit(str(args[1])), F.lit(int(args[2])))


DERIVATIONS: dict[str, Callable[[Sequence[Any], Lookup], Column | None]] = {
    "len": _length,
    "concat_ws": _concat_ws,
    "split_part": _split_part,
}


def derive(rule: dict[str, Any] | None, column_of: Lookup) -> Column | None:
    """Column for ``{op, args}``; ``None`` when the operation or one of its inputs is unknown."""
    rule = rule or {}
    builder = DERIVATIONS.get(rule.get("op"))
    return None if builder is None else builder(rule.get("args") or [], column_of)
