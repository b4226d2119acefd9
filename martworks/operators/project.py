"""Config-driven projection. All config styles become one ``select`` of built-in expressions.

Styles:
  * select mapping: ``{"select": {out: {path, type, default}}, "derive": …, "fillna": …, "order": […]}``
  * flat mapping:   ``{out: {mapping, data_type}, "_config": {"order": […]}}``
  * legacy steps:   ``{"explode", "flatten", "rename", "select": […], "casts", "fillna", "drop"}``
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martworks.functions.coerce import coerce, lost, target_type, to_timestamp
from martworks.functions.derive import derive
from martworks.functions.paths import quoted, resolve, resolve_name, spellings
from martworks.functions.scalars import parse_ds
from martworks.operators.reshape import auto_flatten, copy_paths, explode_column

# Column order of cart lines when the config names none.
CART_ORDER = ("cart_id", "user_id", "order_date", "product_id", "quantity", "ds")

# Cast names of the legacy style.
LEGACY_NAMES = ("int", "float", "str")
LEGACY_TIME_NAMES = ("timestamp", "datetime", "date")


@dataclass(frozen=True)
class ColumnSpec:
    """One output column: where it comes from, how it is read, what replaces null."""

    name: str
    path: str
    type: str = ""
    default: Any = None


def column_specs(config: Mapping[str, Any]) -> list[ColumnSpec]:
    """Column specs of either mapping style; empty for the legacy style."""
    selected = config.get("select")
    if isinstance(selected, Mapping):
        return [
            ColumnSpec(name, spec.get("path", name), spec.get("type") or "", spec.get("default"))
            for name, spec in ((name, spec or {}) for name, spec in selected.items())
        ]
    if is_flat_mapping(config):
        return [
            ColumnSpec(name, spec.get("mapping", name), spec.get("data_type") or "")
            for name, spec in config.items()
            if not name.startswith("_") and isinstance(spec, Mapping)
        ]
    return []


def is_flat_mapping(config: Mapping[str, Any]) -> bool:
    return "select" not in config and any(
        isinstance(spec, Mapping) and ("mapping" in spec or "data_type" in spec)
        for name, spec in config.items()
        if not name.startswith("_")
    )


def apply_config(df: DataFrame, config: Mapping[str, Any], strict: bool = False) -> DataFrame:
    """Project ``df`` by a config of any style. ``strict`` makes fractional integers fail instead of nulling them."""
    if is_flat_mapping(config):
        return _apply_flat(df, config, strict)
    if isinstance(config.get("select"), Mapping) and config["select"]:
        return _apply_select(df, config, strict)
    return _apply_legacy(df, config)


def read_column(df: DataFrame, spec: ColumnSpec, strict: bool = False) -> tuple[Column, T.DataType]:
    """Resolve, coerce, then default: a value that fails its cast takes the default as well."""
    found = resolve(df, spec.path)
    target = target_type(spec.type)
    if found is None:
        dtype = target or T.StringType()
        column = F.lit(None).cast(dtype)
    else:
        dtype = target or found.type
        column = coerce(found.column, found.type, spec.type, strict)
    return _with_default(column, dtype, spec.default), dtype


def _with_default(column: Column, dtype: T.DataType, value: Any) -> Column:
    return column if value is None else F.coalesce(column, F.lit(value).try_cast(dtype))


def _apply_select(df: DataFrame, config: Mapping[str, Any], strict: bool) -> DataFrame:
    columns: dict[str, Column] = {}
    types: dict[str, T.DataType] = {}
    for spec in column_specs(config):
        columns[spec.name], types[spec.name] = read_column(df, spec, strict)

    def column_of(name: str) -> Column | None:
        if name in columns:
            return columns[name]
        found = resolve(df, name)
        return found.column if found else None

    for name, rule in (config.get("derive") or {}).items():
        derived = derive(rule, column_of)
        if derived is not None:
            columns[name] = derived
            types.pop(name, None)
    for name, value in (config.get("fillna") or {}).items():
        if name in columns:
            dtype = types.get(name)
            columns[name] = (
                _with_default(columns[name], dtype, value) if dtype else F.coalesce(columns[name], F.lit(value))
            )
    names = ordered_names(list(columns), config.get("order") or [])
    return df.select(*(columns[name].alias(name) for name in names))


def _apply_flat(df: DataFrame, config: Mapping[str, Any], strict: bool) -> DataFrame:
    work = df.drop("products")
    columns = {spec.name: read_column(work, spec, strict)[0] for spec in column_specs(config)}
    order = (config.get("_config") or {}).get("order") or CART_ORDER
    return work.select(*(columns[name].alias(name) for name in ordered_names(list(columns), order)))


def _apply_legacy(df: DataFrame, config: Mapping[str, Any]) -> DataFrame:
    df = auto_flatten(df)
    for name in config.get("explode") or []:
        df = explode_column(df, resolve_name(df, name) or name)
    df = copy_paths(df, config.get("flatten") or {})
    renames = config.get("rename") or {}
    df = rename_columns(df, renames)
    if isinstance(config.get("select"), (list, tuple)):
        df = select_columns(df, config["select"], renames)
    df = cast_columns(df, config.get("casts") or {})
    df = fill_nulls(df, config.get("fillna") or {})
    return df.drop(*(config.get("drop") or []))


def ordered_names(names: Sequence[str], order: Sequence[str]) -> list[str]:
    """Names listed in ``order`` first, the others after them as they were."""
    first = [name for name in order if name in names]
    return first + [name for name in names if name not in first]


def order_columns(df: DataFrame, order: Sequence[str]) -> DataFrame:
    return df.select(*(quoted(name) for name in ordered_names(df.columns, order)))


def rename_columns(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Rename the columns that are present, under any spelling of their path."""
    actual = {}
    for old, new in renames.items():
        column = resolve_name(df, old)
        if column is not None:
            actual[column] = new
    return df.withColumnsRenamed(actual) if actual else df


def select_columns(df: DataFrame, wanted: Sequence[str], renames: Mapping[str, str] | None = None) -> DataFrame:
    """Keep the wanted columns, found by name, by their new or old name, or by dotted or underscored spelling.

    When none is found the frame is left unchanged.
    """
    renames = renames or {}
    old_names = {new: old for old, new in renames.items()}
    keep: list[str] = []
    for name in wanted:
        candidates = (name, renames.get(name), old_names.get(name), *spellings(name)[1:])
        hit = next((c for c in candidates if c in df.columns), None)
        if hit is not None:
            keep.append(hit)
    return df.select(*(quoted(name) for name in dict.fromkeys(keep))) if keep else df


def cast_columns(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Legacy casts. A column has one type here, so a value that cannot be cast becomes null."""
    new: dict[str, Column] = {}
    for name, type_name in casts.items():
        if name not in df.columns:
            continue
        wanted = str(type_name).lower()
        if wanted in LEGACY_TIME_NAMES:
            new[name] = to_timestamp(quoted(name), df.schema[name].dataType)
        elif wanted in LEGACY_NAMES:
            new[name] = coerce(quoted(name), df.schema[name].dataType, wanted)
        elif wanted == "bool":
            new[name] = quoted(name).try_cast("boolean")
    return df.withColumns(new) if new else df


def fill_nulls(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    """Replace nulls by column, for the columns that are present."""
    new = {
        name: _with_default(quoted(name), df.schema[name].dataType, value)
        for name, value in values.items()
        if name in df.columns
    }
    return df.withColumns(new) if new else df


def _texts(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if f.dataType == T.StringType()]


def packed(df: DataFrame) -> DataFrame:
    """Texts as binaries that are equal when the texts are, digests in hex at half their length; for a shuffle.

    Digests come first, then other texts; within both the order is that of the texts.
    """
    digest = lambda c: F.concat(F.lit(b"\0"), F.unhex(c))
    other = lambda c: F.concat(F.lit(b"\1"), c.cast("binary"))
    found = {c: F.when(quoted(c).rlike(r"\A(?:[0-9a-f][0-9a-f])+\z"), digest(quoted(c))).otherwise(other(quoted(c)))
             for c in _texts(df.schema)}
    return df.withColumns(found) if found else df


def unpacked(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The texts of :func:`packed` again; ``schema`` is that of the frame before."""
    rest = lambda c: F.substring(c, 2, 2_147_483_647)
    found = {c: F.when(F.substring(quoted(c), 1, 1) == F.lit(b"\0"), F.lower(F.hex(rest(quoted(c)))))
             .otherwise(rest(quoted(c)).cast("string")) for c in _texts(schema)}
    return df.withColumns(found) if found else df


def stamp_ds(df: DataFrame, ds: str | dt.date) -> DataFrame:
    """Set the batch day, replacing any ``ds`` column."""
    return df.withColumn("ds", F.lit(parse_ds(ds)).cast("date"))


def cast_losses(df: DataFrame, config: Mapping[str, Any]) -> DataFrame:
    """Per output column, how many present values its cast turned into null; one pass over the input."""
    counts: dict[str, Column] = {}
    for spec in column_specs(config):
        found = resolve(df, spec.path)
        if found is not None and target_type(spec.type) is not None:
            counts[spec.name] = F.count_if(lost(found.column, coerce(found.column, found.type, spec.type)))
    totals = df.agg(*(count.alias(name) for name, count in counts.items()))
    return totals.unpivot([], [quoted(name) for name in counts], "column", "lost")
