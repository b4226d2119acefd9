"""Flatten structs and explode lists. Everything is decided from the schema, so no row is touched in Python."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martworks.functions.coerce import to_float, to_int
from martworks.functions.paths import Found, lookup, quoted

# Python words that are not JSON, with their JSON spelling. Only whole values between separators are replaced.
PYTHON_WORDS = (("None", "null"), ("True", "true"), ("False", "false"))
PYTHON_TEXT = r"[\[:,]\s*(None|True|False)\s*[,\]}]|,\s*[\]}]"

ITEM = "struct<productId:string,quantity:string>"


def _leaves(column: Column, dtype: T.DataType, name: str) -> list[tuple[str, Column]]:
    if not isinstance(dtype, T.StructType):
        return [(name, column)]
    out: list[tuple[str, Column]] = []
    for field in dtype.fields:
        out += _leaves(column.getField(field.name), field.dataType, f"{name}_{field.name}")
    return out


def _select_named(df: DataFrame, columns: Sequence[tuple[str, Column]]) -> DataFrame:
    names = [name for name, _ in columns]
    clash = sorted({name for name in names if names.count(name) > 1})
    if clash:
        raise ValueError(f"flattening gives the same column twice: {clash}")
    return df.select(*(column.alias(name) for name, column in columns))


def flatten(df: DataFrame) -> DataFrame:
    """Every struct field, at any depth, as its own ``a_b_c`` column. Arrays stay as they are."""
    columns: list[tuple[str, Column]] = []
    for field in df.schema.fields:
        columns += _leaves(quoted(field.name), field.dataType, field.name)
    return _select_named(df, columns)


def flatten_struct(df: DataFrame, name: str, prefix: str | None = None) -> DataFrame:
    """Replace one struct column by its fields, ``<prefix>_<field>``, placed last. Other types stay unchanged."""
    if name not in df.columns or not isinstance(df.schema[name].dataType, T.StructType):
        return df
    rest = [(c, quoted(c)) for c in df.columns if c != name]
    return _select_named(df, rest + _leaves(quoted(name), df.schema[name].dataType, prefix or name))


def auto_flatten(df: DataFrame, max_depth: int = 2) -> DataFrame:
    """Flatten all struct columns, in up to ``max_depth`` passes; one pass already reaches every level."""
    for _ in range(max_depth):
        structs = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StructType)]
        if not structs:
            break
        for name in structs:
            df = flatten_struct(df, name)
    return df


def copy_paths(df: DataFrame, paths: Mapping[str, str]) -> DataFrame:
    """Copy values at ``path`` into ``column``; a column that exists already is left alone, a dead path gives null."""
    new: dict[str, Column] = {}
    for path, name in paths.items():
        if name in df.columns or name in new:
            continue
        if path in df.columns:
            new[name] = quoted(path)
            continue
        found = lookup(df, path) or lookup(df, path.replace(".", "_"))
        new[name] = found.column if found else F.lit(None).cast("string")
    return df.withColumns(new) if new else df


def explode_column(df: DataFrame, name: str) -> DataFrame:
    """One row per list element; a scalar counts as a list of one, null or empty lists keep one row with null.

    Struct elements become ``<name>_<field>`` columns, other elements one ``<name>_value`` column.
    """
    if name not in df.columns:
        return df
    dtype = df.schema[name].dataType
    rest = [quoted(c) for c in df.columns if c != name]
    if isinstance(dtype, T.ArrayType):
        element = dtype.elementType
        rows = df.select(*rest, F.explode_outer(quoted(name)).alias(name))
    else:
        element = dtype
        rows = df
    if isinstance(element, T.StructType):
        return auto_flatten(flatten_struct(rows, name), max_depth=1)
    out = rows.select(*rest, quoted(name).alias(f"{name}_value"))
    return auto_flatten(out, max_depth=1)


def _json_form(text: Column) -> Column:
    """JSON spelling of a list or object that may be a Python literal; the test spares JSON the rewriting."""
    spelled = text
    for word, json_word in PYTHON_WORDS:
        spelled = F.regexp_replace(spelled, rf"([\[:,]\s*){word}(?=\s*[,\]}}])", f"$1{json_word}")
    spelled = F.regexp_replace(spelled, r",\s*([\]}])", "$1")
    return F.when(text.rlike(PYTHON_TEXT), spelled).otherwise(text)


def _text_to_item(text: Column) -> Column:
    """Object written as text; other text is no object."""
    trimmed = F.trim(text)
    return F.when(trimmed.startswith("{"), F.from_json(_json_form(trimmed), ITEM))


def _text_to_items(text: Column) -> Column:
    """Objects of a list written as text, or of a lone object; junk is null.

    One parse reads a list of objects. Only when that fails are the elements taken one by one, so that an element that
    is no object, or is itself text, does not cost its neighbours.
    """
    trimmed = F.trim(text)
    spelled = F.when(trimmed.startswith("[") | trimmed.startswith("{"), _json_form(trimmed))
    elements = F.transform(F.from_json(spelled, "array<string>"), _text_to_item)
    return F.coalesce(F.from_json(spelled, f"array<{ITEM}>"), elements)


def _items(column: Column, dtype: T.DataType) -> Found:
    """The items of a list in any of its forms, and their type."""
    if isinstance(dtype, T.StringType):
        return Found(_text_to_items(column), T.StructType.fromDDL("productId string, quantity string"))
    if not isinstance(dtype, T.ArrayType):
        return Found(F.when(column.isNotNull(), F.array(column)), dtype)
    if isinstance(dtype.elementType, T.StringType):
        return Found(F.transform(column, _text_to_item), T.StructType.fromDDL("productId string, quantity string"))
    return Found(column, dtype.elementType)


def explode_items(df: DataFrame, name: str = "products") -> DataFrame:
    """One row per cart line, with numeric ``<name>_productId`` and ``<name>_quantity``.

    The list may be an array of structs, a lone struct, JSON text, Python-literal text, or an array of such texts.
    Carts without a readable line keep one row with null item fields; elements that are no objects give null fields.
    """
    if name not in df.columns:
        return df
    items, element = _items(quoted(name), df.schema[name].dataType)
    kept = [quoted(c) for c in df.columns if c != name]
    rows = df.select(*kept, F.explode_outer(items).alias(name))
    fields = {f.name: f.dataType for f in element.fields} if isinstance(element, T.StructType) else {}
    item = quoted(name)
    product = (
        to_int(item.getField("productId"), fields["productId"]) if "productId" in fields else F.lit(None).cast("bigint")
    )
    quantity = (
        to_float(item.getField("quantity"), fields["quantity"]) if "quantity" in fields else F.lit(None).cast("double")
    )
    return rows.select(*kept, product.alias(f"{name}_productId"), quantity.alias(f"{name}_quantity"))
