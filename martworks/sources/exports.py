"""CSV exports of marts and tables, and the catalogue of columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martworks.functions.paths import quoted
from martworks.functions.scalars import on_day
from martworks.operators.project import packed, unpacked
from martworks.session import FILE_RECORDS, TEXT_CODEC


def _of_day(df: DataFrame, column: str, ds: str | dt.date) -> DataFrame:
    return df.where(on_day(quoted(column), df.schema[column].dataType, ds))


def export_fact(fact: DataFrame, ds: str | dt.date) -> DataFrame:
    """Sales of one batch by (transaction_date, product_id), nulls last.

    The key column ends the order: it makes ties stable and lets the range sort split a day that sold one product. Texts
    are packed for the sort, so keys that are digests come before others.
    """
    order = [F.asc_nulls_last(c) for c in ("transaction_date", "product_id", "transaction_id") if c in fact.columns]
    return unpacked(packed(_of_day(fact, "load_ds", ds)).orderBy(*order), fact.schema)


def export_dim(dim: DataFrame, ds: str | dt.date) -> DataFrame:
    """Products last seen on one day by product_id; all products when that day has none or no day is recorded."""
    tie_break = [c for c in ("product_name", "category", "price") if c in dim.columns]
    order = [F.asc_nulls_last(c) for c in ("product_id", *tie_break)]
    if "last_ingested_ds" not in dim.columns:
        return dim.orderBy(*order)
    seen = on_day(quoted("last_ingested_ds"), dim.schema["last_ingested_ds"].dataType, ds)
    return dim.where(seen | ~dim.where(seen).exists()).orderBy(*order)


def export_rows(table: DataFrame, ds: str | dt.date) -> DataFrame:
    """Rows of one batch day of a lake table."""
    return _of_day(table, "ds", ds)


# Quotes are doubled, as other readers expect; blanks at either end belong to the value; null is an empty field and empty
# text a quoted one.
_CSV = {
    "header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
    "nullValue": "", "emptyValue": '""',
}


def write_csv(df: DataFrame, path: str) -> None:
    """Compressed CSV with header; an ordered frame gives part files in order. Texts come back as they were, line breaks
    included."""
    df.write.mode("overwrite").options(**_CSV, compression=TEXT_CODEC, maxRecordsPerFile=FILE_RECORDS).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with header; timestamps are parsed by the schema, so no inference pass runs.

    Values may hold line breaks, so a file is one task's work; the writer leaves a file for each of its tasks.
    """
    # The reader turns an unquoted empty field into its null mark, so that mark must be no text that can occur.
    marks = {"emptyValue": "", "nullValue": "\u0000"}
    return spark.read.schema(schema).options(**{**_CSV, **marks}).option("multiLine", True).csv(path)


def catalog_columns(tables: Mapping[str, DataFrame], counts: bool = True) -> DataFrame:
    """One row per table column: position, type, rows and nulls. Each table is read once.

    Without ``counts`` the rows come from the schemas alone, and no table is read.
    """
    if not counts:
        rows = [
            (name, f.name, i, f.dataType.simpleString())
            for name, df in tables.items() for i, f in enumerate(df.schema.fields, start=1)
        ]
        spark = next(iter(tables.values())).sparkSession
        return spark.createDataFrame(rows, "table_name string, column_name string, column_index int, column_type string")
    return _union([_describe(name, df) for name, df in tables.items()])


def _describe(table: str, df: DataFrame) -> DataFrame:
    fields = df.schema.fields
    facts = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(i).alias("column_index"),
            F.lit(f.dataType.simpleString()).alias("column_type"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(quoted(f.name).isNull()).alias("null_count"),
        )
        for i, f in enumerate(fields, start=1)
    ]
    return (
        df.agg(F.array(*facts).alias("facts"))
        .select(F.lit(table).alias("table_name"), F.inline("facts"))
    )


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first
