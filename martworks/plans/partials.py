"""KPIs from daily partials: what a day adds to revenue, items and distinct counts, so that a KPI row reads days, not lines.

A day's partial has one row for each kind of id (products, orders) and each 32,768 neighbouring ids: a bitmap of the ids that
occur, stored as hexadecimal text, and for products the sums of their lines. Bitmaps of several days merge by or, so distinct
counts over any days are exact although an order or product may occur on several of them; sums merge by addition. A day that
is loaded again replaces its partial. Ids must be whole numbers; for keys that are text, a
:class:`martworks.sources.key_index.KeyIndex` counts distinct ones without reading lines.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martworks.functions.paths import quoted
from martworks.sources import tables

PRODUCT, ORDER = "product", "order"


def daily_partials(fact: DataFrame, order: str = "cart_id", product: str = "product_id", revenue: str = "total_sales",
                   items: str = "quantity", day: str = "ds") -> DataFrame:
    """``kind, bucket, bitmap, revenue, items, <day>`` from one scan of the lines, summed in each task before the shuffle.

    Lines without a product or order count in the sums, not in the distinct counts: their bucket is null. No lines give no
    rows.
    """
    for name in (order, product):
        if not isinstance(fact.schema[name].dataType, T.IntegralType):
            raise TypeError(f"{name} is no whole number")
    line = fact.select(quoted(day).alias("day"), F.inline(F.array(
        F.struct(F.lit(PRODUCT).alias("kind"), quoted(product).cast("bigint").alias("id"),
                 quoted(revenue).alias("revenue"), quoted(items).alias("items")),
        F.struct(F.lit(ORDER).alias("kind"), quoted(order).cast("bigint").alias("id"),
                 F.lit(None).cast(fact.schema[revenue].dataType).alias("revenue"),
                 F.lit(None).cast(fact.schema[items].dataType).alias("items")))))
    grouped = line.groupBy("day", "kind", F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bitmap"),
        F.sum("revenue").alias("revenue"), F.sum("items").alias("items"))
    return grouped.select("kind", "bucket", F.hex("bitmap").alias("bitmap"), "revenue", "items", F.col("day").alias(day))


def load(fact: DataFrame, table: str, many_days: bool = False, **columns: str) -> None:
    """Replace the partials of the days that occur in ``fact``, which must hold these days whole."""
    tables.replace_partition(daily_partials(fact, **columns), table, columns.get("day", "ds"), many_days)


def summary(partials: DataFrame, days: Sequence[Any] | None = None, day: str = "ds") -> DataFrame:
    """The KPI row of :func:`martworks.operators.kpi.summary` over all days, or over some: no line is read."""
    if days is not None:
        partials = partials.where(quoted(day).isin(list(days)))
    merged = partials.groupBy("kind", "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg(F.unhex("bitmap"))).alias("ids"), F.sum("revenue").alias("revenue"), F.sum("items").alias("items"))
    ids = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("ids"))), F.lit(0))
    totals = merged.agg(
        F.coalesce(F.sum("revenue"), F.lit(0)).cast("double").alias("revenue"), ids(ORDER).alias("orders"),
        F.coalesce(F.sum("items"), F.lit(0)).cast("bigint").alias("items"), ids(PRODUCT).alias("unique_products"))
    value = F.when(F.col("orders") > 0, F.col("revenue") / F.col("orders")).otherwise(F.lit(0.0))
    return totals.withColumn("aov", value)
