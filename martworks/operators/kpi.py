"""KPIs of the sales fact and the product dimension. Groups are summed before they shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martworks.functions.paths import quoted


def _sum(column: str) -> Column:
    """Sum that is zero for no values."""
    return F.coalesce(F.sum(quoted(column)), F.lit(0))


def order_column(fact: DataFrame) -> str:
    """Column that identifies an order: the transaction, else the cart."""
    return "transaction_id" if "transaction_id" in fact.columns else "cart_id"


def summary(fact: DataFrame) -> DataFrame:
    """One row: revenue, orders, items, unique products, average order value (0 without orders).

    Two exact distinct counts in one aggregate would copy every row for each of them. Here the sums go by product
    first, which also counts the products, and the orders are counted by a subquery that reads only their column.
    """
    orders = fact.agg(F.count_distinct(quoted(order_column(fact)))).scalar()
    by_product = fact.groupBy("product_id").agg(_sum("total_sales").alias("revenue"), _sum("quantity").alias("items"))
    totals = by_product.agg(
        _sum("revenue").cast("double").alias("revenue"),
        orders.alias("orders"),
        _sum("items").cast("bigint").alias("items"),
        F.count("product_id").alias("unique_products"),
    )
    value = F.when(F.col("orders") > 0, F.col("revenue") / F.col("orders")).otherwise(F.lit(0.0))
    return totals.withColumn("aov", value)


def revenue_by(fact: DataFrame, *keys: str) -> DataFrame:
    """Revenue per key; rows with a null in any key are left out."""
    return fact.dropna(subset=list(keys)).groupBy(*map(quoted, keys)).agg(_sum("total_sales").alias("revenue"))


def daily_sales(fact: DataFrame) -> DataFrame:
    return revenue_by(fact.withColumn("day", F.to_date("transaction_date")), "day")


def top(revenue: DataFrame, keys: Sequence[str], n: int = 10) -> DataFrame:
    """The ``n`` rows of highest revenue; equal revenue goes by key."""
    return revenue.orderBy(F.desc("revenue"), *(F.asc(k) for k in keys)).limit(n)


def best_day(fact: DataFrame) -> DataFrame:
    """Day of highest revenue, the earliest of equals."""
    return top(daily_sales(fact), ["day"], 1)


def top_categories(fact: DataFrame, n: int = 10) -> DataFrame:
    return top(revenue_by(fact, "category"), ["category"], n)


def top_products(fact: DataFrame, n: int = 10) -> DataFrame:
    return top(revenue_by(fact, "product_id", "product_name"), ["product_id", "product_name"], n)


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Counts over equal-width bins from the least to the greatest value; empty bins count 0, nulls are left out.

    A bin holds its lower edge, the last one its upper edge too. One distinct value gets a range of half a unit to each
    side. The bounds are a scalar subquery, so rows are binned where they are read and one count per bin and task is
    shuffled.
    """
    values = df.select(quoted(column).cast("double").alias("v")).where(F.col("v").isNotNull())
    bounds = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    spread = F.when(F.col("lo") == F.col("hi"), F.lit(0.5)).otherwise(F.lit(0.0))
    ends = bounds.select(F.struct((F.col("lo") - spread).alias("lo"), (F.col("hi") + spread).alias("hi")))
    placed = values.withColumn("ends", ends.scalar())
    low, high, value, at = F.col("ends.lo"), F.col("ends.hi"), F.col("v"), F.col("at")

    def edge(k: Column) -> Column:
        return F.when(k == bins, high).otherwise(low + k * ((high - low) / bins))

    # Rounding can put a value one bin off its edges, so the guess is compared with both edges.
    guess = F.least(F.floor((value - low) / (high - low) * bins), F.lit(bins - 1)).cast("int")
    exact = F.when(value < edge(at), at - 1).when((value >= edge(at + 1)) & (at != bins - 1), at + 1).otherwise(at)
    hits = placed.withColumn("at", guess).select((exact + 1).alias("bin"), F.lit(1).alias("n"))
    every = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"), F.lit(0).alias("n"))
    return hits.union(every).groupBy("bin").agg(F.sum("n").alias("n"))


def head(df: DataFrame, order: Sequence[str], n: int = 3) -> DataFrame:
    """First rows of a stated order."""
    return df.orderBy(*(F.asc_nulls_last(c) for c in order)).limit(n)
