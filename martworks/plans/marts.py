"""Staging views and marts: ``fact_sales`` and ``dim_product``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martworks.functions.paths import quoted
from martworks.functions.scalars import PRICE, QUANTITY, clean_category, on_day, transaction_key


def _batch(df: DataFrame, batch_ds: str | dt.date | None) -> DataFrame:
    return df if batch_ds is None else df.where(on_day(quoted("ds"), df.schema["ds"].dataType, batch_ds))


def stg_products(
    products: DataFrame, batch_ds: str | dt.date | None = None, price: T.DecimalType = PRICE
) -> DataFrame:
    """Product rows; ``price`` is the type of the money operand (``cast_changes`` tells what it rounds)."""
    return _batch(products, batch_ds).select(
        "product_id",
        quoted("title").alias("product_name"),
        clean_category(quoted("category")).alias("category"),
        quoted("price").cast(price).alias("price"),
        quoted("ds").alias("load_ds"),
    )


def stg_carts(
    carts: DataFrame, batch_ds: str | dt.date | None = None, quantity: T.DecimalType = QUANTITY
) -> DataFrame:
    """Cart lines; the transaction date is ``order_date``, else ``date``, else the batch day."""
    by_name = {name.lower(): name for name in carts.columns}
    dated = next(by_name[name] for name in ("order_date", "date", "ds") if name in by_name)
    return _batch(carts, batch_ds).select(
        "cart_id",
        "product_id",
        quoted("quantity").cast(quantity).alias("quantity"),
        quoted(dated).cast("timestamp_ntz").alias("transaction_date"),
        quoted("ds").alias("load_ds"),
    )


def latest_products(products: DataFrame) -> DataFrame:
    """One staged row per product, from its last day. A max of structs, so versions are merged before the shuffle."""
    newest = F.max(F.struct("load_ds", "product_name", "category", "price")).alias("newest")
    return products.groupBy("product_id").agg(newest).select(
        "product_id", "newest.product_name", "newest.category", "newest.price", "newest.load_ds"
    )


def fact_sales(carts: DataFrame, products: DataFrame, latest_product: bool = False) -> DataFrame:
    """Sales lines from staged carts and products.

    Every product day matches by default; ``latest_product`` keeps one product row, so lines are not multiplied. Only
    the needed product columns reach the join. Small products are broadcast by Catalyst; otherwise AQE splits the lines
    of a hot or null product over tasks.
    """
    if latest_product:
        products = latest_products(products)
    lines = carts.join(products.select("product_id", "product_name", "category", "price"), "product_id", "left")
    return lines.select(
        transaction_key(F.col("cart_id"), F.col("product_id"), F.col("transaction_date")).alias("transaction_id"),
        "product_id",
        "product_name",
        "category",
        "quantity",
        "price",
        (F.col("quantity") * F.col("price")).alias("total_sales"),
        "transaction_date",
        "load_ds",
    )


def dim_product(products: DataFrame, latest_product: bool = False) -> DataFrame:
    """Distinct product versions with the last day each product was seen on.

    The last day per product is an aggregate joined back, not a window: a window would bring all rows of a product into
    one task, while here equal versions are merged first and the join is split by AQE.
    """
    if latest_product:
        return latest_products(products).withColumnRenamed("load_ds", "last_ingested_ds")
    versions = products.groupBy("product_id", "product_name", "category", "price").agg(F.max("load_ds").alias("seen"))
    last = versions.groupBy(F.col("product_id").alias("id")).agg(F.max("seen").alias("last_ingested_ds"))
    return versions.join(last, F.col("product_id").eqNullSafe(F.col("id"))).select(
        "product_id", "product_name", "category", "price", "last_ingested_ds"
    )
