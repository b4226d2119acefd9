"""The given test tables in the shapes of the shop resources.

Every function is a projection of whole tables; only ``carts`` joins, on the order key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Schemas of the given tables, so that opening one starts no job to read its footers.
SCHEMAS = {
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def carts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cart lines: an order is a cart, its lines are the items, its year is the batch day."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderkey").alias("cart_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.trunc("o_orderdate", "year").alias("ds"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products in one version each, seen on one of two days by size."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("description"),
        F.col("p_retailprice").alias("price"),
        F.concat(F.lit("  "), F.initcap("p_type"), F.lit(" ")).alias("category"),
        F.lit(None).cast("string").alias("image_url"),
        (F.col("p_size") / 8).alias("rating_rate"),
        (F.col("p_size") - 3).cast("bigint").alias("rating_count"),
        F.length("p_name").cast("bigint").alias("title_len"),
        F.when(F.col("p_size") <= 25, F.lit("1996-01-01")).otherwise(F.lit("1997-01-01")).cast("date").alias("ds"),
    )


def product_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products seen on two days, dearer on the second."""
    days = F.array(
        F.struct(F.lit("1996-01-01").cast("date").alias("ds"), F.col("price").alias("price")),
        F.struct(F.lit("1997-01-01").cast("date").alias("ds"), (F.col("price") + 10).alias("price")),
    )
    one = products(spark, sf_dir)
    return one.select(*(c for c in one.columns if c not in ("ds", "price")), F.inline(days))


def messy_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products that break rules: missing titles, prices at or below zero, repeated ids."""
    one = products(spark, sf_dir)
    return one.withColumns({
        "product_id": F.when(F.col("description") == "Brand#7", F.lit(None)).otherwise(F.floor(F.col("price") * 5)),
        "title": F.when(F.col("rating_count") == 10, F.lit(None)).otherwise(F.col("title")),
        "price": F.when(F.col("rating_count") == 20, F.lit(None)).otherwise(F.col("price") - 905),
    })


def messy_carts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cart lines with repeated keys and quantities below one; needs no join."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("cart_id"),
        F.col("l_suppkey").alias("user_id"),
        F.when(F.col("l_quantity") == 7, F.lit(None)).otherwise(F.col("l_partkey")).alias("product_id"),
        (F.col("l_quantity") - 3).cast("bigint").alias("quantity"),
        F.trunc("l_shipdate", "year").alias("ds"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw product records: every leaf is text, ratings are nested, some values are missing or unreadable."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        F.concat(F.col("p_name"), F.lit(" ")).alias("title"),
        F.when(F.col("p_size") > 40, F.lit("n/a")).otherwise(F.col("p_retailprice").cast("string")).alias("price"),
        F.when(F.col("p_size") > 10, F.col("p_brand")).alias("description"),
        F.when(F.col("p_type") != "PROMO", F.col("p_type")).alias("category"),
        F.concat(F.lit("img/"), F.col("p_partkey").cast("string"), F.lit(".png")).alias("image"),
        F.struct(
            (F.col("p_size") / 8).cast("string").alias("rate"),
            F.when(F.col("p_size") < 30, F.col("p_size").cast("string")).otherwise(F.lit("many")).alias("count"),
        ).alias("rating"),
    )


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw user records, nested three levels deep."""
    nation = F.col("c_nationkey").cast("string")
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.concat(F.lower("c_name"), F.lit("@"), F.lower("c_mktsegment"), F.lit(".com")).alias("email"),
        F.col("c_name").alias("username"),
        F.lit("secret").alias("password"),
        F.concat(F.lit("1-"), nation).alias("phone"),
        F.struct(
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("firstname"),
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("lastname"),
        ).alias("name"),
        F.struct(
            F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("city"),
            F.lit("Main St").alias("street"),
            nation.alias("number"),
            F.struct(
                F.col("c_acctbal").cast("string").alias("lat"),
                F.concat(F.lit("x"), nation).alias("long"),
            ).alias("geolocation"),
        ).alias("address"),
    )


def _items(text: bool = False) -> Column:
    """Lines of one raw cart, by return flag: two for R, one for A, an empty list for N and O, null for line 7."""
    def item(product: str, quantity: str) -> Column:
        return F.struct(
            F.col(product).cast("bigint").alias("productId"), F.col(quantity).cast("bigint").alias("quantity")
        )

    first, second = item("l_partkey", "l_quantity"), item("l_suppkey", "l_linenumber")
    empty = F.slice(F.array(first), 1, 0)
    listed = F.when(F.col("l_returnflag") == "R", F.array(first, second)).when(
        F.col("l_returnflag") == "A", F.array(first)
    ).otherwise(empty)
    return F.when(F.col("l_linenumber") != 7, listed)


def raw_carts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw cart records, one per order line, with a list of no, one or two items."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.col("l_suppkey").alias("userId"),
        F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit("T00:00:00.000Z")).alias("date"),
        _items().alias("products"),
    )


def text_carts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw carts whose list arrives as text: JSON for R, a lone JSON object for A, a Python literal for N."""
    part, count = F.col("l_partkey").cast("string"), F.col("l_quantity").cast("bigint").cast("string")
    python = F.concat(
        F.lit("[{'productId': "), part, F.lit(", 'quantity': None}, {'productId': "), part, F.lit(", 'quantity': '"),
        count, F.lit("'}]"),
    )
    lone = F.concat(F.lit('{"productId": '), part, F.lit(', "quantity": '), count, F.lit("}"))
    text = (
        F.when(F.col("l_linenumber") == 7, F.lit("not a list"))
        .when(F.col("l_returnflag") == "R", F.to_json(_items()))
        .when(F.col("l_returnflag") == "A", lone)
        .otherwise(python)
    )
    raw = table(spark, sf_dir, "lineitem")
    return raw.select(F.col("l_orderkey").alias("id"), F.col("l_suppkey").alias("userId"), text.alias("products"))
