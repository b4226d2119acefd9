"""Tables kept beside the lake's: key indexes for upserts, unique keys and references over all days, and KPI partials."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martworks.plans import partials
from martworks.queries.loading import fresh_table
from martworks.queries.registry import CARTS, PRODUCTS, query
from martworks.sources import adapters, key_index, tables
from martworks.sources.key_index import KeyIndex

ORDER_DAYS = """
order_days as (
  select o_orderkey, o_custkey, o_orderstatus, o_totalprice, date_trunc('year', o_orderdate)::date as ds from orders)"""


def _order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.trunc("o_orderdate", "year").alias("ds"))


def _indexed(spark: SparkSession, name: str, rows: DataFrame, *keys: list[str]) -> list[KeyIndex]:
    """A fresh table of the rows with an index for each list of keys."""
    table = fresh_table(spark, name)
    tables.replace_partition(rows, table, many_days=True)
    return [KeyIndex(spark, table, own, buckets=16).open() for own in keys]


@query("upsert_indexed", f"""with {ORDER_DAYS},
batch as (
  select case when o_orderstatus = 'P' then o_orderkey + 100000000 else o_orderkey end as o_orderkey,
         o_totalprice * 2 as o_totalprice, date '1999-01-01' as ds
  from order_days where o_orderstatus <> 'O')
select coalesce(o.o_orderkey, b.o_orderkey) as o_orderkey, o.o_custkey, o.o_orderstatus,
       coalesce(b.o_totalprice, o.o_totalprice) as o_totalprice, coalesce(b.ds, o.ds) as ds
from order_days o full outer join batch b on o.o_orderkey = b.o_orderkey""")
def upsert_indexed(spark, sf_dir):
    """Matched orders move to the batch's day, others are new; the keys are matched in the index."""
    days = _order_days(spark, sf_dir)
    index, = _indexed(spark, "orders", days, ["o_orderkey"])
    key = F.when(F.col("o_orderstatus") == "P", F.col("o_orderkey") + 100000000).otherwise(F.col("o_orderkey"))
    batch = days.where("o_orderstatus <> 'O'").select(
        key.alias("o_orderkey"), (F.col("o_totalprice") * 2).alias("o_totalprice"),
        F.lit("1999-01-01").cast("date").alias("ds"))
    key_index.upsert(batch, index)
    return spark.table(index.table)


@query("dq_stored_keys", f"""with {ORDER_DAYS}
select o_orderkey, date '1997-01-01' as ds, ds as stored_ds from order_days where ds = date '1996-01-01'
union all
select o_orderkey, ds, null from order_days where ds = date '1997-01-01'""")
def dq_stored_keys(spark, sf_dir):
    """A new version of a day that repeats keys of the day before is refused, and these keys are named."""
    days = _order_days(spark, sf_dir)
    index, = _indexed(spark, "orders", days, ["o_orderkey"])
    batch = days.where("year(ds) in (1996, 1997)").withColumn("ds", F.lit("1997-01-01").cast("date"))
    try:
        key_index.load_unique(batch, index)
    except tables.DuplicateKeys:
        kept = spark.table(index.table).where("year(ds) = 1997")
        return index.conflicts(batch).unionByName(
            kept.select("o_orderkey", "ds", F.lit(None).cast("date").alias("stored_ds")))
    return index.conflicts(batch).where("false")


@query("dq_incremental", f"""with {CARTS}, {PRODUCTS},
now as (
  select cart_id, case when ds = date '1997-01-01' then product_id * 2 else product_id end as product_id, ds
  from carts where ds <> date '1996-01-01' or quantity > 10)
select 'carts_unique' as test_name, cart_id, product_id, count(*) as n_records from now group by all having count(*) > 1
union all
select 'carts_product', null, product_id, count(*) from now
where product_id not in (select product_id from products) group by all""")
def dq_incremental(spark, sf_dir):
    """Two days are replaced; unique keys and references of all days are then tested in the indexes."""
    carts = adapters.carts(spark, sf_dir)
    lines, by_product = _indexed(spark, "carts", carts, ["cart_id", "product_id"], ["product_id"])
    parent, = _indexed(spark, "products", adapters.products(spark, sf_dir), ["product_id"])
    doubled = F.when(F.year("ds") == 1997, F.col("product_id") * 2).otherwise(F.col("product_id"))
    batch = carts.where("year(ds) = 1997 or (year(ds) = 1996 and quantity > 10)").withColumn("product_id", doubled)
    key_index.load(batch, [lines, by_product])
    columns = ["test_name", "cart_id", "product_id", "n_records"]
    again = lines.repeated().withColumn("test_name", F.lit("carts_unique"))
    lost = by_product.orphans(parent).withColumns({
        "test_name": F.lit("carts_product"), "cart_id": F.lit(None).cast("long")})
    return again.select(columns).unionByName(lost.select(columns))


@query("kpi_from_partials", f"""with {CARTS},
now as (
  select cart_id, case when ds = date '1997-01-01' then product_id * 2 else product_id end as product_id, quantity, ds
  from carts where ds <> date '1997-01-01' or quantity > 10),
rows as (select 'all' as days, * from now union all select '1996 to 1997', * from now where year(ds) in (1996, 1997)),
totals as (
  select days, coalesce(sum(quantity * 2), 0)::double as revenue, count(distinct cart_id) as orders,
         coalesce(sum(quantity), 0)::bigint as items, count(distinct product_id) as unique_products from rows group by days)
select *, case when orders > 0 then revenue / orders else 0.0 end as aov from totals""")
def kpi_from_partials(spark, sf_dir):
    """One day's lines are replaced and with them its partial; KPI rows over all days and over two of them."""
    lines = adapters.carts(spark, sf_dir).withColumn("total_sales", F.col("quantity") * 2)
    table = fresh_table(spark, "kpi_partials")
    partials.load(lines, table, many_days=True)
    again = lines.where("year(ds) = 1997 and quantity > 10").withColumn("product_id", F.col("product_id") * 2)
    partials.load(again, table)
    kept = spark.table(table)
    two = [dt.date(1996, 1, 1), dt.date(1997, 1, 1)]
    return partials.summary(kept).withColumn("days", F.lit("all")).unionByName(
        partials.summary(kept, two).withColumn("days", F.lit("1996 to 1997")))
