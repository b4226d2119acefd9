"""Table loads. Each query loads fresh tables below the shared scratch folder and reads them back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martworks.operators.quality import QualityError, at_least
from martworks.plans.batch import Lake, load_gated
from martworks.queries.registry import CARTS, MESSY_CARTS, PRODUCT_DAYS, PRODUCTS, query
from martworks.session import scratch_dir
from martworks.sources import adapters, tables


def fresh_table(spark: SparkSession, name: str) -> str:
    """Name of a table that does not exist yet, in a database of its own."""
    database = f"run_{uuid.uuid4().hex}"
    tables.ensure_database(spark, database, scratch_dir(spark, "tables"))
    return f"{database}.{name}"


def _day(df: DataFrame, day: str) -> DataFrame:
    return df.where(F.col("ds") == F.lit(day).cast("date"))


@query("load_append_evolve", f"""with {PRODUCTS}, {PRODUCT_DAYS}
select * exclude (rating_rate, rating_count, image_url),
       case when ds = date '1997-01-01' then rating_rate end as rating_rate,
       case when ds = date '1997-01-01' then rating_count end as rating_count from product_days""")
def load_append_evolve(spark, sf_dir):
    """The second day brings two new columns; rows of the first day read them as null."""
    days = adapters.product_days(spark, sf_dir).drop("image_url")
    table = fresh_table(spark, "products")
    tables.append_rows(_day(days, "1996-01-01").drop("rating_rate", "rating_count"), table)
    tables.append_rows(_day(days, "1997-01-01"), table)
    return spark.table(table)


@query("load_truncate", f"with {MESSY_CARTS} select * from messy_carts where quantity < 1")
def load_truncate(spark, sf_dir):
    """A second load replaces the first; an empty third one changes nothing."""
    carts = adapters.messy_carts(spark, sf_dir)
    table = fresh_table(spark, "carts")
    tables.truncate_insert(carts, table, many_days=True)
    tables.truncate_insert(carts.where("quantity < 1"), table, many_days=True)
    tables.truncate_insert(carts.where("quantity < -100"), table)
    return spark.table(table)


@query("load_replace_partition", f"""with {CARTS}
select cart_id, user_id, order_date, product_id,
       case when ds = date '1997-01-01' then quantity * 2 else quantity end as quantity, ds
from carts where ds <> date '1997-01-01' or quantity > 10""")
def load_replace_partition(spark, sf_dir):
    """One day is replaced, twice with the same outcome; the other days stay."""
    carts = adapters.carts(spark, sf_dir)
    table = fresh_table(spark, "carts")
    tables.replace_partition(carts, table, many_days=True)
    batch = _day(carts, "1997-01-01").where("quantity > 10").withColumn("quantity", F.col("quantity") * 2)
    tables.replace_partition(batch, table)
    tables.replace_partition(batch, table)
    tables.replace_partition(batch.where("quantity < 0"), table)
    return spark.table(table)


@query("delete_where", f"""with {CARTS}
select * from carts where not (ds = date '1997-01-01' and quantity = 5) and ds <> date '1998-01-01'""")
def delete_where(spark, sf_dir):
    """Rows of one day and quantity go, then a whole day; an empty condition deletes nothing."""
    table = fresh_table(spark, "carts")
    tables.replace_partition(adapters.carts(spark, sf_dir), table, many_days=True)
    tables.delete_where(spark, table, {"ds": "1997-01-01", "quantity": 5})
    tables.delete_where(spark, table, {"ds": "1998-01-01"})
    tables.delete_where(spark, table, {})
    return spark.table(table)


@query("load_upsert", f"""with {PRODUCTS}, {PRODUCT_DAYS},
old as (select * exclude (image_url) from product_days where ds = date '1996-01-01'),
new as (
  select case when description = 'Brand#7' then null when rating_count <= 7 then product_id + 10000000
              else product_id end as product_id,
         title, description, price + 100 as price, date '1997-01-01' as ds
  from old where rating_count <= 20)
select coalesce(o.product_id, n.product_id) as product_id,
       case when n.ds is not null then n.title else o.title end as title,
       case when n.ds is not null then n.description else o.description end as description,
       o.category, o.rating_rate, o.rating_count, o.title_len,
       case when n.ds is not null then n.price else o.price end as price,
       case when n.ds is not null then n.ds else o.ds end as ds
from old o full outer join new n on o.product_id = n.product_id""")
def load_upsert(spark, sf_dir):
    """Matched products move to the batch's day and keep the columns the batch lacks; null keys are inserted."""
    old = _day(adapters.product_days(spark, sf_dir), "1996-01-01").drop("image_url")
    key = F.when(F.col("description") == "Brand#7", F.lit(None)).when(
        F.col("rating_count") <= 7, F.col("product_id") + 10000000
    ).otherwise(F.col("product_id"))
    batch = old.where("rating_count <= 20").select(
        key.alias("product_id"), "title", "description", (F.col("price") + 100).alias("price"),
        F.lit("1997-01-01").cast("date").alias("ds"),
    )
    table = fresh_table(spark, "products")
    tables.append_rows(old, table)
    tables.upsert(batch, table, ["product_id"])
    return spark.table(table)


@query("load_upsert_keys_only", """
select p_partkey as product_id from part union select p_partkey + 1000 from part""")
def load_upsert_keys_only(spark, sf_dir):
    """A batch of keys inserts the new ones and leaves the others alone; the table has no partitions."""
    keys = adapters.products(spark, sf_dir).select("product_id")
    table = fresh_table(spark, "keys")
    tables.append_rows(keys, table)
    tables.upsert(keys.select((F.col("product_id") + 1000).alias("product_id")), table, ["product_id"])
    return spark.table(table)


@query("gated_load", f"""with {CARTS},
good as (select * replace (quantity * 2 as quantity) from carts where ds = date '1997-01-01'),
bad as (select * replace (quantity - 5 as quantity) from carts where ds = date '1996-01-01')
select 'table' as kind, cart_id, product_id, quantity, ds from carts where ds <> date '1997-01-01'
union all select 'table', cart_id, product_id, quantity, ds from good
union all select 'quarantine', cart_id, product_id, quantity, ds from bad where quantity < 1""")
def gated_load(spark, sf_dir):
    """All days are published together, then a good new version of one day; a bad one stays out and goes to quarantine."""
    carts = adapters.carts(spark, sf_dir)
    lake = Lake(spark, scratch_dir(spark, "gated"), l1=f"run_{uuid.uuid4().hex}")
    tables.ensure_database(spark, lake.l1, f"{lake.root}/{lake.l1}")
    tests = [at_least("carts_quantity_positive", "quantity", 1)]
    load_gated(lake, "carts", "1995-01-01", carts, tests)
    load_gated(lake, "carts", "1997-01-01", _day(carts, "1997-01-01").withColumn("quantity", F.col("quantity") * 2), tests)
    bad = _day(carts, "1996-01-01").withColumn("quantity", F.col("quantity") - 5)
    try:
        load_gated(lake, "carts", "1996-01-01", bad, tests)
    except QualityError:
        pass
    columns = ["cart_id", "product_id", "quantity", "ds"]
    kept = lake.table("l1", "carts").select(F.lit("table").alias("kind"), *columns)
    out = spark.read.parquet(f"{lake.root}/quarantine/l1_candidate/carts/ds=1996-01-01").withColumnRenamed("row_ds", "ds")
    return kept.unionByName(out.select(F.lit("quarantine").alias("kind"), *columns))
