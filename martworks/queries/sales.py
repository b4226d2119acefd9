"""Marts and KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martworks.operators import kpi
from martworks.plans import marts
from martworks.queries.registry import CARTS, FACT_COLUMNS, PRODUCT_DAYS, PRODUCTS, facts, query
from martworks.sources import adapters

BATCH = "1997-01-01"


def fact(spark: SparkSession, sf_dir: str, batch_ds: str | None = None) -> DataFrame:
    return marts.fact_sales(
        marts.stg_carts(adapters.carts(spark, sf_dir), batch_ds),
        marts.stg_products(adapters.products(spark, sf_dir), batch_ds),
    )


def dim(spark: SparkSession, sf_dir: str, latest_product: bool = False) -> DataFrame:
    return marts.dim_product(marts.stg_products(adapters.product_days(spark, sf_dir)), latest_product)


WITH_FACT = f"with {CARTS}, {PRODUCTS}, {facts()}"


@query("stg_products", f"""with {PRODUCTS}
select product_id, title as product_name, lower(trim(category)) as category, price::decimal(18, 4)::double as price,
       ds as load_ds from products""")
def stg_products(spark, sf_dir):
    return marts.stg_products(adapters.products(spark, sf_dir))


@query("stg_carts_by_ds", f"""with {CARTS}
select cart_id, product_id, quantity::double as quantity, ds::timestamp as transaction_date, ds as load_ds
from carts where ds = date '{BATCH}'""")
def stg_carts_by_ds(spark, sf_dir):
    """No order date: the batch day dates the transaction."""
    return marts.stg_carts(adapters.carts(spark, sf_dir).drop("order_date"), BATCH)


@query("fact_sales", f"{WITH_FACT} select {FACT_COLUMNS} from fact")
def fact_sales(spark, sf_dir):
    return fact(spark, sf_dir)


@query("fact_sales_batch", f"""with {CARTS}, batch as (select * from carts where ds = date '{BATCH}'), {PRODUCTS},
{facts(f"(select * from products where ds = date '{BATCH}')").replace("from carts c", "from batch c")}
select {FACT_COLUMNS} from fact""")
def fact_sales_batch(spark, sf_dir):
    return fact(spark, sf_dir, BATCH)


@query("fact_sales_product_days", f"with {CARTS}, {PRODUCTS}, {PRODUCT_DAYS}, {facts('product_days')} "
       f"select {FACT_COLUMNS} from fact")
def fact_sales_product_days(spark, sf_dir):
    """Two days of each product: every day matches."""
    return marts.fact_sales(
        marts.stg_carts(adapters.carts(spark, sf_dir)), marts.stg_products(adapters.product_days(spark, sf_dir))
    )


LATEST = """latest as (
  select * from product_days
  qualify row_number() over (partition by product_id order by ds desc, title desc, category desc, price desc) = 1
)"""


@query("fact_sales_latest_product", f"with {CARTS}, {PRODUCTS}, {PRODUCT_DAYS}, {LATEST}, {facts('latest')} "
       f"select {FACT_COLUMNS} from fact")
def fact_sales_latest_product(spark, sf_dir):
    return marts.fact_sales(
        marts.stg_carts(adapters.carts(spark, sf_dir)), marts.stg_products(adapters.product_days(spark, sf_dir)), True
    )


@query("dim_product", f"""with {PRODUCTS}, {PRODUCT_DAYS}
select distinct product_id, title as product_name, lower(trim(category)) as category,
       price::decimal(18, 4)::double as price, max(ds) over (partition by product_id) as last_ingested_ds
from product_days""")
def dim_product(spark, sf_dir):
    return dim(spark, sf_dir)


@query("dim_product_latest", f"""with {PRODUCTS}, {PRODUCT_DAYS}, {LATEST}
select product_id, title as product_name, lower(trim(category)) as category, price::decimal(18, 4)::double as price,
       ds as last_ingested_ds from latest""")
def dim_product_latest(spark, sf_dir):
    return dim(spark, sf_dir, latest_product=True)


@query("kpi_summary", f"""{WITH_FACT}, totals as (
  select coalesce(sum(total_sales), 0)::decimal(18, 4)::double as revenue,
         count(distinct transaction_id) as orders, coalesce(sum(quantity), 0)::bigint as items,
         count(distinct product_id) as unique_products from fact)
select *, case when orders > 0 then revenue / orders else 0.0 end as aov from totals""")
def kpi_summary(spark, sf_dir):
    return kpi.summary(fact(spark, sf_dir))


@query("kpi_summary_by_cart", f"""with {CARTS}, totals as (
  select coalesce(sum(quantity * 2), 0)::double as revenue, count(distinct cart_id) as orders,
         coalesce(sum(quantity), 0)::bigint as items, count(distinct product_id) as unique_products from carts)
select *, case when orders > 0 then revenue / orders else 0.0 end as aov from totals""")
def kpi_summary_by_cart(spark, sf_dir):
    """A fact without transaction ids counts carts as orders."""
    lines = adapters.carts(spark, sf_dir)
    return kpi.summary(lines.withColumn("total_sales", F.col("quantity") * 2))


def _revenue(keys: str, order: str = "", where: str = "true") -> str:
    return f"""{WITH_FACT}
select {keys}, coalesce(sum(total_sales), 0)::decimal(18, 4)::double as revenue from fact where {where}
group by all {order}"""


@query("daily_sales", _revenue("transaction_date::date as day"))
def daily_sales(spark, sf_dir):
    return kpi.daily_sales(fact(spark, sf_dir))


@query("best_day", _revenue("transaction_date::date as day", "order by revenue desc, day limit 1"))
def best_day(spark, sf_dir):
    return kpi.best_day(fact(spark, sf_dir))


@query("category_revenue_top10", _revenue("category", "order by revenue desc, category limit 10", "category is not null"))
def category_revenue_top10(spark, sf_dir):
    return kpi.top_categories(fact(spark, sf_dir))


@query("product_revenue_top10", _revenue(
    "product_id, product_name", "order by revenue desc, product_id, product_name limit 10", "product_name is not null"))
def product_revenue_top10(spark, sf_dir):
    return kpi.top_products(fact(spark, sf_dir))


@query("top_category", _revenue("category", "order by revenue desc, category limit 1", "category is not null"))
def top_category(spark, sf_dir):
    return kpi.top_categories(fact(spark, sf_dir), 1)


@query("top_product", _revenue(
    "product_id, product_name", "order by revenue desc, product_id, product_name limit 1", "product_name is not null"))
def top_product(spark, sf_dir):
    return kpi.top_products(fact(spark, sf_dir), 1)


@query("price_histogram", f"""with {PRODUCTS}, {PRODUCT_DAYS},
v as (select distinct product_id, title, category, price::decimal(18, 4)::double as v from product_days),
b as (select min(v) as lo, max(v) as hi from v),
g as (select v, lo, hi, least(floor((v - lo) / (hi - lo) * 30), 29)::int as g from v, b),
p as (select case when v < lo + g * ((hi - lo) / 30) then g - 1
                  when g <> 29 and v >= lo + (g + 1) * ((hi - lo) / 30) then g + 1 else g end + 1 as bin from g)
select r.bin::int as bin, count(p.bin) as n from range(1, 31) r(bin) left join p using (bin) group by all""")
def price_histogram(spark, sf_dir):
    return kpi.histogram(dim(spark, sf_dir), "price")


@query("fact_head", f"""{WITH_FACT} select {FACT_COLUMNS} from fact
order by transaction_date nulls last, product_id nulls last, transaction_id limit 3""")
def fact_head(spark, sf_dir):
    return kpi.head(fact(spark, sf_dir), ["transaction_date", "product_id", "transaction_id"])
