"""The registry, and SQL fragments for the test-table shapes of :mod:`martworks.sources.adapters`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from martworks.functions.paths import quoted
from martworks.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(function(tune(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for comparison; sums were exact before this."""
    decimals = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
    if not decimals:
        return df
    return df.select(
        *(
            quoted(c).cast(T.DecimalType(38, 4)).cast("double").alias(c) if c in decimals else quoted(c)
            for c in df.columns
        )
    )


CARTS = """
carts as (
  select o_orderkey as cart_id, o_custkey as user_id, o_orderdate as order_date, l_partkey as product_id,
         l_quantity::bigint as quantity, date_trunc('year', o_orderdate)::date as ds
  from lineitem join orders on l_orderkey = o_orderkey
)"""

PRODUCTS = """
products as (
  select p_partkey as product_id, p_name as title, p_brand as description, p_retailprice as price,
         '  ' || upper(p_type[1]) || lower(p_type[2:]) || ' ' as category, null::varchar as image_url,
         p_size / 8 as rating_rate, (p_size - 3)::bigint as rating_count, length(p_name) as title_len,
         case when p_size <= 25 then date '1996-01-01' else date '1997-01-01' end as ds
  from part
)"""

PRODUCT_DAYS = """
product_days as (
  select product_id, title, description, category, image_url, rating_rate, rating_count, title_len,
         date '1996-01-01' as ds, price from products
  union all
  select product_id, title, description, category, image_url, rating_rate, rating_count, title_len,
         date '1997-01-01' as ds, price + 10 as price from products
)"""

MESSY_PRODUCTS = """
messy_products as (
  select case when description = 'Brand#7' then null else floor(price * 5)::bigint end as product_id,
         case when rating_count = 10 then null else title end as title, description,
         case when rating_count = 20 then null else price - 905 end as price,
         category, image_url, rating_rate, rating_count, title_len, ds
  from products
)"""

MESSY_CARTS = """
messy_carts as (
  select l_orderkey as cart_id, l_suppkey as user_id,
         case when l_quantity = 7 then null else l_partkey end as product_id,
         (l_quantity - 3)::bigint as quantity, date_trunc('year', l_shipdate)::date as ds
  from lineitem
)"""


def facts(products: str = "products", where: str = "true") -> str:
    """CTE ``fact``: the sales fact over ``carts`` and a products relation."""
    return f"""
fact as (
  select md5(concat_ws('||', c.cart_id::varchar, c.product_id::varchar,
                       coalesce(strftime(c.order_date, '%Y%m%d%H%M%S'), ''))) as transaction_id,
         c.product_id, p.title as product_name, lower(trim(p.category)) as category,
         c.quantity::decimal(18, 4) as quantity, p.price::decimal(18, 4) as price,
         c.quantity::decimal(18, 4) * p.price::decimal(18, 4) as total_sales,
         c.order_date as transaction_date, c.ds as load_ds
  from carts c left join {products} p using (product_id)
  where {where}
)"""


FACT_COLUMNS = """transaction_id, product_id, product_name, category, quantity::double as quantity,
       price::double as price, total_sales::double as total_sales, transaction_date, load_ds"""
