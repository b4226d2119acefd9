"""Raw layer, exports, catalogue, source picking and the daily batch."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from martworks.operators import kpi
from martworks.plans import batch
from martworks.plans.resources import RAW_SCHEMAS
from martworks.queries.registry import CARTS, FACT_COLUMNS, PRODUCT_DAYS, PRODUCTS, facts, query
from martworks.queries.sales import BATCH, WITH_FACT, dim, fact
from martworks.session import scratch_dir
from martworks.sources import adapters, exports, pick, raw, tables

DAY = "2025-11-08"


@query("export_fact", f"{WITH_FACT} select {FACT_COLUMNS} from fact where load_ds = date '{BATCH}'")
def export_fact(spark, sf_dir):
    """Ordered CSV of one batch, read back by schema."""
    rows = exports.export_fact(fact(spark, sf_dir), BATCH)
    path = scratch_dir(spark, "fact")
    exports.write_csv(rows, path)
    return exports.read_csv(spark, path, rows.schema)


DIM_SQL = f"""with {PRODUCTS}, {PRODUCT_DAYS}
select distinct product_id, title as product_name, lower(trim(category)) as category,
       price::decimal(18, 4)::double as price, date '1997-01-01' as last_ingested_ds from product_days"""


@query("export_dim", DIM_SQL.replace("from product_days", "from product_days where product_id % 3 <> 0"))
def export_dim(spark, sf_dir):
    """A third of the products was last seen on another day and stays out."""
    seen = F.when(F.col("product_id") % 3 != 0, F.col("last_ingested_ds")).otherwise(F.lit("1996-01-01").cast("date"))
    return exports.export_dim(dim(spark, sf_dir).withColumn("last_ingested_ds", seen), "1997-01-01")


@query("export_dim_fallback", DIM_SQL)
def export_dim_fallback(spark, sf_dir):
    """No product was last seen on that day, so all are exported."""
    return exports.export_dim(dim(spark, sf_dir), "2030-01-01")


@query("export_l1", f"with {CARTS} select * from carts where ds = date '{BATCH}'")
def export_l1(spark, sf_dir):
    rows = exports.export_rows(adapters.carts(spark, sf_dir), BATCH)
    path = scratch_dir(spark, "carts")
    exports.write_csv(rows, path)
    return exports.read_csv(spark, path, rows.schema)


@query("read_sql", f"with {CARTS} select cart_id, product_id, quantity from carts where ds = date '{BATCH}'")
def read_sql(spark, sf_dir):
    """A parameterised query over a named view."""
    tables.materialize_view(adapters.carts(spark, sf_dir), "l1_carts")
    return tables.read_sql(
        spark, "select cart_id, product_id, quantity from l1_carts where ds = cast(:ds as date)", ds=BATCH
    )


def _catalog(table: str, columns: list[tuple[str, str]]) -> str:
    return " union all ".join(
        f"select '{table}' as table_name, '{name}' as column_name, {i} as column_index, '{dtype}' as column_type, "
        f"count(*) as row_count, count(*) filter ({name} is null) as null_count from {table}"
        for i, (name, dtype) in enumerate(columns, start=1)
    )


@query("catalog_columns", _catalog("part", [
    ("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"), ("p_size", "int"),
    ("p_retailprice", "double"),
]) + " union all " + _catalog("orders", [
    ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
    ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string"),
]))
def catalog_columns(spark, sf_dir):
    return exports.catalog_columns({name: adapters.table(spark, sf_dir, name) for name in ("part", "orders")})


USERS_SQL = """
select c_custkey::varchar as id, lower(c_name) || '@' || lower(c_mktsegment) || '.com' as email, c_name as username,
       '1-' || c_nationkey as phone from customer"""


@query("raw_envelope_roundtrip", USERS_SQL)
def raw_envelope_roundtrip(spark, sf_dir):
    """Records landed as JSON lines and read back by schema; the password is not in it."""
    root = scratch_dir(spark, "raw")
    raw.write_raw(adapters.raw_users(spark, sf_dir), root, "users", DAY, "customer")
    users = raw.read_raw(spark, root, "users", DAY, RAW_SCHEMAS["users"])
    return users.select("id", "email", "username", "phone")


@query("raw_envelopes", USERS_SQL)
def raw_envelopes(spark, sf_dir):
    """Envelopes ``{meta, data}``, here one per record, are unwrapped to their records."""
    path = scratch_dir(spark, "envelopes")
    users = adapters.raw_users(spark, sf_dir)
    meta = F.struct(F.lit("customer").alias("source"), F.lit(1).alias("count"))
    users.select(meta.alias("meta"), F.array(F.struct(*users.columns)).alias("data")).write.json(path)
    return raw.read_json(spark, path, RAW_SCHEMAS["users"]).select("id", "email", "username", "phone")


@query("raw_meta", f"""select 'customer' as source, '{DAY}T07:11:02Z' as fetched_at, count(*) as count,
date '{DAY}' as ds from customer""")
def raw_meta(spark, sf_dir):
    """The meta row beside the landed records."""
    root = scratch_dir(spark, "raw")
    at = dt.datetime(2025, 11, 8, 7, 11, 2, tzinfo=dt.timezone.utc)
    raw.write_raw(adapters.raw_users(spark, sf_dir), root, "users", DAY, "customer", at)
    return raw.read_meta(spark, root, "users", DAY).withColumn("ds", F.lit(DAY).cast("date"))


@query("staging_by_ds", f"with {CARTS} select * from carts where ds = date '{BATCH}'")
def staging_by_ds(spark, sf_dir):
    """All days go to staging; reading one opens that day's folder only."""
    root = scratch_dir(spark, "lake")
    raw.write_staging(adapters.carts(spark, sf_dir).hint("rebalance", "ds"), root, "carts")
    return raw.read_staging(spark, root, "carts", BATCH)


@query("pick_source", "select c_custkey::varchar as id, c_name as username from customer")
def pick_source(spark, sf_dir):
    """The dated layer folder is missing, so the feed's ``ds=`` folder is used; the object naming the day wins."""
    root = scratch_dir(spark, "feeds")
    users = adapters.raw_users(spark, sf_dir).select("id", "username")
    prefixes = pick.candidate_prefixes(root, "raw", "users", DAY, "shop")
    users.withColumn("id", F.lit("other")).write.json(f"{prefixes[1]}/a_other.json")
    users.write.json(f"{prefixes[1]}/users_{DAY}.json")
    found = pick.pick_source(spark, prefixes, ".json", DAY)
    folder = found.rsplit("/", 1)[0]
    return raw.read_json(spark, folder, users.schema)


BATCH_FACTS = f"""with carts as (
  select l_orderkey as cart_id, l_suppkey as user_id, l_shipdate as order_date, l_partkey as product_id,
         l_quantity::bigint as quantity, date '{DAY}' as ds
  from lineitem where l_linenumber <> 7 and l_returnflag in ('R', 'A')
  union all
  select l_orderkey, l_suppkey, l_shipdate, l_suppkey, l_linenumber::bigint, date '{DAY}'
  from lineitem where l_linenumber <> 7 and l_returnflag = 'R'
  union all
  select l_orderkey, l_suppkey, l_shipdate, null, null, date '{DAY}'
  from lineitem where l_linenumber = 7 or l_returnflag = 'N'
), products as (
  select p_partkey as product_id, p_name || ' ' as title,
         case when p_type <> 'PROMO' then p_type else 'unknown' end as category,
         case when p_size <= 40 then p_retailprice end as price from part
), {facts()}"""


def _run(spark, sf_dir) -> tuple[batch.Lake, object]:
    run = uuid.uuid4().hex
    lake = batch.Lake(spark, scratch_dir(spark, "lake"), f"l1_{run}", f"l2_{run}").create()
    feeds = {
        "products": adapters.raw_products(spark, sf_dir),
        "carts": adapters.raw_carts(spark, sf_dir),
        "users": adapters.raw_users(spark, sf_dir),
    }
    for name, records in feeds.items():
        raw.write_raw(records, lake.root, name, DAY, name)
    return lake, batch.run_day(lake, DAY, gate=False)


@query("daily_batch_kpis", f"""{BATCH_FACTS}, totals as (
  select coalesce(sum(total_sales), 0)::decimal(18, 4)::double as revenue, count(distinct transaction_id) as orders,
         coalesce(sum(quantity), 0)::bigint as items, count(distinct product_id) as unique_products from fact)
select *, case when orders > 0 then revenue / orders else 0.0 end as aov from totals""")
def daily_batch_kpis(spark, sf_dir):
    """Raw JSON to staging, tables, marts, tests and exports, then the KPIs of the stored fact."""
    lake, _ = _run(spark, sf_dir)
    return kpi.summary(lake.table("l2", "fact_sales"))


@query("daily_batch_report", f"""{BATCH_FACTS},
users as (select c_custkey as user_id from customer),
f as (select * from fact),
failed as (
  select 'staging' as layer, 'products' as resource, 'products_not_null_price' as test_name,
         count(*) filter (price is null) as failures from products
  union all select 'staging', 'products', 'products_not_null_title', 0
  union all select 'staging', 'products', 'products_gt_zero_price', 0
  union all select 'staging', 'products', 'products_unique_product_id', 0
  union all select 'staging', 'products', 'cfg_not_null_product_id', 0
  union all select 'staging', 'products', 'cfg_not_null_title', 0
  union all select 'staging', 'products', 'cfg_unique', 0
  union all select 'staging', 'carts', 'carts_gt_zero_quantity', 0
  union all select 'staging', 'carts', 'carts_unique_cart_id_product_id', sum(n - 1)::bigint
    from (select count(*) as n from carts group by cart_id, product_id)
  union all select 'staging', 'users', unnest(['users_not_null_email', 'users_unique_user_id', 'cfg_not_null_user_id',
    'cfg_not_null_username', 'cfg_not_null_email', 'cfg_unique']), 0
  union all select 'l1', 'products', unnest(['products_not_null_product_id', 'products_not_null_title',
    'products_not_null_ds', 'products_unique_product_id', 'products_price_nonneg', 'products_rating_count_nonneg']), 0
  union all select 'l1', 'products', 'products_not_null_price', count(*) filter (price is null) from products
  union all select 'l1', 'products', 'products_rating_range', count(*) filter (p_size / 8 > 5) from part
  union all select 'l1', 'users', unnest(['users_not_null_user_id', 'users_not_null_email', 'users_not_null_ds',
    'users_unique_user_id']), 0
  union all select 'l1', 'carts', unnest(['carts_not_null_cart_id', 'carts_not_null_user_id', 'carts_not_null_ds',
    'carts_quantity_positive']), 0
  union all select 'l1', 'carts', 'carts_not_null_product_id', count(*) filter (product_id is null) from carts
  union all select 'l1', 'carts', 'carts_not_null_quantity', count(*) filter (quantity is null) from carts
  union all select 'l1', 'carts', 'carts_compound_pk', count(*)
    from (select 1 from carts group by cart_id, product_id having count(*) > 1)
  union all select 'l1', 'carts', 'carts_user_id_in_users', count(*) from carts c
    where not exists (select 1 from users u where u.user_id = c.user_id)
  union all select 'l1', 'carts', 'carts_product_id_in_products', count(*) from carts c
    where product_id is not null and not exists (select 1 from products p where p.product_id = c.product_id)
  union all select 'l2', 'dim_product', unnest(['dim_product_not_null_product_id', 'dim_product_not_null_product_name',
    'dim_product_not_null_category', 'dim_product_unique_product_id']), 0
  union all select 'l2', 'dim_product', 'dim_product_not_null_price', count(*) filter (price is null) from products
  union all select 'l2', 'fact_sales', unnest(['fact_sales_not_null_transaction_id',
    'fact_sales_not_null_transaction_date', 'fact_sales_price_nonneg', 'fact_sales_quantity_positive',
    'fact_sales_total_matches']), 0
  union all select 'l2', 'fact_sales', 'fact_sales_not_null_product_id', count(*) filter (product_id is null) from f
  union all select 'l2', 'fact_sales', 'fact_sales_not_null_quantity', count(*) filter (quantity is null) from f
  union all select 'l2', 'fact_sales', 'fact_sales_not_null_price', count(*) filter (price is null) from f
  union all select 'l2', 'fact_sales', 'fact_sales_not_null_total_sales', count(*) filter (total_sales is null) from f
  union all select 'l2', 'fact_sales', 'fact_sales_unique_transaction_id', count(*)
    from (select 1 from f group by transaction_id having count(*) > 1)
  union all select 'l2', 'fact_sales', 'fact_sales_product_id_in_dim_product', count(*) from f
    where product_id is not null and not exists (select 1 from products p where p.product_id = f.product_id))
select test_name, layer, resource, date '{DAY}' as ds, case when failures > 0 then 'fail' else 'pass' end as status,
       failures::bigint as failures from failed""")
def daily_batch_report(spark, sf_dir):
    """The report of all tests of one day, without the gate."""
    return _run(spark, sf_dir)[1]
