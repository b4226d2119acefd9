"""Data-quality checks, reports and quarantine."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martworks.operators import quality as dq
from martworks.plans import rules
from martworks.plans.resources import PRODUCTS_CONFIG
from martworks.queries.registry import MESSY_CARTS, MESSY_PRODUCTS, PRODUCTS, query
from martworks.queries.sales import WITH_FACT, fact
from martworks.session import scratch_dir
from martworks.sources import adapters

DAY = "2025-11-08"
MESSY = f"with {PRODUCTS}, {MESSY_PRODUCTS}, {MESSY_CARTS}"
COLUMNS = (
    "product_id", "title", "description", "price", "category", "image_url", "rating_rate", "rating_count", "title_len",
    "ds",
)


@query("dq_null_counts", MESSY + " ".join(
    f"{'union all' if i else ''} select '{c}' as \"column\", count(*) filter ({c} is null) as nulls from messy_products"
    for i, c in enumerate(COLUMNS)))
def dq_null_counts(spark, sf_dir):
    return dq.null_counts(adapters.messy_products(spark, sf_dir))


@query("dq_not_null", f"{MESSY} " + " union all ".join(
    f"select 'products_not_null_{c}' as test_name, * from messy_products where {c} is null"
    for c in ("product_id", "title", "price")))
def dq_not_null(spark, sf_dir):
    """Whole rows, once per violated test."""
    wanted = [dq.not_null(f"products_not_null_{c}", c) for c in ("product_id", "title", "price")]
    return dq.row_violations(adapters.messy_products(spark, sf_dir), wanted)


@query("dq_gt_zero", f"{MESSY} select 'carts_gt_zero_quantity' as test_name, * from messy_carts where quantity <= 0")
def dq_gt_zero(spark, sf_dir):
    return dq.row_violations(
        adapters.messy_carts(spark, sf_dir), [dq.above_zero("carts_gt_zero_quantity", "quantity")]
    )


@query("dq_unique", f"""{MESSY}
select product_id, count(*) as n_records from messy_products where product_id is not null
group by all having count(*) > 1""")
def dq_unique(spark, sf_dir):
    """Warehouse uniqueness: nulls left out."""
    return dq.key_violations(adapters.messy_products(spark, sf_dir), dq.unique("unique", "product_id"))


@query("dq_duplicates", f"""{MESSY}
select coalesce(sum(n - 1), 0)::bigint as duplicates
from (select product_id, count(*) as n from messy_products group by all)""")
def dq_duplicates(spark, sf_dir):
    """Pre-load uniqueness: rows beyond the first, nulls equal."""
    return dq.duplicate_count(adapters.messy_products(spark, sf_dir), ["product_id"])


@query("dq_compound_key", f"""{MESSY}
select cart_id, product_id, count(*) as n_records from messy_carts group by all having count(*) > 1""")
def dq_compound_key(spark, sf_dir):
    return dq.key_violations(
        adapters.messy_carts(spark, sf_dir), dq.compound_key("carts_compound_pk", "cart_id", "product_id")
    )


PARENTS = """
users as (select s_suppkey as user_id from supplier where s_acctbal > 0),
parents as (select p_partkey as product_id from part where p_size <= 40)"""


def _carts_rules(spark, sf_dir):
    users = adapters.table(spark, sf_dir, "supplier").where("s_acctbal > 0").selectExpr("s_suppkey as user_id")
    parents = adapters.table(spark, sf_dir, "part").where("p_size <= 40").selectExpr("p_partkey as product_id")
    return rules.carts_rules(users, parents)


@query("dq_relationships", f"""{MESSY}, {PARENTS}
select 'carts_user_id_in_users' as test_name, user_id as key, count(*) as n_records from messy_carts c
where user_id is not null and not exists (select 1 from users u where u.user_id = c.user_id) group by all
union all
select 'carts_product_id_in_products', product_id, count(*) from messy_carts c
where product_id is not null and not exists (select 1 from parents p where p.product_id = c.product_id) group by all""")
def dq_relationships(spark, sf_dir):
    carts = adapters.messy_carts(spark, sf_dir)
    found = []
    for rule in _carts_rules(spark, sf_dir):
        if isinstance(rule, dq.ReferenceRule):
            orphans = dq.reference_violations(carts, rule)
            found.append(orphans.select(
                F.lit(rule.name).alias("test_name"), F.col(rule.columns[0]).alias("key"), "n_records"
            ))
    return reduce(DataFrame.unionByName, found)


@query("dq_ranges", f"""{MESSY}
select 'products_price_nonneg' as test_name, * from messy_products where price <= 0
union all select 'products_rating_count_nonneg', * from messy_products where rating_count < 0
union all select 'products_rating_range', * from messy_products where rating_rate < 0 or rating_rate > 5""")
def dq_ranges(spark, sf_dir):
    ranges = [r for r in rules.products_rules() if isinstance(r, dq.RowRule) and "not_null" not in r.name]
    return dq.row_violations(adapters.messy_products(spark, sf_dir), ranges)


@query("dq_cart_quantity", f"""{MESSY} select 'carts_quantity_positive' as test_name, * from messy_carts
where quantity is not null and quantity < 1""")
def dq_cart_quantity(spark, sf_dir):
    return dq.row_violations(
        adapters.messy_carts(spark, sf_dir), [dq.at_least("carts_quantity_positive", "quantity", 1)]
    )


@query("dq_total_matches", f"""{WITH_FACT}, off as (
  select transaction_id, product_id, quantity - 2 as quantity, price - 901 as price,
         total_sales + case when product_name like 'small%' then 0.01 else 0 end as total_sales
  from (select * replace ((quantity - 2) * (price - 901) as total_sales) from fact)),
t as (
  select 'fact_sales_price_nonneg' as test_name, * from off where price < 0
  union all select 'fact_sales_quantity_positive', * from off where quantity <= 0
  union all select 'fact_sales_total_matches', * from off where abs(total_sales - quantity * price) > 1e-9)
select test_name, transaction_id, product_id, quantity::double as quantity, price::double as price,
       total_sales::double as total_sales from t""")
def dq_total_matches(spark, sf_dir):
    """Price, quantity and total tests on a fact whose totals are off for some products."""
    extra = F.when(F.col("product_name").startswith("small"), F.lit("0.01").cast("decimal(18,2)")).otherwise(
        F.lit(0).cast("decimal(18,2)")
    )
    good = fact(spark, sf_dir)
    off = good.select(
        "transaction_id", "product_id", (F.col("quantity") - 2).alias("quantity"), (F.col("price") - 901).alias("price"),
        ((F.col("quantity") - 2) * (F.col("price") - 901) + extra).alias("total_sales"),
    )
    wanted = [r for r in rules.fact_sales_rules(good) if r.name.endswith(("_nonneg", "_positive", "_matches"))]
    return dq.row_violations(off, wanted)


REPORT = f"""{MESSY}, {PARENTS}, failed as (
  select 'carts_not_null_cart_id' as test_name, count(*) filter (cart_id is null) as failures from messy_carts
  union all select 'carts_not_null_user_id', count(*) filter (user_id is null) from messy_carts
  union all select 'carts_not_null_product_id', count(*) filter (product_id is null) from messy_carts
  union all select 'carts_not_null_quantity', count(*) filter (quantity is null) from messy_carts
  union all select 'carts_not_null_ds', count(*) filter (ds is null) from messy_carts
  union all select 'carts_quantity_positive', count(*) filter (quantity < 1) from messy_carts
  union all select 'carts_compound_pk', count(*) from (
    select 1 from messy_carts group by cart_id, product_id having count(*) > 1)
  union all select 'carts_user_id_in_users', count(*) from messy_carts c
    where user_id is not null and not exists (select 1 from users u where u.user_id = c.user_id)
  union all select 'carts_product_id_in_products', count(*) from messy_carts c
    where product_id is not null and not exists (select 1 from parents p where p.product_id = c.product_id)),
report as (
  select test_name, 'l1' as layer, 'carts' as resource, date '{DAY}' as ds,
         case when failures > 0 then 'fail' else 'pass' end as status, failures from failed
  union all select 'absent_not_null', 'l1', 'carts', date '{DAY}', 'skipped', null)"""


def _report(spark, sf_dir):
    wanted = [*_carts_rules(spark, sf_dir), dq.not_null("absent_not_null", "absent")]
    return dq.report(adapters.messy_carts(spark, sf_dir), wanted, "l1", "carts", DAY)


@query("dq_report", f"{REPORT} select * from report")
def dq_report(spark, sf_dir):
    """Stored and read back."""
    return dq.write_report(_report(spark, sf_dir), scratch_dir(spark, "report"), "l1", "carts", DAY)


@query("dq_status_counts", f"{REPORT} select status, count(*) as tests from report group by all")
def dq_status_counts(spark, sf_dir):
    return dq.status_counts(_report(spark, sf_dir))


@query("dq_basic_checks", f"""{MESSY}, failed as (
  select 'products_not_null_title' as test_name, count(*) filter (title is null) as failures from messy_products
  union all select 'products_not_null_price', count(*) filter (price is null) from messy_products
  union all select 'products_gt_zero_price', count(*) filter (price <= 0) from messy_products
  union all select 'cfg_not_null_product_id', count(*) filter (product_id is null) from messy_products
  union all select 'cfg_not_null_title', count(*) filter (title is null) from messy_products
  union all select 'products_unique_product_id', count(*) - count(distinct coalesce(product_id, -1)) from messy_products
  union all select 'cfg_unique', count(*) - count(distinct coalesce(product_id, -1)) from messy_products)
select test_name, 'staging' as layer, 'products' as resource, date '{DAY}' as ds,
       case when failures > 0 then 'fail' else 'pass' end as status, failures from failed""")
def dq_basic_checks(spark, sf_dir):
    """Pre-load checks of a resource and of its config."""
    wanted = dq.basic_checks("products", PRODUCTS_CONFIG)
    return dq.report(adapters.messy_products(spark, sf_dir), wanted, "staging", "products", DAY)


@query("quarantine_rows", f"""{MESSY}, {PARENTS}, q as (
  select 'carts_not_null_product_id' as test_name, cart_id, user_id, product_id, quantity, ds as row_ds,
         null::bigint as n_records from messy_carts where product_id is null
  union all select 'carts_quantity_positive', cart_id, user_id, product_id, quantity, ds, null from messy_carts
    where quantity < 1
  union all select 'carts_compound_pk', cart_id, null, product_id, null, null, count(*) from messy_carts
    group by cart_id, product_id having count(*) > 1
  union all select 'carts_user_id_in_users', null, user_id, null, null, null, count(*) from messy_carts c
    where user_id is not null and not exists (select 1 from users u where u.user_id = c.user_id) group by user_id
  union all select 'carts_product_id_in_products', null, null, product_id, null, null, count(*) from messy_carts c
    where product_id is not null and not exists (select 1 from parents p where p.product_id = c.product_id)
    group by product_id)
select *, date '{DAY}' as ds from q""")
def quarantine_rows(spark, sf_dir):
    """Violations written by test and read back."""
    path = scratch_dir(spark, "quarantine")
    carts, wanted = adapters.messy_carts(spark, sf_dir), _carts_rules(spark, sf_dir)
    failed = dq.failed_rules(dq.report(carts, wanted, "l1", "carts", DAY), wanted)
    dq.quarantine(carts, failed, path, "l1", "carts", DAY)
    return spark.read.parquet(f"{path}/l1/carts").withColumn("ds", F.col("ds").cast("date"))
