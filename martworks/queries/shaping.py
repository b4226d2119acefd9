"""Reshaping, config projection and casts."""

from __future__ import annotations

from pyspark.sql import functions as F

from martworks.functions.coerce import to_bool, to_float, to_int, to_text, to_timestamp
from martworks.functions.paths import lookup
from martworks.functions.scalars import clean_category, valid_ds
from martworks.operators import project, reshape
from martworks.plans.batch import to_columns
from martworks.plans.resources import PRODUCTS_CONFIG, USERS_CONFIG
from martworks.queries.registry import query
from martworks.sources import adapters

CART_ITEMS = """
items as (
  select l_orderkey, l_suppkey, l_shipdate, l_partkey as product_id, l_quantity::bigint as quantity
  from lineitem where l_linenumber <> 7 and l_returnflag in ('R', 'A')
  union all
  select l_orderkey, l_suppkey, l_shipdate, l_suppkey, l_linenumber::bigint
  from lineitem where l_linenumber <> 7 and l_returnflag = 'R'
  union all
  select l_orderkey, l_suppkey, l_shipdate, null, null
  from lineitem where l_linenumber = 7 or l_returnflag = 'N'
)"""


@query("explode_cart_lines", f"""with {CART_ITEMS}
select l_orderkey as id, l_suppkey as "userId", strftime(l_shipdate, '%Y-%m-%d') || 'T00:00:00.000Z' as date,
       product_id as "products_productId", quantity::double as products_quantity from items""")
def explode_cart_lines(spark, sf_dir):
    return reshape.explode_items(adapters.raw_carts(spark, sf_dir))


@query("explode_outer_empty", f"""with {CART_ITEMS}
select l_orderkey as id, product_id as "products_productId", quantity as products_quantity
from items""")
def explode_outer_empty(spark, sf_dir):
    """Generic explode of a list of objects; empty and null lists keep a row."""
    raw = adapters.raw_carts(spark, sf_dir).select("id", "products")
    return reshape.explode_column(raw, "products")


@query("explode_scalar_list", """
select l_orderkey as id, unnest(case l_returnflag when 'R' then [l_partkey, l_suppkey] when 'A' then [l_partkey]
                                else [null] end) as codes_value from lineitem""")
def explode_scalar_list(spark, sf_dir):
    """Generic explode of a list of plain values."""
    codes = F.when(F.col("l_returnflag") == "R", F.array("l_partkey", "l_suppkey")).when(
        F.col("l_returnflag") == "A", F.array("l_partkey")
    )
    raw = adapters.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), codes.alias("codes"))
    return reshape.explode_column(raw, "codes")


@query("explode_string_encoded", """
select l_orderkey as id, l_suppkey as "userId", l_partkey as "products_productId", l_quantity as products_quantity
from lineitem where l_linenumber <> 7
union all
select l_orderkey, l_suppkey, l_suppkey, l_linenumber::double from lineitem
where l_linenumber <> 7 and l_returnflag = 'R'
union all
select l_orderkey, l_suppkey, l_partkey, null from lineitem where l_linenumber <> 7 and l_returnflag = 'N'
union all
select l_orderkey, l_suppkey, null, null from lineitem where l_linenumber = 7""")
def explode_string_encoded(spark, sf_dir):
    """Lists sent as JSON text, as a lone object or as a Python literal; junk keeps a row."""
    return reshape.explode_items(adapters.text_carts(spark, sf_dir))


@query("config_products", """
select p_partkey as product_id, p_name || ' ' as title,
       case when p_size > 10 then p_brand else '' end as description,
       case when p_size <= 40 then p_retailprice end as price,
       case when p_type <> 'PROMO' then p_type else 'unknown' end as category,
       'img/' || p_partkey || '.png' as image_url, p_size / 8 as rating_rate,
       case when p_size < 30 then p_size else 0 end::bigint as rating_count, length(p_name) + 1 as title_len
from part""")
def config_products(spark, sf_dir):
    return project.apply_config(adapters.raw_products(spark, sf_dir), PRODUCTS_CONFIG)


@query("config_carts", f"""with {CART_ITEMS}
select l_orderkey as cart_id, l_suppkey as user_id, date_trunc('day', l_shipdate)::timestamp as order_date, product_id,
       quantity, date '2025-11-08' as ds from items""")
def config_carts(spark, sf_dir):
    return to_columns("carts", adapters.raw_carts(spark, sf_dir), "2025-11-08")


@query("config_users", """
select c_custkey as user_id, c_name as username, lower(c_name) || '@' || lower(c_mktsegment) || '.com' as email,
       lower(c_mktsegment) || '.com' as email_domain, '1-' || c_nationkey as phone,
       split_part(c_name, '#', 1) as first_name, split_part(c_name, '#', 2) as last_name,
       replace(c_name, '#', ' ') as full_name, 'Main St' as address_street, c_nationkey::bigint as address_number,
       case when c_acctbal > 0 then c_mktsegment else '' end as address_city, '' as address_zip,
       c_acctbal as geo_lat, null::double as geo_lng
from customer""")
def config_users(spark, sf_dir):
    """Allow-list projection: the password in the raw records is not selected."""
    return project.apply_config(adapters.raw_users(spark, sf_dir), USERS_CONFIG)


LEGACY = {
    "explode": ["products"],
    "flatten": {"products_productId": "code"},
    "rename": {"id": "cart_id", "userId": "user_id"},
    "select": ["id", "user_id", "products.quantity", "code", "date"],
    "casts": {"code": "str", "products_quantity": "float", "date": "timestamp"},
    "fillna": {"products_quantity": 0, "code": "none"},
    "drop": ["user_id", "absent"],
}


@query("config_legacy", f"""with {CART_ITEMS}
select l_orderkey as cart_id, coalesce(quantity, 0)::double as products_quantity,
       coalesce(product_id::varchar, 'none') as code, date_trunc('day', l_shipdate)::timestamp as date from items""")
def config_legacy(spark, sf_dir):
    return project.apply_config(adapters.raw_carts(spark, sf_dir), LEGACY)


@query("cast_losses", """
select 'price' as "column", count(*) filter (p_size > 40) as lost from part
union all select 'rating_count', count(*) filter (p_size >= 30) from part
union all select c, 0 from (values ('product_id'), ('title'), ('description'), ('category'), ('image_url'),
                                   ('rating_rate')) t(c)""")
def cast_losses(spark, sf_dir):
    return project.cast_losses(adapters.raw_products(spark, sf_dir), PRODUCTS_CONFIG)


USERS_FLAT = """
select c_custkey::varchar as id, lower(c_name) || '@' || lower(c_mktsegment) || '.com' as email, c_name as username,
       'secret' as password, '1-' || c_nationkey as phone,
       split_part(c_name, '#', 1) as name_firstname, split_part(c_name, '#', 2) as name_lastname,
       case when c_acctbal > 0 then c_mktsegment end as address_city, 'Main St' as address_street,
       c_nationkey::varchar as address_number, c_acctbal::varchar as address_geolocation_lat,
       'x' || c_nationkey as address_geolocation_long
from customer"""


@query("flatten_struct", f"select * exclude (address_geolocation_lat) from ({USERS_FLAT})")
def flatten_struct(spark, sf_dir):
    return reshape.flatten(adapters.raw_users(spark, sf_dir)).drop("address_geolocation_lat")


@query("auto_flatten", f"select * exclude (address_geolocation_lat) from ({USERS_FLAT})")
def auto_flatten(spark, sf_dir):
    return reshape.auto_flatten(adapters.raw_users(spark, sf_dir)).drop("address_geolocation_lat")


@query("path_lookup", """
select l_orderkey as id,
       case when l_linenumber <> 7 and l_returnflag in ('R', 'A') then l_partkey end as first_product,
       case when l_linenumber <> 7 and l_returnflag = 'R' then l_linenumber::bigint end as second_quantity,
       null::bigint as ninth_product, null::varchar as dead
from lineitem""")
def path_lookup(spark, sf_dir):
    raw = adapters.raw_carts(spark, sf_dir)
    paths = {
        "products.0.productId": "first_product",
        "products.1.quantity": "second_quantity",
        "products.9.productId": "ninth_product",
        "products.-1.productId": "dead",
    }
    return reshape.copy_paths(raw, paths).select("id", *paths.values())


@query("column_steps", """
select c_mktsegment as segment, c_custkey as id, c_name, coalesce(c_acctbal::varchar, '') <> '' as has_balance
from customer""")
def column_steps(spark, sf_dir):
    """Rename, order, drop and fill, each on the columns that are present."""
    raw = adapters.table(spark, sf_dir, "customer").withColumn("has_balance", F.col("c_acctbal").isNotNull())
    renamed = project.rename_columns(raw, {"c_custkey": "id", "c_mktsegment": "segment", "absent": "x"})
    filled = project.fill_nulls(renamed, {"has_balance": False, "absent": 0})
    return project.order_columns(filled, ["segment", "absent", "id"]).drop("c_acctbal", "c_nationkey", "absent")


@query("lenient_casts", """
select o_orderkey, case when o_totalprice = floor(o_totalprice) then o_totalprice::bigint end as whole,
       o_totalprice as number, null::bigint as no_int, null::double as no_number,
       o_orderpriority <> '' as truth, o_orderkey <> 0 as key_truth,
       o_orderdate::timestamp as iso_time, o_orderdate::timestamp as us_time, null::timestamp as no_time,
       o_orderkey::varchar as text, case when o_orderkey <> 0 then 'True' else 'False' end as truth_text,
       (o_orderkey * 10)::bigint as exponent, coalesce(null::bigint, -1) as defaulted
from orders""")
def lenient_casts(spark, sf_dir):
    raw = adapters.table(spark, sf_dir, "orders")
    types = {f.name: f.dataType for f in raw.schema.fields}
    text = types["o_orderpriority"]
    price = F.col("o_totalprice").cast("string")
    priority = F.col("o_orderpriority")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    truth = F.col("o_orderkey") != 0
    return raw.select(
        "o_orderkey",
        to_int(price, text).alias("whole"),
        to_float(price, text).alias("number"),
        to_int(priority, text).alias("no_int"),
        to_float(priority, text).alias("no_number"),
        to_bool(priority, text).alias("truth"),
        to_bool(F.col("o_orderkey"), types["o_orderkey"]).alias("key_truth"),
        to_timestamp(F.concat(day, F.lit("T00:00:00.000Z")), text).alias("iso_time"),
        to_timestamp(F.date_format("o_orderdate", "MM/dd/yyyy"), text).alias("us_time"),
        to_timestamp(priority, text).alias("no_time"),
        to_text(F.col("o_orderkey"), types["o_orderkey"]).alias("text"),
        to_text(truth, raw.select(truth.alias("t")).schema["t"].dataType).alias("truth_text"),
        to_int(F.concat(F.col("o_orderkey").cast("string"), F.lit("e1")), text).alias("exponent"),
        F.coalesce(to_int(priority, text), F.lit(-1)).alias("defaulted"),
    )


@query("clean_categories", """
select lower(trim('  ' || upper(p_type[1]) || lower(p_type[2:]) || ' ')) as category, count(*) as products
from part group by all""")
def clean_categories(spark, sf_dir):
    products = adapters.products(spark, sf_dir)
    return products.groupBy(clean_category(F.col("category")).alias("category")).agg(
        F.count(F.lit(1)).alias("products")
    )


@query("valid_ds", """
select o_orderkey, true as good, false as short, false as text from orders""")
def valid_days(spark, sf_dir):
    raw = adapters.table(spark, sf_dir, "orders")
    return raw.select(
        "o_orderkey",
        valid_ds(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("good"),
        valid_ds(F.date_format("o_orderdate", "yy-M-d")).alias("short"),
        valid_ds(F.col("o_orderpriority")).alias("text"),
    )


@query("json_props", """
select event_id, json_extract_string(props, '$.k')::bigint as props_k from events""")
def json_props(spark, sf_dir):
    """JSON text to typed fields, through the same config path as nested records."""
    raw = adapters.table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k string").alias("props"))
    config = {"select": {"event_id": {"type": "int"}, "props_k": {"path": "props.k", "type": "int"}}}
    return project.apply_config(raw, config)
