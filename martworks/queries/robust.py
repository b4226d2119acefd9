"""Input that is sparse, odd or large, and tables that outlive a process."""

from __future__ import annotations

from pyspark.sql import functions as F

from martworks.operators import kpi
from martworks.plans import marts
from martworks.plans.resources import RAW_SCHEMAS
from martworks.queries.loading import fresh_table
from martworks.queries.registry import CARTS, PRODUCT_DAYS, PRODUCTS, query
from martworks.session import scratch_dir
from martworks.sources import adapters, exports, raw, tables

DAY = "2025-11-08"


@query("raw_sparse_records", """
select case when c_custkey % 3 <> 0 then c_custkey::varchar end as id,
       case when c_custkey % 3 = 1 then c_name end as username from customer""")
def raw_sparse_records(spark, sf_dir):
    """A third of the records fills no field of the schema; none is lost."""
    root = scratch_dir(spark, "raw")
    users = adapters.raw_users(spark, sf_dir).select("id", "username")
    third = F.col("id").cast("bigint") % 3
    sparse = users.select(F.when(third != 0, F.col("id")).alias("id"), F.when(third == 1, F.col("username")).alias("username"),
                          F.lit(1).alias("other"))
    raw.write_raw(sparse, root, "users", DAY, "customer")
    return raw.read_raw(spark, root, "users", DAY, RAW_SCHEMAS["users"]).select("id", "username")


@query("raw_odd_records", """
select c_custkey::varchar as id, case when c_custkey % 2 = 1 then split_part(c_name, '#', 1) end as firstname,
       c_custkey % 2 = 0 as odd from customer
union all select null, null, true from customer where c_custkey % 5 = 0""")
def raw_odd_records(spark, sf_dir):
    """Half of the users have a text where a struct belongs, which reads as null; a line that is no JSON is told apart."""
    path = scratch_dir(spark, "odd")
    users = adapters.raw_users(spark, sf_dir).select("id", "name")
    key = F.col("id").cast("bigint")
    good = F.to_json(F.struct("id", "name"))
    odd = F.to_json(F.struct("id", F.lit("n/a").alias("name")))
    lines = users.select(F.when(key % 2 == 1, good).otherwise(odd).alias("value")).unionByName(
        users.where(key % 5 == 0).select(F.lit('{"id": ').alias("value")))
    lines.write.text(path)
    records = raw.read_json(spark, path, RAW_SCHEMAS["users"], lenient=True)
    return records.select("id", F.col("name.firstname").alias("firstname"), F.col(raw.CORRUPT).isNotNull().alias("odd"))


@query("staging_emptied_day", f"with {CARTS} select * from carts where ds = date '1997-01-01'")
def staging_emptied_day(spark, sf_dir):
    """A day staged again without rows is empty afterwards; the other days stay."""
    root = scratch_dir(spark, "lake")
    carts = adapters.carts(spark, sf_dir)
    for day in ("1996-01-01", "1997-01-01"):
        raw.write_staging_day(exports.export_rows(carts, day), root, "carts", day)
    raw.write_staging_day(exports.export_rows(carts, "1996-01-01").where("cart_id is null"), root, "carts", "1996-01-01")
    days = [raw.read_staging(spark, root, "carts", day) for day in ("1996-01-01", "1997-01-01")]
    return days[0].unionByName(days[1])


@query("load_case_names", f"""with {PRODUCTS}, {PRODUCT_DAYS}
select product_id, title, price, ds from product_days""")
def load_case_names(spark, sf_dir):
    """The second batch spells its columns in another case; its values land in the table's columns."""
    days = adapters.product_days(spark, sf_dir).select("product_id", "title", "price", "ds")
    table = fresh_table(spark, "products")
    tables.append_rows(days.where("ds = date '1996-01-01'"), table)
    second = days.where("ds = date '1997-01-01'").toDF("PRODUCT_ID", "Title", "Price", "ds")
    tables.append_rows(second, table)
    return spark.table(table)


@query("load_reopened", f"""with {CARTS}
select * from carts where ds in (date '1996-01-01', date '1997-01-01')""")
def load_reopened(spark, sf_dir):
    """The catalogue forgets the table while its files stay; the next day is loaded beside the first."""
    carts = adapters.carts(spark, sf_dir)
    table = fresh_table(spark, "carts")
    tables.replace_partition(exports.export_rows(carts, "1996-01-01"), table)
    spark.sql(f"DROP TABLE {table}")
    tables.replace_partition(exports.export_rows(carts, "1997-01-01"), table)
    return spark.table(table)


@query("export_csv_exact", """
select p_partkey as product_id, p_name || ' "x", ' as title, ' lead' || chr(10) || p_brand as description,
       case when p_size > 25 then '' end as note from part""")
def export_csv_exact(spark, sf_dir):
    """Blanks at the ends, quotes, separators, line breaks, empty texts and nulls come back as they were."""
    rows = adapters.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.concat("p_name", F.lit(' "x", ')).alias("title"),
        F.concat(F.lit(" lead\n"), "p_brand").alias("description"), F.when(F.col("p_size") > 25, F.lit("")).alias("note"))
    path = scratch_dir(spark, "csv")
    exports.write_csv(rows, path)
    return exports.read_csv(spark, path, rows.schema)


@query("fact_sales_fine_prices", f"""with {PRODUCTS}, {CARTS}
select c.product_id, count(*) as n, sum(((p.price * 100)::bigint + 123) * c.quantity)::double as millionths
from carts c join products p using (product_id) group by 1""")
def fact_sales_fine_prices(spark, sf_dir):
    """Prices of a few millionths keep all their decimals."""
    tiny = (F.round(F.col("price") * 100).cast("bigint") + 123).cast("decimal(20,0)") / F.lit(1000000).cast("decimal(7,0)")
    products = adapters.products(spark, sf_dir).withColumn("price", tiny.cast("decimal(21,8)"))
    fact = marts.fact_sales(marts.stg_carts(adapters.carts(spark, sf_dir)), marts.stg_products(products))
    sums = fact.where("price is not null").groupBy("product_id").agg(
        F.count("*").alias("n"), F.sum("total_sales").alias("total"))
    return sums.select("product_id", "n", (F.col("total") * 1000000).cast("double").alias("millionths"))


@query("revenue_large", f"""with {PRODUCTS}, {CARTS}
select c.order_date::date as day, sum(c.quantity::hugeint * 1000000000 * p.price::decimal(18, 2))::double as revenue
from carts c join products p using (product_id) group by 1""")
def revenue_large(spark, sf_dir):
    """Quantities in the billions: revenue of a day passes ten to the fourteenth."""
    carts = adapters.carts(spark, sf_dir).withColumn("quantity", F.col("quantity") * F.lit(1000000000))
    fact = marts.fact_sales(marts.stg_carts(carts), marts.stg_products(adapters.products(spark, sf_dir)))
    return kpi.daily_sales(fact)
