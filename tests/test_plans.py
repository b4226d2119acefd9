"""Plans that have to hold at scale: pruning, pushdown, one pass, no Python, split hot keys."""

import re

from pyspark.sql import functions as F

from martworks import session
from martworks.operators import kpi
from martworks.operators import quality as dq
from martworks.plans import marts
from martworks.sources import adapters, raw

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    execution = df._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    return execution.executedPlan().toString()


def test_scans_read_only_what_is_used(spark):
    text = plan(marts.fact_sales(
        marts.stg_carts(adapters.carts(spark, SF), "1997-01-01"),
        marts.stg_products(adapters.products(spark, SF), "1997-01-01"),
    ))
    schemas = sorted(re.findall(r"ReadSchema: struct<([^>]*)>", text))
    assert schemas == [
        "l_orderkey:bigint,l_partkey:bigint,l_quantity:double",
        "o_orderkey:bigint,o_orderdate:timestamp_ntz",
        "p_partkey:bigint,p_name:string,p_type:string,p_size:int,p_retailprice:double",
    ]


def test_staging_prunes_days(spark, tmp_path):
    raw.write_staging(adapters.carts(spark, SF), str(tmp_path), "carts")
    files = raw.read_staging(spark, str(tmp_path), "carts", "1997-01-01").inputFiles()
    assert files and all("/ds=1997-01-01/" in name for name in files)


def test_row_filters_reach_the_scan(spark):
    parts = adapters.table(spark, SF, "part")
    text = plan(dq.row_violations(parts, [dq.above_zero("a", "p_retailprice"), dq.at_least("b", "p_size", 1)]))
    assert re.search(r"PushedFilters: \[Or\(", text)
    assert text.count("FileScan") == 1


def test_all_row_rules_take_one_scan(spark):
    parts = adapters.table(spark, SF, "part")
    rules = [dq.not_null(f"n_{c}", c) for c in parts.columns] + [dq.above_zero("z", "p_retailprice")]
    assert plan(dq.failures(parts, rules)).count("FileScan") == 1


def test_dim_product_has_no_window(spark):
    text = plan(marts.dim_product(marts.stg_products(adapters.product_days(spark, SF))))
    assert "Window" not in text


def test_summary_copies_no_rows(spark):
    lines = adapters.carts(spark, SF).withColumn("total_sales", F.col("quantity") * 2)
    assert "Expand" not in plan(kpi.summary(lines))


def hot_carts(spark, n=200_000):
    """A third of all lines sell product 7, another third have no product."""
    product = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("id")).cast("bigint")
    return spark.range(0, n, 1, 8).select(
        F.col("id").alias("cart_id"), product.alias("product_id"), F.lit(2).cast("bigint").alias("quantity"),
        F.lit("2025-01-01").cast("timestamp_ntz").alias("order_date"), F.lit("2025-01-01").cast("date").alias("ds"),
    )


def test_hot_and_missing_products_are_split(spark):
    n = 200_000
    products = spark.range(0, n, 1, 8).select(
        F.col("id").alias("product_id"), F.concat(F.lit("p"), "id").alias("title"), F.lit("toys").alias("category"),
        F.lit(1.5).alias("price"), F.lit("2025-01-01").cast("date").alias("ds"),
    )
    with (
        session.setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"),
        session.setting(spark, "spark.sql.adaptive.autoBroadcastJoinThreshold", "-1"),
        session.setting(spark, "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64k"),
        session.setting(spark, "spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2"),
        session.setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k"),
        session.setting(spark, "spark.sql.shuffle.partitions", "16"),
    ):
        fact = marts.fact_sales(marts.stg_carts(hot_carts(spark, n)), marts.stg_products(products))
        text = final_plan(fact)
        assert "SortMergeJoin(skew=true)" in text
        assert fact.count() == n
        assert fact.where("product_id = 7 and total_sales = 3").count() == len(range(0, n, 3)) + 1
        assert fact.where("product_id is null and total_sales is null").count() == len(range(2, n, 3))


def test_hot_keys_are_merged_before_the_shuffle(spark):
    text = plan(dq.key_violations(hot_carts(spark, 100), dq.unique("u", "product_id")))
    assert text.count("HashAggregate") == 2
    assert text.index("Exchange") < text.rindex("HashAggregate")


def test_scratch_follows_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    path = session.scratch_dir(spark, "x")
    assert "/martworks/x-" in path
    assert shared is None or path.startswith(shared)
