import datetime as dt
import uuid

import pytest

from martworks.operators import kpi
from martworks.plans import partials
from martworks.sources import tables

D1, D2 = dt.date(2025, 1, 1), dt.date(2025, 1, 2)
SCHEMA = "cart_id bigint, product_id int, quantity bigint, total_sales decimal(20,2), ds date"


def lines(spark, *rows):
    return spark.createDataFrame(rows, "cart_id bigint, product_id int, quantity bigint, total_sales double, ds date").selectExpr(
        "cart_id", "product_id", "quantity", "cast(total_sales as decimal(20,2)) as total_sales", "ds")


@pytest.fixture
def fact(spark):
    return lines(spark, (1, 1, 2, 0.1, D1), (1, 2, 1, 0.2, D1), (1, 2, 1, 5.0, D2), (-7, 70_000, 1, None, D2),
                 (None, None, 3, 1.5, D2), (2**40, 2, None, 1.0, None), (32_768, 32_769, 1, 1.0, D1))


def test_partials_give_the_row_of_the_lines(fact, rows):
    parts = partials.daily_partials(fact)
    assert rows(partials.summary(parts)) == rows(kpi.summary(fact))
    assert rows(partials.summary(parts, [D2])) == rows(kpi.summary(fact.where("ds = date'2025-01-02'")))
    assert rows(partials.summary(partials.daily_partials(fact.where("false")))) == [(0.0, 0, 0, 0, 0.0)]


def test_a_day_loaded_again_replaces_its_partial(spark, fact, tmp_path, rows):
    database = f"p_{uuid.uuid4().hex}"
    tables.ensure_database(spark, database, str(tmp_path / "db"))
    table = f"{database}.parts"
    dated = fact.where("ds is not null")
    partials.load(dated, table, many_days=True)
    again = lines(spark, (9, 9, 1, 2.0, D2))
    partials.load(again, table)
    assert rows(partials.summary(spark.table(table))) == rows(
        kpi.summary(dated.where("ds = date'2025-01-01'").unionByName(again)))


def test_lines_are_scanned_once_and_summed_before_the_shuffle(spark, tmp_path):
    spark.range(10).selectExpr("id as cart_id", "id as product_id", "id as quantity", "id as total_sales",
                               "date'2025-01-01' as ds", "'x' as other").write.parquet(str(tmp_path / "lines"))
    plan = partials.daily_partials(spark.read.parquet(str(tmp_path / "lines")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and "partial_bitmap_construct_agg" in plan
    assert "other" not in plan


def test_ids_that_are_text_raise(fact):
    with pytest.raises(TypeError, match="cart_id"):
        partials.daily_partials(fact.withColumn("cart_id", fact.cart_id.cast("string")))
