import datetime as dt

import pytest

from martworks.plans import marts

D1, D2 = dt.date(2025, 1, 1), dt.date(2025, 1, 2)


@pytest.fixture
def products(spark):
    return marts.stg_products(spark.createDataFrame([
        (1, "one", "  Toys ", 1.5, D1), (1, "one", "toys", 2.5, D2), (2, "two", None, 3.0, D1), (2, "two", None, 3.0, D2),
        (None, "none", "x", 1.0, D1),
    ], "product_id int, title string, category string, price double, ds date"))


@pytest.fixture
def carts(spark):
    return spark.createDataFrame([
        (1, 1, 2, dt.datetime(2025, 1, 5, 6), D1), (1, 2, 1, None, D1), (2, 9, 1, dt.datetime(2025, 1, 6), D2),
        (3, None, None, None, D2),
    ], "cart_id int, product_id int, quantity int, order_date timestamp_ntz, ds date")


def test_every_product_day_matches(carts, products, rows):
    fact = marts.fact_sales(marts.stg_carts(carts), products)
    assert rows(fact.selectExpr("product_id", "double(total_sales)", "category")) == sorted([
        (1, 3.0, "toys"), (1, 5.0, "toys"), (2, 3.0, None), (2, 3.0, None), (9, None, None), (None, None, None),
    ], key=repr)


def test_latest_product_keeps_one(carts, products, rows):
    fact = marts.fact_sales(marts.stg_carts(carts), products, latest_product=True)
    assert rows(fact.selectExpr("product_id", "double(total_sales)")) == sorted(
        [(1, 5.0), (2, 3.0), (9, None), (None, None)], key=repr
    )


def test_dim_product(products, rows):
    assert rows(marts.dim_product(products).selectExpr("product_id", "double(price)", "last_ingested_ds")) == sorted(
        [(1, 1.5, D2), (1, 2.5, D2), (2, 3.0, D2), (None, 1.0, D1)], key=repr
    )
    latest = marts.dim_product(products, latest_product=True)
    assert rows(latest.selectExpr("product_id", "double(price)", "last_ingested_ds")) == sorted(
        [(1, 2.5, D2), (2, 3.0, D2), (None, 1.0, D1)], key=repr
    )


def test_transaction_date_falls_back(carts, rows):
    day = dt.datetime(2025, 1, 1)
    dated = [(None,), (dt.datetime(2025, 1, 5, 6),)]
    assert rows(marts.stg_carts(carts, "2025-01-01"), "transaction_date") == dated
    named = carts.withColumnRenamed("order_date", "Date")
    assert rows(marts.stg_carts(named, "2025-01-01"), "transaction_date") == dated
    bare = carts.drop("order_date")
    assert rows(marts.stg_carts(bare, "2025-01-01"), "transaction_date") == [(day,), (day,)]


def test_batch_filter(products, carts):
    assert marts.stg_carts(carts).count() == 4
    assert marts.stg_carts(carts, "2025-01-02").count() == 2
