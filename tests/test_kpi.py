import datetime as dt

import numpy as np
import pytest

from martworks.operators import kpi

FACT = "transaction_id string, product_id int, product_name string, category string, quantity double, " \
       "total_sales double, transaction_date timestamp_ntz"


@pytest.fixture
def fact(spark):
    a, b = dt.datetime(2025, 1, 1, 23), dt.datetime(2025, 1, 2)
    return spark.createDataFrame([
        ("t1", 1, "p1", "x", 2.0, 20.0, a), ("t1", 2, None, "x", 1.0, None, b), ("t2", 2, "p2", None, 1.0, 20.0, b),
        (None, None, None, "y", None, None, None), ("t3", 3, "p3", "z", 1.0, 5.0, a),
    ], FACT)


def test_summary(fact, rows):
    assert rows(kpi.summary(fact)) == [(45.0, 3, 5, 3, 15.0)]
    assert rows(kpi.summary(fact.where("false"))) == [(0.0, 0, 0, 0, 0.0)]
    carts = fact.withColumnRenamed("transaction_id", "cart_id")
    assert rows(kpi.summary(carts), "orders") == [(3,)]


def test_groups_drop_null_keys_and_sum_nothing_to_zero(fact, rows):
    assert rows(kpi.revenue_by(fact, "category")) == [("x", 20.0), ("y", 0.0), ("z", 5.0)]
    assert rows(kpi.revenue_by(fact, "product_id", "product_name")) == [
        (1, "p1", 20.0), (2, "p2", 20.0), (3, "p3", 5.0),
    ]


def test_days_and_ties(fact, rows):
    first, second = dt.date(2025, 1, 1), dt.date(2025, 1, 2)
    assert rows(kpi.daily_sales(fact)) == [(first, 25.0), (second, 20.0)]
    assert rows(kpi.best_day(fact)) == [(first, 25.0)]
    assert rows(kpi.best_day(fact.where("product_id < 3"))) == [(first, 20.0)]
    assert rows(kpi.top_products(fact, 1)) == [(1, "p1", 20.0)]
    assert [r["category"] for r in kpi.top_categories(fact).collect()] == ["x", "z", "y"]
    assert rows(kpi.best_day(fact.where("false"))) == []


@pytest.mark.parametrize("values, bins", [
    ([0.1 * i for i in range(100)], 30),
    ([1.0, 1.1, 1.2, 1.3, 2.0, 3.0, 10.0], 3),
    ([5.0] * 4, 30),
    ([-2.0, -1.9999999999999998, 7.3, 0.0], 7),
    (list(np.random.default_rng(3).normal(size=500).round(2)), 30),
])
def test_histogram_bins_as_numpy(spark, rows, values, bins):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "price double")
    expected = np.histogram(values, bins=bins)[0]
    assert rows(kpi.histogram(df, "price", bins)) == sorted(
        ((i + 1, int(n)) for i, n in enumerate(expected)), key=repr
    )


def test_head(fact):
    assert [r["product_id"] for r in kpi.head(fact, ["transaction_date", "product_id"]).collect()] == [1, 3, 2]
